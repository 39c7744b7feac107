"""Exact n-gram Jaccard join by universe partition.

Sets fall into size bands. The tokens of a set are hashed into the segments of a band; two sets that
differ in at most H tokens agree on segments of total weight above the band's slack, where a segment of
weight 1 must agree in full and one of weight 2 may differ in one token (it is indexed with its
one-deletion neighbourhood). `allocation` chooses the segments of a band by estimated cost; each set
leaves out its costliest segments within the slack: those with the fewest tokens that are not frequent
in the whole table. What shares a key is verified exactly on the token sets.

Copies (equal sets) form one class. Keys with few classes give all their pairs. Keys with many give a
star to their smallest document; after its links have been merged into components, only documents of
different components under one key are compared, in blocks of bounded size, so that nothing is left
out and no group is expanded into all pairs. Token identities are 64-bit hashes.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.links import components
from marketlens.llm.words import bounds, mix, run_ids, shingle_sets, slices, tidy, word_ids
from marketlens.session import settle

BAND_RATIO = 1.6
FREQUENT_SHARE = 1 / 2000  # a token in more than this share of documents is costly; bounds the broadcast
FREQUENT_LEAST = 20
FEW = 10                   # up to so many documents, a key gives all pairs
BLOCK = 1500               # documents of a block where a key is compared in blocks
BINS = 256                 # of the token histogram that bounds the difference of two sets from below
CANDIDATE_COST = 64.0


@functools.cache
def band_bounds(i: int) -> tuple[int, int]:
    """Smallest and largest set size of band i."""
    if i == 0:
        return 1, 1
    low = band_bounds(i - 1)[1] + 1
    return low, max(low, math.ceil(low * BAND_RATIO) - 1)


@functools.cache
def bands_of(n: int, percent: int) -> tuple[tuple[int, int], ...]:
    """(band, largest difference to a partner there) for the bands where a set of n meets partners of its size or more."""
    out, i = [], 0
    while band_bounds(i)[1] < n:
        i += 1
    most = n * 100 // percent
    while band_bounds(i)[0] <= most:
        out.append((i, difference(n, min(most, band_bounds(i)[1]), percent)))
        i += 1
    return tuple(out)


def difference(a: int, b: int, percent: int) -> int:
    """Largest symmetric difference of linked sets of these sizes."""
    return (a + b) * (100 - percent) // (100 + percent)


@functools.cache
def allocation(band: int, percent: int) -> tuple[int, int]:
    """Segments of weight 2 and of weight 1 of a band, least in keys plus expected chance candidates."""
    top = band_bounds(band)[1]
    need = difference(top, top, percent) + 1
    best = (math.inf, 0, 0)
    for wide in range(min(4, (need + 1) // 2) + 1):
        rest = max(0, need - 2 * wide)
        narrow = rest + (max(1, math.ceil(0.2 * rest)) if rest and need > 1 else 0)
        unit = top / (2 * wide + narrow)
        cost = rest * (1 + CANDIDATE_COST * 4.0 ** -unit)
        cost += wide * (1 + 2 * unit) * (1 + CANDIDATE_COST * 4.0 ** -(2 * unit - 1))
        best = min(best, (cost, wide, narrow))
    return best[1], best[2]


def signature_keys(tokens: np.ndarray, rare: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set; two linked sets share at least one of them.

    Where a set keeps an empty segment (or one of weight 2 with a single token), it also takes part in
    the next level, a new partition; two sets meet at the first level where one of them does not.
    """
    out = []
    scrambled = mix(tokens)
    for band, most in bands_of(len(tokens), percent):
        wide, narrow = allocation(band, percent)
        units, keep = 2 * wide + narrow, max(0, most + 1 - 2 * wide)
        for level in range(64):
            seed = np.uint64(((band + 1) << 40) + (level << 32))
            shift = np.uint64(int(seed) * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)
            unit = (mix(tokens + shift) % np.uint64(units)).astype(np.int64)
            sums = np.zeros(units, np.uint64)
            np.add.at(sums, unit, scrambled)
            sizes = np.bincount(unit, minlength=units)
            sparse = False
            if wide:
                both = sizes[:2 * wide].reshape(-1, 2).sum(1)
                total = sums[:2 * wide:2] + sums[1:2 * wide:2]
                sparse = bool((both < 2).any()) if len(tokens) > 1 else False
                place = np.arange(wide, dtype=np.uint64) + seed
                out.append(mix(total[both > 0] + mix(place[both > 0])))
                inside = np.flatnonzero(unit < 2 * wide)
                seg = unit[inside] // 2
                cut = inside[both[seg] > 1]
                seg = unit[cut] // 2
                out.append(mix(total[seg] - scrambled[cut] + mix(place[seg])))
            if keep:
                size, total = sizes[2 * wide:], sums[2 * wide:]
                cold = np.bincount(unit, weights=rare, minlength=units)[2 * wide:].astype(np.int64)
                order = np.argsort(-((cold << 40) + (size << 20) - np.arange(narrow)), kind="stable")[:keep]
                sparse = sparse or bool((size[order] == 0).any())
                order = order[size[order] > 0]
                out.append(mix(total[order] + mix((order + 2 * wide).astype(np.uint64) + (seed << np.uint64(1)))))
            if not sparse:
                break
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def frequent_tokens(texts: DataFrame, shingle: int) -> np.ndarray:
    """Sorted tokens that occur in more than FREQUENT_SHARE as many places as there are documents.

    Only the order of costs depends on them, never a result. Each batch reports what is frequent
    there; at most mean set size / FREQUENT_SHARE tokens can be frequent in the whole.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = [], []
            for row, end, data, offsets in slices(batch.column(0)):
                starts, ends, first = bounds(data, offsets)
                runs = run_ids(word_ids(data, starts, ends, True), shingle)
                u, c = np.unique(runs, return_counts=True)
                enough = c >= max(2, (end - row) * FREQUENT_SHARE / 2)
                values.append(u[enough])
                counts.append(c[enough])
            u, inv = np.unique(np.concatenate(values or [np.zeros(0, np.uint64)]), return_inverse=True)
            c = np.bincount(inv, weights=np.concatenate(counts or [np.zeros(0)]), minlength=len(u))
            yield pa.RecordBatch.from_arrays([
                pa.array([None, *u.view(np.int64).tolist()], pa.int64()),
                pa.array([batch.num_rows, *c.astype(np.int64).tolist()], pa.int64())], ["token", "n"])

    counted = settle(texts.mapInArrow(tidy(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    documents = counted.where("token is null").agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT_LEAST, documents * FREQUENT_SHARE)
    rows = counted.where("token is not null").where(F.col("n") >= F.lit(float(least))).select("token").toArrow()
    return np.sort(rows.column(0).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def _histogram(tokens: np.ndarray) -> bytes:
    return np.minimum(np.bincount((tokens >> np.uint64(56)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def _index(percent: int, shingle: int, parts: int, frequent: np.ndarray):
    """Rows of documents (part null) and packed keys of each batch by part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, sets in shingle_sets(batch.column(1), shingle):
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                doc = ids.slice(row, len(sets))
                yield _rows(doc=doc, n=pa.array([len(s) for s in sets], pa.int64()), digest=pa.array(digests, pa.binary()),
                            bins=pa.array([_histogram(s) for s in sets], pa.binary()))
                yield from _keys(doc.to_pylist(), sets, digests)

    def _keys(doc: list, sets: list, digests: list) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, int] = {}
        for i, digest in enumerate(digests):
            if digest is not None and doc[i] is not None and (digest not in first or doc[i] < doc[first[digest]]):
                first[digest] = i
        chosen = sorted(first.values(), key=lambda i: doc[i])
        if not chosen:
            return
        every = np.concatenate([sets[i] for i in chosen])
        at = np.searchsorted(frequent, every)
        rare = np.ones(len(every)) if not len(frequent) else (
            frequent[np.minimum(at, len(frequent) - 1)] != every).astype(float)
        cuts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in chosen])])
        keys = [signature_keys(sets[i], rare[cuts[j]:cuts[j + 1]], percent) for j, i in enumerate(chosen)]
        docs = np.repeat(np.array([doc[i] for i in chosen], np.int64), [len(k) for k in keys])
        keys = np.concatenate(keys)
        part = (keys >> np.uint64(32)) % np.uint64(parts)
        code = (part << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
        order = np.argsort(code, kind="stable")
        code, docs = code[order], docs[order]
        cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        size = np.diff(np.append(cut, len(code)))
        many = np.repeat(size > FEW, size)
        if many.any():  # only the star's centre goes on to meet other batches; documents ascend within a key
            yield _rows(part=pa.array([-1], pa.int32()), keys=pa.array([code[many].tobytes()], pa.binary()),
                        docs=pa.array([docs[many].tobytes()], pa.binary()))
        stay = ~many
        stay[cut] = True
        crowded = many[stay]
        code, docs = code[stay], docs[stay]
        back = np.lexsort((docs, code >> np.uint64(32)))
        code, docs, crowded = code[back], docs[back], crowded[back]
        group = (code >> np.uint64(32)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        ends = np.append(cut[1:], len(code))
        yield _rows(
            part=pa.array(group[cut], pa.int32()),
            keys=pa.array([(code[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for a, b in zip(cut, ends)], pa.binary()),
            docs=pa.array([np.diff(docs[a:b], prepend=0).tobytes() for a, b in zip(cut, ends)], pa.binary()),
            crowded=pa.array([np.packbits(crowded[a:b]).tobytes() if crowded[a:b].any() else None for a, b in zip(cut, ends)], pa.binary()))

    return run


INDEX_SCHEMA = "doc long, n long, digest binary, bins binary, part int, keys binary, docs binary, crowded binary"
_FIELDS = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("bins", pa.binary()),
                     ("part", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("crowded", pa.binary())])


def _rows(**columns: pa.Array) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FIELDS], schema=_FIELDS)


def _group(table: pa.Table) -> pa.Table:
    """Pairs and crowded memberships of the keys of one part."""
    part = table.column("part")[0].as_py()
    keys = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()])
    docs = np.concatenate([np.cumsum(np.frombuffer(x, np.int64)) for x in table.column("docs").to_pylist()])
    flags = np.concatenate([
        np.unpackbits(np.frombuffer(f, np.uint8), count=len(x) // 4).astype(bool) if f is not None else np.zeros(len(x) // 4, bool)
        for f, x in zip(table.column("crowded").to_pylist(), table.column("keys").to_pylist())])
    order = np.lexsort((docs, keys))
    keys, docs, flags = keys[order], docs[order], flags[order]
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(cut, len(keys)))
    crowd = np.logical_or.reduceat(flags, cut) | (size > FEW)
    which = np.repeat(np.arange(len(cut)), size)
    a, b = [], []
    for gap in range(1, FEW):
        left = np.arange(len(keys) - gap)
        left = left[(which[left] == which[left + gap]) & ~crowd[which[left]]]
        a.append(docs[left])
        b.append(docs[left + gap])
    lone = crowd[which]
    centre = docs[cut][which[lone]]
    a, b = np.concatenate([*a, centre]), np.concatenate([*b, docs[lone]])
    pairs = np.unique(np.stack([a[a != b], b[a != b]]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
    code = (keys[lone].astype(np.int64)) | (part << 32)
    return pa.table({"a": np.concatenate([pairs[0], docs[lone]]), "b": np.concatenate([pairs[1], np.zeros(lone.sum(), np.int64)]),
                     "code": pa.array(np.concatenate([np.zeros(pairs.shape[1], np.int64), code]),
                                      mask=np.arange(pairs.shape[1] + lone.sum()) < pairs.shape[1])})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Crowded memberships found within a batch of documents: to the star's centre, and by key."""
    for batch in batches:
        for keys, docs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            code, doc = np.frombuffer(keys, np.int64), np.frombuffer(docs, np.int64)
            cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            centre = np.repeat(doc[cut], np.diff(np.append(cut, len(code))))
            other = doc != centre
            pairs = np.unique(np.stack([centre[other], doc[other]]), axis=1)
            none = np.zeros(len(code), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(none), pa.array(code)], ["a", "b", "code"])
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(pairs.shape[1], pa.int64())], ["a", "b", "code"])


def _bin_filter(percent: int):
    """Drops pairs that sizes or histograms show to differ too much; never a linked pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16) for c in ("xa", "xb"))
                ok = (np.abs(x - y).sum(1) <= (na + nb) * (100 - percent) // (100 + percent)) & (
                    100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
                yield batch.select(["a", "b"]).filter(pa.array(ok))
    return run


def _overlap(percent: int) -> Column:
    """Whether two token sets are similar enough; taken row by row, so no batch holds the sets of many pairs."""
    return F.lit(100 + percent).cast("long") * F.size(F.array_intersect("xa", "xb")) >= percent * (F.size("xa") + F.size("xb")).cast("long")


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in shingle_sets(batch.column(1), shingle):
                tokens = pa.array(np.concatenate(sets).view(np.int64))
                ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), pa.ListArray.from_arrays(ends, tokens)], ["doc", "x"])
    return run


def _verified(pairs: DataFrame, rows: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough."""
    def with_sides(pairs: DataFrame, sides: DataFrame, *columns: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(sides.select(F.col("doc").alias(side), *[F.col(c).alias(c + side) for c in columns]), side)
        return pairs

    close = settle(with_sides(pairs, rows, "n", "x").mapInArrow(_bin_filter(percent), "a long, b long"))
    wanted = close.select(F.col("a").alias("doc")).union(close.select("b")).distinct()
    sets = settle(texts.join(wanted, "doc", "left_semi").select("doc", "text").mapInArrow(tidy(_sets(shingle)), "doc long, x array<long>"))
    return with_sides(close, sets, "x").where(_overlap(percent)).select("a", "b")


def _blocks(members: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Close pairs of different components under one key, compared in blocks of bounded size."""
    size = members.groupBy("code").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = (members.join(size, "code").join(rows.select(F.col("doc").alias("a"), "n", "x"), "a")
             .withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = dealt.select("code", "a", "component", "n", "x", "own",
                         F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        doc, comp, n, own, i = (table.column(c).to_numpy() for c in ("a", "component", "n", "own", "i"))
        j = table.column("j")[0].as_py()
        bins = np.frombuffer(b"".join(table.column("x").to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
        left = np.flatnonzero(own == i[0])
        right = np.flatnonzero(own == j)
        out = [np.zeros((2, 0), np.int64)]
        for at in left:
            near = right[(comp[right] != comp[at]) & (doc[right] != doc[at])]
            most = (n[near] + n[at]) * (100 - percent) // (100 + percent)
            near = near[np.abs(bins[near] - bins[at]).sum(1) <= most]
            out.append(np.stack([np.minimum(doc[near], doc[at]), np.maximum(doc[near], doc[at])]))
        pairs = np.unique(np.concatenate(out, axis=1), axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    return dealt.groupBy("code", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 80,
                    shingle: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of docs; other columns are not looked at.

    Texts without words (null, empty, blank) have the empty set and link with nothing. Rows without an
    id have no component and link with nothing. Rows that repeat an id are one node: it links if one of
    its texts does. Equal sets always link. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    parts = max(64, texts.rdd.getNumPartitions())
    frequent = frequent_tokens(texts.select("text"), shingle)
    index = settle(texts.mapInArrow(tidy(_index(percent, shingle, parts, frequent)), INDEX_SCHEMA))
    rows = index.where("part is null").select("doc", "n", "digest", F.col("bins").alias("x"))

    found = settle(index.where("part >= 0").select("part", "keys", "docs", "crowded").groupBy("part").applyInArrow(
        _group, "a long, b long, code long").union(
        index.where("part = -1").select("keys", "docs").mapInArrow(_unpack, "a long, b long, code long")))
    sized = rows.where("n > 0 and doc is not null")
    copies = sized.groupBy("digest").agg(F.min("doc").alias("first"))
    classes = settle(sized.join(copies, "digest").groupBy("doc").agg(
        F.min("first").alias("first"), (F.min("digest") == F.max("digest")).alias("single")))
    moved = classes.where("single and doc <> first").select("doc", "first")

    def of_classes(members: DataFrame, *columns: str) -> DataFrame:
        """Documents replaced by the first of their class; an id with several texts stands for itself."""
        for c in columns:
            members = members.join(moved.select(F.col("doc").alias(c), F.col("first").alias("to")), c, "left").withColumn(
                c, F.coalesce("to", c)).drop("to")
        return members

    pairs = settle(of_classes(found.where("code is null").select("a", "b").distinct(), "a", "b").where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = settle(_verified(pairs, sized, texts, percent, shingle))
    edges = sized.join(copies, "digest").where("doc <> first").select(F.col("doc").alias("a"), F.col("first").alias("b")).distinct()
    merged = components(edges.union(links))

    crowd = of_classes(found.where("code is not null").select("a", "code").distinct(), "a").distinct()
    crowd = settle(crowd.join(merged.withColumnRenamed("node", "a"), "a", "left").withColumn(
        "component", F.coalesce("component", "a")))
    mixed = crowd.groupBy("code").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("code")
    open_pairs = settle(_blocks(crowd.join(mixed, "code", "left_semi"), sized, percent).join(pairs, ["a", "b"], "left_anti"))
    more = settle(_verified(open_pairs, sized, texts, percent, shingle))
    if not more.isEmpty():
        merged = components(merged.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    return rows.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles")).join(
        merged.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
