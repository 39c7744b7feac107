"""Removal of repeated passages with sharded Aho-Corasick automata.

A window is `width` consecutive words. Texts are packed into bundles of about a megabyte.

1. Every window has an anchor, the least of its word k-grams; equal windows have equal anchors. Anchors
   that stand at one place only are ruled out.
2. The other windows are confirmed: each bundle sends the identity of each window once, with a mark if
   it has it twice, and learns for every one whether it recurs and which bundle owns it (the first).
3. Runs of owned windows are the passages. Their aligned blocks of (width + 1) // 2 words, of which
   every window of a passage contains one, are the patterns of an automaton per shard. The repeated
   stretches of all documents are streamed through the shard of their owner; block matches are extended
   word by word and cover what is equal over at least `width` words.

A bundle sends an identity once, so a passage in a third of all documents costs one entry per bundle;
shards with much text are salted, with the automaton repeated. Answers are bit masks by bundle. The
confirming identity is 64 bits plus the number of the part, taken from an independent hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import bounds, mix, run_ids, slices, word_ids
from marketlens.session import settle

BUNDLE_BYTES = 1 << 20
GRAM = 8
SHARD_BUNDLES = 8
OTHER = np.uint64(0xA24BAED4963EE407)


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in slices(batch.column(1)):
            at = 0
            while at < end - row:
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BUNDLE_BYTES, "right")) - 1)
                to = min(to, end - row)
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column(0).slice(row + at, to - at).to_pylist()], pa.list_(pa.int64())),
                    pa.array([(offsets[at:to + 1] - offsets[at]).astype(np.int64).tobytes()], pa.binary()),
                    pa.array([zstandard.compress(data[offsets[at]:offsets[to]].tobytes(), 3)], pa.binary())],
                    ["docs", "offsets", "data"])
                at = to


class _Words:
    """Words of a bundle."""

    def __init__(self, offsets: bytes, data: bytes):
        self.data = zstandard.decompress(data)
        self.raw = np.frombuffer(self.data, np.uint8)
        self.starts, self.ends, self.first = bounds(self.raw, np.frombuffer(offsets, np.int64))
        self.ids = word_ids(self.raw, self.starts, self.ends, False)

    def documents(self, width: int) -> Iterator[tuple[int, int]]:
        """First and end word of the documents that hold a window."""
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if b - a >= width:
                yield a, b

    def text(self, a: int, b: int) -> str:
        return b" ".join(self.data[s:e] for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())).decode()


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of each `width` consecutive values."""
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return pick(x[:len(x) - rest], x[rest:]) if rest else x


def _anchors(words: _Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the anchor of each window, and the anchors by place."""
    grams = run_ids(words.ids, GRAM)
    span = width - GRAM + 1
    at, values, places = [], [], []
    for a, b in words.documents(width):
        g = grams[a:b - GRAM + 1]
        least = _slide(g, span, np.minimum)
        pad = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
        places.append(g[_slide(pad, span, np.maximum) == g])
        at.append(np.arange(a, b - width + 1))
        values.append(least)
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(at), np.concatenate(values), np.concatenate(places)


def _by_part(codes: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Indices of the codes of each part, in order."""
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1]])) if len(codes) else np.zeros(0, int)
    for a, b in zip(cut, np.append(cut[1:], len(codes))):
        yield int(part[order[a]]), order[a:b]


def _windows(words: _Words, width: int, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, distinct identities, first index, places and second hash of the windows with one of the anchors."""
    at, values, _ = _anchors(words, width)
    at = at[np.isin(values, anchors)]
    ids, first, count = np.unique(run_ids(words.ids, width)[at] if len(at) else np.zeros(0, np.uint64), return_index=True, return_counts=True)
    second = run_ids(words.ids ^ OTHER, width)[at[first]] if len(at) else ids
    return at, ids, first, count, second


def _sent(bundle: int, codes: np.ndarray, count: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    parts, blobs, twice = [], [], []
    for p, idx in _by_part(codes, part):
        parts.append(p)
        blobs.append(codes[idx].tobytes())
        twice.append(np.packbits(count[idx] > 1).tobytes())
    return pa.RecordBatch.from_arrays([
        pa.array([bundle] * len(parts), pa.int64()), pa.array(parts, pa.int32()),
        pa.array(blobs, pa.binary()), pa.array(twice, pa.binary())], ["bundle", "part", "codes", "twice"])


SENT = "bundle long, part int, codes binary, twice binary"


def _recurring(owners: bool):
    """Answer to every bundle: which of its codes recur, and the owner of each that does."""
    def run(table: pa.Table) -> pa.Table:
        codes = [np.frombuffer(x, np.uint64) for x in table.column("codes").to_pylist()]
        sizes = np.array([len(c) for c in codes])
        every = np.concatenate(codes)
        twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n).astype(bool)
                                for t, n in zip(table.column("twice").to_pylist(), sizes)])
        bundle = np.repeat(table.column("bundle").to_numpy(), sizes)
        order = np.lexsort((bundle, every))
        cut = np.flatnonzero(np.concatenate([[True], every[order][1:] != every[order][:-1]]))
        size = np.diff(np.append(cut, len(every)))
        again = np.repeat((size > 1) | np.logical_or.reduceat(twice[order], cut), size)
        recurs, owner = np.zeros(len(every), bool), np.zeros(len(every), np.int64)
        recurs[order] = again
        owner[order] = np.repeat(bundle[order][cut], size)
        edges = np.cumsum(sizes)[:-1]
        masks, owned = np.split(recurs, edges), np.split(owner, edges)
        return pa.table({
            "bundle": table.column("bundle"), "part": table.column("part"),
            "mask": pa.array([np.packbits(m).tobytes() for m in masks], pa.binary()),
            "owner": pa.array([o[m].tobytes() if owners else None for m, o in zip(masks, owned)], pa.binary())})
    return run


ANSWER = "bundle long, part int, mask binary, owner binary"


def _answers(sent: DataFrame, owners: bool) -> DataFrame:
    """One row per bundle with the answers of all parts; a bundle has at most as many as codes."""
    return sent.groupBy("part").applyInArrow(_recurring(owners), ANSWER).groupBy("bundle").agg(
        F.collect_list(F.struct("part", "mask", "owner")).alias("answers"))


def _chosen(answers: list, part: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of recurring codes and their owners, from the answers of the parts."""
    mask, owner = np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
    by_part = {x["part"]: x for x in answers or []}
    for p, idx in _by_part(codes, part):
        got = by_part[p]
        mask[idx] = np.unpackbits(np.frombuffer(got["mask"], np.uint8), count=len(idx)).astype(bool)
        if got["owner"] is not None:
            owner[idx[mask[idx]]] = np.frombuffer(got["owner"], np.int64)
    return mask, owner


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _first_round(width: int, parts: int):
    def run(batches):
        for row in _rows(batches):
            _, _, places = _anchors(_Words(row["offsets"], row["data"]), width)
            codes, count = np.unique(places, return_counts=True)
            yield _sent(row["bundle"], codes, count, (mix(codes ^ OTHER) % np.uint64(parts)).astype(np.int64))
    return run


def _known_anchors(words: _Words, width: int, parts: int, answers: list) -> np.ndarray:
    codes = np.unique(_anchors(words, width)[2])
    mask, _ = _chosen(answers, (mix(codes ^ OTHER) % np.uint64(parts)).astype(np.int64), codes)
    return codes[mask]


def _second_round(width: int, parts: int):
    def run(batches):
        for row in _rows(batches):
            words = _Words(row["offsets"], row["data"])
            anchors = _known_anchors(words, width, parts, row["answers"])
            at, codes, first, count, second = _windows(words, width, anchors)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["bundle"]]), pa.nulls(1, pa.int32()), pa.array([anchors.tobytes()], pa.binary()), pa.nulls(1, pa.binary())],
                ["bundle", "part", "codes", "twice"])
            yield _sent(row["bundle"], codes, count, (second % np.uint64(parts)).astype(np.int64))
    return run


def _runs(at: np.ndarray, tag: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, last, tag) of stretches of consecutive starts with one tag."""
    if len(at):
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (tag[1:] != tag[:-1])]))
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(at)).tolist()):
            yield int(at[a]), int(at[b - 1]), int(tag[a])


def _stretches(width: int, parts: int, shards: int):
    """Passages that a bundle owns (kind 0) and its repeated stretches (kind 1), by shard of the owner."""
    def run(batches):
        for row in _rows(batches):
            words, bundle = _Words(row["offsets"], row["data"]), row["bundle"]
            at, codes, first, _, second = _windows(words, width, np.frombuffer(row["anchors"], np.uint64))
            mask, owner = _chosen(row["answers"], (second % np.uint64(parts)).astype(np.int64), codes)
            shard_of = lambda b: int(mix(np.array([b], np.int64).view(np.uint64))[0] % np.uint64(shards))
            out = []
            own = np.sort(at[first[mask & (owner == bundle)]])
            doc = np.searchsorted(words.first, own, "right")
            out += [(shard_of(bundle), 0, a, words.text(a, b + width)) for a, b, _ in _runs(own, doc)]
            place = np.searchsorted(codes, run_ids(words.ids, width)[at]) if len(at) else at
            rec = mask[place]
            starts, owners = at[rec], owner[place][rec]
            doc = np.searchsorted(words.first, starts, "right")
            cut = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else []
            for a, b in zip(cut, np.append(cut[1:], len(doc)) if len(doc) else []):
                out += [(shard_of(o), 1, s, words.text(s, e + width)) for s, e, o in _runs(starts[a:b], owners[a:b])]
            if out:
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()),
                    pa.array([bundle] * len(out), pa.int64()), pa.array([x[2] for x in out], pa.int64()),
                    pa.array([x[3] for x in out], pa.string())], ["shard", "kind", "bundle", "start", "text"])
    return run


class _Shard:
    """Automaton over the aligned blocks of a shard's passages."""

    def __init__(self, width: int):
        self.width, self.block = width, (width + 1) // 2
        self.passages: list[list[str]] = []
        self.where: dict[str, list[tuple[int, int]]] = {}
        self.machine = None

    def add(self, text: str) -> None:
        words = text.split(" ")
        for at in range(0, len(words) - self.block + 1, self.block):
            self.where.setdefault(f" {' '.join(words[at:at + self.block])} ", []).append((len(self.passages), at))
        self.passages.append(words)

    def locate(self, text: str) -> list[tuple[int, int]]:
        """Word ranges of the text that equal a passage over at least the width."""
        if self.machine is None:
            self.machine = ahocorasick.Automaton()
            for block, where in self.where.items():
                self.machine.add_word(block, (len(block), where))
            self.machine.make_automaton()
        if not self.where:
            return []
        words, found, done = text.split(" "), [], {}
        index = {}
        at = 1
        for i, w in enumerate(words):
            index[at] = i
            at += len(w) + 1
        for end, (size, where) in self.machine.iter(f" {text} "):
            i = index[end - size + 2]
            for number, offset in where:
                key = (number, i - offset)
                if done.get(key, 0) > i:
                    continue
                passage, a, b, n = self.passages[number], i, i + self.block, i - offset
                while a > 0 and a - n > 0 and words[a - 1] == passage[a - n - 1]:
                    a -= 1
                while b < len(words) and b - n < len(passage) and words[b] == passage[b - n]:
                    b += 1
                done[key] = b
                if b - a >= self.width:
                    found.append((a, b))
        return found


def _locate(width: int):
    """Streams the rows of each (shard, salt), passages first, and yields covered word ranges of bundles."""
    def run(batches):
        key, shard = None, None
        for batch in batches:
            bundles, starts, ends = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("shard", "salt", "kind", "bundle", "start", "text")]
            for number, salt, kind, bundle, start, text in zip(*columns):
                if key != (number, salt):
                    key, shard = (number, salt), _Shard(width)
                if kind == 0:
                    shard.add(text)
                else:
                    for a, b in shard.locate(text):
                        bundles.append(bundle)
                        starts.append(start + a)
                        ends.append(start + b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (bundles, starts, ends)], ["bundle", "a", "b"])
    return run


def _strip(batches):
    for row in _rows(batches):
        words = _Words(row["offsets"], row["data"])
        n = len(words.starts)
        delta = np.zeros(n + 1, np.int64)
        for r in row["ranges"] or []:
            delta[r["a"]] += 1
            delta[r["b"]] -= 1
        keep = np.cumsum(delta)[:n] == 0
        ids, total, gone, texts = row["docs"], [], [], []
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            stay = np.flatnonzero(keep[a:b]) + a
            total.append(b - a)
            gone.append(b - a - len(stay))
            texts.append(b" ".join(words.data[s:e] for s, e in zip(words.starts[stay].tolist(), words.ends[stay].tolist())))
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
            pa.array([t.decode() for t in texts], pa.string()),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])


def strip_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and kept_sha256 of each row of docs; other columns are not looked at.

    A word goes if a window that covers it starts anywhere else as well, in the same row or another one.
    Null and empty texts have no words; repeated rows count as places of their own, so both lose what
    they share; a null id is kept as null. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    parts = max(64, texts.rdd.getNumPartitions())
    bundles = settle(texts.mapInArrow(_bundle, "docs array<long>, offsets binary, data binary").withColumn(
        "bundle", F.monotonically_increasing_id()))
    sent = bundles.select("bundle", "offsets", "data").mapInArrow(_first_round(width, parts), SENT)
    windows = settle(bundles.select("bundle", "offsets", "data").join(_answers(sent, False), "bundle").mapInArrow(
        _second_round(width, parts), SENT))
    known = _answers(windows.where("part is not null"), True).join(
        windows.where("part is null").select("bundle", F.col("codes").alias("anchors")), "bundle")
    shards = max(16, bundles.count() // SHARD_BUNDLES)
    rows = settle(bundles.select("bundle", "offsets", "data").join(known, "bundle").mapInArrow(
        _stretches(width, parts, shards), "shard int, kind int, bundle long, start long, text string"))

    load = rows.where("kind = 1").groupBy("shard").agg(F.sum(F.length("text")).alias("load"))
    mean = load.agg(F.avg("load")).first()[0] or 1.0
    load = load.select("shard", F.ceil(F.col("load") / F.lit(mean)).cast("int").alias("salts"))
    dealt = rows.join(load, "shard").select(
        "shard", "kind", "bundle", "start", "text",
        F.explode(F.when(F.col("kind") == 0, F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("bundle", "start"), F.col("salts")).cast("int")))).alias("salt"))
    ranges = dealt.repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", "kind").mapInArrow(
        _locate(width), "bundle long, a long, b long").groupBy("bundle").agg(
        F.collect_list(F.struct("a", "b")).alias("ranges"))
    return bundles.join(ranges, "bundle", "left").select("docs", "offsets", "data", "ranges").mapInArrow(
        _strip, "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string")
