"""Language-model scoring by prediction by partial matching over bytes.

Documents are coded as their words with one space between, A-Z in lower case, and an end. The trie of byte contexts is a set of tables, one
per order: a row per context and next symbol with its count over all learned documents; lower orders are sums of higher ones.
A symbol that followed its context has its count over the context's total plus distinct symbols; else the escape takes the distinct
symbols' share and the next shorter context is asked without the symbols the longer one knew (symbol exclusion); below
order 0 the symbols nobody knew are equal.

What a symbol costs depends only on it and its context, so costs are worked out once per distinct context and symbol and summed per
document. Those of at least 1/SHARE of all learned symbols (so at most SHARE of them) are sent to all tasks, as are
words of that share; the rest of each document is counted per distinct item and meets the tables in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import SLICE_BYTES, SPACE, bounds, slices, tidy, word_ids
from marketlens.session import settle

#: Bytes of context. One more byte must fit the keys, so at most 6.
ORDER = 5
SHARE = 1 << 22
#: Neither byte occurs in UTF-8: the end of a document, and what stands before its beginning.
END, BEFORE, SYMBOLS = 0xFF, 0xFE, 256
END_WORD = -1
WORD, GRAM = 0, 1
#: Distinct items a task holds while counting.
HELD = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Piece:
    """Some rows of a batch: words' hashes, words per row, and the coded bytes with where each row's begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, order: int):
        self.order = order
        starts, ends, self.first = bounds(data, offsets)
        self.words = word_ids(data, starts, ends, True).view(np.int64) if len(starts) else np.zeros(0, np.int64)
        size = np.concatenate([[0], np.cumsum(ends - starts)])
        n = np.diff(self.first)
        length = size[self.first[1:]] - size[self.first[:-1]] + np.maximum(n - 1, 0) + order + 1
        self.base = np.concatenate([[0], np.cumsum(length)])
        self.coded = np.full(self.base[-1], 32, np.uint8)
        row = np.repeat(np.arange(len(n)), n)
        shift = self.base[row] + order - size[self.first[row]] + np.arange(len(row)) - self.first[row]
        for a in range(0, len(starts), SLICE_BYTES // 8):
            b = min(a + SLICE_BYTES // 8, len(starts))
            block = data[starts[a]:ends[b - 1]]
            self.coded[np.arange(size[a], size[b]) + np.repeat(shift[a:b], ends[a:b] - starts[a:b])] = _LOWER[block[~SPACE[block]]]
        for k in range(order):
            self.coded[self.base[:-1] + k] = BEFORE
        self.coded[self.base[1:] - 1] = END

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row and key (context and symbol, a byte each) of each symbol, in blocks."""
        for a in range(0, len(self.coded), SLICE_BYTES):
            part = self.coded[max(0, a - self.order):a + SLICE_BYTES].astype(np.int64)
            n = len(part) - self.order
            if n <= 0:
                continue
            key = part[:n].copy()
            for k in range(1, self.order + 1):
                key <<= 8
                key |= part[k:k + n]
            at = np.flatnonzero(part[self.order:] != BEFORE)
            where = at + max(0, a - self.order) + self.order
            yield np.searchsorted(self.base, where, "right") - 1, key[at]


class Tally:
    """Sums by key, in bounded memory: what is held beyond a limit is handed on as partial sums."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        keys = np.sort(keys)
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.parts.append((keys[at], np.diff(np.r_[at, len(keys)])))
        self.size += len(at)
        if self.size > HELD:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate([np.zeros(0, np.int64), *(p[i] for p in self.parts)]) for i in (0, 1))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.parts = [(keys[at], np.add.reduceat(n, at) if len(at) else n)]
        self.size = len(at)
        return self.parts[0]

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.merge()
        self.parts, self.size = [], 0
        return out


def counts(learned: DataFrame, text_column: str = "text", order: int = ORDER) -> DataFrame:
    """kind, key and n of all words, the ends and all (context, symbol) keys of a table, written once."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {WORD: Tally(), GRAM: Tally()}

        def out(kind: int) -> pa.RecordBatch:
            keys, n = tallies[kind].take()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)], ["kind", "key", "n"])

        for batch in batches:
            for row, end, data, offsets in slices(batch.column(0)):
                piece = Piece(data, offsets, order)
                tallies[WORD].add(np.append(piece.words, np.full(end - row, END_WORD)))
                for _, keys in piece.grams():
                    tallies[GRAM].add(keys)
                for kind, tally in tallies.items():
                    if tally.size > HELD // 2:
                        yield out(kind)
        yield out(WORD)
        yield out(GRAM)

    return settle(learned.select(text_column).mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))


class Trie:
    """Tables per order k: grams[k] (key, n) and contexts[k] (context, total, kinds, excluded); excluded sums what the context's symbols
    count in the next shorter context."""

    def __init__(self, found: DataFrame, order: int = ORDER):
        self.order = order
        self.grams = {order: found.where(F.col("kind") == GRAM).select("key", "n")}
        for k in range(order - 1, -1, -1):
            self.grams[k] = settle(self.grams[k + 1].groupBy(suffix("key", k + 1).alias("key")).agg(F.sum("n").alias("n")))
        self.contexts = {0: self._contexts(self.grams[0].withColumn("low", F.lit(0)))}
        for k in range(1, order + 1):
            low = self.small(self.grams[k - 1].select(F.col("key").alias("rest"), F.col("n").alias("low")), k)
            self.contexts[k] = self._contexts(self.grams[k].join(low, suffix("key", k) == F.col("rest")))

    @staticmethod
    def _contexts(grams: DataFrame) -> DataFrame:
        return settle(grams.groupBy(F.shiftright("key", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("low").cast("long").alias("excluded")))

    @staticmethod
    def small(df: DataFrame, key_bytes: int) -> DataFrame:
        """Keys of two bytes have at most 65,536 rows, which goes to all tasks; the planner decides on others."""
        return F.broadcast(df) if key_bytes <= 2 else df

    def known(self) -> DataFrame:
        """key, n and cost (log10 of the probability) of everything learned at the full order."""
        contexts = self.contexts[self.order]
        return settle(self.grams[self.order].join(contexts, F.shiftright("key", 8) == F.col("context")).select(
            "key", "n", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("cost")))

    def escaped(self, unknown: DataFrame) -> DataFrame:
        """key and cost of keys that were not learned at the full order: the frontier goes down one order at a time."""
        now = unknown.select("key", F.lit(0.0).alias("cost"), F.lit(False).alias("done"), F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("out"))
        for k in range(self.order, -1, -1):
            contexts = self.small(self.contexts[k].withColumnRenamed("context", "__context"), k)
            now = now.withColumn("here", suffix("key", k + 1)).join(contexts, F.shiftright("here", 8) == F.col("__context"), "left")
            if k < self.order:
                now = now.join(self.small(self.grams[k].select(F.col("key").alias("__key"), "n"), k + 1), F.col("here") == F.col("__key"), "left")
            else:
                now = now.withColumn("n", F.lit(None).cast("long")).withColumn("__key", F.lit(None).cast("long"))
            kinds, total = F.col("kinds") - F.col("seen"), F.col("total") - F.col("out") + F.col("kinds") - F.col("seen")
            now = now.select(
                "key",
                F.when(F.col("done"), F.col("cost")).when(F.col("n").isNotNull(), F.col("cost") + F.log10(F.col("n") / total))
                .when(kinds > 0, F.col("cost") + F.log10(kinds / total)).otherwise(F.col("cost")).alias("cost"),
                (F.col("done") | F.col("n").isNotNull()).alias("done"),
                F.coalesce("kinds", F.lit(0)).cast("long").alias("seen"), F.coalesce("excluded", F.lit(0)).cast("long").alias("out"))
        return now.select("key", F.when(F.col("done"), F.col("cost")).otherwise(F.col("cost") - F.log10(F.lit(SYMBOLS) - F.col("seen"))).alias("cost"))


def suffix(key: str, n: int) -> Column:
    """The last n bytes of a key."""
    return F.col(key).bitwiseAND(F.lit((1 << 8 * n) - 1))


class Lookup:
    """Values of keys by a table of slots; keys that share a slot are found by bisection."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.bits = np.uint64(64 - max(10, (2 * len(keys)).bit_length()))
        self.slot = np.full(1 << int(64 - self.bits), -1, np.int32)
        self.slot[self._slots(self.keys)] = np.arange(len(keys))
        self.shared = np.zeros(len(self.slot), bool)
        if len(keys):
            self.shared[self._slots(self.keys)[self.slot[self._slots(self.keys)] != np.arange(len(keys))]] = True

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.bits

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key, 0 where it is unknown, and whether it is known."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        slots = self._slots(keys)
        at = self.slot[slots]
        hit = (at >= 0) & (self.keys[at] == keys)
        rest = np.flatnonzero(~hit & self.shared[slots])
        where = np.minimum(np.searchsorted(self.keys, keys[rest]), len(self.keys) - 1)
        at[rest], hit[rest] = where, self.keys[where] == keys[rest]
        return np.where(hit, self.values[at], 0.0), hit


def held_out(id_column: str) -> Column:
    """Whether crc32 of the id as text (a null id: empty), modulo 7, is 2."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def _rare(row: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) with counts."""
    order = np.lexsort((keys, row))
    row, keys = row[order], keys[order]
    at = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])]) if len(row) else np.zeros(0, np.int64)
    return row[at], keys[at], np.diff(np.r_[at, len(row)])


def _lists(rows: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)), pa.array(values))


_OPEN = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, cost double, keys array<long>, times array<long>, words int"


def _first_pass(docs: DataFrame, word_costs: tuple[np.ndarray, np.ndarray], gram_costs: tuple[np.ndarray, np.ndarray], order: int) -> DataFrame:
    """Per document the sums over what all tasks know, and the rest as distinct keys with counts: words first, then grams."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((word_costs, gram_costs))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_table, gram_table = (Lookup(*x) for x in sent.value)
        place, done = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(2)):
                n, piece = end - row, Piece(data, offsets, order)
                of = np.repeat(np.arange(n), np.diff(piece.first))
                value, hit = word_table.find(piece.words)
                base, known = np.bincount(of, value, n), np.bincount(of[hit], minlength=n)
                found = [_rare(of[~hit], piece.words[~hit])]
                n_words = np.bincount(found[0][0], minlength=n)
                cost = np.zeros(n)
                for at, keys in piece.grams():
                    value, hit = gram_table.find(keys)
                    cost += np.bincount(at, value, n)
                    found.append(_rare(at[~hit], keys[~hit]))
                rows, keys, times = (np.concatenate([f[i] for f in found]) for i in range(3))
                by = np.argsort(rows, kind="stable")
                yield pa.RecordBatch.from_arrays([
                    pa.array(place + done + np.arange(n)), batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(np.diff(piece.first) + 1),
                    pa.array(known), pa.array(base), pa.array(cost), _lists(rows[by], keys[by], n), _lists(rows[by], times[by], n),
                    pa.array(n_words.astype(np.int32))], [f.split()[0] for f in _OPEN.split(", ")])
                done += n

    return settle(docs.mapInArrow(run, _OPEN))


def _numpy(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Two columns of a table with a proven bound on its rows."""
    table = df.toArrow()
    return table.column(0).to_numpy().astype(np.int64), table.column(1).to_numpy().astype(float)


def score(docs: DataFrame, learned: DataFrame, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER, share: int = SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs, learned from the rows of learned.

    A null text is empty and has its end only. Rows without an id are not held out. Repeated rows are each learned and
    scored. Texts of any length are coded whole, in blocks. If nothing is learned all symbols cost the same. An
    empty table gives no rows; other columns are not looked at.
    """
    found = counts(learned, text_column, order)
    words = found.where(F.col("kind") == WORD).select("key", "n")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.max(F.when(F.col("key") == END_WORD, F.col("n"))).alias("ends")).first()
    total, room, ends = sums["n"], sums["n"] + sums["v"] + 1, sums["ends"] or 0
    word_cost = F.log10((F.col("n") + 1) / F.lit(float(room)))
    trie = Trie(found, order)
    known = trie.known()
    symbols = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(id_column).alias("held_out"), F.col(text_column))
    first = _first_pass(rows, _numpy(words.where(F.col("n") * share >= total).select("key", word_cost)),
                        _numpy(known.where(F.col("n") * share >= symbols).select("key", "cost")), order)

    rest = first.select("row", "words", F.posexplode(F.arrays_zip("keys", "times")).alias("at", "item")).select(
        "row", F.when(F.col("at") < F.col("words"), F.lit(WORD)).otherwise(F.lit(GRAM)).alias("kind"), F.col("item.keys").alias("key"), F.col("item.times").alias("times"))
    unknown = rest.where(F.col("kind") == GRAM).select("key").distinct().join(known.select("key"), "key", "left_anti")
    costs = words.select(F.lit(WORD).alias("kind"), "key", word_cost.alias("cost")).union(
        known.select(F.lit(GRAM), "key", "cost")).union(settle(trie.escaped(unknown)).select(F.lit(GRAM), "key", "cost"))
    more = rest.join(costs, ["kind", "key"], "left").groupBy("row").agg(
        F.sum(F.when((F.col("kind") == WORD) & F.col("cost").isNotNull(), F.col("times"))).alias("more_known"),
        F.sum(F.when(F.col("kind") == WORD, F.col("times") * F.coalesce("cost", -F.log10(F.lit(float(room)))))).alias("more_base"),
        F.sum(F.when(F.col("kind") == GRAM, F.col("times") * F.col("cost"))).alias("more_cost"))
    end_cost = F.log10(F.lit((ends + 1) / room))
    zero = F.lit(0)
    return first.drop("keys", "times").join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", zero) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", zero) + end_cost).alias("base_score"),
        (F.col("cost") + F.coalesce("more_cost", zero)).alias("score"))
