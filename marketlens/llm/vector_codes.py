"""Vector code compression: parts of vectors are coded by the nearest of a few entries, learned in rounds.

Components become integers. Each task keeps a memo of grid cells: a part falls into a coarse cell (its components
shifted right), and the memo holds, per cell, the entries that are not dominated across the cell's box, i.e.
whose least distance to the box is not above the smallest greatest distance of any entry. Only those are
evaluated exactly, so codes equal those of a full search, ties included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import settle, small_side

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components of a larger size have no code, so that no sum of squares leaves 64 bits.
REACH = 1 << 24
#: Cells a task's memo holds per part; it starts anew beyond.
MEMO = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Memo:
    """Candidate entries by coarse cell for one part position."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.shift: int | None = None
        steps = np.full(entries.shape[1], _MIX, np.uint64)
        self.step = np.multiply.accumulate(steps)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.cells = np.zeros((0, self.entries.shape[1]), np.int64)
        self.open = np.zeros((0, len(self.entries)), bool)

    def bounds(self, cells: np.ndarray) -> np.ndarray:
        """Which entries no other one dominates across each cell's box."""
        low = (cells << self.shift)[:, None]
        high = low + (1 << self.shift) - 1
        least = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
        most = np.maximum(np.abs(low - self.entries), np.abs(self.entries - high))
        return (least * least).sum(2) <= (most * most).sum(2).min(1, keepdims=True)

    def choose_width(self, values: np.ndarray) -> None:
        """The cell width with the least work on some values: bounds of distinct cells, then exact evaluations. Codes don't depend on it."""
        work = {}
        for self.shift in range(max(0, int(np.abs(values).max()).bit_length() - 5), int(np.abs(values).max()).bit_length() + 1):
            cells, n = np.unique(values >> self.shift, axis=0, return_counts=True)
            work[self.shift] = 2 * cells.shape[0] * len(self.entries) + int((self.bounds(cells).sum(1) * n).sum())
        self.shift = min(work, key=work.get)

    def candidates(self, values: np.ndarray) -> np.ndarray:
        """A row of flags per value; all entries where another cell has the same hash."""
        if self.shift is None:
            self.choose_width(values[:1024])
        cells = values >> self.shift
        keys = (cells.astype(np.uint64) * self.step).sum(1, dtype=np.uint64)
        keys ^= keys >> np.uint64(29)
        distinct, first = np.unique(keys, return_index=True)
        at = np.searchsorted(self.keys, distinct)
        new = first[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != distinct)] if len(self.keys) else first
        if len(new):
            if len(self.keys) + len(new) > MEMO:
                self.clear()
                new = first
            keys_now = np.concatenate([self.keys, keys[new]])
            order = np.argsort(keys_now)
            self.keys = keys_now[order]
            self.cells = np.concatenate([self.cells, cells[new]])[order]
            self.open = np.concatenate([self.open, self.bounds(cells[new])])[order]
        at = np.searchsorted(self.keys, keys)
        return self.open[at] | (self.cells[at] != cells).any(1, keepdims=True)

    def nearest(self, values: np.ndarray) -> np.ndarray:
        """Index of the nearest entry of each value; the lower index on ties."""
        row, entry = np.nonzero(self.candidates(values))
        gap = values[row] - self.entries[entry]
        distance = (gap * gap).sum(1)
        start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        best = np.repeat(np.minimum.reduceat(distance, start), np.diff(np.r_[start, len(row)]))
        return np.minimum.reduceat(np.where(distance == best, entry, len(self.entries)), start)


class Coder:
    """Codebooks (part, entry, component) and the memos of one task."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.memos = [Memo(b) for b in books]

    def assign(self, values: np.ndarray) -> np.ndarray:
        """Entry per row and part."""
        cut = values.reshape(len(values), len(self.books), -1)
        return np.stack([m.nearest(np.ascontiguousarray(cut[:, p])) for p, m in enumerate(self.memos)], 1)

    def errors(self, values: np.ndarray, codes: np.ndarray) -> np.ndarray:
        cut = values.reshape(len(values), len(self.books), -1)
        gap = cut - self.books[np.arange(len(self.books)), codes]
        return (gap * gap).sum((1, 2))


def _integers(vectors: pa.Array) -> list[bytes | None]:
    """Little-endian 32-bit components per vector; None if it is dropped, empty bytes if a component is out of reach."""
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), float)
    size = pc.list_value_length(vectors)
    ends = np.cumsum(size.fill_null(0).to_numpy(zero_copy_only=False))
    with np.errstate(over="ignore", invalid="ignore"):
        q = np.floor(flat * SCALE)
        near = np.abs(q) <= REACH
    odd, far = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(flat), ~near))
    raw = np.where(near, q, 0).astype("<i4").tobytes()
    out: list[bytes | None] = []
    at = 0
    for end, present in zip(ends.tolist(), size.is_valid().to_pylist()):
        out.append(None if not present or odd[end] > odd[at] else b"" if far[end] > far[at] else raw[4 * at:4 * end])
        at = end
    return out


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, label and q (integer components as bytes) of the kept rows, written once since every round reads them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = pa.array(_integers(batch.column(2)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), q], ["vec_id", "label", "q"])

    kind = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long"), "label", "embedding").mapInArrow(run, f"vec_id long, label {kind}, q binary")
    return settle(rows.where("q is not null"))


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have the codebooks' dimension, and their components."""
    values = column.to_pylist()
    rows = np.array([i for i, v in enumerate(values) if width and len(v) == 4 * width], np.int64)
    data = np.frombuffer(b"".join(values[i] for i in rows), "<i4").astype(np.int64)
    return rows, data.reshape(len(rows), max(1, width))


def first_books(kept: DataFrame) -> np.ndarray:
    """The parts of the vectors with the smallest ids; one vector per id (the least bytes), of one dimension."""
    usable = kept.where(f"vec_id is not null and length(q) > 0 and length(q) % {4 * PARTS} = 0")
    first = usable.groupBy("vec_id").agg(F.min("q").alias("q")).orderBy("vec_id").limit(ENTRIES).collect()
    first = [np.frombuffer(r["q"], "<i4").astype(np.int64) for r in first]
    width = len(first[0]) if first else 0
    rows = [x for x in first if len(x) == width]
    return np.array(rows, np.int64).reshape(len(rows), PARTS, width // PARTS).transpose(1, 0, 2)


def _round(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries replaced by the floored means of their parts; tasks add up sums and counts before the shuffle."""
    shape = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, total, count = Coder(books), np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            rows, values = _matrix(batch.column(0), shape[0] * shape[2])
            if not len(rows):
                continue
            codes = coder.assign(values)
            cut = values.reshape(len(values), shape[0], -1)
            for p in range(shape[0]):
                np.add.at(total[p], codes[:, p], cut[:, p])
                count[p] += np.bincount(codes[:, p], minlength=shape[1])
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            ["part", "entry", "n", "total"])

    rows = kept.select("q").mapInArrow(run, "part int, entry int, n long, total array<long>")
    sums = rows.select("part", "entry", "n", F.posexplode("total").alias("at", "x")).groupBy("part", "entry", "at").agg(
        F.sum("x").alias("x"), F.sum("n").alias("n"))
    out = books.copy()
    for r in sums.collect():  # one row per component of the codebooks
        out[r["part"], r["entry"], r["at"]] = r["x"] // r["n"]
    return out


def learn(kept: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after all rounds; their size depends on the dimension only."""
    books = first_books(kept)
    for _ in range(rounds if books.size else 0):
        books = _round(kept, books)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of each kept row."""
    width = books.shape[0] * books.shape[2] if books.size else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        for batch in batches:
            code, error = [None] * batch.num_rows, [None] * batch.num_rows
            rows, values = _matrix(batch.column(2), width)
            if len(rows):
                codes = coder.assign(values)
                for i, c, e in zip(rows, codes.astype(np.uint8), coder.errors(values, codes).tolist()):
                    code[i], error[i] = c.tobytes().hex(), e
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return kept.mapInArrow(run, f"vec_id long, label {kept.schema['label'].dataType.simpleString()}, code string, error long")


def compress(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each row of vectors (vec_id, embedding, label) that is kept.

    Rows whose vector is null or holds null or non-finite components are dropped. Empty vectors, vectors of
    another dimension than the first kept id's, of one that 8 does not divide, or with a component beyond 4096 are kept with
    null code and error. Rows without an id are coded but start no entry; of repeated ids one vector starts
    an entry, and all are coded. With fewer ids than entries there are as many entries as ids. Null labels
    count as equal. An empty table gives no rows; other columns are not looked at.
    """
    kept = quantised(vectors)
    books = learn(kept)
    coded = settle(encode(kept, books))
    total = small_side(coded.groupBy("label").agg(F.sum("error").alias("label_error"))).withColumnRenamed("label", "__label")
    return coded.join(total, F.col("label").eqNullSafe(F.col("__label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
