"""Language identification with error-correcting output codes.

Each language has a codeword of -1 and 1. Per bit, a binary classifier over hashed byte n-grams weighs
the languages with 1 against those with -1 (log odds of n-gram shares, languages counting equally). Decoding
sums the logistic losses of the bits against each codeword, weighted by how well the bit separates the
languages it was fitted on, and takes the least; a small lead over the next one is flagged.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM, FEATURES = 3, 4096
SHARPNESS = 20.0
AMBIGUOUS = 0.6
UNDETERMINED = "und"

_FOLD = np.full(256, 32, np.uint32)
_FOLD[list(range(97, 123))] = range(97, 123)
_FOLD[list(range(65, 91))] = range(97, 123)
_FOLD[128:] = range(128, 256)


def features(text: str) -> np.ndarray:
    """Counts of hashed n-grams of the letters of a text; other ASCII counts as a space."""
    t = np.concatenate([[32], _FOLD[np.frombuffer(text.encode(), np.uint8)], [32]]).astype(np.uint32)
    h = np.zeros(max(0, len(t) - GRAM + 1), np.uint32)
    for k in range(GRAM):
        h = (h ^ t[k:k + len(h)]) * np.uint32(0x01000193) + np.uint32(0x9E3779B9)
    return np.bincount((h >> np.uint32(20)) % np.uint32(FEATURES), minlength=FEATURES)


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 per class: all two-way splits up to five classes, else seeded random ones."""
    if n <= 5:
        bits = [c for c in itertools.product((1, -1), repeat=n) if c[:1] == (1,) and -1 in c]
        return np.array(bits, float).reshape(len(bits), n).T
    rng = np.random.default_rng(n)
    while True:
        code = rng.choice([-1.0, 1.0], (n, 10 * math.ceil(math.log2(n))))
        code = code[:, np.abs(code.sum(0)) < n]
        if len(np.unique(code, axis=0)) == n:
            return code


class Model:
    """Languages, codewords, weights of the bits' classifiers and trust in each bit."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        shares = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * FEATURES) for x in self.languages]).reshape(-1, FEATURES)
        self.code = codewords(len(self.languages))
        self.weights = np.zeros((FEATURES, self.code.shape[1]))
        for b in range(self.code.shape[1]):
            on = self.code[:, b] > 0
            self.weights[:, b] = np.log(shares[on].mean(0)) - np.log(shares[~on].mean(0))
        margins = (shares @ self.weights) * self.code
        trust = np.maximum(margins.min(0), 1e-3) if margins.size else np.zeros(0)
        self.trust = trust / trust.sum() if trust.size else trust

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in 0..1 and whether the choice is ambiguous."""
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        count = features(text)
        margin = count @ self.weights / max(1, count.sum())
        loss = (np.logaddexp(0, -SHARPNESS * self.code * margin) * self.trust).sum(1)
        chance = np.exp(-(loss - loss.min()))
        chance /= chance.sum()
        best = int(chance.argmax())
        score = min(1.0, float(chance[best]))
        return self.languages[best], score, score < AMBIGUOUS


def fit(labelled: DataFrame) -> Model:
    """A model from all rows of labelled (text, lang) with both; tasks add up n-grams per language first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                got = features(text.as_py())
                total[lang] = total[lang] + got if lang in total else got
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())], ["lang", "feature", "n"])

    rows = labelled.where("text is not null and lang is not null").select("text", "lang").mapInArrow(
        count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    counts: dict[str, np.ndarray] = {}
    for r in rows.collect():  # at most FEATURES per language
        counts.setdefault(r["lang"], np.zeros(FEATURES))[r["feature"]] = r["n"]
    return Model(counts)


def held_out(id_column: str) -> Column:
    """Whether a row is kept from fitting: crc32 of the id as text (a null id: empty), modulo 4, is 2."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of each row of docs.

    Texts that are null or have no letter are `und` with score 0, as are all texts if nothing was learned.
    Rows without an id are not held out and are learned from. Ties go to the language that sorts first. Repeated rows give
    repeated results; an empty table gives no rows; other columns are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [model.predict(t.as_py()) for t in part.column(2)]
                lang, score, flag = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(flag, pa.bool_())],
                    ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out(id_column).alias("held_out"),
                       F.col(text_column)).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
