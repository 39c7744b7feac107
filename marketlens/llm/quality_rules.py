"""Quality rules by divergence from language references.

A document's shares of character classes and of common words are compared with those of each language
(all documents labelled with it) by Jensen-Shannon distance; what is far from every language, in one or the
other, is rejected. How far is far comes from the labelled documents' distances to their own language, by
classes of length, since short texts have ragged histograms: their median and some spreads more. Common
words are those above a share of a language's words. Batches nominate words above half that share; where
a word is not nominated, it has less than half the share, so the nominations bound its count from above.
Words whose bound reaches the share are at most 2 / share, and a second pass counts them exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import bounds, run_ids, slices, tidy, word_ids
from marketlens.session import settle

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT, REPEAT_WINDOW = 50, 50, 3

COMMON_SHARE = 0.005
# Spreads above the median that are not far yet, and documents of a length class that a spread takes.
SPREADS, LEAST_DOCUMENTS = 4.0, 30
BINS, LENGTHS = 1024, 40  # of the distances, and of the lengths: each class is twice as long as the one before

CLASSES = ("lower", "upper", "digit", "beyond ascii", "space", "line end", "sentence mark", "symbol", "other mark")


def _classes() -> np.ndarray:
    table = np.full(256, 8, np.int64)
    table[97:123], table[65:91], table[48:58], table[0xC0:] = 0, 1, 2, 3
    table[[32, 9, 11, 12, 13]], table[10] = 4, 5
    table[list(b".,;:!?'\"()-")] = 6
    table[list(SYMBOLS)] = 7
    table[0x80:0xC0] = len(CLASSES)  # continuation bytes belong to the character before
    return table


CLASS_OF = _classes()


@dataclass
class References:
    """Common words (sorted identities) and the shares of each language."""
    vocabulary: np.ndarray
    languages: list[str] = field(default_factory=list)
    characters: np.ndarray = field(default_factory=lambda: np.zeros((0, len(CLASSES))))
    words: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    limits: np.ndarray = field(default_factory=lambda: np.full((LENGTHS, 2), np.inf))  # of characters and words by length class


def histograms(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, first: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of character classes and of common words (the rest last) of each row."""
    rows, k, v = len(offsets) - 1, len(CLASSES) + 1, len(vocabulary) + 1
    of_byte = np.repeat(np.arange(rows), np.diff(offsets))
    chars = np.bincount(of_byte * k + CLASS_OF[data], minlength=rows * k).reshape(rows, k)[:, :-1]
    if len(vocabulary):
        at = np.minimum(np.searchsorted(vocabulary, ids), len(vocabulary) - 1)
        at = np.where(vocabulary[at] == ids, at, len(vocabulary))
    else:
        at = np.zeros(len(ids), np.int64)
    of_word = np.repeat(np.arange(rows), np.diff(first))
    return chars, np.bincount(of_word * v + at, minlength=rows * v).reshape(rows, v)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances, base 2, of each row of counts p to each row of shares q."""
    p = p / np.maximum(p.sum(1, keepdims=True), 1)
    out = np.zeros((len(p), len(q)))
    with np.errstate(divide="ignore", invalid="ignore"):
        for j, r in enumerate(q):
            m = (p + r) / 2
            a = np.where(p > 0, p * np.log2(p / m), 0.0).sum(1)
            b = np.where(r > 0, r * np.log2(r / m), 0.0).sum(1)
            out[:, j] = np.sqrt(np.clip((a + b) / 2, 0, 1))
    return out


def length_class(words: np.ndarray) -> np.ndarray:
    """0 below twice LEAST_WORDS, 1 below four times as many, and so on."""
    return np.clip(np.log2(np.maximum(words, LEAST_WORDS) / LEAST_WORDS).astype(np.int64), 0, LENGTHS - 1)


def limits_of(counts: np.ndarray, spreads: float) -> np.ndarray:
    """Limits of (characters, words) by length class from counts of distances (length class, measure, bin).

    The spread is taken below the median, as junk lies above, and is no less than what drawing as many words
    at random gives. Classes of few documents take the limit of shorter ones, which is wider, or have none.
    """
    out, last = np.full((LENGTHS, 2), np.inf), np.full(2, np.inf)
    for k, measures in enumerate(counts):
        if measures[0].sum() >= LEAST_DOCUMENTS:
            low, middle = (np.array([np.searchsorted(np.cumsum(m), q * m.sum()) + 1 for m in measures]) / BINS for q in (0.25, 0.5))
            last = middle + spreads * np.maximum((middle - low) / 0.6745, 1 / np.sqrt(16 * np.log(2) * LEAST_WORDS * 2.0 ** k))
        out[k] = last
    return out


def references(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", share: float = COMMON_SHARE,
               spreads: float = SPREADS) -> References:
    """References of all languages, from all documents with a text and a language.

    What reaches the driver is bounded: at most 2 / share words and the character classes per language,
    and a histogram of distances per length class.
    """
    rows = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(F.col(text_column), F.col(lang_column).cast("string"))

    def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        langs = np.array(batch.column(1).to_pylist(), object)
        for lang in sorted(set(langs)):
            for _, _, data, offsets in slices(batch.column(0).filter(pa.array(langs == lang))):
                yield lang, data, offsets

    def nominate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data, offsets in by_language(batch):
                starts, ends, _ = bounds(data, offsets)
                word, n = np.unique(word_ids(data, starts, ends, True), return_counts=True)
                total = int(n.sum())
                ok = n >= max(1, share / 2 * total)
                named = int(ok.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (named + 1), pa.string()), pa.array([*word[ok].view(np.int64).tolist(), None], pa.int64()),
                     pa.array([*n[ok].tolist(), total], pa.int64()), pa.array([total] * (named + 1), pa.int64())],
                    ["lang", "word", "n", "among"])

    named = settle(rows.mapInArrow(tidy(nominate), "lang string, word long, n long, among long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"), F.sum("among").alias("among")))
    totals = named.where("word is null").select("lang", F.col("n").alias("total"))
    likely = named.where("word is not null").join(totals, "lang").where(F.col("n") >= F.lit(share / 2) * (F.col("total") + F.col("among")) - F.lit(1e-6))
    nominated = np.sort(np.array([r["word"] for r in likely.select("word").distinct().toLocalIterator()], np.int64).view(np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            for lang, data, offsets in by_language(batch):
                starts, ends, first = bounds(data, offsets)
                chars, words = histograms(data, offsets, word_ids(data, starts, ends, True), first, nominated)
                got = totals.setdefault(lang, [np.zeros(chars.shape[1], np.int64), np.zeros(words.shape[1], np.int64)])
                got[0] += chars.sum(0)
                got[1] += words.sum(0)
        for lang, got in totals.items():
            both = np.concatenate(got)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(both), pa.string()), pa.array(np.arange(len(both))), pa.array(both)], ["lang", "at", "n"])

    counted: dict[str, np.ndarray] = {}
    for r in rows.mapInArrow(tidy(count), "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toLocalIterator():
        counted.setdefault(r["lang"], np.zeros(len(CLASSES) + len(nominated) + 1))[r["at"]] = r["n"]
    langs = sorted(counted)
    every = np.array([counted[x] for x in langs]).reshape(len(langs), len(CLASSES) + len(nominated) + 1)
    chars, words = every[:, :len(CLASSES)], every[:, len(CLASSES):]
    common = (words[:, :-1] >= share * np.maximum(1, words.sum(1, keepdims=True))).any(0) if langs else np.zeros(0, bool)
    kept = np.concatenate([words[:, :-1][:, common], words.sum(1, keepdims=True) - words[:, :-1][:, common].sum(1, keepdims=True)], 1)
    found = References(nominated[common], langs, chars / np.maximum(1, chars.sum(1, keepdims=True)), kept / np.maximum(1, kept.sum(1, keepdims=True)))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LENGTHS * 2 * BINS, np.int64)
        for batch in batches:
            for lang, data, offsets in by_language(batch):
                starts, ends, first = bounds(data, offsets)
                n, own = np.diff(first), found.languages.index(lang)
                long = n >= LEAST_WORDS
                both = histograms(data, offsets, word_ids(data, starts, ends, True), first, found.vocabulary)
                for measure, (rows, shares) in enumerate(zip(both, (found.characters, found.words))):
                    far = distance(rows[long], shares[own:own + 1])[:, 0]
                    at = (length_class(n[long]) * 2 + measure) * BINS + np.minimum((far * BINS).astype(np.int64), BINS - 1)
                    counts += np.bincount(at, minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "n"])

    spreading = np.zeros(LENGTHS * 2 * BINS)
    for r in rows.mapInArrow(tidy(spread), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
        spreading[r["at"]] = r["n"]
    found.limits = limits_of(spreading.reshape(LENGTHS, 2, BINS), spreads)
    return found


def _duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip():
            seen.add(line)
    return n


def _repeated_words(ids: np.ndarray) -> int:
    runs = run_ids(ids, REPEAT_WINDOW)
    order = np.argsort(runs)
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(REPEAT_WINDOW):
        covered[k:k + len(runs)] |= twice
    return int(covered.sum())


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "character_distance", "word_distance", "kept")
SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "character_distance double, word_distance double, kept boolean")


def judge(docs: DataFrame, reference: References, text_column: str = "text") -> DataFrame:
    """Every row of docs as a struct `doc`, with its measures and verdict as a struct `quality`.

    A row is rejected if the base rules fail or if no language has both its characters and its words within
    the limits of its length. The distances are those to the language that comes nearest to that; they are
    null below LEAST_WORDS and without references, where only the base rules count. Null and empty texts have no words and fail. Repeated rows get equal verdicts.
    """
    inner = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), F.col(text_column).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(1)):
                columns = _measure(data, offsets, reference)
                quality = pa.StructArray.from_arrays(columns, list(MEASURES))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), quality], ["doc", "quality"])

    kind = inner.schema["doc"].dataType.simpleString()
    return inner.mapInArrow(tidy(run), f"doc {kind}, quality struct<{SCHEMA.replace(' long', ':long').replace(' boolean', ':boolean').replace(' double', ':double')}>")


def _measure(data: np.ndarray, offsets: np.ndarray, reference: References) -> list[pa.Array]:
    rows = len(offsets) - 1
    starts, ends, first = bounds(data, offsets)
    exact = word_ids(data, starts, ends, False)
    folded = word_ids(data, starts, ends, True)
    words = np.diff(first)
    chars, common = histograms(data, offsets, folded, first, reference.vocabulary)
    opening = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    letters = np.concatenate([[0], np.cumsum(opening[ends] - opening[starts])])
    symbols = chars[:, CLASSES.index("symbol")]
    raw = data.tobytes()
    lines = np.array([_duplicate_lines(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], np.int64)
    repeats = np.array([_repeated_words(exact[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())], np.int64)
    failed = (words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * words)
    far_chars, far_words = np.full(rows, np.nan), np.full(rows, np.nan)
    limits = reference.limits[length_class(words)]
    if reference.languages and rows:
        far = np.stack([distance(chars, reference.characters), distance(common, reference.words)], 2)
        # Without limits all languages are equally good; the sum of the distances decides then.
        nearest = np.lexsort((far.sum(2), (far / limits[:, None, :]).max(2)))[:, 0]
        far = np.where((words >= LEAST_WORDS)[:, None], far[np.arange(rows), nearest], np.nan)
        far_chars, far_words = far[:, 0], far[:, 1]
    kept = ~failed & ~(far_chars > limits[:, 0]) & ~(far_words > limits[:, 1])
    return [pa.array(words.astype(np.int64)), pa.array((letters[first[1:]] - letters[first[:-1]]).astype(np.int64)), pa.array(symbols.astype(np.int64)),
            pa.array(lines), pa.array(repeats), pa.array(failed), pa.array(far_chars, mask=np.isnan(far_chars)),
            pa.array(far_words, mask=np.isnan(far_words)), pa.array(kept)]
