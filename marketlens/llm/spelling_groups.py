"""Spelling variant grouping: words one edit apart, by a frontier of states over a relational trie.

The trie holds every word forwards (below the node ``f``) and backwards (below ``r``), as an edge table (node, child letter). A word
and a variant that is as long or one longer agree on half of the word at one of its ends, so a state enters the frontier at each
node of the word's own path beyond its half, takes its one edit there, and then follows the letters that are
left, level by level of the trie: one join per level, of that level's states and edges only. Each edge carries two 64-bit masks of
what follows below it, so most hopeless states never come into being. A state with nothing left at the end of a word is a neighbour.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import settle, shared_path

SHORTEST, MODULUS, FACTOR = 7, 31, 10
#: Longest word on the trie; longer ones meet by their one-deletion hashes, so that the levels stay few.
DEEPEST = 64
#: Distinct words a task counts before it hands them on.
HELD = 200_000
SLICE = 1 << 20
RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
LETTER = re.compile("[A-Za-zÀ-ÿ]")


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Pieces of a text of about size, cut at characters that are no letters."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and LETTER.match(text, end):
            end += 1
        yield text[at:end]
        at = end


def damaged(doc: str, run: str) -> str:
    """The run, without one letter where the hash of document and run says so."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % MODULUS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word and n of the words with two occurrences or more; tasks add up first and hold a bounded number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for piece in slices(text.as_py().encode().lower().decode()) if text.is_valid else ():
                    for word, n in Counter(RUN.findall(piece)).items():
                        word = damaged(doc, word)
                        if len(word) >= SHORTEST:
                            held[word] += n
                    if len(held) > HELD:
                        yield out()
        yield out()

    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")), text_column).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where("n >= 2")


def _paths(words: DataFrame) -> DataFrame:
    """Both spellings of each word with their side; depth counts the side's letter, so a word of k letters ends at depth k + 1."""
    return words.select("word", "n", F.length("word").alias("k"), F.explode(F.array(F.lit("f"), F.lit("r"))).alias("side")).select(
        "word", "n", "k", "side", F.when(F.col("side") == "f", F.concat("side", "word")).otherwise(F.concat("side", F.reverse("word"))).alias("path"))


def _edges(paths: DataFrame, depth: int) -> DataFrame:
    """node, letter, two masks of the hashes of what may follow the letter, and n of the word that ends with it."""
    p = depth - 1
    rows = paths.where(f"k > {p} and {p} >= if(side = 'f', k - 1, k) div 2").select(
        F.substring("path", 1, depth).alias("node"), F.substring("path", depth + 1, 1).alias("letter"),
        F.expr(f"substring(path, {depth + 2})").alias("below"), "n")
    return rows.repartition("node").groupBy("node", "letter").agg(
        F.expr("bit_or(shiftleft(1L, cast(xxhash64(below) & 63 as int)))").alias("mask"),
        F.expr("bit_or(shiftleft(1L, cast(xxhash64(below) >> 6 & 63 as int)))").alias("mask2"),
        F.expr("max(if(below = '', n, null))").alias("end_n"))


def _entering(paths: DataFrame, depth: int) -> DataFrame:
    """States without an edit on the own path of each word, from its half on; rest are the letters left."""
    p = depth - 1
    return paths.where(f"k >= {p} and {p} >= if(side = 'f', k, k + 1) div 2").select(
        "word", "n", F.substring("path", 1, depth).alias("node"), F.expr(f"substring(path, {depth + 1})").alias("rest"), F.lit(0).alias("edits"))


def _level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one level down. A state with its edit behind it follows its next letter; one without takes another letter (a larger one:
    each pair once) or puts a letter in (unequal to the next: of equal alignments the last)."""
    return states.join(edges, "node").where("edits = 0 or letter = left(rest, 1)").select(
        "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("taken")).where(
        "(edits = 1 and taken = 1) or (edits = 0 and ((taken = 1 and rest <> '' and letter > left(rest, 1)) or (taken = 0 and letter <> left(rest, 1))))"
    ).select("word", "n", F.concat("node", "letter").alias("node"), F.expr("substring(rest, 1 + taken)").alias("rest"), F.lit(1).alias("edits"),
             "mask", "mask2", "end_n").where(
        "if(rest = '', end_n is not null, "
        "shiftright(mask, cast(xxhash64(rest) & 63 as int)) & shiftright(mask2, cast(xxhash64(rest) >> 6 & 63 as int)) & 1L = 1L)").drop("mask", "mask2")


def _both(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.expr("inline(array(named_struct('word', word, 'near', near, 'near_n', near_n), named_struct('word', near, 'near', word, 'near_n', n)))"))


def trie_neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of all words (word, n) one edit apart, in both directions, each once."""
    longest = words.agg(F.max(F.length("word"))).first()[0]
    spark = words.sparkSession
    path, kind = shared_path(spark, "frontier"), "word string, n long, node string, rest string, edits int, end_n long"
    paths, states, levels = _paths(words), None, []
    for depth in range(SHORTEST // 2 + 1, (longest or 0) + 2):
        now = _entering(paths, depth)
        if states is not None:
            now = now.unionByName(states)
        levels.append(f"{path}/{depth}")
        _level(now, _edges(paths, depth)).write.parquet(levels[-1])
        states = spark.read.schema(kind).parquet(levels[-1]).where("rest <> ''").drop("end_n")
    if not levels:
        return spark.createDataFrame([], "word string, near string, near_n long")
    ends = spark.read.schema(kind).parquet(*levels).where("rest = ''").select(
        "word", "n", F.left("node", F.lit(1)).alias("side"), F.expr("substring(node, 2)").alias("found"), F.col("end_n").alias("near_n"), F.expr("length(word) div 2").alias("half")).select(
        "word", "n", "side", F.when(F.col("side") == "f", F.col("found")).otherwise(F.reverse("found")).alias("near"), "near_n", "half")
    # a letter put in is found from both sides if the longest common beginning and end both reach their half
    return _both(ends.where("side = 'f' or length(near) = length(word) or left(word, half) <> left(near, half)"))


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point lies between a and b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    x, y = (np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in (a, b))
    differs = np.flatnonzero(x != y[:len(x)])
    if not len(differs):
        return True
    at = differs[0]
    return bool((x[at + 1:] == y[at + 1:]).all() if len(x) == len(y) else (x[at:] == y[at + 1:]).all())


def deletion_hashes(word: str) -> np.ndarray:
    """Distinct 64-bit hashes of the word and of the word without any one code point."""
    x = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
    base = np.full(len(x) + 1, 0x9E3779B97F4A7C15, np.uint64)
    base[0] = 1
    power = np.multiply.accumulate(base)
    before = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * power[:-1], out=before[1:])
    after = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x[1:] * power[:-2], out=after[2:])
    after[1:] = after[-1] - after[1:]
    return np.unique(np.append(before[:-1] + after[1:], before[-1])).astype(np.int64)


def long_neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n) like trie_neighbours: words with a common one-deletion hash, compared exactly."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, word in enumerate(batch.column(0)):
                found = deletion_hashes(word.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([word.as_py()] * len(found), pa.string()), pa.array([batch.column(1)[i].as_py()] * len(found), pa.int64()),
                                                  pa.array(found, pa.int64())], ["word", "n", "hash"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([one_edit(a.as_py(), b.as_py()) for a, b in zip(batch.column(0), batch.column(2))], pa.bool_()))

    rows = settle(words.mapInArrow(hashes, "word string, n long, hash long"))
    other = rows.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "hash")
    pairs = rows.join(other, "hash").where("word < near").select("word", "n", "near", "near_n").distinct()
    return _both(pairs.mapInArrow(compared, "word string, n long, near string, near_n long"))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near, near_n) of all words one edit apart, in both directions, each once.

    Words of up to DEEPEST code points meet on the trie; from DEEPEST on they also meet by hashes, which adds the pairs
    with a longer word.
    """
    if not words.where(f"length(word) > {DEEPEST}").limit(1).count():
        return trie_neighbours(words)
    on_trie = trie_neighbours(words.where(f"length(word) <= {DEEPEST}"))
    beyond = long_neighbours(words.where(f"length(word) >= {DEEPEST}")).where(f"length(word) > {DEEPEST} or length(near) > {DEEPEST}")
    return on_trie.union(beyond)


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of each row (word, form), followed to the end; each step doubles the way gone."""
    now = settle(forms.select("word", F.col("form").alias("root")))
    for _ in range(steps):
        far = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        now = settle(now.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root")))
    return now


def group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n and root of each word of docs.

    A null text has no words; a null id counts as an empty one. Repeated rows count as often as they occur. Texts of any
    length are read in slices between words, and words of any length are compared. Of near words with equal n the
    smallest in code-point order is the form. An empty table gives no rows; other columns are not looked at.
    """
    words = settle(vocabulary(docs, id_column, text_column))
    best = neighbours(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = settle(words.join(best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.expr(f"if(near_n >= {FACTOR} * n, near, null)").alias("form"), F.expr(f"if(near_n >= {FACTOR} * n, near_n, null)").alias("form_n")))
    forms = found.where("form is not null")
    most = words.agg(F.max("n")).first()[0] or 0
    hops = len(str(most))  # n grows tenfold with each
    ends = roots(forms, max(0, (hops - 1).bit_length()))
    return found.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
