"""Vector codes, spelling groups and context coding against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from marketlens.llm import context_coding, queries, spelling_groups, vector_codes

FOLDER = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("word", T.StringType()),
                     T.StructField("key", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("row", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2, "y") for d, t in rows], DOCS).repartition(3)


# --- vector codes

def plain_codes(rows):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[math.floor(4096 * x) for x in v] for _, v, _ in kept]
    ids = sorted({i for (i, v, _), q in zip(kept, ints) if i is not None and q and len(q) % 8 == 0 and max(map(abs, q)) <= vector_codes.REACH})[:16]
    start = []
    for i in ids:
        start.append(min((q for (j, _, _), q in zip(kept, ints) if i == j), key=lambda q: np.array(q, "<i4").tobytes()))
    width = len(start[0]) if start else 0
    start = [q for q in start if len(q) == width]
    w = width // 8
    books = [[q[p * w:(p + 1) * w] for q in start] for p in range(8)] if start else []
    use = [bool(width) and len(q) == width and max(map(abs, q)) <= vector_codes.REACH for q in ints]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))
    for _ in range(6):
        for p in range(len(books)):
            groups = defaultdict(list)
            for q, ok in zip(ints, use):
                if ok:
                    groups[nearest(q[p * w:(p + 1) * w], p)[1]].append(q[p * w:(p + 1) * w])
            for k, parts in groups.items():
                books[p][k] = [sum(x) // len(parts) for x in zip(*parts)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (i, _, label), q, ok in zip(kept, ints, use):
        found = [nearest(q[p * w:(p + 1) * w], p) for p in range(8)] if ok else None
        out.append((i, label, "".join(f"{k:02x}" for _, k in found) if ok else None, sum(d for d, _ in found) if ok else None))
    total = defaultdict(lambda: None)
    for _, label, _, e in out:
        if e is not None:
            total[label] = (total[label] or 0) + e
    return Counter((i, c, e, total[label], sha) for i, label, c, e in out)


def vector_rows():
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(5, 24))
    rows = [(i, (centres[i % 5] + rnd.normal(size=24) * (0.01 if i % 3 else 0.8)).tolist(), i % 4 if i % 7 else None) for i in range(3, 260)]
    rows += [(300, rows[4][1], 9), (300, rows[5][1], 9), (5, rows[9][1], 2), (5, rows[9][1], 2), (None, rows[7][1], 1), (-4, rows[8][1], None)]
    rows += [(1, None, 1), (2, [1.0] * 23 + [None], 1), (400, [math.nan] * 24, 1), (401, [math.inf] * 24, 1), (402, [], 77), (403, [1.0] * 16, 1),
             (404, [0.5] * 25, 1), (0, [1e30] * 24, 1), (-9, [0.5] * 9, 3)]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int, q string, code int, __label int"


@pytest.mark.parametrize("part", (slice(None), slice(0, 6), slice(-9, None)))
def test_vector_codes_equal_full_search(spark, part):
    rows = vector_rows()[part]
    df = spark.createDataFrame([(*r, "q", 1, 2) for r in rows], SCHEMA).repartition(3)
    out = vector_codes.compress(df)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(tuple(r) for r in out.collect()) == plain_codes(rows)


def test_vector_codes_empty(spark):
    assert vector_codes.compress(spark.createDataFrame([], SCHEMA)).count() == 0


def test_memo_prunes_and_keeps_ties(monkeypatch):
    monkeypatch.setattr(vector_codes, "MEMO", 50)
    rnd = np.random.default_rng(1)
    values = rnd.integers(-2000, 2000, (40, 6))[rnd.integers(0, 40, 3000)] + rnd.integers(-40, 40, (3000, 6))
    entries = np.concatenate([values[:13], values[:3]])
    memo = vector_codes.Memo(entries)
    for a in range(0, 3000, 500):
        part = values[a:a + 500]
        want = ((part[:, None] - entries) ** 2).sum(2).argmin(1)
        assert (memo.nearest(part) == want).all()
    assert memo.candidates(values[:500]).sum(1).mean() < 8


# --- spelling groups

def plain_words(rows):
    import re
    lower = {c: c + 32 for c in range(65, 91)}
    count = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(rows):
    words = plain_words(rows)
    out, forms = [], {}
    for w, n in words.items():
        found = sorted((-m, v) for v, m in words.items() if abs(len(v) - len(w)) < 2 and near(v, w))
        good = found and -found[0][0] >= 10 * n
        forms[w] = found[0][1] if good else None
        out.append([w, n, len(found), forms[w], -found[0][0] if good else None])
    for row in out:
        root = row[0]
        while forms[root]:
            root = forms[root]
        row.append(root)
    return Counter(map(tuple, out))


def spelling_rows():
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("abÀé") for _ in range(rnd.randint(6, 10))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "Éclairage", "éclairage"]
    letters, rows = "abÀé×", []
    long = "".join(rnd.choice("abc") for _ in range(64))
    very_long = "".join(rnd.choice("xyz") for _ in range(3000))
    extra = [long, long + "a", long[:40] + "z" + long[40:], long + "ab", very_long, very_long[:1500] + very_long[1501:], "y" + very_long[1:], "z" + very_long[1:]]
    for i in range(150):
        words = []
        for _ in range(60):
            w = rnd.choice(vocabulary[:3] if rnd.random() < 0.5 else vocabulary)
            if rnd.random() < 0.3:
                at = rnd.randrange(len(w))
                w = rnd.choice([w[:at] + w[at + 1:], w[:at] + rnd.choice(letters) + w[at:], w[:at] + rnd.choice(letters) + w[at + 1:]])
            words.append(w.upper() if rnd.random() < 0.1 and w.isascii() else w)
        rows.append((i, " 3,\n".join(words)))
    rows += [(500 + i, " ".join(extra)) for i in range(3)] + [(None, " ".join(vocabulary)), (7, None), (8, ""), (9, "a b c 123"), (9, "a b c 123"), (10, "aaaaaaa-" * 9000)]
    return rows


def test_spelling_groups_equal_plain(spark, monkeypatch):
    monkeypatch.setattr(spelling_groups, "HELD", 40)
    rows = spelling_rows()
    out = spelling_groups.group(frame(spark, rows)).select("word", "n", "n_near", "form", "form_n", "root")
    assert Counter(tuple(r) for r in out.collect()) == plain_groups(rows)


def test_spelling_groups_empty(spark):
    assert spelling_groups.group(frame(spark, [])).count() == 0
    assert spelling_groups.group(frame(spark, [(1, None), (2, "one two")])).count() == 0


def test_slices_cut_between_words():
    text = "ab cdé,f " * 30 + "x" * 50 + " y"
    pieces = list(spelling_groups.slices(text, 7))
    assert "".join(pieces) == text and max(map(len, pieces)) <= 57
    assert all(not (a[-1].isalpha() and b[0].isalpha()) for a, b in zip(pieces, pieces[1:]))


def test_one_edit_and_hashes():
    rnd = random.Random(4)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    for a in words:
        for b in words:
            assert spelling_groups.one_edit(a, b) == near(a, b)
            if near(a, b):
                assert set(spelling_groups.deletion_hashes(a)) & set(spelling_groups.deletion_hashes(b))


# --- context coding

def coded(text):
    words = (text or "").encode().lower().split()
    return words, b" ".join(words)


class PlainModel:
    """Contexts as dictionaries; one symbol after the other."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for text in texts:
            for context, symbol in self.steps(text):
                for k in range(order + 1):
                    self.seen[context[order - k:]][symbol] += 1

    def steps(self, text):
        line = bytes([0xFE] * self.order) + coded(text)[1] + b"\xff"
        return [(line[i - self.order:i], line[i]) for i in range(self.order, len(line))]

    def chance(self, context, symbol):
        p, out = 1.0, set()
        for k in range(self.order, -1, -1):
            known = {s: n for s, n in self.seen[context[self.order - k:]].items() if s not in out}
            if not known:
                continue
            total = sum(known.values()) + len(known)
            if symbol in known:
                return p * known[symbol] / total
            p *= len(known) / total
            out |= set(known)
        return p / (256 - len(out))

    def score(self, text):
        return sum(math.log10(self.chance(*s)) for s in self.steps(text))


def plain_scores(rows, order):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    learned = [t for (_, t), h in zip(rows, held) if not h]
    count = Counter(w for t in learned for w in coded(t)[0])
    count["end"] = len(learned)
    total, v = sum(count.values()), sum(n > 0 for n in count.values())
    model, out = PlainModel(learned, order), defaultdict(list)
    for (d, t), h in zip(rows, held):
        tokens = [*coded(t)[0], "end"]
        base = sum(math.log10((count[w] + 1) / (total + v + 1)) for w in tokens)
        out[d].append((h, len(tokens), sum(count[w] > 0 for w in tokens), total, base, model.score(t)))
    return out


def text_rows():
    rnd = random.Random(2)
    vocabulary = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6))) for _ in range(80)]
    rows = [(i, "  ".join(rnd.choice(vocabulary) if rnd.random() < 0.97 else f"zq{i}x" for _ in range(rnd.randint(0, 50)))) for i in range(90)]
    rows += [(200, "ABC Abc\tabc\n"), (200, "ABC Abc\tabc\n"), (None, "no id"), (None, None), (201, None), (202, ""), (203, " \n"), (204, "漢字 ü"), (205, "long " * 2000)]
    return rows


def same(out, want):
    got = defaultdict(list)
    for r in out.collect():
        got[r[0]].append(tuple(r[1:]))
    assert got.keys() == want.keys()
    for d in want:
        assert len(got[d]) == len(want[d])
        for a, b in zip(sorted(got[d], key=str), sorted(want[d], key=str)):
            assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order, share, held, block", ((4, 1 << 21, 1 << 21, 1 << 20), (4, 30, 500, 64), (2, 0, 1 << 21, 1 << 20), (0, 50, 1 << 21, 1 << 20)))
def test_context_coding_equals_plain(spark, monkeypatch, order, share, held, block):
    monkeypatch.setattr(context_coding, "HELD", held)
    monkeypatch.setattr(context_coding, "SLICE_BYTES", block)
    rows = text_rows()
    docs = frame(spark, rows)
    out = context_coding.score(docs, docs.where(~context_coding.held_out("doc_id")), order=order, share=share)
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(out, plain_scores(rows, order))


def test_context_coding_without_rows_or_training(spark):
    empty = frame(spark, [])
    assert context_coding.score(empty, empty).count() == 0
    r = context_coding.score(frame(spark, [(1, "ab")]), empty).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (2, 0, 0, 0.0) and r["score"] == pytest.approx(-3 * math.log10(256))


def test_chances_add_up_to_one_at_most():
    model = PlainModel([t for _, t in text_rows()], 3)
    for context in list(model.seen)[:200]:
        if len(context) == 3:
            assert sum(model.chance(context, s) for s in range(256)) <= 1 + 1e-9


def test_lookup_finds_keys_that_share_slots():
    rnd = np.random.default_rng(5)
    keys = np.unique(rnd.integers(-(1 << 62), 1 << 62, 5000))
    table = context_coding.Lookup(keys, np.arange(len(keys)).astype(float))
    asked = np.concatenate([keys[::3], rnd.integers(-(1 << 62), 1 << 62, 5000)])
    value, hit = table.find(asked)
    where = {k: i for i, k in enumerate(keys.tolist())}
    assert hit.tolist() == [k in where for k in asked.tolist()] and value.tolist() == [where.get(k, 0) for k in asked.tolist()]


def test_longer_contexts_help_out_of_training(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    learned = docs.where(~context_coding.held_out("doc_id"))
    total = [context_coding.score(docs, learned, order=k).where("held_out").selectExpr("sum(score)").first()[0] for k in (0, 2, 5)]
    assert total[0] < total[1] < total[2] < 0
    assert queries.QUERIES["op13_context_coding"](spark, FOLDER).count() == docs.count()
