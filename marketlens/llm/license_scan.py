"""Fuzzy search for short license notices.

A notice of the catalogue may differ from a text in up to `edits` characters. Split into edits + 1
pieces, at least one piece then stands in the text unchanged (pigeonhole). One automaton finds the
pieces of all notices; around a piece, the regex library matches the notice with bounded errors, which
verifies the edits and gives the span. Notices and texts are compared as words joined by one space.
The names in a notice tell licences apart: a short one has to stand unchanged in the match, a long one may have one edit.
Of overlapping matches with different labels the one with the fewest edits stays. Labels of the base phrases
are exact places of their words.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose places count as the base result, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

Catalogue = tuple[tuple[str, str, tuple[str, ...]], ...]

#: Short notices: label, words, and the names among them that tell the licence from others.
CATALOGUE: Catalogue = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache", "2 0")),
    ("apache-2.0", "apache license version 2 0", ("apache", "2 0")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ()),
    ("bsd", "this software is licensed under the bsd license", ("bsd",)),
    ("bsd", "licensed under the bsd license", ("bsd",)),
    ("cc-by", "licensed under cc by 4 0", ("by 4",)),
    ("cc-by", "creative commons attribution 4 0 international license", ("creative commons", "attribution 4")),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("by nc",)),
    ("cc-by-nc", "creative commons attribution noncommercial", ("creative commons", "noncommercial")),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("by sa",)),
    ("cc-by-sa", "creative commons attribution sharealike", ("creative commons", "sharealike")),
    ("cc0", "released under cc0 1 0 universal", ("cc0",)),
    ("cc0", "dedicated to the public domain", ("public domain",)),
    ("gpl", "licensed under the gnu general public license", ("gnu general",)),
    ("gpl", "gnu general public license version 3", ("gnu general",)),
    ("gpl", "gnu general public license version 2", ("gnu general",)),
    ("lgpl", "gnu lesser general public license", ("lesser",)),
    ("mit", "licensed under the mit license", ("mit",)),
    ("mit", "released under the mit license", ("mit",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ()),
    ("mpl-2.0", "mozilla public license version 2 0", ("mozilla", "2 0")),
    ("reserved", "all rights reserved", ("reserved",)),
)
#: A name of so many characters may have one edit; words that are one edit away but mean something else.
LONG_NAME, OTHERS = 6, ("preserved", "deserved", "reversed")
EDIT_SHARE = 0.1

_WORD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_BASE_PLACES = regex.compile(b"(?<= )(?:" + b"|".join(p.encode() for p in BASE) + b")(?= )")


def edits_of(notice: str, share: float = EDIT_SHARE) -> int:
    return int(len(notice) * share)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece) of edits + 1 pieces that differ in length by one at most."""
    cuts = [i * len(notice) // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Search:
    """Seeds of all notices of a catalogue in one automaton, with their patterns."""

    def __init__(self, catalogue: Catalogue, share: float):
        self.machine: ahocorasick.Automaton = ahocorasick.Automaton()
        where: dict[str, list] = {}
        for label, notice, names in catalogue:
            edits = edits_of(notice, share)
            pattern = regex.compile(rf"(?b)\b(?:{regex.escape(notice)}){{e<={edits}}}\b")
            named = [regex.compile(rf"(?b)\b(?:{regex.escape(n)}){'{e<=1}' if len(n) >= LONG_NAME else ''}\b") for n in names]
            for offset, piece in pieces(notice, edits):
                where.setdefault(piece, []).append((label, notice, edits, offset, pattern, named))
        for piece, uses in where.items():
            self.machine.add_word(piece, (len(piece), uses))
        self.machine.make_automaton()

    @staticmethod
    def _names_stand(text: str, named: list) -> bool:
        """Whether each name is in the match, unchanged or else with one edit that gives no word of OTHERS."""
        return all((m := pattern.search(text)) and (sum(m.fuzzy_counts) == 0 or m.group() not in OTHERS) for pattern in named)

    def notices_in(self, text: str) -> list[tuple[int, int, str, int]]:
        """(start, end, label, edits) of notices in a text of words joined by one space, in code points.

        Per notice, the best match around each piece; matches of one notice do not overlap, and of overlapping
        matches of different labels the one with fewest edits, then the longest, stays.
        """
        near: dict[str, list] = {}
        for end, (size, uses) in self.machine.iter(text):
            for use in uses:
                begin = end + 1 - size - use[3]
                near.setdefault(use[1], []).append((begin, use))
        found = set()
        for notice, hits in near.items():
            label, _, edits, _, pattern, named = hits[0][1]
            last, seen = -1, None
            for begin, _ in sorted(hits, key=lambda h: h[0]):
                if seen is not None and begin <= seen:
                    continue
                low, high = max(0, last, begin - edits), min(len(text), begin + len(notice) + 2 * edits)
                seen = begin
                if high - low < len(notice) - edits:
                    continue
                match = pattern.search(text, low, high)
                if match and match.end() > last:
                    last = match.end()
                    if self._names_stand(match.group(), named):
                        found.add((match.start(), match.end(), label, sum(match.fuzzy_counts)))
        return best(found)


def best(found: Iterable[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Matches without those that overlap a better one of another label, by start."""
    kept: list[tuple[int, int, str, int]] = []
    for span in sorted(found, key=lambda s: (s[3], s[0] - s[1], s)):
        if all(span[2] == k[2] or span[1] <= k[0] or k[1] <= span[0] for k in kept):
            kept.append(span)
    return sorted(kept)


@functools.cache
def search(catalogue: Catalogue, share: float) -> Search:
    return Search(catalogue, share)


def notices_in(text: str, share: float = EDIT_SHARE, catalogue: Catalogue = CATALOGUE) -> list[tuple[int, int, str, int]]:
    return search(catalogue, share).notices_in(text)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, spans array<struct<start:long,end:long,label:string,edits:int>>")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("edits", pa.int32())]))


def scan_text(text: str | None, share: float = EDIT_SHARE, catalogue: Catalogue = CATALOGUE) -> tuple:
    """The values of a row after its id."""
    words = (text or "").encode().lower().translate(_WORD).split()
    joined = b" ".join(words)
    padded = b" " + joined + b" "
    places, labels, at, index = [], set(), 0, 0
    for m in _BASE_PLACES.finditer(padded):
        index += padded.count(b" ", at, m.start())
        at = m.start()
        places.append(index - 1)
        labels.add(BASE[m.group().decode()])
    base = sorted(labels)
    spans = []
    for start, end, label, edits in notices_in(joined.decode(), share, catalogue):
        spans.append((start, end, label, edits))
        labels.add(label)
    score = 1.0 if places else max((1.0 - e / (b - a) for a, b, _, e in spans), default=0.0)
    return (len(words), len(places), places[0] if places else None, places[-1] if places else None,
            ",".join(base), ",".join(sorted(labels)), score,
            [{"start": a, "end": b, "label": x, "edits": e} for a, b, x, e in spans])


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", share: float = EDIT_SHARE, catalogue: Catalogue = CATALOGUE) -> DataFrame:
    """One row per row of docs: counts, first and last place of base phrases, labels, score, spans of notices.

    Null and empty texts have no words, no labels and score 0. The score is 1 with a base phrase, else one
    less the edited share of the best notice. Spans count code points of the words joined by one space.
    Texts of any length are searched whole. Repeated rows give repeated results; a null id stays null; an empty table
    gives no rows; other columns are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = [scan_text(t.as_py(), share, catalogue) for t in batch.column(1).slice(at, 512)]
                columns = list(zip(*rows))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPANS]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 512), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return docs.select(F.col(id_column).cast("long"), F.col(text_column)).mapInArrow(run, SCHEMA)
