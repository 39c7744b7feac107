"""Rule tables compiled to column expressions: first match, several labels, numbers in text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Sequence[str]]


def any_case(pattern: str) -> str:
    return f"(?i){pattern}"


def plain_word(pattern: str) -> str:
    """Longest run of letters and digits that every match holds, in lower case; '' if none is certain."""
    if re.search(r"\\[^bBsSdDwW.,'/-]", pattern):
        return ""
    left = re.sub(r"\[[^\]]*\]", "\x01", re.sub(r"\\.", "\x01", pattern))
    while (shorter := re.sub(r"\([^()]*\)", "\x01", left)) != left:
        left = shorter
    if re.search(r"[|{()\[\]]", left):
        return ""
    return max(re.findall(r"[a-z0-9]+", re.sub(r".[?*]", "\x01", left).lower()), key=len, default="")


def holds_any(text: Column, words: Sequence[str]) -> Column:
    """Whether the text holds one of the words in any case: a cheap test before patterns that need one."""
    found = F.lit(False)
    for word in sorted(set(words)):
        found = found | F.contains(F.lower(text), F.lit(word))
    return found


def matches(text: Column, patterns: Sequence[str]) -> Column:
    """Whether one of the patterns is found; only a text with a word of theirs is searched."""
    found = text.rlike(any_case("|".join(f"(?:{p})" for p in patterns)))
    words = [plain_word(p) for p in patterns]
    return holds_any(text, words) & found if all(words) else found


def first_label(text: Column, rules: Sequence[Rule]) -> Column:
    """Label of the first rule (table order, then pattern order) that matches, else NULL."""
    return F.coalesce(*[F.when(matches(text, patterns), F.lit(label)) for label, patterns in rules])


def first_match(text: Column, rules: Sequence[Rule]) -> Column:
    """Text matched by the rule that ``first_label`` picks."""
    found = [
        F.when(holds_any(text, [plain_word(p)]), F.nullif(F.regexp_extract(text, any_case(p), 0), F.lit("")))
        for _, patterns in rules for p in patterns
    ]
    return F.coalesce(*found)


def labels(text: Column, rules: Sequence[Rule]) -> Column:
    """Sorted distinct labels of all matching rules."""
    hits = [F.when(matches(text, patterns), F.lit(label)) for label, patterns in rules]
    return F.sort_array(F.array_distinct(F.array_compact(F.array(*hits))))


def number_after_or_before(text: Column, label: str) -> Column:
    """Hours such as ``engine hours: 1,234``, else ``1,234 engine hours``."""
    patterns = (
        rf"\b(?:total\s+)?{label}\s*(?:hours?|hrs?)\s*[:#-]?\s*([0-9][0-9,]*)\b",
        rf"\b([0-9][0-9,]*)\s*(?:total\s+)?{label}\s*(?:hours?|hrs?)\b",
    )
    return F.coalesce(*[
        F.when(holds_any(text, [plain_word(p)]), F.replace(F.regexp_extract(text, any_case(p), 1), F.lit(","), F.lit(""))
               .try_cast("bigint"))
        for p in patterns
    ])


def claim(value: Column, matched: Column | None = None) -> Column:
    known = value.isNotNull()
    return F.struct(
        value.alias("value"),
        F.when(known, F.lit("source_text_reported_unverified"))
        .otherwise(F.lit("unknown")).alias("evidence_status"),
        (F.lit(None).cast("string") if matched is None else matched).alias("matched_text"),
    )
