"""Column expressions for free text, identifiers and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"


def collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def normalised(c: Column) -> Column:
    return F.upper(collapsed(c))


def slug(c: Column) -> Column:
    """Lower-case letters and digits, every other run one hyphen."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def digit_class(c: Column, names: dict[int, str]) -> Column:
    """Class of an identifier by its digit count; ``missing`` and ``other`` remain."""
    n = F.length(digits_only(F.coalesce(c, F.lit(""))))
    out = F.when(n == 0, F.lit("missing"))
    for length, name in names.items():
        out = out.when(n == length, F.lit(name))
    return out.otherwise(F.lit("other"))


def yes_no_flag(c: Column, yes: str = "Y", no: str = "N") -> Column:
    up = F.upper(F.trim(c))
    return F.when(up.startswith(yes), F.lit(1)).when(up.startswith(no), F.lit(0)).cast("bigint")


def code_set(c: Column, pattern: str, group: int = 1) -> Column:
    """Distinct codes in a text, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(group))))


def words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(f"({WORD})"), F.lit(1))


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    A lambda re-evaluates whatever it closes over for every element; as the variable
    of an outer one-element transform the value is computed before the inner loop.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_tokens(c: Column) -> Column:
    """Distinct lower-case words and adjacent word pairs."""

    def tokens(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        pairs = F.zip_with(
            F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b)
        )
        return F.array_distinct(F.concat(w, pairs))

    return bound(words(c), tokens)


def word_pairs(c: Column) -> Column:
    """Distinct adjacent pairs of lower-case words, the two parted by one blank."""

    def pairs(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        both = F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
        return F.array_distinct(both)

    return bound(words(c), pairs)


def excerpt_text(c: Column) -> Column:
    """White space collapsed and dropped before punctuation."""
    return F.regexp_replace(collapsed(c), r"\s+([,;:.!?])", "$1")


def excerpt_match(text: Column, excerpt: Column) -> Column:
    """How an excerpt occurs in a text: contiguous, in ordered spans, or NULL.

    Each span between ellipses is searched after the end of the one before; the
    position is folded through the spans and stays 0 once a span is missing.
    """
    e = excerpt_text(excerpt)

    def match(t: Column) -> Column:
        spans = F.filter(
            F.transform(F.split(e, r"\.{3}|…"), lambda s: F.trim(s)), lambda s: F.length(s) > 0
        )

        def advance(at: Column, span: Column) -> Column:
            hit = F.call_function("locate", span, t, at)
            return F.when((at > 0) & (hit > 0), hit + F.length(span)).otherwise(F.lit(0)).cast("int")

        end = F.aggregate(spans, F.lit(1).cast("int"), advance)
        return F.when((F.length(e) > 0) & F.contains(t, e), F.lit("contiguous")).when(
            (F.size(spans) >= 2) & (end > 0), F.lit("ordered-spans")
        )

    return bound(excerpt_text(text), match)
