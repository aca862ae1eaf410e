"""Text expressions: case folding, substring predicates, trigrams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the search tokenizer works on three-character grams
GRAM = 3


def fold(x: Column | str) -> Column:
    """Case folding used on both sides of a substring match: each code point on its own.
    ``lower`` has one rule that looks at neighbours (a final sigma), so sigmas are
    lower-cased before it."""
    c = F.col(x) if isinstance(x, str) else x
    return F.lower(F.replace(c, F.lit("Σ"), F.lit("σ")))


def fold_literal(term: str) -> str:
    """The same folding of a literal."""
    return term.replace("Σ", "σ").lower()


def usable_terms(terms: Iterable[str] | None) -> list[str]:
    """Terms a trigram index can match: folded, at least three characters.

    Shorter terms cannot be answered by trigrams; on their own they match
    nothing, next to longer terms they are ignored."""
    out = []
    for t in terms or []:
        if t is None:
            continue
        f = fold_literal(t)
        if len(f) >= GRAM and f not in out:
            out.append(f)
    return out


def term_in_any(term: str, columns: list[str]) -> Column:
    """Folded ``term`` occurs in at least one of ``columns`` (NULLs never match)."""
    preds = [F.coalesce(F.contains(fold(c), F.lit(term)), F.lit(False)) for c in columns]
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out


def code_points(x: Column | str) -> Column:
    """Folded text as an array of code points (newlines included), O(length)."""
    return F.regexp_extract_all(fold(x), F.lit(r"(?s)."), F.lit(0))


# fixed value: every overlapping window of three code points, in one regex pass
TRIGRAM_PATTERN = r"(?s)(?=(.{3}))"


def trigrams(x: Column | str) -> Column:
    """Distinct trigrams of the folded text as array<string>; empty when shorter
    than three characters.

    A zero-width lookahead yields every overlapping three-character window in
    one linear pass over the text (taking ``substring(text, i, 3)`` for each
    position would rescan the UTF-8 bytes from the start: O(length^2))."""
    grams = F.regexp_extract_all(fold(x), F.lit(TRIGRAM_PATTERN), F.lit(1))
    return F.coalesce(F.array_distinct(grams), F.array().cast("array<string>"))


def literal_trigrams(term: str) -> list[str]:
    """Distinct trigrams of one folded literal term (driver-side, bounded by
    the term's own length)."""
    f = fold_literal(term)
    seen: list[str] = []
    for i in range(len(f) - GRAM + 1):
        g = f[i:i + GRAM]
        if g not in seen:
            seen.append(g)
    return seen
