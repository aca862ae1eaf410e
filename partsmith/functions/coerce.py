"""Expressions that turn loosely typed document values into typed columns.

Documents are parsed with every scalar as STRING (a typed ``from_json`` nulls a
whole record on one mistyped field), then each value is coerced here.  Each
rule is written once, as SQL expression text (``*_sql``), so that wide
projections can be handed to Spark in a single ``selectExpr`` call; the
Column-returning helpers wrap the same text.  Arguments are SQL expressions —
a column name is one.  All of these are plain Catalyst expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partsmith import schemas as S

# fixed values: words a lax boolean accepts (compared lower-cased)
TRUE_WORDS = ["1", "1.0", "true", "t", "yes", "y", "on"]
FALSE_WORDS = ["0", "0.0", "false", "f", "no", "n", "off"]


def _in_list(words: list[str]) -> str:
    return ", ".join("'" + w + "'" for w in words)


# --- SQL text of each rule ----------------------------------------------------------
def lax_long_sql(x: str) -> str:
    """String -> BIGINT the lenient way: ``"12"`` and ``"12.0"`` give 12;
    ``"12.5"``, ``"abc"`` and booleans give NULL (a coercion failure)."""
    d = f"try_cast(CAST({x} AS STRING) AS DECIMAL(38,9))"
    return f"CASE WHEN {d} = floor({d}) THEN try_cast({d} AS BIGINT) END"


def lax_double_sql(x: str) -> str:
    """String -> DOUBLE; booleans and non-numbers give NULL."""
    return f"try_cast(CAST({x} AS STRING) AS DOUBLE)"


def lax_bool_sql(x: str) -> str:
    """String -> BOOLEAN accepting the usual words and the numbers 0/1 only."""
    s = f"lower(trim(CAST({x} AS STRING)))"
    return (f"CASE WHEN {s} IN ({_in_list(TRUE_WORDS)}) THEN true "
            f"WHEN {s} IN ({_in_list(FALSE_WORDS)}) THEN false END")


def coercion_failed_sql(raw: str, typed: str) -> str:
    """A value was present but could not be coerced."""
    return f"({raw} IS NOT NULL AND {typed} IS NULL)"


def falsy_default_sql(x: str, default) -> str:
    """``x or default``: NULL *and zero* become the default."""
    kind = "DOUBLE" if isinstance(default, float) else "BIGINT"
    return (f"coalesce(nullif(CAST({x} AS {kind}), CAST(0 AS {kind})), "
            f"CAST({default!r} AS {kind}))")


def flag01_sql(x: str) -> str:
    """Boolean -> 0/1 as BIGINT; NULL -> 0."""
    return f"CAST(CASE WHEN {x} THEN 1 ELSE 0 END AS BIGINT)"


def first_nonzero_sql(a: str, b: str) -> str:
    """``a or b`` for ids: zero counts as missing."""
    return f"coalesce(nullif({a}, 0), {b})"


def first_nonempty_sql(*xs: str) -> str:
    """``a or b or ""`` for strings: empty counts as missing."""
    return "coalesce(" + ", ".join(f"nullif({x}, '')" for x in xs) + ", '')"


def tier_label_sql(basic: str, preferred: str) -> str:
    """Vendor library tier: basic=1 -> Basic, else preferred=1 -> Preferred,
    else Extended (NULL flags fall through to Extended)."""
    return (f"CASE WHEN {basic} = 1 THEN '{S.TIER_BASIC}' "
            f"WHEN {preferred} = 1 THEN '{S.TIER_PREFERRED}' ELSE '{S.TIER_EXTENDED}' END")


def epoch_to_timestamp_sql(x: str) -> str:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock)."""
    return f"CAST(timestamp_seconds({x}) AS TIMESTAMP_NTZ)"


def timestamp_to_epoch_sql(x: str) -> str:
    """TIMESTAMP_NTZ (UTC wall clock) -> whole epoch seconds."""
    return f"unix_seconds(CAST({x} AS TIMESTAMP))"


def prefixed_key_sql(prefix: str, x: str) -> str:
    """``prefix || x`` with NULL propagation (a NULL id gives a NULL key)."""
    return f"concat('{prefix}', CAST({x} AS STRING))"


def json_array_text_sql(x: str) -> str:
    """Array of structs -> JSON text that keeps NULL fields; missing -> ``[]``."""
    return f"CASE WHEN {x} IS NULL THEN '[]' ELSE to_json({x}, map('ignoreNullFields', 'false')) END"


def ladder_texts_sql(entries: str, keys: list[str]) -> str:
    """Price-ladder entries (array of VARIANT) -> array of structs: the known ``keys`` as text,
    and ``other``, the JSON object of an entry's other keys (NULL: the entry is no object)."""
    known = ", ".join(f"'{k}', try_variant_get(e, '$.{k}', 'string')" for k in keys)
    names = ", ".join(f"'{k}'" for k in keys)
    other = (f"to_json(map_filter(try_cast(e AS MAP<STRING, VARIANT>), (k, v) -> k NOT IN ({names})),"
             " map('ignoreNullFields', 'false'))")
    return f"transform({entries}, e -> named_struct({known}, 'other', {other}))"


def ladder_typed_sql(texts: str) -> str:
    """``ladder_texts_sql`` -> the same with ``ladder`` and ``usdPrice`` typed.  Plain digits
    need no decimal (a lambda has no common subexpressions: ``lax_long_sql`` would make it
    several times per entry)."""
    ladder = ("CASE WHEN x.ladder RLIKE '^-?[0-9]{1,18}$' THEN CAST(x.ladder AS BIGINT) "
              f"ELSE {lax_long_sql('x.ladder')} END")
    return (f"transform({texts}, x -> named_struct('ladder', {ladder}, "
            f"'usdPrice', {lax_double_sql('x.usdPrice')}, 'other', x.other))")


def ladder_json_sql(typed: str) -> str:
    """``ladder_typed_sql`` -> JSON text: the typed ``ladder`` and ``usdPrice`` (NULLs kept),
    then an entry's other keys as they are; ``[]`` for a missing ladder.  Every entry is read
    and written once, whatever the length of the ladder."""
    price = "CAST(x.usdPrice AS STRING)"  # as to_json writes it: what is no number is quoted
    price = (f"CASE WHEN x.usdPrice IN (double('NaN'), double('Infinity'), double('-Infinity')) "
             f"THEN concat('\"', {price}, '\"') ELSE {price} END")
    # "{}" has no other key, NULL is no object
    entry = ("concat('{\"ladder\":', coalesce(CAST(x.ladder AS STRING), 'null'),"
             f" ',\"usdPrice\":', coalesce({price}, 'null'),"
             " CASE WHEN length(x.other) > 2 THEN concat(',', substr(x.other, 2)) ELSE '}' END)")
    return f"coalesce(concat('[', array_join(transform({typed}, x -> {entry}), ','), ']'), '[]')"


# --- Column helpers (same rules) -------------------------------------------------------
def lax_long(x: str) -> Column:
    return F.expr(lax_long_sql(x))


def lax_double(x: str) -> Column:
    return F.expr(lax_double_sql(x))


def lax_bool(x: str) -> Column:
    return F.expr(lax_bool_sql(x))


def falsy_default(x: str, default) -> Column:
    return F.expr(falsy_default_sql(x, default))


def flag01(x: str) -> Column:
    return F.expr(flag01_sql(x))


def first_nonzero(a: str, b: str) -> Column:
    return F.expr(first_nonzero_sql(a, b))


def first_nonempty(*xs: str) -> Column:
    return F.expr(first_nonempty_sql(*xs))


def tier_label(basic: str, preferred: str) -> Column:
    return F.expr(tier_label_sql(basic, preferred))


def epoch_to_timestamp(x: str) -> Column:
    return F.expr(epoch_to_timestamp_sql(x))


def timestamp_to_epoch(x: str) -> Column:
    return F.expr(timestamp_to_epoch_sql(x))


def prefixed_key(prefix: str, x: str) -> Column:
    return F.expr(prefixed_key_sql(prefix, x))


def json_array_text(x: Column | str) -> Column:
    """Array column (or SQL expression) -> JSON text keeping NULL fields."""
    if isinstance(x, str):
        return F.expr(json_array_text_sql(x))
    return F.when(x.isNull(), F.lit("[]")).otherwise(F.to_json(x, {"ignoreNullFields": "false"}))
