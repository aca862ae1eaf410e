"""Small helpers for writing the DuckDB oracle SQL."""

from __future__ import annotations

from partsmith import schemas as S


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_col_contains(term: str, cols=None) -> str:
    cols = cols or S.SEARCH_INDEXED_COLUMNS
    return "(" + " OR ".join(f"coalesce(contains(lower({c}), {q(term.lower())}), false)"
                             for c in cols) + ")"
