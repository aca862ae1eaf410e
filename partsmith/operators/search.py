"""Catalog queries: substring search, composite filters, top-k, paging, facets.

All of these are declarative DataFrame operations: predicates reach the
Parquet scan where they can (``=``/``IN``/``>`` are pushed down, ``contains``
is evaluated right above the scan inside whole-stage codegen), top-k becomes
``TakeOrderedAndProject`` (a per-partition heap, no global sort), and facet
counts use partial (map-side) aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.functions.text import fold_literal, term_in_any, usable_terms


def as_list(value) -> list | None:
    """A single id or an id list -> list; ``None`` stays ``None``."""
    if value is None:
        return None
    if isinstance(value, (list, tuple, set)):
        return list(value)
    return [value]


def search_predicate(all_terms: Iterable[str] | None = None,
                     any_terms: Iterable[str] | None = None,
                     none_terms: Iterable[str] | None = None,
                     columns: Sequence[str] | None = None) -> Column:
    """Row predicate of a trigram substring search.

    * every ``all`` term must occur (case-folded) in at least one column —
      different terms may match in different columns;
    * at least one ``any`` term must occur, when ``any`` terms are given;
    * no ``none`` term may occur;
    * terms shorter than three characters cannot be matched by trigrams: they
      are ignored next to longer terms, and a query left with no usable
      positive term matches nothing.
    """
    cols = list(columns or S.SEARCH_INDEXED_COLUMNS)
    must = usable_terms(all_terms)
    should = usable_terms(any_terms)
    must_not = usable_terms(none_terms)
    if not must and not should:
        return F.lit(False)
    pred = F.lit(True)
    for t in must:
        pred = pred & term_in_any(t, cols)
    if should:
        anyp = term_in_any(should[0], cols)
        for t in should[1:]:
            anyp = anyp | term_in_any(t, cols)
        pred = pred & anyp
    for t in must_not:
        pred = pred & ~term_in_any(t, cols)
    return pred


def search(df: DataFrame, all: Iterable[str] | None = None,  # noqa: A002 - API name
           any: Iterable[str] | None = None,  # noqa: A002
           none: Iterable[str] | None = None,
           columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` matching a substring search over ``columns`` (default:
    the indexed catalog columns that ``df`` has)."""
    return df.filter(search_predicate(all, any, none, columns or indexed_columns(df)))


def indexed_columns(df: DataFrame) -> list[str]:
    return [c for c in S.SEARCH_INDEXED_COLUMNS if c in df.columns]


def catalog_filter(df: DataFrame, category_ids=None, brand_ids=None,
                   instock_only: bool = False, keyword: str | None = None,
                   category_col: str = "category_id", brand_col: str = "brand_id",
                   stock_col: str = "stock",
                   keyword_columns: Sequence[str] | None = None,
                   empty_means_all: bool = False) -> DataFrame:
    """Composite catalog filter; an absent (``None``/false) argument adds no
    predicate.  ``keyword`` is a plain case-folded substring (any length) over
    ``keyword_columns``.  An explicit empty id list matches nothing (a product
    query), or nothing is filtered with ``empty_means_all`` (catalog-list
    counts)."""
    pred = F.lit(True)
    for ids, column in ((as_list(category_ids), category_col), (as_list(brand_ids), brand_col)):
        if ids is None or (not ids and empty_means_all):
            continue
        pred = pred & F.col(column).isin(*ids) if ids else F.lit(False)
    if instock_only:
        pred = pred & (F.col(stock_col) > 0)
    if keyword:
        k = fold_literal(keyword)
        cols = list(keyword_columns or indexed_columns(df))
        pred = pred & term_in_any(k, cols) if len(cols) else pred
    return df.filter(pred)


def top_k(df: DataFrame, k: int, order: Sequence[Column | str],
          tie_break: Sequence[str] = ()) -> DataFrame:
    """``ORDER BY order..., tie_break... LIMIT k`` — planned as
    TakeOrderedAndProject (bounded per-task heap, no full sort)."""
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    keys += [F.col(c).asc() for c in tie_break]
    return df.orderBy(*keys).limit(k)


#: Rows up to which a page is taken from a per-task heap.
HEAP_ROWS = 100_000


def page(df: DataFrame, page_no: int, page_size: int = S.PAGE_SIZE,
         order: Sequence[str] = (S.PRODUCT_KEY,)) -> DataFrame:
    """Page ``page_no`` (1-based) of ``page_size`` rows in a deterministic (unique) order.
    Early pages are a bounded heap per task; beyond ``HEAP_ROWS`` rows the page is cut by
    distributed row numbers, so a deep page holds no more than its rows.  To walk through
    pages use ``page_after``."""
    if page_no < 1 or page_size < 1:
        raise ValueError("page and page_size are 1-based positive numbers")
    skip = (page_no - 1) * page_size
    if skip + page_size <= HEAP_ROWS:
        return df.orderBy(*order).offset(skip).limit(page_size)
    from partsmith.operators.ordering import global_index

    idx = global_index(df, order, "__row")
    return (idx.filter((F.col("__row") > skip) & (F.col("__row") <= skip + page_size))
            .orderBy("__row").drop("__row"))


def page_after(df: DataFrame, after: str | int | None, page_size: int = S.PAGE_SIZE,
               key: str = S.PRODUCT_KEY) -> DataFrame:
    """The page that follows key ``after`` (None: the first), in key order: a filter that
    reaches a stored key's statistics and a bounded heap, however deep the page."""
    rows = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(page_size)


def page_envelope(df: DataFrame, page_no: int, page_size: int = S.PAGE_SIZE,
                  order: Sequence[str] = (S.PRODUCT_KEY,)) -> DataFrame:
    """A page of rows plus the envelope fields ``total_row``, ``total_page``,
    ``curr_page``.  The total is one global count (partial aggregates, one
    row) evaluated once as a scalar subquery — no join."""
    rows = page(df, page_no, page_size, order)
    total = df.agg(F.count(F.lit(1))).scalar()
    return rows.select(
        "*", total.cast("bigint").alias("total_row"),
        F.floor((total + F.lit(page_size - 1)) / F.lit(page_size)).cast("bigint").alias("total_page"),
        F.lit(page_no).cast("bigint").alias("curr_page"))


def facet_counts(df: DataFrame, facet_col: str, name_col: str | None = None) -> DataFrame:
    """Facet values under the (already filtered) rows with their counts and the
    filter's total count.  Partial aggregation shrinks each task's rows to one
    row per facet value before the shuffle, so a dominant value costs nothing
    extra."""
    keys = [facet_col] + ([name_col] if name_col else [])
    facets = df.filter(F.col(facet_col).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return facets.select("*", total.alias("total_count"))



def assign_pages(df: DataFrame, page_size: int, order: Sequence[str],
                 page_col: str = "page", pos_col: str = "pos") -> DataFrame:
    """Bulk paging: every row gets its 1-based ``page`` and 0-based ``pos``
    inside the page, in the (unique) ``order``.  Uses the distributed global
    index (range-partitioned sort + per-partition offsets), never a single
    task."""
    from partsmith.operators.ordering import global_index

    idx = global_index(df, order, "__row")
    return (idx.withColumn(page_col, (F.floor((F.col("__row") - 1) / page_size) + 1).cast("bigint"))
            .withColumn(pos_col, ((F.col("__row") - 1) % page_size).cast("bigint"))
            .drop("__row"))
