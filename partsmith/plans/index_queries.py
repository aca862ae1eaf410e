"""Trigram postings: build (X1) and indexed lookup (X1 + X2)."""

from __future__ import annotations

from partsmith.operators.index import (
    build_postings,
    posting_lists,
    search_indexed,
    write_index,
    write_postings,
)
from partsmith.operators.ordering import spread
from partsmith.plans.bindings import t
from partsmith.plans.registry import query
from partsmith.plans.sqlbits import any_col_contains
from partsmith.session import scratch_path

INDEXED_ALL = ["there", "zz"]   # "zz" is shorter than a trigram: ignored
INDEXED_NONE = ["ouè"]


# --- X1: postings of part names and types ---------------------------------------
@query("trigram_postings", sql="""
SELECT DISTINCT substr(lower(p_name), i, 3) AS trigram, p_partkey, 'p_name' AS "column"
FROM (SELECT p_partkey, p_name, unnest(range(1, length(p_name) - 1)) AS i FROM part)
UNION ALL
SELECT DISTINCT substr(lower(p_type), i, 3) AS trigram, p_partkey, 'p_type' AS "column"
FROM (SELECT p_partkey, p_type, unnest(range(1, length(p_type) - 1)) AS i FROM part)""")
def trigram_postings(spark, sf):
    """Distinct trigram postings of two ``part`` text columns."""
    return build_postings(t(spark, sf, "part"), ["p_partkey"], ["p_name", "p_type"])


# --- X3: the same postings as compacted files -------------------------------------
@query("postings_compact", sql="""
SELECT DISTINCT substr(lower(p_name), i, 3) AS trigram, p_partkey, 'p_name' AS "column"
FROM (SELECT p_partkey, p_name, unnest(range(1, length(p_name) - 1)) AS i FROM part)""")
def postings_compact(spark, sf):
    """Postings of ``part.p_name`` written as range-partitioned, sorted files, read back."""
    path = scratch_path(spark, "postings")
    write_postings(posting_lists(t(spark, sf, "part"), ["p_partkey"], ["p_name"]), path,
                   lists=["p_partkey"])
    return spark.read.parquet(path)


# --- X1 + X2: search answered through written postings, verified ------------------
@query("trigram_search_indexed", sql=f"""
SELECT doc_id, lang FROM documents
WHERE {any_col_contains('there', ['text'])} AND NOT {any_col_contains('ouè', ['text'])}""")
def trigram_search_indexed(spark, sf):
    """Index over ``documents.text`` written; a search answered through its rarest lists and
    verified."""
    docs = t(spark, sf, "documents")
    index = write_index(posting_lists(spread(docs), ["doc_id"], ["text"]),
                        scratch_path(spark, "index"), lists=["doc_id"])
    return search_indexed(docs, index, ["doc_id"], all=INDEXED_ALL,
                          none=INDEXED_NONE, columns=["text"]).select("doc_id", "lang")
