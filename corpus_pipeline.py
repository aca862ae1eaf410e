"""A training-corpus pipeline of five operators, each stage over all that the one before it
kept: language identification, toxicity, near duplicates, benchmark decontamination and
tokenization.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return
the columns of ``docs``.  ``run`` writes each stage as Parquet to the shared checkpoint
folder and reads it again.

Defined cases: rows with a null id are kept where their text is fine; empty tables pass
through as empty tables; null and empty texts have no language and go in the first stage.
Verdicts are on (id, text): repeated rows get the same one, and of rows that share an id each
gets its own text's.  Of a group of near duplicates the row with the smallest id stays (a null id
last; ties by hashes of text and row).  Texts are read whole, however long.  All columns
of ``documents`` are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partsmith.llm import bpe, decontaminate, jaccard_join, language_id, toxicity
from partsmith.llm.common import table, text_key, written
from partsmith.llm.queries import vocabulary


def _without(docs: DataFrame, rejected: DataFrame, keys: list[Column], names: list[str]) -> DataFrame:
    """``docs`` without the rows whose ``keys`` are in ``rejected`` (null-safe)."""
    marked = docs.select(F.struct(*docs.columns).alias("__doc"),
                         *[k.alias(f"__{n}") for k, n in zip(keys, names, strict=True)])
    cond = F.lit(True)
    bad = rejected.select(*names).distinct()
    for n in names:
        cond = cond & marked[f"__{n}"].eqNullSafe(bad[n])
    return marked.join(bad, cond, "left_anti").select("__doc.*")


def _by_text(docs: DataFrame) -> DataFrame:
    """The rows with a number for each (id, text), so that a verdict on a text reaches the
    very rows that hold it, even where an id repeats."""
    return docs.withColumn("doc_id", F.struct(*text_key(F.col("doc_id"), F.col("text"))))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language (null, no letter) or with an ambiguous one.  A row's
    own ``lang`` is learned from (held-out ids excepted), never copied."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.fit(docs, F.col("doc_id").isNotNull() & ~held)
    out = language_id.identify(_by_text(docs), model=model)
    rejected = out.where((F.col("lang_pred") == language_id.UNKNOWN) | F.col("ambiguous"))
    return _without(docs, rejected.select("doc_id.*"),
                    text_key(F.col("doc_id"), F.col("text")), ["doc_id", "text_hash"])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a toxicity score of 0.5 or more; without labels none."""
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"),
                           F.col("doc_id").isNotNull() & ~held)
    out = toxicity.score(_by_text(docs), weights)
    return _without(docs, out.where("score >= 0.5").select("doc_id.*"),
                    text_key(F.col("doc_id"), F.col("text")), ["doc_id", "text_hash"])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest id; rows
    without words are no one's duplicates."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item (with an empty benchmark none)."""
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, out.where("n_hit > 0"), text_key(F.col("doc_id"), F.col("text")),
                    ["doc_id", "text_hash"])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoded text, as digests; one row per row."""
    return bpe.encode_documents(docs, vocabulary())


STAGES = [
    ("language", keep_known_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("tokens", tokenize),
]

#: The fitted stages can't be told in SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
