"""Landed API documents: product pages, facet responses, category trees.

Documents are read as text (JSON lines, one envelope per line — splittable,
so a large landing folder spreads over all executors) and parsed with an
explicit schema.  Scalars are parsed as STRING and coerced afterwards (see
``partsmith.functions.coerce``); list elements are kept as their raw JSON text
so that each product's original document survives as ``raw_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsmith import schemas as S

STR = T.StringType()

# Columns that never arrive in a product document.
_NOT_IN_DOC = set(S.VENDOR_COLUMNS) | {"last_updated", "raw_json", "category_id"}


def _doc_fields() -> list[T.StructField]:
    fields: list[T.StructField] = []
    seen: set[str] = set()

    def add(name: str, dtype: T.DataType = STR) -> None:
        if name not in seen:
            seen.add(name)
            fields.append(T.StructField(name, dtype, True))

    for c in S.PRODUCT_COLUMNS:
        if c in _NOT_IN_DOC:
            continue
        if c == "price_ladder":
            ladder = T.ArrayType(T.VariantType())  # entries keep keys that aren't known here
            add(S.doc_key(c), ladder)
            add(c, ladder)
            continue
        add(S.doc_key(c))
        add(c)
    for k in (S.DOC_PRODUCT_ID, S.DOC_CATALOG_ID, S.DOC_WM_CATALOG_ID):
        add(k)
    add("product_id")
    add("catalog_id")
    add("wm_catalog_id")
    params = T.ArrayType(T.StructType([T.StructField(k, STR) for k in S.PARAM_KEYS]))
    add(S.DOC_PARAMS, params)
    add("params", params)
    return fields


PRODUCT_DOC_SCHEMA = T.StructType(_doc_fields())

PAGE_SCHEMA = T.StructType([
    T.StructField("dataList", T.ArrayType(STR), True),
    T.StructField("totalRow", STR, True),
    T.StructField("currPage", STR, True),
    T.StructField("totalPage", STR, True),
])

FACET_SCHEMA = T.StructType([
    T.StructField("totalCount", STR, True),
    T.StructField("Manufacturer", T.ArrayType(T.StructType([
        T.StructField("id", STR, True), T.StructField("name", STR, True)])), True),
])


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of a landing folder with the file they came from."""
    return spark.read.text(path).select(
        F.col("value").alias("doc"), F.col("_metadata.file_path").alias("source_file"))


def read_json_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file for API responses saved one (possibly pretty-printed)
    JSON document per file; each file is read whole by one task."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("doc"), F.col("_metadata.file_path").alias("source_file"))


def unwrap(docs: DataFrame, json_path: str, doc_col: str = "doc") -> DataFrame:
    """Replace each document by the JSON value at ``json_path`` (e.g. the
    ``$.result`` payload of an API response); missing -> NULL."""
    return docs.withColumn(doc_col, F.get_json_object(F.col(doc_col), json_path))


def read_page_stream(spark: SparkSession, landing: str, files_per_trigger: int) -> DataFrame:
    """Lines of landed files as a stream, with the file they came from."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger)
            .load(landing)
            .select(F.col("value").alias("doc"), F.col("_metadata.file_path").alias("source_file")))


def bad_page_lines(envelopes: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Every line that isn't blank as ``line`` with ``bad``: it is no JSON object with an
    array (or null) under ``dataList``, so its products can't be known."""
    keys = F.json_object_keys(F.col(doc_col))
    items = F.get_json_object(F.col(doc_col), "$.dataList")
    good = F.array_contains(keys, "dataList") & (items.isNull() | items.startswith("["))
    carry = [c for c in envelopes.columns if c != doc_col]
    return envelopes.where(F.trim(F.col(doc_col)) != "").select(
        *carry, F.col(doc_col).alias("line"), (~F.coalesce(good, F.lit(False))).alias("bad"))


def inline_pages(envelopes: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Page envelopes -> one row per product document.

    Keeps ``page`` (currPage), ``pos`` (position inside the page) and the
    envelope totals; ``doc`` is the product's own JSON text."""
    env = F.from_json(F.col(doc_col), PAGE_SCHEMA)
    e = envelopes.select("*", env.alias("__env"))
    carry = [c for c in envelopes.columns if c != doc_col]
    return e.select(
        *carry,
        # envelope defaults: page 1, totals 0
        F.coalesce(F.col("__env.currPage").try_cast("bigint"), F.lit(1).cast("bigint")).alias("page"),
        F.coalesce(F.col("__env.totalRow").try_cast("bigint"), F.lit(0).cast("bigint"))
        .alias("total_row"),
        F.coalesce(F.col("__env.totalPage").try_cast("bigint"), F.lit(0).cast("bigint"))
        .alias("total_page"),
        F.posexplode_outer(F.col("__env.dataList")).alias("pos", "doc"),
    ).filter(F.col("doc").isNotNull())


DOC_KEYS = [f.name for f in PRODUCT_DOC_SCHEMA.fields]
NESTED_TYPES = {f.name: f.dataType for f in PRODUCT_DOC_SCHEMA.fields
                if not isinstance(f.dataType, T.StringType)}


def _text_keys() -> list[str]:
    """Document keys whose value must be a JSON string."""
    types = {n: t for n, t, _ in S.PRODUCT_FIELDS}
    cols = [c for c in S.PRODUCT_COLUMNS if c not in _NOT_IN_DOC | {"price_ladder", "product_images"}
            and isinstance(types[c], T.StringType)]
    return list(dict.fromkeys(k for c in cols for k in (S.doc_key(c), c)))


def _not_text_sql(doc_col: str) -> str:
    """Array of the text keys that hold a number, a boolean or a nested value.  The types are
    read from the schema of the document's VARIANT, inner levels removed."""
    x = f"schema_of_variant(try_parse_json({_q(doc_col)}))"
    x = f"substr({x}, 8)"  # after OBJECT<
    for _ in range(6):     # levels of nesting inside a document
        x = f"regexp_replace({x}, '<[^<>]*>', '')"
    keys = "|".join(_text_keys())
    return (f"regexp_extract_all({x}, '(?:^|, )`?({keys})`?: "
            "(?:BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN|OBJECT|ARRAY)', 1)")


def parse_documents(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Add ``doc_keys`` (keys the document carries; NULL when it is not a
    JSON object), ``not_text`` (known text keys whose value is another JSON type) and one
    STRING column ``k__<key>`` per known document key.

    Both come out of generators: ``json_tuple`` parses each document once and
    yields every top-level value as text (nested lists as their JSON text).
    A generator is also a boundary the optimizer does not inline through, so
    filters on flags derived from them stay above it instead of being pushed
    (and re-evaluated) further down the plan."""
    carry = [c for c in docs.columns if c != doc_col]
    keyed = docs.select(*carry, F.inline(F.array(F.struct(F.col(doc_col).alias(doc_col)))))
    # between the generators: made once per document, and not at all where nothing reads them
    keyed = keyed.withColumns({"doc_keys": F.json_object_keys(F.col(doc_col)),
                               "not_text": F.expr(_not_text_sql(doc_col))})
    gen = F.json_tuple(F.col(doc_col), *DOC_KEYS).alias(*[f"k__{k}" for k in DOC_KEYS])
    return keyed.select("*", gen)


def _q(name: str) -> str:
    return "`" + name + "`"


def raw_key_sql(key: str) -> str:
    """SQL for the raw text of one document key (nested lists parsed to their
    typed shape) over the output of ``parse_documents``."""
    if key in NESTED_TYPES:
        return f"from_json({_q('k__' + key)}, '{NESTED_TYPES[key].simpleString()}')"
    return _q("k__" + key)


def doc_value_sql(column: str) -> str:
    """SQL for a canonical column from a parsed document: the API alias wins,
    the canonical name is accepted too."""
    alias = S.doc_key(column)
    if alias == column:
        return raw_key_sql(column)
    return f"coalesce({raw_key_sql(alias)}, {raw_key_sql(column)})"


def parse_facets(envelopes: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Facet envelope -> one row per manufacturer: ``brand_id`` (string ids are
    coerced to BIGINT; an unparsable id is kept in ``brand_id_raw`` and flagged),
    ``brand_name`` and the envelope's ``total_count``."""
    env = F.from_json(F.col(doc_col), FACET_SCHEMA)
    carry = [c for c in envelopes.columns if c != doc_col]
    e = envelopes.select(*carry, env.alias("__f"))
    m = e.select(*carry, F.coalesce(F.col("__f.totalCount").try_cast("bigint"),
                                    F.lit(0).cast("bigint")).alias("total_count"),
                 F.explode_outer("__f.Manufacturer").alias("__m"))
    from partsmith.functions.coerce import lax_long
    return m.select(*carry, "total_count",
                    lax_long("__m.id").alias("brand_id"),
                    F.col("__m.id").alias("brand_id_raw"),
                    F.coalesce(F.col("__m.name"), F.lit("")).alias("brand_name"),
                    (F.col("__m.id").isNotNull() & lax_long("__m.id").isNull())
                    .alias("rejected"))
