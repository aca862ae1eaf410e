import json

from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.operators.align import align_schema


def docs_df(spark, docs, extra=None):
    """Product documents (dicts or raw strings) as a ``doc`` column plus an
    ``seq`` order column."""
    rows = [(json.dumps(d, ensure_ascii=False) if not isinstance(d, str) else d, i)
            for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "doc string, seq long")


def products_df(spark, rows):
    """Canonical products from partial dicts (other columns NULL)."""
    cols = sorted({k for r in rows for k in r})
    types = dict((n, t) for n, t, _ in S.PRODUCT_FIELDS)
    schema = ", ".join(f"{c} {types[c].simpleString()}" for c in cols)
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)
    return align_schema(df, S.PRODUCT_SCHEMA)


def rows_by(df, key="sku"):
    return {r[key]: r.asDict() for r in df.collect()}


def ts(s):
    return F.lit(s).cast("timestamp_ntz")
