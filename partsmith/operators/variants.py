"""Published variants of the catalog: a registry of DataFrame -> tables
builders, writers with a codec option, and schema alignment for old tables.

A variant is a dict ``table name -> DataFrame`` built from the base tables
(``products``, ``categories``, ``product_params``); absent optional tables are
skipped.  Writing sorts the search table by key so Parquet min/max statistics
serve key lookups (the role secondary B-tree indexes play elsewhere), and adds Bloom filters
of the columns that are looked up by value, which serve them in any order of rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.sources.files import swap_in

Tables = dict[str, DataFrame]


def search_only(base: Tables) -> Tables:
    """Search table (every product column except the raw document) plus the
    categories; the base products table itself is not part of the variant."""
    out = {"search_docs": base["products"].select(*S.SEARCH_COLUMNS)}
    if base.get("categories") is not None:
        out["categories"] = base["categories"].select("id", "parent_id", "name_en", "name_cn",
                                                      "code")
    return out


def clear_column(column: str, value=None) -> Callable[[DataFrame], DataFrame]:
    def f(df: DataFrame) -> DataFrame:
        return df.withColumn(column, F.lit(value).cast(df.schema[column].dataType))
    return f


def transformed_copy(transforms: list[Callable[[DataFrame], DataFrame]],
                     table: str = "products") -> Callable[[Tables], Tables]:
    """Copy every base table, applying ``transforms`` in order to ``table``."""
    def build(base: Tables) -> Tables:
        out = {k: v for k, v in base.items() if v is not None}
        out[table] = reduce(lambda df, f: f(df), transforms, base[table])
        return out
    return build


# fixed values: variant names and descriptions
VARIANTS: dict[str, tuple[str, Callable[[Tables], Tables]]] = {
    "search_only": ("Search table with every product attribute, plus categories", search_only),
    "no_raw_json": ("Full catalog with the raw document cleared",
                    transformed_copy([clear_column("raw_json")])),
    "minimal": ("Minimal catalog with the raw document cleared",
                transformed_copy([clear_column("raw_json")])),
}


def kept_columns(name: str) -> list[str]:
    """Product columns whose values a variant keeps."""
    return S.SEARCH_COLUMNS if name in VARIANTS else S.PRODUCT_COLUMNS


def asset_labels() -> dict[str, dict[str, str]]:
    """Label, archive name and description of every published asset, in order."""
    named = {"catalog": "Catalog tables as they are"} | {n: d for n, (d, _) in VARIANTS.items()}
    return {n: {"variant": n, "archive_name": f"{n}.tar.xz", "description": d}
            for n, d in named.items()}


def build_variant(base: Tables, name: str) -> Tables:
    if name not in VARIANTS:
        raise ValueError(f"Unknown variant {name!r}. Available: {list(VARIANTS)}")
    return VARIANTS[name][1](base)


def selected_variants(selected: Iterable[str] | None) -> list[str]:
    """``None``/empty/``["all"]`` -> every registered variant, in order."""
    sel = [s for s in (selected or []) if s]
    if not sel or sel == ["all"]:
        return list(VARIANTS)
    return sel


#: Columns looked up by value.
LOOKUP_COLUMNS = [S.PRODUCT_KEY, "mfr_part_number"]


def bloom_options(columns: Iterable[str], expected: int | None = None) -> dict[str, str]:
    """Writer options for Parquet Bloom filters of ``columns`` in every row group, as large as
    the values found ask for, or as ``expected`` different values do."""
    out = {} if expected else {"parquet.bloom.filter.adaptive.enabled": "true"}
    for c in columns:
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
        if expected:
            out[f"parquet.bloom.filter.expected.ndv#{c}"] = str(expected)
    return out


def write_tables(tables: Tables, out_dir: str, compression: str = "zstd",
                 sort_keys: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Write each table to ``out_dir/<table>``, range-partitioned and sorted by its key when
    one is given (``sort_keys``; default: the catalog's keys).  A table that is there already is replaced when the new one is written
    whole; if the write fails it stays."""
    if sort_keys is None:
        sort_keys = {"search_docs": [S.PRODUCT_KEY], "products": [S.PRODUCT_KEY],
                     "categories": ["id"]}
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        keys = sort_keys.get(name)
        out = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
        fresh = f"{out_dir.rstrip('/')}/.{name}.{uuid.uuid4().hex}.new"
        bloom = bloom_options(c for c in LOOKUP_COLUMNS if c in df.columns)
        out.write.option("compression", compression).options(**bloom).parquet(fresh)
        swap_in(df.sparkSession, fresh, path)
        paths[name] = path
    return paths


def generate_variants(base: Tables, out_dir: str, selected: Iterable[str] | None = None,
                      compression: str = "zstd", archive: str | None = None) -> list[dict]:
    """Build and write the selected variants; one result dict per variant with
    its folder, table paths and written size (``db_size_bytes``, told from the tables' files
    without reading them).  With ``archive`` (a codec) every table is also written compressed
    that way below ``out_dir/<variant>.archive``; ``archive_size_bytes`` is its size, else
    None."""
    results = []
    for name in selected_variants(selected):
        tables = build_variant(base, name)
        vdir = f"{out_dir.rstrip('/')}/{name}"
        paths = write_tables(tables, vdir, compression)
        spark = base["products"].sparkSession
        packed = None
        if archive:
            # from the tables as written, so nothing is computed twice
            written = {n: spark.read.parquet(p) for n, p in paths.items()}
            packed = write_tables(written, f"{vdir}.archive", archive)
        results.append({"variant": name, "description": VARIANTS[name][0], "path": vdir,
                        "tables": paths, "db_size_bytes": written_bytes(spark, paths),
                        "archive_size_bytes": written_bytes(spark, packed) if packed else None})
    return results


def written_bytes(spark, paths: dict[str, str]) -> int:
    """Bytes of the files of written tables."""
    from partsmith.operators.report import table_files

    # one row per table
    return sum(table_files(spark.read.parquet(p)).first()["bytes"] for p in paths.values())
