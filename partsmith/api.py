"""One call per catalog workflow, for users of the command-line flows.

* ``ingest``  - load the category tree, drain landed product pages into the catalog
  (streaming upsert), then set the stock of products not seen this run to 0; ``progress``
  and ``summary`` read what the run logged;
* ``enrich``  - overlay the second vendor's bulk tables onto the catalog, its category
  names included;
* ``publish`` - write the published variants of the current catalog;
* ``release_manifest`` - size statistics of published variants merged into an
  existing manifest table.

The catalog lives under one root as versioned tables (``products``, ``product_params``,
``categories`` and the logs ``rejects`` and ``bad_pages``; see ``streaming.catalog``).
Every call that changes it writes the tables it changes and then commits one version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.operators.enrich import enrich as enrich_rows
from partsmith.operators.enrich import vendor_categories
from partsmith.operators.merge import ACTION, merge, merge_partial
from partsmith.operators.ordering import materialize
from partsmith.operators.policies import OVERLAY_DEFAULT, overlay_rules
from partsmith.operators.report import format_size_exact, manifest_rows, merge_manifest
from partsmith.operators.variants import asset_labels, generate_variants
from partsmith.session import run_marker, scratch_path
from partsmith.sources.documents import read_json_files
from partsmith.sources.trees import category_records, unroll_tree
from partsmith.sources.vendor import read_vendor_tables
from partsmith.streaming.catalog import Catalog
from partsmith.streaming.ingest import run_progress, run_report, run_stream


def load_categories(spark: SparkSession, tree: str, catalog_root: str,
                    root_path: str | None = None, buckets: int = 16) -> int:
    """Upsert the nodes of category tree documents (one JSON response per file under
    ``tree``; ``root_path`` as in ``unroll_tree``) into the catalog; returns the version."""
    catalog = Catalog(spark, catalog_root, buckets)
    nodes = category_records(unroll_tree(read_json_files(spark, tree), root_path=root_path))
    rows = materialize(nodes.where("id is not null"))
    return _merge_categories(catalog, rows, S.CATEGORY_SCHEMA.fieldNames()[1:], ["path_key"])


def _merge_categories(catalog: Catalog, rows: DataFrame, columns: list[str],
                      order_by: list[str]) -> int:
    state, version = catalog.state(), catalog.next_version()
    only = catalog.touched("categories", rows, state)
    merged = merge_partial(catalog.read("categories", state=state, only=only), rows, ["id"],
                           columns, order_by=order_by)
    catalog.publish(version, catalog.write("categories", merged, version, state, only))
    return version


def ingest(spark: SparkSession, landing: str, catalog_root: str, run_ts: str | None = None,
           include_raw_json: bool = True, whole_catalog: bool = True,
           checkpoint: str | None = None, files_per_trigger: int = 1000,
           category_tree: str | None = None, category_root_path: str | None = None,
           buckets: int = 16) -> int | None:
    """Upsert every landed page file into the catalog; returns the current version.
    ``run_ts`` names the run (default: the time now; give the same one to resume a run), also
    to ``progress`` and ``summary``.  ``buckets`` counts when the catalog is created.
    ``checkpoint`` defaults to a folder under the shared checkpoint directory (reuse the same
    one to resume an interrupted run).  With ``category_tree`` the categories are
    loaded first.  ``whole_catalog=False`` for runs over a part of the catalog: they leave
    the stock of other products alone."""
    run_ts = run_ts or run_marker(spark)
    if category_tree:
        load_categories(spark, category_tree, catalog_root, category_root_path, buckets)
    ckpt = checkpoint or scratch_path(spark, "ingest-checkpoint")
    return run_stream(spark, landing, catalog_root, ckpt, run_ts, include_raw_json,
                      files_per_trigger, whole_catalog, buckets)


def last_run(spark: SparkSession, catalog_root: str) -> str | None:
    """Name of the last ingest run of a catalog; None if there was none."""
    return (Catalog(spark, catalog_root).state().get("run") or {}).get("ts")


def progress(spark: SparkSession, catalog_root: str, expected: int = 0,
             run_ts: str | None = None) -> DataFrame:
    """Running totals, percent of ``expected``, rate and ETA after every page of a run (default:
    the last one)."""
    run_ts = run_ts or last_run(spark, catalog_root)
    return run_progress(Catalog(spark, catalog_root), run_ts, expected)


def summary(spark: SparkSession, catalog_root: str, expected: int = 0,
            run_ts: str | None = None) -> DataFrame:
    """Duration, items fetched, percent of ``expected`` and distinct products of a run (default:
    the last one)."""
    run_ts = run_ts or last_run(spark, catalog_root)
    return run_report(Catalog(spark, catalog_root), run_ts, expected)


def enrich(spark: SparkSession, catalog_root: str, vendor_dir: str, run_ts: str | None = None,
           fmt: str = "parquet") -> dict:
    """Overlay the second vendor's tables onto the current catalog, products and category
    names, and commit the result.  Returns ``{"version", "affected"}`` where ``affected``
    counts the products inserted or updated.  Of vendor rows with the same key the one
    updated last counts."""
    run_ts = run_ts or run_marker(spark)
    catalog = Catalog(spark, catalog_root)
    before = catalog.current_version()
    v = read_vendor_tables(spark, vendor_dir, fmt)
    names = vendor_categories(v["categories"]).withColumn("__name", F.col("name_en"))
    _merge_categories(catalog, names, ["name_en"], ["__name"])
    state, version = catalog.state(), catalog.next_version()
    # the catalog without an overlay; an ingest in between begins anew
    state["primary_version"] = state.get("primary_version", before)
    rows = enrich_rows(v["components"], v["categories"], v["manufacturers"])
    rows = materialize(rows.select("*", F.struct("vendor_last_updated", "vendor_stock",
                                                 "mfr_part_number").alias("__order")))
    only = catalog.touched("products", rows, state)
    merged = merge(
        catalog.read("products", state=state, only=only), rows, [S.PRODUCT_KEY],
        overlay_rules(run_ts), default=OVERLAY_DEFAULT, order_by=["__order"], with_action=True)
    # counted by the write itself
    seen = Observation("overlay")
    observed = merged.observe(seen, F.count_if(F.col(ACTION) != "unchanged").alias("affected"))
    state = catalog.write("products", observed.drop(ACTION), version, state, only)
    catalog.publish(version, state)
    return {"version": version, "affected": seen.get["affected"]}


def publish(spark: SparkSession, catalog_root: str, out_dir: str,
            selected: list[str] | None = None, compression: str = "zstd",
            dataset: str = "integrated", archive: str | None = None) -> list[dict]:
    """Write the selected variants (all when ``None``/empty) of the current catalog, its
    categories included, under ``out_dir/<variant>``.  ``dataset="primary"`` publishes the
    catalog as it was before the second vendor's overlay (the same as the current one if there
    was none).  With ``archive`` (a codec) compressed copies are written, too."""
    if dataset not in ("integrated", "primary"):
        raise ValueError(f"Unknown dataset {dataset!r}. Available: integrated, primary")
    catalog = Catalog(spark, catalog_root)
    state = catalog.state()
    before = state.get("primary_version")
    if dataset == "primary" and before is not None:
        state = catalog.state(before)
    base = {t: catalog.read(t, state=state) for t in ("products", "product_params", "categories")}
    return generate_variants(base, out_dir, selected, compression, archive)


def release_manifest(spark: SparkSession, published: list[dict], updated_at: str,
                     known: dict[str, dict[str, str]] | None = None,
                     previous: DataFrame | None = None) -> DataFrame:
    """Manifest rows (asset, label, archive, description, bytes, ...) of the
    published variants, with the sizes of their written files (compressed ones where archives
    were written), merged into the ``previous`` manifest (new entries replace old ones by
    asset)."""
    # one row per published variant
    stats = spark.createDataFrame(
        [(r["variant"], r["db_size_bytes"], r.get("archive_size_bytes")) for r in published],
        "name string, logical_bytes long, archive_bytes long")
    new = manifest_rows(stats, known or asset_labels(), updated_at, archive_col="archive_bytes")
    out = new if previous is None else merge_manifest(previous, new)
    return out.withColumn("db_size", format_size_exact("db_size_bytes"))
