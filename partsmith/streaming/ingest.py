"""Page ingest as a Structured Streaming query.

Landed page envelopes (JSON lines) are read with the file source; every micro-batch is
parsed, deduplicated (last write wins in file/page/position order) and merged into the
catalog through ``foreachBatch``.  Contract: landed file paths sort in arrival order
(e.g. a zero-padded sequence or timestamp in the name), so that a micro-batch with
several files orders them right; files are also taken in modification-time order across
micro-batches.

Nothing landed is lost: records that fail coercion go to the catalog's ``rejects`` log and
lines that are no page envelope to ``bad_pages``, in the same commit as the products.  So do
the pages read (``pages``, with their items) and the product ids seen (``seen``, as bitmaps
that add up exactly over micro-batches), from which ``run_progress`` and ``run_report`` tell
a run's progress and summary.  The
parameters of a product are those of the last page that holds it, however pages are
spread over files and micro-batches.  A commit names the checkpoint and batch it came
from, so a micro-batch that is replayed after a failure (foreachBatch is at-least-once)
is recognised and skipped.

After a run, products it did not see get stock 0, but only if the run covered the whole
catalog, read at least one page and no bad one, and every rejected record had a key; the
keys of rejected records count as seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.operators.ingest import catalog_rows, params_rows, records_from_documents
from partsmith.operators.merge import mark_unseen, merge, refresh_children, stale_predicate
from partsmith.operators.ordering import materialize
from partsmith.operators.progress import progress_series, run_totals
from partsmith.operators.policies import product_rules
from partsmith.session import run_marker
from partsmith.sources import files
from partsmith.sources.documents import bad_page_lines, inline_pages, read_page_stream
from partsmith.streaming.catalog import Catalog

ORDER = ["source_file", "page", "pos"]
#: Micro-batches that a backlog is drained in, at most.  Each rewrites the buckets it touches
#: (soon all of them), so as many of them as files would rewrite the catalog once per few files.
BACKLOG_BATCHES = 8


def _run(state: dict, run_ts: str) -> dict:
    """Counts of the run so far; another timestamp begins a new run."""
    run = state.get("run") or {}
    if run.get("ts") != str(run_ts):
        run = {"ts": str(run_ts), "pages": 0, "bad_pages": 0, "keyless_rejects": 0}
    return run


def ingest_batch(catalog: Catalog, batch: DataFrame, run_ts: str, include_raw_json: bool = True,
                 source: tuple[str, int] | None = None) -> None:
    """Merge one micro-batch of page envelopes (``doc``, ``source_file``) and commit it as
    the next version.  ``source`` names the checkpoint and batch id."""
    state = catalog.state()
    done = state.get("stream") or {}
    if source and done.get("checkpoint") == source[0] and done["batch"] >= source[1]:
        return
    version, ts = catalog.next_version(), F.lit(run_ts).cast("timestamp_ntz")
    # parsed once (written to the shared folder), used by every table below
    recs = materialize(records_from_documents(inline_pages(batch), include_raw_json,
                                              keep_doc="__doc"))
    rows = catalog_rows(recs, keep=ORDER)
    state["run"] = run = _run(state, run_ts)
    state.pop("primary_version", None)  # products come from the pages again

    buckets = catalog.touched("products", rows, state)
    if buckets:
        merged = merge(catalog.read("products", state=state, only=buckets), rows,
                       [S.PRODUCT_KEY], product_rules(run_ts, include_raw_json), order_by=ORDER)
        state = catalog.write("products", merged, version, state, buckets)
        # the last page that holds a product decides its parameters
        page = F.struct("source_file", "page").alias("batch")
        params = refresh_children(
            catalog.read("product_params", state=state, only=buckets),
            rows.select(S.PRODUCT_KEY, page),
            params_rows(recs, keep=ORDER).select(*S.PARAM_SCHEMA.fieldNames(), page),
            S.PRODUCT_KEY, batch_col="batch")
        state = catalog.write("product_params", params, version, state, buckets)
    rejects = recs.where("rejected").select(ts.alias("run_ts"), *ORDER, S.PRODUCT_KEY,
                                            "reject_reason", F.col("__doc").alias("doc"))
    keyless = F.coalesce(F.col(S.PRODUCT_KEY), F.lit("")) == ""
    n_items, n_rejects, n_keyless = recs.agg(
        F.count(F.lit(1)), F.count_if(F.col("rejected")), F.count_if(F.col("rejected") & keyless)).first()
    if n_rejects:
        state = catalog.append("rejects", rejects, version, state)
    pages = recs.groupBy("source_file", "page").agg(
        F.count(F.lit(1)).alias("items"),
        F.count(F.nullif("product_id", F.lit(0))).alias("known_items"))
    if n_items:
        state = catalog.append("pages", pages.select(
            ts.alias("run_ts"), "source_file", F.lit(version).cast("long").alias("batch"), "page",
            "items", "known_items",
            F.lit(run_marker(catalog.spark)).cast("timestamp_ntz").alias("logged_at")),
            version, state)
        state = catalog.append("seen", _seen(recs).select(ts.alias("run_ts"), "bucket", "ids"),
                               version, state)
    bad = bad_page_lines(batch)
    n_pages, n_bad = bad.agg(F.count_if(~F.col("bad")), F.count_if(F.col("bad"))).first()
    if n_bad:
        lines = bad.where("bad").select(ts.alias("run_ts"), "source_file", "line")
        state = catalog.append("bad_pages", lines, version, state)
    state["run"] = {"ts": run["ts"], "pages": run["pages"] + n_pages,
                    "bad_pages": run["bad_pages"] + n_bad,
                    "keyless_rejects": run["keyless_rejects"] + n_keyless}
    if source:
        state["stream"] = {"checkpoint": source[0], "batch": source[1]}
    catalog.publish(version, state)


def _seen(records: DataFrame) -> DataFrame:
    """Distinct non-zero product ids as one bitmap per 32,768 ids."""
    return (records.where("product_id != 0")
            .groupBy(F.bitmap_bucket_number("product_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("product_id")).alias("ids")))


def run_progress(catalog: Catalog, run_ts: str, expected: int) -> DataFrame:
    """Progress series (``operators.progress``) of a run's pages, in the order of their commits:
    ``batch, source_file, page, items, fetched, pct, remaining, rate, eta, ...``."""
    log = catalog.read("pages").where(F.col("run_ts") == F.lit(run_ts).cast("timestamp_ntz"))
    return progress_series(log, "run_ts", "logged_at", ["batch", "source_file", "page"], "items",
                           expected)


def run_report(catalog: Catalog, run_ts: str, expected: int) -> DataFrame:
    """One row about a run: ``duration, expected, fetched, pct, unique_products`` (no row if it
    read no product)."""
    mine = F.col("run_ts") == F.lit(run_ts).cast("timestamp_ntz")
    unique = (catalog.read("seen").where(mine).groupBy("bucket")
              .agg(F.bitmap_or_agg("ids").alias("ids"))
              .agg(F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0))).scalar())
    return run_totals(catalog.read("pages").where(mine), "run_ts", "logged_at", "items",
                      expected).withColumn("unique_products", unique.cast("long"))


def covers_catalog(run: dict) -> bool:
    """Whether a run read pages, all of them well, and can name all it rejected."""
    return run.get("pages", 0) > 0 and not run["bad_pages"] and not run["keyless_rejects"]


def mark_unseen_products(catalog: Catalog, run_ts: str) -> bool:
    """Set the stock of products this run did not see to 0 and commit; False if the run
    doesn't allow it.  Only buckets with such products are rewritten."""
    state = catalog.state()
    if not covers_catalog(_run(state, run_ts)):
        return False
    ts = F.lit(run_ts).cast("timestamp_ntz")
    refused = (catalog.read("rejects", state=state).where(F.col("run_ts") == ts)
               .select(S.PRODUCT_KEY).distinct().withColumn("__refused", F.lit(True)))
    stale = stale_predicate(ts)
    old = (catalog.read("products", state=state).where(stale)
           .select(S.PRODUCT_KEY).join(refused, S.PRODUCT_KEY, "left_anti"))
    buckets = catalog.touched("products", old, state)
    if not buckets:
        return True
    products = catalog.read("products", state=state, only=buckets).join(
        refused, S.PRODUCT_KEY, "left")
    marked = mark_unseen(products, ts, S.STOCK_COLUMNS, unless=F.coalesce("__refused", F.lit(False)))
    version = catalog.next_version()
    state = catalog.write("products", marked, version, state, buckets)
    catalog.publish(version, state)
    return True


def backlog_trigger(n_files: int, files_per_trigger: int) -> int:
    """Files per micro-batch: ``files_per_trigger``, or more where a landing of ``n_files`` would
    take over ``BACKLOG_BATCHES`` micro-batches."""
    return max(files_per_trigger, -(-n_files // BACKLOG_BATCHES))


def run_stream(spark: SparkSession, landing: str, table_root: str, checkpoint: str, run_ts: str,
               include_raw_json: bool = True, files_per_trigger: int = 1000,
               whole_catalog: bool = True, buckets: int = 16) -> int | None:
    """Drain ``landing`` into the catalog at ``table_root``; returns the current version.
    ``whole_catalog``: the run covers the catalog, so products it doesn't see are gone (a
    run over one category or over stocked items only must set it to False).
    ``files_per_trigger``: the least that a micro-batch takes (see ``backlog_trigger``)."""
    catalog = Catalog(spark, table_root, buckets)

    def each(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(catalog, batch, run_ts, include_raw_json, (checkpoint, batch_id))

    landed = [n for n in files.names(spark, landing) or [] if not n.startswith(("_", "."))]
    q = (read_page_stream(spark, landing, backlog_trigger(len(landed), files_per_trigger))
         .writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if whole_catalog:
        mark_unseen_products(catalog, run_ts)
    return catalog.current_version()
