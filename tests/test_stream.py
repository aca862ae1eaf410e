"""Streaming ingest (foreachBatch upsert of landed page files) equals the batch upsert of
the same pages, loses nothing, and replaying is harmless."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.operators.align import align_schema
from partsmith.operators.ingest import catalog_rows, records_from_documents
from partsmith.operators.merge import const, merge
from partsmith.sources.documents import inline_pages
from partsmith.streaming.catalog import Catalog
from partsmith.streaming.ingest import ORDER, ingest_batch, run_stream

RUN_TS = "2024-03-01 00:00:00"


def _pages():
    p1 = {"dataList": [{"productCode": "C1", "productModel": "a", "stockNumber": 5,
                        "paramVOList": [{"paramNameEn": "R", "paramValueEn": "1k"}]},
                       {"productCode": "C2", "productModel": "b", "stockNumber": 7}],
          "currPage": 1, "totalRow": 3, "totalPage": 2}
    p2 = {"dataList": [{"productCode": "C1", "productModel": "a2", "stockNumber": 9}],
          "currPage": 2, "totalRow": 3, "totalPage": 2}
    p3 = {"dataList": [{"productCode": "C3", "productModel": "c", "stockNumber": "bad"},
                       {"productCode": "C4", "productModel": "d"}],
          "currPage": 1, "totalRow": 2, "totalPage": 1}
    return [p1, p2, p3]


def _land(folder, pages, per_file=1):
    """Page envelopes (dicts, or raw lines) as files whose names sort in arrival order."""
    os.makedirs(folder, exist_ok=True)
    lines = [p if isinstance(p, str) else json.dumps(p) for p in pages]
    for i in range(0, len(lines), per_file):
        path = os.path.join(folder, f"page-{i:03d}.json")
        with open(path, "w") as f:
            f.write("\n".join(lines[i:i + per_file]) + "\n")
        t = time.time() - 100 + i
        os.utime(path, (t, t))


def _page(n, *products):
    return {"dataList": list(products), "currPage": n, "totalRow": len(products), "totalPage": 9}


def _product(code, stock, **more):
    return {"productCode": code, "productModel": "m-" + code, "stockNumber": stock} | more


def _seeded(spark, root, stocks):
    rows = spark.createDataFrame([(k, "old", v) for k, v in stocks.items()],
                                 "sku string, mfr_part_number string, stock long")
    rows = align_schema(rows.withColumn("last_updated", F.lit("2024-01-01").cast("timestamp_ntz")),
                        S.PRODUCT_SCHEMA)
    catalog = Catalog(spark, root, buckets=3)
    catalog.seed(products=rows)
    return catalog


def _stocks(catalog):
    return {r.sku: r.stock for r in catalog.read("products").collect()}


def test_stream_equals_batch_and_rerun_is_harmless(spark, scratch):
    landing, root, ckpt = f"{scratch}/landing", f"{scratch}/catalog", f"{scratch}/ckpt"
    _land(landing, _pages())
    final = run_stream(spark, landing, root, ckpt, RUN_TS, files_per_trigger=1)
    catalog = Catalog(spark, root)

    # batch: one merge of every page in file/page/position order
    env = spark.read.text(landing).select(F.col("value").alias("doc"),
                                          F.col("_metadata.file_path").alias("source_file"))
    rows = catalog_rows(records_from_documents(inline_pages(env)), keep=ORDER)
    batch = merge(spark.createDataFrame([], S.PRODUCT_SCHEMA), rows, ["sku"],
                  {"last_updated": const(F.lit(RUN_TS).cast("timestamp_ntz"))}, order_by=ORDER)

    def snap(df):
        return sorted((r.sku, r.mfr_part_number, r.stock) for r in df.collect())

    assert snap(catalog.read("products")) == snap(batch) == [
        ("C1", "a2", 9), ("C2", "b", 7), ("C4", "d", 0)]
    assert catalog.read("product_params").count() == 0  # C1's last page carried none
    # a second run over the same checkpoint finds nothing new
    assert run_stream(spark, landing, root, ckpt, RUN_TS) == final
    assert snap(catalog.read("products")) == snap(batch)


def test_unseen_rejected_and_uncovered_products(spark, scratch):
    root = f"{scratch}/catalog"
    catalog = _seeded(spark, root, {"C1": 5, "C2": 6, "C3": 7, "C9": 3})
    # C1 is rejected (bad stock), C2 refreshed, C3 and C9 not there
    _land(f"{scratch}/a", [_page(1, _product("C1", "bad"), _product("C2", 8))])
    run_stream(spark, f"{scratch}/a", root, f"{scratch}/ca", RUN_TS)
    assert _stocks(catalog) == {"C1": 5, "C2": 8, "C3": 0, "C9": 0}
    rejects = catalog.read("rejects").collect()
    assert [(r.sku, r.reject_reason) for r in rejects] == [("C1", "stockNumber")]
    assert json.loads(rejects[0].doc)["productCode"] == "C1"


@pytest.mark.parametrize("case", ["cut line", "no key", "nothing landed", "part of the catalog"])
def test_stock_stays_when_the_run_cannot_know(spark, scratch, case):
    root = f"{scratch}/catalog"
    catalog = _seeded(spark, root, {"C1": 5, "C3": 7})
    good = json.dumps(_page(1, _product("C1", 6)))
    pages = {"cut line": [good, json.dumps(_page(2, _product("C3", 8)))[:-25]],
             "no key": [good, _page(2, {"stockNumber": "bad"})],
             "nothing landed": [], "part of the catalog": [good]}[case]
    os.makedirs(f"{scratch}/in")
    _land(f"{scratch}/in", pages)
    run_stream(spark, f"{scratch}/in", root, f"{scratch}/ck", RUN_TS,
               whole_catalog=case != "part of the catalog")
    assert _stocks(catalog) == {"C1": 5 if case == "nothing landed" else 6, "C3": 7}
    assert catalog.read("bad_pages").count() == (case == "cut line")


@pytest.mark.parametrize("per_file,per_trigger", [(1, 1), (1, 3), (1, 10), (2, 1), (3, 1)])
def test_last_page_decides_parameters(spark, scratch, per_file, per_trigger):
    def with_param(v):
        return _product("C1", 1, paramVOList=[{"paramNameEn": "R", "paramValueEn": v}])

    pages = [_page(1, with_param("1k")), _page(2, with_param("2k")), _page(3, _product("C2", 2))]
    _land(f"{scratch}/in", pages, per_file)
    run_stream(spark, f"{scratch}/in", f"{scratch}/c", f"{scratch}/ck", RUN_TS,
               files_per_trigger=per_trigger)
    params = Catalog(spark, f"{scratch}/c").read("product_params").collect()
    assert [(r.sku, r.param_name, r.param_value) for r in params] == [("C1", "R", "2k")]


def _batch(spark, pages):
    return spark.createDataFrame([(json.dumps(p), f"f{i}") for i, p in enumerate(pages)],
                                 "doc string, source_file string")


def test_replayed_batch_is_skipped(spark, scratch):
    catalog = _seeded(spark, f"{scratch}/c", {"C1": 5})
    batch = _batch(spark, [_page(1, _product("C1", 6))])
    ingest_batch(catalog, batch, RUN_TS, source=("ck", 0))
    v = catalog.current_version()
    ingest_batch(catalog, batch, RUN_TS, source=("ck", 0))
    assert catalog.current_version() == v
    ingest_batch(catalog, batch, RUN_TS, source=("ck", 1))
    assert catalog.current_version() == v + 1


def test_crash_between_write_and_commit(spark, scratch, monkeypatch):
    catalog = _seeded(spark, f"{scratch}/c", {"C1": 5, "C2": 6})
    batch = _batch(spark, [_page(1, _product("C1", 9))])

    def crash(*a):
        raise RuntimeError("killed")

    monkeypatch.setattr(catalog, "publish", crash)
    with pytest.raises(RuntimeError):
        ingest_batch(catalog, batch, RUN_TS, source=("ck", 0))
    monkeypatch.undo()
    assert _stocks(catalog) == {"C1": 5, "C2": 6}
    ingest_batch(catalog, batch, RUN_TS, source=("ck", 0))
    assert _stocks(catalog) == {"C1": 9, "C2": 6}


def test_unreadable_pointer_is_an_error_not_an_empty_catalog(spark, scratch):
    catalog = _seeded(spark, f"{scratch}/c", {"C1": 5})
    path = f"{scratch}/c/_versions/00000000.json"
    with open(path, "w") as f:
        f.write('{"buckets"')
    crc = f"{scratch}/c/_versions/.00000000.json.crc"
    if os.path.exists(crc):
        os.unlink(crc)
    with pytest.raises(ValueError):
        ingest_batch(catalog, _batch(spark, [_page(1, _product("C2", 1))]), RUN_TS)


def test_only_touched_buckets_are_rewritten(spark, scratch):
    catalog = _seeded(spark, f"{scratch}/c", {f"C{i}": i for i in range(30)})
    before = catalog.state()["tables"]["products"]
    ingest_batch(catalog, _batch(spark, [_page(1, _product("C7", 70))]), RUN_TS)
    after = catalog.state()["tables"]["products"]
    assert sum(before[b] != after[b] for b in before) == 1 and before.keys() == after.keys()
    assert _stocks(catalog) == {f"C{i}": i for i in range(30)} | {"C7": 70}


# -- commits, logs, vacuum ---------------------------------------------------------------
def test_of_two_writers_the_loser_changes_nothing(spark, scratch):
    root = f"{scratch}/catalog"
    catalog = _seeded(spark, root, {f"C{i}": i for i in range(30)})
    late = Catalog(spark, root)
    state, version = late.state(), late.next_version()
    changed = catalog.read("products").withColumn("stock", F.lit(1).cast("long"))
    lost = late.write("products", changed.withColumn("stock", F.lit(2).cast("long")), version, state)
    # another one commits the same version in between
    catalog.publish(catalog.next_version(), catalog.write("products", changed, version, catalog.state()))
    with pytest.raises(FileExistsError):
        late.publish(version, lost)
    assert set(_stocks(catalog).values()) == {1}
    assert catalog.vacuum(keep=10)  # what the loser wrote
    assert set(_stocks(catalog).values()) == {1}


def test_one_of_many_writers_gets_a_file(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    from partsmith.sources import files

    def attempt(i):
        try:
            files.write_once(spark, f"{scratch}/v.json", f"writer {i}" * 1000)
            return i
        except FileExistsError:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(attempt, range(8)) if i is not None]
    assert len(won) == 1
    assert files.read_text(spark, f"{scratch}/v.json") == f"writer {won[0]}" * 1000
    assert [n for n in os.listdir(scratch) if n.endswith(".tmp")] == []


def test_vacuum_keeps_the_newest_versions_and_open_attempts(spark, scratch):
    catalog = _seeded(spark, f"{scratch}/catalog", {f"C{i}": i for i in range(10)})
    for n in range(4):
        rows = catalog.read("products").withColumn("stock", F.lit(n).cast("long"))
        version, state = catalog.next_version(), catalog.state()
        catalog.publish(version, catalog.write("products", rows, version, state))
    # an attempt at the next version that hasn't committed yet
    open_state = catalog.write("products", catalog.read("products"), 5, catalog.state())
    removed = catalog.vacuum(keep=2)
    assert len(removed) == 3 and all(r.startswith("products/v0000000") for r in removed)
    assert set(_stocks(catalog).values()) == {3}
    assert {r.stock for r in catalog.read("products", version=3).collect()} == {2}
    catalog.publish(5, open_state)
    assert catalog.read("products").count() == 10
    assert sorted(os.listdir(f"{scratch}/catalog/_versions"))[-1] == "00000005.json"


def test_version_files_stay_small_however_many_batches(spark, scratch, monkeypatch):
    from partsmith.streaming import catalog as M

    monkeypatch.setattr(M, "LOG_MERGE", 3)
    catalog = Catalog(spark, f"{scratch}/catalog")
    for n in range(11):
        row = spark.createDataFrame([(f"f{n}", f"line {n}")], "source_file string, line string")
        version, state = catalog.next_version(), catalog.state()
        state = catalog.append("bad_pages", row.withColumn("run_ts", F.lit(RUN_TS).cast("timestamp_ntz")),
                               version, state)
        catalog.publish(version, state)
    held = catalog.state()["logs"]["bad_pages"]
    assert [t for _, t in held] == [2, 0, 0]  # 9 + 1 + 1
    assert sorted(r.line for r in catalog.read("bad_pages").collect()) == sorted(f"line {n}" for n in range(11))
    assert catalog.read("bad_pages", version=4).count() == 5


def test_a_run_logs_its_pages_and_ids(spark, scratch):
    from partsmith import api

    pages = [_page(1, _product("C1", 5, productId=70000), _product("C2", 6, productId=1)),
             _page(2, _product("C3", 7, productId=1), _product("C4", "bad", productId=0)),
             _page(3, _product("C5", 1, productId=3), _product("C6", 2))]
    _land(f"{scratch}/in", pages)
    root = f"{scratch}/catalog"
    run_stream(spark, f"{scratch}/in", root, f"{scratch}/ck", RUN_TS, files_per_trigger=1)
    # replaying a batch logs nothing twice
    run_stream(spark, f"{scratch}/in", root, f"{scratch}/ck", RUN_TS, files_per_trigger=1)
    assert api.last_run(spark, root) == RUN_TS
    got = sorted((r.page, r["items"], r.fetched, r.pct, r.remaining)
                 for r in api.progress(spark, root, expected=8).collect())
    assert got == [(1, 2, 2, 25.0, 6), (2, 2, 4, 50.0, 4), (3, 2, 6, 75.0, 2)]
    one = api.summary(spark, root, expected=8).first()
    assert (one.fetched, one.pct, one.unique_products) == (6, 75.0, 3)
    assert api.summary(spark, root, run_ts="2001-01-01 00:00:00").collect() == []
    known = {r.page: r.known_items for r in Catalog(spark, root).read("pages").collect()}
    assert known == {1: 2, 2: 1, 3: 1}


def test_a_long_landing_is_drained_in_few_micro_batches(spark, scratch):
    pages = [_page(n, {"productCode": f"C{n}", "productModel": "m", "stockNumber": n},
                   {"productCode": "C0", "productModel": "m", "stockNumber": n})
             for n in range(1, 20)]
    _land(f"{scratch}/in", [*pages, '{"dataList":[{"productCode":"C'])
    root = f"{scratch}/cat"
    # 20 files, of which the caller asks for one at a time
    run_stream(spark, f"{scratch}/in", root, f"{scratch}/ck", RUN_TS, files_per_trigger=1)
    catalog = Catalog(spark, root)
    assert catalog.current_version() == 6  # seven commits of three files
    got = {r.sku: r.stock for r in catalog.read("products").collect()}
    assert got == {"C0": 19} | {f"C{n}": n for n in range(1, 20)}
    assert catalog.read("pages").count() == 19 and catalog.read("bad_pages").count() == 1
