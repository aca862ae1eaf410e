"""Search semantics, top-k, lookup, paging, facets and the postings index
(FIXTURES §3)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partsmith.functions.text import literal_trigrams
from partsmith.operators.index import build_postings, search_indexed, write_postings
from partsmith.operators.search import catalog_filter, facet_counts, page_envelope, search, top_k
from tests.helpers import products_df

ROWS = [
    {"sku": "C11", "mfr_part_number": "LANTERN-9W", "brand_name": "Halmar",
     "package": "box of 6", "description": "Garden lantern with warm light, mains powered",
     "first_category_name": "Lighting", "second_category_name": "Outdoor", "stock": 40,
     "vendor_stock": 12, "vendor_library_type": "Basic", "pdf_url": "https://example.com/lantern.pdf",
     "category_id": 1, "raw_json": "{\"w\": 9}"},
    {"sku": "C22", "mfr_part_number": "TORCH-USB", "brand_name": "Brightco",
     "package": "single", "description": "Re-chargeable torch with cold light",
     "first_category_name": "Lighting", "second_category_name": "Portable",
     "stock": 15, "vendor_stock": 5, "vendor_library_type": "Preferred",
     "pdf_url": "https://example.com/torch.pdf", "category_id": 2},
    {"sku": "C33", "mfr_part_number": "WIRE-2M", "brand_name": "Câblerie du Lac",
     "package": "roll", "description": "Copper wire, 2 m", "stock": 0, "category_id": 1},
]


def _p(spark):
    return products_df(spark, ROWS)


def skus(df):
    return sorted(r.sku for r in df.select("sku").collect())


def test_search_finds_exactly_the_part(spark):
    hits = search(_p(spark), all=["Lantern"]).collect()
    assert [h.sku for h in hits] == ["C11"]
    assert hits[0].stock == 40 and hits[0].vendor_library_type == "Basic"


def test_unindexed_columns_never_match(spark):
    assert skus(search(_p(spark), all=["lantern.pdf"])) == []
    assert skus(search(_p(spark), all=["https"])) == []


def test_case_folding_and_accents(spark):
    assert skus(search(_p(spark), all=["CÂBLERIE"])) == ["C33"]
    assert skus(search(_p(spark), all=["cablerie"])) == []


def test_short_terms(spark):
    assert skus(search(_p(spark), all=["zz"])) == []
    assert skus(search(_p(spark), all=["zz", "lantern"])) == ["C11"]


def test_terms_may_match_in_different_columns(spark):
    assert skus(search(_p(spark), all=["lantern", "mains"])) == ["C11"]
    assert skus(search(_p(spark), any=["torch", "lantern"])) == ["C11", "C22"]
    assert skus(search(_p(spark), all=["light"], none=["re-ch"])) == ["C11"]


def test_key_lookup_and_topk(spark):
    assert _p(spark).filter(F.col("sku") == "C22").count() == 1
    top = top_k(search(_p(spark), all=["light"]), 1, [F.col("stock").desc()], ["sku"]).collect()
    assert [r.sku for r in top] == ["C11"]


def test_filters_absent_arguments_add_nothing(spark):
    p = _p(spark)
    assert catalog_filter(p).count() == 3
    assert skus(catalog_filter(p, category_ids=1)) == ["C11", "C33"]
    assert skus(catalog_filter(p, category_ids=1, instock_only=True)) == ["C11"]
    assert skus(catalog_filter(p, keyword="usb")) == ["C22"]
    assert catalog_filter(p, category_ids=[]).count() == 0
    assert catalog_filter(p, category_ids=[], empty_means_all=True).count() == 3
    assert skus(catalog_filter(p, brand_ids=[], category_ids=2, empty_means_all=True)) == ["C22"]


def test_page_envelope_and_facets(spark):
    p = _p(spark)
    pg = page_envelope(p, 2, 2).collect()
    assert [r.sku for r in pg] == ["C33"]
    assert pg[0].total_row == 3 and pg[0].total_page == 2 and pg[0].curr_page == 2
    f = {r.brand_name: (r.n, r.total_count) for r in facet_counts(p, "brand_name").collect()}
    assert f["Brightco"] == (1, 3)


def test_postings_written_and_searched(spark, scratch):
    p = _p(spark)
    cols = ["mfr_part_number", "description"]
    write_postings(build_postings(p, ["sku"], cols), f"{scratch}/postings")
    posts = spark.read.parquet(f"{scratch}/postings")
    hits = search_indexed(p, posts, ["sku"], all=["mains"], columns=cols)
    assert skus(hits) == ["C11"]
    # every trigram of "abcde" occurs, the term itself does not: verification drops it
    q = products_df(spark, [{"sku": "C1", "mfr_part_number": "x", "description": "abcd bcde"}])
    qp = build_postings(q, ["sku"], cols)
    assert qp.filter("trigram in ('abc', 'bcd', 'cde')").count() == 3  # distinct per value
    assert skus(search_indexed(q, qp, ["sku"], all=["abcde"], columns=cols)) == []
    assert skus(search_indexed(q, qp, ["sku"], all=["bcde"], columns=cols)) == ["C1"]


TEXT = "".join(r["description"] + r["mfr_part_number"] for r in ROWS).lower()


@settings(max_examples=8, deadline=None)
@given(st.integers(0, len(TEXT) - 6), st.integers(2, 6))
def test_index_path_equals_scan_path(spark, start, n):
    term = TEXT[start:start + n]
    p = _p(spark)
    cols = ["mfr_part_number", "description"]
    posts = build_postings(p, ["sku"], cols)
    assert skus(search_indexed(p, posts, ["sku"], all=[term], columns=cols)) == \
        skus(search(p, all=[term], columns=cols))


def test_bulk_paging(spark):
    from partsmith.operators.search import assign_pages

    df = spark.range(0, 250, 1, 5).selectExpr("id * 7 % 250 AS k")
    got = {r.k: (r.page, r.pos) for r in assign_pages(df, 100, ["k"]).collect()}
    assert got[0] == (1, 0) and got[99] == (1, 99) and got[100] == (2, 0) and got[249] == (3, 49)


def test_repeated_keys_are_found_like_the_scan(spark):
    rows = [("k", "abcabc xyz"), ("k", "abcabc"), ("m", "zabcabc")]
    df = spark.createDataFrame(rows, "id string, body string")
    posts = build_postings(df, ["id"], ["body"])
    got = search_indexed(df, posts, ["id"], all=["abcabc"], columns=["body"])
    assert sorted(got.collect()) == sorted(search(df, all=["abcabc"], columns=["body"]).collect())
    assert got.count() == 3


def test_postings_of_a_dominating_trigram_are_spread(spark, scratch):
    posts = spark.range(20000).selectExpr(
        "if(id % 10 = 0, lpad(string(id % 700), 3, '0'), 'the') AS trigram", "id", "'body' AS column")
    write_postings(posts, f"{scratch}/p", rows_per_file=2500)
    back = spark.read.parquet(f"{scratch}/p")
    sizes = [r[1] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 20000 and len(sizes) == 8 and max(sizes) < 2 * 2500
    plan = back.filter(F.col("trigram").isin("the", "012"))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(trigram" in plan


def test_folding_has_no_context_rules(spark):
    df = spark.createDataFrame([("ΟΔΟΣΑ",)], "body string")
    assert search(df, all=["ΟΔΟΣ"], columns=["body"]).count() == 1
    posts = build_postings(df, ["body"], ["body"])
    assert search_indexed(df, posts, ["body"], all=["ΟΔΟΣ"], columns=["body"]).count() == 1


def test_deep_pages_and_key_paging(spark, monkeypatch):
    from partsmith.operators import search as M

    df = spark.range(0, 500, 1, 4).selectExpr("lpad(string(id * 7 % 500), 4, '0') AS sku")
    want = [f"{i:04d}" for i in range(500)]
    early = [r.sku for r in M.page(df, 3, 50, ["sku"]).collect()]
    monkeypatch.setattr(M, "HEAP_ROWS", 60)
    deep = [r.sku for r in M.page(df, 3, 50, ["sku"]).collect()]
    after = [r.sku for r in M.page_after(df, want[99], 50).collect()]
    assert early == deep == after == want[100:150]
    assert [r.sku for r in M.page_after(df, None, 2).collect()] == want[:2]
    assert M.page(df, 11, 50, ["sku"]).collect() == []


# -- index with trigram counts ---------------------------------------------------------
def _scanned_rows(df):
    """Rows that the Parquet scans of a query gave to their filters."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture()
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lists_of_common_trigrams_are_not_read(spark, scratch, plain_plans):
    from partsmith.operators.index import Index, rarest_trigrams, write_index

    # every row holds "common" with all its trigrams, ten hold "qzx"
    df = spark.range(20000).selectExpr("id", "if(id % 2000 = 0, 'common qzx', 'common') AS body")
    index = write_index(build_postings(df, ["id"], ["body"]), f"{scratch}/i", rows_per_file=5000)
    counts = {r.trigram: r.n_postings for r in index.trigrams.collect()}
    assert counts["com"] == 20000 and counts["qzx"] == 10
    assert rarest_trigrams(index.trigrams, "common qzx")[0] not in ("com", "omm", "mmo", "mon")
    assert set(rarest_trigrams(index.trigrams, "common qzx")) <= {"on ", "n q", " qz", "qzx"}
    assert rarest_trigrams(index.trigrams, "absent") is None
    term = "common qzx"
    hits = search_indexed(df, index, ["id"], all=[term], columns=["body"])
    assert sorted(r.id for r in hits.collect()) == list(range(0, 20000, 2000))
    rare = rarest_trigrams(index.trigrams, term)
    read = _scanned_rows(index.postings.filter(F.col("trigram").isin(*rare)))
    all_lists = _scanned_rows(index.postings.filter(F.col("trigram").isin(*literal_trigrams(term))))
    assert all_lists >= 80000 and read < all_lists / 4
    for terms in (["absent"], ["qzx", "absent"], ["zz"]):
        assert search_indexed(df, index, ["id"], all=terms, columns=["body"]).count() == 0
    assert search_indexed(df, index, ["id"], any=["absent", "qzx"], columns=["body"]).count() == 10
    assert isinstance(index, Index)


def test_postings_are_generated_once(spark, scratch):
    calls = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(i, f"body {i}") for i in range(50)], "id long, body string")

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    counted_rows = rows.mapInArrow(counted, rows.schema)
    write_postings(build_postings(counted_rows, ["id"], ["body"]), f"{scratch}/once")
    assert calls.value == 50


ODD_TEXTS = [("a", "Abcabc abc", "x"), ("a", "Abcabc abc", None), (None, "ab", "\0\0\0ß"), ("b", None, ""),
             ("c", "", "ΟΔΟΣ İİ 語語語語"), ("d", "abc" * 50, "zab")]


def _posting_rows(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("block_chars, piece, batch", [(4 << 20, 64, 1 << 18), (4, 2, 3), (200, 1, 1)])
def test_posting_lists_hold_the_rows_of_build_postings(spark, block_chars, piece, batch, monkeypatch):
    from partsmith.operators import index as I

    schema, cols = "id string, t string, u string", ["t", "u"]
    df = spark.createDataFrame(ODD_TEXTS, schema)
    for key, n in (("BLOCK_CHARS", block_chars), ("PIECE", piece), ("BATCH_POSTINGS", batch)):
        monkeypatch.setattr(I, key, n)
    for keys in (["id"], ["id", "t"]):
        # the functions of the tasks, with these settings
        got = []
        for c in cols:
            rows = df.where(F.length(c) > 0).select(*keys, I.fold(c).alias("__text")).toArrow()
            for b in I._lists_of_batches(iter(rows.to_batches())):
                for r in b.to_pylist():
                    assert 1 <= len(r["id"]) <= piece
                    got += [(r["trigram"], *k, c) for k in zip(*(r[k] for k in keys), strict=True)]
        want = _posting_rows(build_postings(df, keys, cols))
        assert sorted(got, key=str) == [tuple(r) for r in sorted(want, key=lambda r: str(tuple(r)))]
        lists = I.posting_lists(df, keys, cols)
        assert _posting_rows(I.list_postings(lists, keys)) == want


def test_trigrams_beyond_the_basic_plane(spark):
    from partsmith.operators.index import posting_lists

    df = spark.createDataFrame([(1, "a😀b😀"), (2, "😀b")], "id long, body string")
    got = {r.trigram: r.id for r in posting_lists(df, ["id"], ["body"]).collect()}
    assert got == {g: [1] for g in literal_trigrams("a😀b😀")}


def test_an_index_of_lists_moves_few_rows(spark, scratch):
    from partsmith.operators import index as I

    df = spark.range(0, 4000, 1, 4).selectExpr("id", "concat('the other text ', id % 50) AS body")
    lists = I.posting_lists(df, ["id"], ["body"])
    index = I.write_index(lists, f"{scratch}/i", lists=["id"], rows_per_file=9000)
    want = build_postings(df, ["id"], ["body"])
    n = want.count()
    # what is staged, shuffled and sorted
    assert lists.count() < n / 20
    assert index.postings.dtypes == want.dtypes and index.postings.count() == n
    assert index.postings.exceptAll(want).count() == 0
    sizes = [r[1] for r in index.postings.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == -(-n // 9000) and max(sizes) < 2 * 9000
    counts = {r.trigram: r.n_postings for r in index.trigrams.collect()}
    assert counts == {r["trigram"]: r["count"] for r in want.groupBy("trigram").count().collect()}
    # every file is a range of trigrams in order
    ranges = sorted((r.lo, r.hi) for r in index.postings.groupBy(F.input_file_name()).agg(
        F.min("trigram").alias("lo"), F.max("trigram").alias("hi")).collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    hits = search_indexed(df, index, ["id"], all=["text 4"], columns=["body"])
    assert hits.count() == search(df, all=["text 4"], columns=["body"]).count() == 880


def test_files_grow_with_the_postings_however_well_they_compress(spark, scratch, monkeypatch):
    from partsmith.operators import index as I

    monkeypatch.setattr(I, "FILE_POSTINGS", 4000)
    df = spark.range(0, 4000, 1, 4).selectExpr("id", "'the same text' AS body")
    I.write_postings(I.posting_lists(df, ["id"], ["body"]), f"{scratch}/p", lists=["id"])
    back = spark.read.parquet(f"{scratch}/p")
    sizes = [r[1] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 44000 and len(sizes) == 11 and max(sizes) < 2 * 4000


def test_bloom_filters_skip_row_groups_of_an_unsorted_copy(spark, scratch, plain_plans):
    from partsmith.operators.variants import LOOKUP_COLUMNS, bloom_options

    df = spark.range(0, 60000, 1, 1).selectExpr(
        "concat('C', hash(id)) AS sku", "concat('m', xxhash64(id)) AS mfr_part_number")
    wanted = df.where("sku = concat('C', hash(41234L))").first()

    def write(name, options):
        (df.write.options(**options).option("parquet.block.size", 1 << 16)
         .option("parquet.enable.dictionary", "false").parquet(f"{scratch}/{name}"))
        hit = spark.read.parquet(f"{scratch}/{name}").where(
            F.col("mfr_part_number") == wanted.mfr_part_number)
        assert hit.count() == 1
        return _scanned_rows(hit)

    without, with_bloom = write("plain", {}), write("bloom", bloom_options(LOOKUP_COLUMNS, 5000))
    assert with_bloom < without / 3
