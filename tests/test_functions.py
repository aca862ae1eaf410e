"""Scalar rules: lax typing, defaults, tiers, epochs, search predicates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from partsmith.functions import coerce as C
from partsmith.functions.text import literal_trigrams, trigrams, usable_terms
from partsmith.operators.search import as_list, page, search
from tests.helpers import products_df


def _eval(spark, expr, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_lax_long(spark):
    got = _eval(spark, C.lax_long("x"), [("12",), ("12.0",), (" 7 ",), ("12.5",), ("abc",),
                                         ("true",), (None,), ("-3",)])
    assert got == [12, 12, 7, None, None, None, None, -3]


def test_lax_bool(spark):
    got = _eval(spark, C.lax_bool("x"), [("yes",), ("1",), ("1.0",), ("off",), ("0",), ("2",),
                                         ("maybe",), (None,)])
    assert got == [True, True, True, False, False, None, None, None]


def test_defaults_flags_fallbacks(spark):
    assert _eval(spark, C.falsy_default("x", 1), [(0,), (None,), (5,)], "x long") == [1, 1, 5]
    assert _eval(spark, C.flag01("x"), [(True,), (False,), (None,)], "x boolean") == [1, 0, 0]
    assert _eval(spark, C.first_nonzero("a", "b"), [(0, 9), (None, 9), (4, 9)],
                 "a long, b long") == [9, 9, 4]
    assert _eval(spark, C.first_nonempty("a", "b"), [("", "x"), (None, None), ("y", "x")],
                 "a string, b string") == ["x", "", "y"]


def test_tier_and_epoch(spark):
    assert _eval(spark, C.tier_label("a", "b"), [(1, 1), (0, 1), (None, None), (0, 0)],
                 "a long, b long") == ["Basic", "Preferred", "Extended", "Extended"]
    ts = _eval(spark, C.epoch_to_timestamp("x"), [(1786342049,)], "x long")[0]
    assert ts == dt.datetime(2026, 8, 10, 6, 7, 29)
    assert _eval(spark, C.timestamp_to_epoch(C.epoch_to_timestamp_sql("x")),
                 [(1786342049,)], "x long") == [1786342049]
    assert _eval(spark, C.prefixed_key("C", "x"), [(5,), (None,)], "x long") == ["C5", None]


def test_trigrams(spark):
    got = _eval(spark, F.array_sort(trigrams("x")), [("AbcAbc",), ("ab",), ("",), (None,),
                                                      ("é€🙂x",)])
    assert got[0] == ["abc", "bca", "cab"] and got[1] == [] and got[2] == [] and got[3] == []
    assert got[4] == sorted(["é€🙂", "€🙂x"])
    assert literal_trigrams("AbcAbc") == ["abc", "bca", "cab"]
    assert usable_terms(["ab", "ABC", "abc", None, "wxyz"]) == ["abc", "wxyz"]


def test_search_edge_cases(spark):
    p = products_df(spark, [{"sku": "C1", "mfr_part_number": "ABC-123", "description": "x"}])
    assert search(p, any=["ab"]).count() == 0        # only a short positive term
    assert search(p, none=["abc"]).count() == 0      # no positive term at all
    assert search(p, all=["c-1"]).count() == 1       # punctuation is literal
    assert as_list(3) == [3] and as_list((1, 2)) == [1, 2] and as_list(None) is None
    with pytest.raises(ValueError):
        page(p, 0)
