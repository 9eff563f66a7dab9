import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordloom.functions import columns as C
from recordloom.functions.addresses import address_hash, fold_accents, normalize_address, normalize_postal
from recordloom.operators.shape import standardize, text_search
from recordloom.plans import presets as P


def one(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_bounded_decimal(spark):
    values = [90.0, 90.0000005, -91.0, math.nan, None, 1.0000005, -1.0000005]
    got = one(spark, [(v,) for v in values], "x double", C.bounded_decimal("x", -90, 90))
    assert got == [
        Decimal("90.000000"), None, None, None, None, Decimal("1.000001"), Decimal("-1.000001"),
    ]


def test_categories_are_case_sensitive_and_null_is_unknown(spark):
    values = ["micro", "nano", "bar", "beergarden", "brewpub", "Micro", "planning", None]
    got = one(spark, [(v,) for v in values], "x string", C.map_category("x", P.CATEGORIES))
    assert got == [
        "microbrewery", "microbrewery", "taproom", "taproom", "brewpub", "Unknown", "Unknown", "Unknown",
    ]


def test_join_parts(spark):
    rows = [(None, None, None), ("a", None, "c"), ("a", "", "c"), (" a", "b ", None)]
    got = one(spark, rows, "a string, b string, c string", C.join_parts("a", "b", "c"))
    assert got == ["", "a c", "a  c", "a b"]


def test_prefix_phone(spark):
    values = ["5035551234", "503-555-1234", "abcdefghij", None]
    got = one(spark, [(v,) for v in values], "x string", C.prefix_phone("x"))
    assert got == ["+15035551234", None, "+1abcdefghij", None]


def test_match_key_strips_unicode_spaces_but_not_tabs(spark):
    values = ["  A b　", "\tA\n", None, ""]
    got = one(spark, [(v,) for v in values], "x string", C.match_key("x"))
    assert got == ["a b", "\ta\n", None, ""]


def test_filters_treat_null_as_sql_does(spark):
    df = spark.createDataFrame(
        [(1, True, "x"), (2, None, "x"), (3, True, None), (4, True, "drop"), (5, True, "Drop")],
        "i int, flag boolean, kind string",
    )
    kept = df.filter(C.is_true("flag")).filter(C.not_in_literals("kind", ["drop"]))
    assert [r.i for r in kept.collect()] == [1, 5]


def test_prefer_with_source(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), (None, None)], "x string, y string")
    value, source = C.prefer_with_source({"left": "x", "right": "y"})
    assert [tuple(r) for r in df.select(value, source).collect()] == [
        ("a", "left"), ("b", "right"), (None, None),
    ]


def test_round_half_even(spark):
    assert one(spark, [(0.00005,), (0.00015,)], "x double", C.round_half_even("x", 4)) == [0.0, 0.0002]


def test_ordered_concat_skips_null(spark):
    df = spark.createDataFrame(
        [("g", 2, "b"), ("g", 1, "a"), ("g", 3, None), ("h", 1, None)], "k string, o int, v string"
    )
    got = df.groupBy("k").agg(C.ordered_concat("v", ["o"], "→").alias("t")).collect()
    assert {r.k: r.t for r in got} == {"g": "a→b", "h": None}


def test_gold_id(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (None, None)], "a int, b int")
    ids = [r[0] for r in df.select(C.gold_id("a", "b", F.lit("n"), F.lit(None), left="l", right="r")).collect()]
    assert ids[:2] == ["l_1", "r_2"] and ids[2].startswith("gen_") and len(ids[2]) == 36


def test_addresses_normalize_alike(spark):
    variants = ["12 Main Street, Suite 4", "12  MAIN ST. Ste 4", "12 máin st ste 4", "12 maiń st, ste 4"]
    got = one(spark, [(v,) for v in variants], "x string", normalize_address("x"))
    assert got[:3] == ["12 main st ste 4"] * 3
    assert one(spark, [("Ünï ß",)], "x string", fold_accents("x")) == ["Uni ß"]


def test_postal_and_hash(spark):
    codes = ["97201", "97201-1234", "972011234", "SW1A 1AA", None]
    assert one(spark, [(c,) for c in codes], "x string", normalize_postal("x")) == [
        "97201", "97201", "97201", "sw1a1aa", None,
    ]
    # The digest of "a|": a missing part counts as empty.
    assert one(spark, [("a", None)], "x string, y string", address_hash("x", "y")) == [
        "93d5e5ca331bf91422ad249e13ec13d4"
    ]


def test_nested_feed(spark):
    address = ("1 St", "City", "ST", "97201", "United States", 91.0, 10.0)
    rows = [
        ("1", "N", "Micro", None, None, "Active", True, address),
        ("2", "N", "Alt Prop", None, None, "Active", True, address),
        ("3", "N", "alt prop", None, None, "Active", True, None),
        ("4", "N", None, None, None, "Active", True, address),
        ("5", "N", "Micro", None, None, "Active", None, address),
        ("6", "N", "Micro", None, None, "Active", False, address),
    ]
    got = standardize(spark.createDataFrame(rows, P.NESTED_SCHEMA), P.NESTED_STANDARD).collect()
    assert [(r[P.RIGHT_ID], r.brewery_type, r.city, r.latitude) for r in got] == [
        ("1", "micro", "City", None), ("3", "alt prop", None, None),
    ]
    assert got[0].longitude == Decimal("10.000000")


def test_text_search_ignores_null_columns(spark):
    df = spark.createDataFrame([("Portland", None), (None, "x"), (None, None)], "a string, b string")
    assert text_search(df, "LAND", ["a", "b"]).count() == 1
    assert text_search(df, "x", ["a", "b"]).count() == 1
