"""Column functions and normalisers, on hand-worked values."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlint.functions.normalize import (
    marketplace_pos_code,
    normalize_ean,
    normalize_product_code,
    prefixed_product_key,
    remap_division,
    sku_traffic_pos_code,
)
from ledgerlint.functions.scalar import (
    abs_measure,
    attribute_array,
    concat_strict,
    dq_score,
    ltrim_chars,
    sql_trim,
    week_start_monday,
    week_start_sunday,
)
from ledgerlint.operators.bagdiff import missing_count


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_dq_score_null_and_zero_total(spark):
    data = [(1, 3), (0, 0), (None, None), (0, 5), (5, 5)]
    got = one(spark, dq_score("i", "t"), data, "i long, t long")
    assert got[0] == Decimal("66.666666667")
    assert got[1] is None and got[2] is None
    assert got[3] == Decimal("100.000000000") and got[4] == Decimal("0E-9")
    assert one(spark, dq_score("i", "t", safe=True), data, "i long, t long") == got


def test_abs_measure(spark):
    data = [(Decimal("-2.5000"),), (None,)]
    assert one(spark, abs_measure("v"), data, "v decimal(18,4)") == [Decimal("2.5000"), Decimal("0.0000")]
    assert one(spark, abs_measure("v", null_as_zero=False), data, "v decimal(18,4)") == [Decimal("2.5000"), None]


def test_attribute_array_keeps_keys_with_null_values(spark):
    df = spark.createDataFrame([("A", None)], "a string, b string")
    arr = df.select(attribute_array([("ka", "a"), ("kb", "b")]).alias("x")).first()["x"]
    assert [(s["key"], s["value"]) for s in arr] == [("ka", "A"), ("kb", None)]


def test_trim_strips_unicode_white_space(spark):
    data = [("  ab　",), ("\tx y\n",), (None,)]
    assert one(spark, sql_trim("s"), data, "s string") == ["ab", "x y", None]


def test_ltrim_chars(spark):
    data = [("000120",), ("0",), ("abc",)]
    assert one(spark, ltrim_chars(F.col("s"), "0"), data, "s string") == ["120", "", "abc"]


def test_concat_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(concat_strict("x", F.lit("_"), "y")).collect()] == [None, "a_b"]


def test_week_starts(spark):
    data = [(dt.date(2021, 8, 1),), (dt.date(2021, 9, 1),), (dt.date(2021, 1, 1),)]  # Sunday, Wednesday, Friday
    mon = one(spark, week_start_monday("d"), data, "d date")
    sun = one(spark, week_start_sunday("d"), data, "d date")
    assert mon == [dt.date(2021, 7, 26), dt.date(2021, 8, 30), dt.date(2020, 12, 28)]
    assert sun == [dt.date(2021, 8, 1), dt.date(2021, 8, 29), dt.date(2020, 12, 27)]
    # the weekly window starts on the second Monday-week of the floor year
    lo = one(spark, F.date_add(week_start_monday("d"), 7), [(dt.date(2021, 1, 1),)], "d date")
    assert lo == [dt.date(2021, 1, 4)]


def test_bag_difference_counts_every_occurrence(spark):
    df = spark.createDataFrame(
        [([1, 1, 2, 3], [2]), ([1, 2], None), ([5], [5]), ([], [1])], "e array<bigint>, a array<bigint>"
    )
    assert [r[0] for r in df.select(missing_count("e", "a")).collect()] == [3, 2, 0, 0]


def test_ean_normaliser(spark):
    data = [
        ("(blank)",), ("  --  ",), ("0",), ("0000000001234",), ("8.9E+12",), ("3.12345E+12",),
        ("77┬á",), (" 0012 ",), ('""',), ("abcE+x",), (None,),
    ]
    got = one(spark, normalize_ean("e"), data, "e string")
    assert got == [None, None, None, "1234", "8900000000000", "3123450000000", "77", "12", None, None, None]


def test_product_code_normaliser(spark):
    data = [("12345678901234",), (None,), ("NA",), ("-1",), ("",), ("123",), (" 12345678 ",), ("12345678",)]
    got = one(spark, normalize_product_code("c"), data, "c string")
    assert got == ["78901234", "-1", "-1", "-1", "-1", "00000123", "12345678", "12345678"]


def test_prefixed_product_key(spark):
    data = [("IN", "123"), ("AU", "123"), ("SA", "12345678901234"), ("XX", "1"), ("MA", None), ("IN", None)]
    got = one(spark, prefixed_product_key("m", "c"), data, "m string, c string")
    assert got == ["P65_123", "P54_00000123", "P05_78901234", None, "P54_-1", None]


def test_pos_codes_and_division_remap(spark):
    df = spark.createDataFrame(
        [("AU", "cl", "ch", "ACD"), ("AU", "cl", None, "X"), (None, "cl", "ch", None), ("AU", "", "s", "LDB")],
        "m string, c string, ch string, d string",
    )
    r = df.select(marketplace_pos_code("m", "c", "ch"), sku_traffic_pos_code("m", "c", "ch"), remap_division("d"))
    assert [tuple(x) for x in r.collect()] == [
        ("AU_CL_CH", "AU_cl_ch", "LDB"),
        ("AU_CL_NA", "AU_cl_NA", "X"),
        ("-1", "-1", None),
        ("AU__S", "-1", "LDB"),
    ]


def test_ean_mapping_join_fans_out_but_keeps_every_row(spark):
    from ledgerlint.functions.normalize import join_ean_mapping

    amz = spark.createDataFrame([("AU", "0001234"), ("AU", "(blank)"), ("SG", "99")], "market_code string, ean_code string")
    mapping = spark.createDataFrame(
        [("001234", "AU", "AU", "AU"), ("1234", "AU", "AU", "AU"), ("1234", "AU", "NZ", "AU"),
         ("0000000000000", "AU", "AU", "AU")],
        "ean_code string, src_market_code string, prioritized_market_code string, market_code string")
    j = join_ean_mapping(amz, mapping)
    got = sorted((r["ean_code"], r["map_ean_code"]) for r in j.collect())
    assert got == sorted([("0001234", "001234"), ("0001234", "1234"), ("(blank)", None), ("99", None)])
    assert j.select("market_code", "ean_code").distinct().count() == amz.count()
