"""DQ rules on hand-made rows: fan-out, join kinds, empty input, NULL keys, properties."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlint.operators.keycount import window_key_count
from ledgerlint.operators.measure import flatten_result
from ledgerlint.params import RunParams
from ledgerlint.plans import registry as reg
from ledgerlint.plans import rules as R

P = RunParams("T", dt.datetime(2024, 1, 31, 12, 0, 0), "2024-01-31")

FACT_SCHEMA = (
    "division_code string, market_code string, point_of_sale_code string, product_code string, "
    "data_source string, unique_id string, order_number string, sellout_date date, "
    "consolidated_sales_eur decimal(18,4)"
)
POS_SCHEMA = "point_of_sale_code string, client_name string, channel_level1 string, channel_level2 string"
D = dt.date(2023, 5, 1)


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def f(div, pos, prod, uid, sales, ds="DS0", date=D, market="AU"):
    return (div, market, pos, prod, ds, uid, "O" + str(uid), date, Decimal(sales))


def pos_dim(spark, rows):
    return spark.createDataFrame(rows, POS_SCHEMA)


def flat(df, keys=R.SELLOUT_KEYS):
    return [r.asDict() for r in flatten_result(df, keys).collect()]


def test_pos_uniqueness_fans_out_squared(spark):
    # POS p1 occurs twice in the dimension: each fact row counts 2 x 2 = 4 times, all invalid.
    fct = fact(spark, [f("A", "p1", "x", "1", "10"), f("A", "p2", "x", "2", "-5")])
    pos = pos_dim(spark, [("p1", "c", "L1", "L2"), ("p1", "c", "L1", "L2"), ("p2", "c", "L1", "L2")])
    out = flat(R.pos_uniqueness_sellout(spark, P, fct, pos))
    assert len(out) == 1
    r = out[0]
    assert (r["invalid_rows"], r["total_rows"]) == (4, 5)
    assert (r["invalid_value"], r["total_value"]) == (40.0, 45.0)
    assert r["dq_score"] == 20.0


def test_product_uniqueness_left_keeps_orphans_as_valid(spark):
    fct = fact(spark, [f("A", "p1", "dup", "1", "1"), f("A", "p1", "orphan", "2", "2")])
    pos = pos_dim(spark, [("p1", "c", "L1", "L2")])
    prod = spark.createDataFrame([("dup",), ("dup",)], "product_code string")
    r = flat(R.product_uniqueness_sellout(spark, P, fct, prod, pos))[0]
    # dup matches twice (2 rows, both invalid); orphan stays once with cnt NULL (valid)
    assert (r["invalid_rows"], r["total_rows"], r["invalid_value"], r["total_value"]) == (2, 3, 2.0, 4.0)


def test_inner_key_join_drops_orphans(spark):
    fct = fact(spark, [f("A", "p1", "x", "1", "1", ds="DS1"), f("A", "p1", "x", "2", "2", ds="DSX")])
    pos = pos_dim(spark, [("p1", "c", "L1", "L2")])
    ds = spark.createDataFrame([("DS1", "Daily")], "data_source_code string, data_source_frequency string")
    r = flat(R.datasource_uniqueness_sellout(spark, P, fct, ds, pos))[0]
    assert (r["invalid_rows"], r["total_rows"]) == (0, 1)


def test_fact_uniqueness_counts_before_the_pos_join_and_nulls_are_one_key(spark):
    rows = [f("A", "p1", "x", "u1", "1"), f("A", "p9", "x", "u1", "2"),  # u1 twice; p9 has no POS
            f("A", "p1", "x", None, "3"), f("A", "p1", "x", None, "4"), f("A", "p1", "x", "u2", "5")]
    pos = pos_dim(spark, [("p1", "c", "L1", "L2")])
    r = flat(R.fact_uniqueness_sellout(spark, P, fact(spark, rows), pos))[0]
    assert (r["invalid_rows"], r["total_rows"]) == (3, 4)
    assert (r["invalid_value"], r["total_value"]) == (8.0, 13.0)


def test_empty_input_left_join_keeps_one_row(spark):
    pos = pos_dim(spark, [("p1", "c", "L1", "L2")])
    out = R.fact_uniqueness_sellout(spark, P, fact(spark, []), pos).collect()
    assert len(out) == 1
    r = out[0]
    assert r["dq_id"] == "T" and r["param_date"] == "2024-01-31"
    assert r["dq_score"] is None and r["total_rows"] is None and r["invalid_value"] is None
    assert [(a["key"], a["value"]) for a in r["attribute_arr"]] == [(k, None) for k in R.SELLOUT_KEYS]


def test_empty_input_cross_join_gives_no_row(spark):
    tables = {reg.FACT_SELLOUT: fact(spark, []),
              reg.DIM_PRODUCT: spark.createDataFrame([("x",)], "product_code string")}
    assert R.reference_integrity_key(spark, P, tables, "PRODUCT.product_code").count() == 0


def test_reference_integrity_key_flags_orphans_and_blanks(spark):
    rows = [f("A", "p1", "x", "1", "1"), f("A", "p1", "y", "2", "2"), f("A", "p1", "", "3", "4"),
            f("A", "p1", None, "4", "8")]
    tables = {reg.FACT_SELLOUT: fact(spark, rows),
              reg.DIM_PRODUCT: spark.createDataFrame([("x",), ("x",), ("",)], "product_code string")}
    r = flat(R.reference_integrity_key(spark, P, tables, "PRODUCT.product_code"), R.INTEGRITY_KEYS)[0]
    # x: valid (no fan-out, DISTINCT); y: orphan; '' matches but is blank; NULL: blank
    assert (r["invalid_rows"], r["total_rows"], r["invalid_value"], r["total_value"]) == (3, 4, 14.0, 15.0)


def test_attribute_condition_null_condition_is_valid(spark):
    rows = [f("A", "p1", "x", "1", "1"), f("A", "p1", "orphan", "2", "2")]
    tables = {reg.FACT_SELLOUT: fact(spark, rows),
              reg.DIM_PRODUCT: spark.createDataFrame([("x", "B1")], "product_code string, brand_name string"),
              reg.DIM_POS: pos_dim(spark, [("p1", "c", "L1", "L2")])}
    r = flat(R.attribute_condition(spark, P, tables, reg.DIM_PRODUCT, "brand_name", "source_column = 'B1'"))[0]
    assert (r["invalid_rows"], r["total_rows"]) == (1, 2)


def test_stock_integrity_rules_and_year_filter(spark):
    schema = ("division_amaas string, tech_period_end_date date, "
              "GEOGRAPHY struct<orga_country_alpha2:string>, DISTRIBUTOR struct<distributor_name:string>, "
              "METADATA_TECHNICAL struct<data_file_provider:string>, FACT_VALUE struct<total_stock_units:bigint>, "
              "PRODUCT struct<brand_code:string>")

    def row(brand, units, year=2024):
        return ("D", dt.date(year, 3, 1), ("AU",), ("dis",), ("prov",), (units,), (brand,))

    stock = spark.createDataFrame(
        [row("b1", -5), row("zz", 1), row("", 2), row("-1", 3), row("unspecified", 4), row(None, 6),
         row("b1", None), row("b1", 100, year=2023)], schema)
    ref = spark.createDataFrame([("b1",)], "brand_code string")
    out = R.reference_integrity_stock(spark, P, stock, ref, "PRODUCT.brand_code", 2024)
    r = flat(out, R.STOCK_KEYS)[0]
    assert (r["invalid_rows"], r["total_rows"]) == (5, 7)
    assert (r["invalid_value"], r["total_value"]) == (16.0, 21.0)
    assert r["attr_source_type"] == "Distributor"


def test_dimension_uniqueness_matches_pos_rule_when_pos_is_unique(spark):
    rnd = random.Random(7)
    rows = [f(rnd.choice("AN"), f"p{rnd.randint(1, 4)}", "x", str(i), str(rnd.randint(-50, 50)))
            for i in range(60)]
    fct = fact(spark, rows)
    pos = pos_dim(spark, [(f"p{i}", f"c{i % 2}", "L1", f"L{i % 3}") for i in range(1, 5)])
    tables = {reg.FACT_SELLOUT: fct, reg.DIM_POS: pos}
    a = flat(R.dimension_key_uniqueness(spark, P, tables, "point_of_sale_code", "cnt > 1"))
    b = flat(R.pos_uniqueness_sellout(spark, P, fct, pos))
    key = lambda d: tuple(str(d[k]) for k in sorted(d))
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_fact_uniqueness_equals_plain_window_count(spark):
    rnd = random.Random(3)
    rows = [f(rnd.choice("ANR"), f"p{rnd.randint(1, 3)}", "x",
              rnd.choice([None, "hot", "hot"] + [str(k) for k in range(30)]), str(rnd.randint(-99, 99)),
              date=dt.date(2020 + rnd.randint(0, 2), 1, 1)) for _ in range(300)]
    fct = fact(spark, rows)
    pos = pos_dim(spark, [("p1", "c1", "L1", "L2"), ("p2", "c2", "L1", "L2"), ("p2", "c2", "L1", "L2")])
    got = flat(R.fact_uniqueness_sellout(spark, P, fct, pos))
    # the plain form: window count over the fact (S3 as written), inner join, conditional sums
    w = window_key_count(fct, "unique_id")
    j = w.join(pos, "point_of_sale_code").withColumn("soval", F.coalesce(F.abs("consolidated_sales_eur"), F.lit(0)))
    exp = j.groupBy("division_code", "market_code", F.year("sellout_date").cast("string").alias("sellout_year"),
                    "channel_level1", "channel_level2", "client_name").agg(
        F.count(F.when(F.col("cnt") > 1, 1)).alias("invalid_rows"), F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(F.col("cnt") > 1, F.col("soval")).otherwise(0)).cast("double").alias("invalid_value"),
        F.sum("soval").cast("double").alias("total_value"))
    exp_rows = {(r["division_code"], r["sellout_year"], r["client_name"]):
                (r["invalid_rows"], r["total_rows"], r["invalid_value"], r["total_value"]) for r in exp.collect()}
    got_rows = {(r["attr_division_code"], r["attr_sellout_year"], r["attr_client_name"]):
                (r["invalid_rows"], r["total_rows"], r["invalid_value"], r["total_value"]) for r in got}
    assert got_rows == exp_rows
    for r in got:
        assert r["invalid_rows"] <= r["total_rows"] and 0 <= r["dq_score"] <= 100


def test_sellthrough_hierarchy_is_b2b_and_year_key_is_sellout_year(spark):
    st = spark.createDataFrame(
        [("A", "AU", "d1", "x", "DS0", "1", D, Decimal("3"))],
        "division_code string, market_code string, distributor_code string, product_code string, "
        "data_source string, unique_id string, sellthrough_date date, consolidated_sales_eur decimal(18,4)")
    dis = spark.createDataFrame([("d1", "Dist One", "L7")], "distributor_code string, distributor_name string, "
                                "channel_level2 string")
    r = R.fact_uniqueness_sellthrough(spark, P, st, dis).first()
    attrs = {a["key"]: a["value"] for a in r["attribute_arr"]}
    assert attrs == {"division_code": "A", "market_code": "AU", "sellout_year": "2023", "channel_level1": "B2B",
                     "channel_level2": "L7", "client_name": "Dist One"}


NINE = "decimal(38,9)"


@pytest.mark.parametrize("kind,value,copies,want", [
    (NINE, "1.123456789", 1, "1.123456789"), (NINE, "-1.123456789", 3, "3.370370367"),
    (NINE, "12345678901234567890.123456789", 7, "86419752308641975230.864197523"), ("double", "0.5", 3, "1.500000000"),
])
def test_copy_weights_keep_every_decimal(spark, kind, value, copies, want):
    fact = spark.createDataFrame([("A", "AU", dt.date(2024, 1, 1), "p", "P1", value)],
                                 "division_code string, market_code string, sellout_date date, point_of_sale_code string, "
                                 "product_code string, v string").selectExpr("*", f"cast(v as {kind}) consolidated_sales_eur")
    product = spark.createDataFrame([("P1",)] * copies, "product_code string")
    pos = spark.createDataFrame([("p", "L1", "L2", "C")], "point_of_sale_code string, channel_level1 string, channel_level2 string, client_name string")
    row = R.product_uniqueness_sellout(spark, RunParams("X", "2024-01-01 00:00:00"), fact, product, pos).first()
    assert str(row.total_value) == want and row.total_rows == copies


def test_weighting_raises_rather_than_losing_digits(spark):
    from ledgerlint.operators.measure import times

    df = spark.createDataFrame([("9" * 28 + ".5", 10)], "v string, n bigint").selectExpr("cast(v as decimal(38,9)) v", "n")
    with pytest.raises(Exception, match="OVERFLOW|PRECISION|NUMERIC_VALUE_OUT_OF_RANGE"):
        df.select(times(F.col("v"), F.col("n"), NINE)).collect()


def test_stock_references_match_numbers_of_other_types(spark):
    stock = spark.sql("""SELECT 'A' division_amaas, DATE'2024-05-01' tech_period_end_date, struct('AU' orga_country_alpha2) GEOGRAPHY,
        struct('n' distributor_name) DISTRIBUTOR, struct('d' data_file_provider) METADATA_TECHNICAL, struct(5 total_stock_units) FACT_VALUE,
        struct(CAST(1.25 AS DOUBLE) conversion_rate) CURRENCY""")
    ref = spark.sql("SELECT CAST(1.25 AS DECIMAL(38,9)) exchange_rate")
    row = R.reference_integrity_stock(spark, RunParams("X", "2024-01-01 00:00:00"), stock, ref, "CURRENCY.conversion_rate", 2024).first()
    assert (row.invalid_rows, row.total_rows) == (0, 1)
