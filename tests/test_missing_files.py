"""Missing-file pipeline on hand-made stores: counts, windows, start rules, variants."""

import datetime as dt
from decimal import Decimal

from ledgerlint.plans import missing_files as mf
from ledgerlint.sources.fixtures import calendar_between

FACT = ("market_code string, division_code string, source_project string, point_of_sale_code string, "
        "sellout_date date, data_source string")
DS = "data_source_code string, data_source_frequency string"
POS = "point_of_sale_code string, client_name string, channel_level1 string, channel_level2 string"
START = "market string, platform string, oms_store_code string, store_created_date date"
SKU = ("market_code string, division string, client string, platform_store_id string, period string, "
       "file_type string, sap_signature_code string, date_id date, gross_sales decimal(18,4), "
       "gross_sold_units bigint, gross_orders bigint")
AMZ = ("market_code string, sap_division_name string, client string, period string, channel_type string, "
       "ean_code string, sap_product_code string, sap_signature_code string, date_id date, shipped_units bigint, "
       "shipped_revenue decimal(18,4), ordered_units bigint, ordered_revenue decimal(18,4)")

SP = mf.SP  # floor year 2021
MFS = mf.MFS
D = dt.date


def inputs(spark, fact, ds=None, pos=None, starts=(), sku=(), amz=(), product=(), signature=()):
    ds = ds or [("DSD", "Daily"), ("DSW", "Weekly"), ("DSM", "Monthly"), ("DSE", ""), ("DSN", None)]
    pos = pos or [("AU_C_S1", "C", "L1", "L2"), ("AU_C_S2", "C", "L1", "L2"), ("AU_C_S3", "C", "L1", "L2")]
    return mf.MissingFileInputs(
        fact=spark.createDataFrame(fact, FACT),
        datasource=spark.createDataFrame(ds, DS),
        pos=spark.createDataFrame(pos, POS),
        calendar=calendar_between(spark, "2020-12-28", "2021-12-31"),
        store_start=spark.createDataFrame(list(starts), START),
        sku_traffic=spark.createDataFrame(list(sku), SKU),
        amz=spark.createDataFrame(list(amz), AMZ),
        product=spark.createDataFrame(list(product), "product_code string, source_project string, division_code string"),
        signature=spark.createDataFrame(list(signature), "signature_code string, division string"),
    )


def result_rows(steps):
    return sorted(((r["point_of_sale_code"], r["year"], r["month"], r["missing_file_count"], r["missing_file"])
                   for r in steps.result.collect()), key=str)


def test_daily_bag_difference_and_no_match(spark):
    fact = [("AU", "A", "P", "AU_C_S1", D(2021, 1, 5), "DSD"), ("AU", "A", "P", "AU_C_S1", D(2021, 1, 6), "DSD"),
            ("AU", "A", "P", "AU_C_S1", D(2021, 2, 10), "DSD")]
    steps = mf.missing_files(inputs(spark, fact), D(2021, 4, 15), SP)
    assert result_rows(steps) == [
        ("AU_C_S1", 2021, 1, 25, 1),   # days 5..31 expected, 5 and 6 delivered
        ("AU_C_S1", 2021, 2, 27, 1),
        ("AU_C_S1", 2021, 3, 31, 1),   # no delivery at all: everything missing
    ]
    spark.catalog.clearCache()


def test_daily_bag_counts_a_day_twice_with_two_creation_dates(spark):
    # Two creation dates for one store give two start rows; the expected bag holds each day twice.
    fact = [("AU", "A", "OMS_SFCC", "AU_C_S1", D(2021, 3, d), "DSD") for d in (1, 2)]
    starts = [("AU", "C", "S1", D(2021, 1, 20)), ("AU", "C", "S1", D(2021, 1, 25))]
    steps = mf.missing_files(inputs(spark, fact, starts=starts), D(2021, 4, 15), SP)
    exp = {(r["month"]): list(r["expected_array"]) for r in steps.expected_daily.collect()}
    assert exp[3] == sorted(list(range(1, 32)) * 2)
    # both rows start 2021-02-01; March: 62 expected entries, days 1 and 2 (4 entries) delivered
    assert result_rows(steps) == [("AU_C_S1", 2021, 1, None, 2), ("AU_C_S1", 2021, 2, 56, 1),
                                  ("AU_C_S1", 2021, 3, 58, 1)]
    spark.catalog.clearCache()


def test_weekly_window_when_the_first_is_a_sunday_and_not(spark):
    fact = [("AU", "A", "P", "AU_C_S2", D(2021, 7, 1), "DSW"), ("AU", "A", "P", "AU_C_S2", D(2021, 7, 14), "DSW")]
    # 2021-08-01 is a Sunday: the window ends on it, the calendar stops at July 31.
    steps = mf.missing_files(inputs(spark, fact), D(2021, 8, 15), SP)
    exp = {(r["year"], r["month"]): list(r["expected_array"]) for r in steps.expected_weekly.collect()}
    assert exp == {(2021, 6): [26], (2021, 7): [27, 28, 29, 30]}
    # 2021-09-01 is a Wednesday: the window ends on Sunday 2021-08-29.
    steps = mf.missing_files(inputs(spark, fact), D(2021, 9, 15), SP)
    exp = {(r["year"], r["month"]): list(r["expected_array"]) for r in steps.expected_weekly.collect()}
    assert exp[(2021, 8)] == [31, 32, 33, 34]
    av = {(r["year"], r["month"]): list(r["available_array"]) for r in steps.available_weekly.collect()}
    assert av == {(2021, 6): [26], (2021, 7): [28]}
    res = {(r["year"], r["month"]): (r["missing_file_count"], r["missing_file"]) for r in steps.result.collect()}
    # start 2021-07-01 lies in the Monday-week of 2021-06-28: January to May come before the start
    assert res == {**{(2021, m): (None, 2) for m in range(1, 6)},
                   (2021, 6): (0, 0), (2021, 7): (3, 1), (2021, 8): (4, 1)}
    spark.catalog.clearCache()


def test_monthly_counts_and_lists(spark):
    fact = [("AU", "A", "P", "AU_C_S3", D(2021, 1, 20), "DSM"), ("AU", "A", "P", "AU_C_S3", D(2021, 3, 3), "DSM")]
    sp = {(r["month"]): r["missing_file_count"] for r in mf.missing_files(inputs(spark, fact), D(2021, 4, 15), SP)
          .result.collect()}
    mfs = {(r["month"]): r["missing_file_count"] for r in mf.missing_files(inputs(spark, fact), D(2021, 4, 15), MFS)
           .result.collect()}
    assert sp == {1: 0, 2: 1, 3: 0} == mfs
    spark.catalog.clearCache()


def test_start_rules_and_months_before_start(spark):
    fact = [("AU", "A", "OMS_SFCC", "AU_C_S1", D(2021, 5, 3), "DSD"),
            ("AU", "A", "OTHER", "AU_C_S1", D(2021, 5, 3), "DSD")]
    starts = [("AU", "C", "S1", D(2021, 2, 10))]
    sp = mf.missing_files(inputs(spark, fact, starts=starts), D(2021, 6, 15), SP)
    got = {r["source_project"]: r["effective_store_start_date"] for r in sp.starts.collect()}
    # SP: creation date only for OMS_SFCC (month after creation); others start at the first delivery
    assert got == {"OMS_SFCC": D(2021, 3, 1), "OTHER": D(2021, 5, 3)}
    before = sorted((r["source_project"], r["month"], r["missing_file"], r["missing_file_count"])
                    for r in sp.before_start.collect())
    assert before == [("OMS_SFCC", 1, 2, None), ("OMS_SFCC", 2, 2, None), ("OTHER", 1, 2, None),
                      ("OTHER", 2, 2, None), ("OTHER", 3, 2, None), ("OTHER", 4, 2, None)]
    mfs = mf.missing_files(inputs(spark, fact, starts=starts), D(2021, 6, 15), MFS)
    got = {r["source_project"]: r["effective_store_start_date"] for r in mfs.starts.collect()}
    # MFS: any project, if created on or after the floor
    assert got == {"OMS_SFCC": D(2021, 3, 1), "OTHER": D(2021, 3, 1)}
    assert {r["missing_file"] for r in mfs.before_start.collect()} == {0}
    assert {r["data_source_frequency"] for r in mfs.result.collect()} == {"DAILY"}
    spark.catalog.clearCache()


def test_weekly_before_start_uses_the_monday_week(spark):
    # Starts on Saturday 2021-05-01: its Monday-week begins 2021-04-26, so April is not "before start".
    fact = [("AU", "A", "P", "AU_C_S2", D(2021, 5, 1), "DSW")]
    steps = mf.missing_files(inputs(spark, fact), D(2021, 6, 15), SP)
    assert sorted(r["month"] for r in steps.before_start.collect()) == [1, 2, 3]
    spark.catalog.clearCache()


def test_frequency_filters_and_inactive_stores(spark):
    fact = [("AU", "A", "P", "AU_C_S1", D(2021, 1, 5), "DSE"),   # '' frequency: dropped
            ("AU", "A", "P", "AU_C_S2", D(2021, 1, 5), "DSN"),   # NULL frequency: dropped
            ("AU", "A", "P", "AU_C_S3", D(2021, 1, 5), "DSD")]   # not active: last delivery too old
    steps = mf.missing_files(inputs(spark, fact), D(2021, 9, 15), SP)
    assert steps.deliveries.count() == 1
    assert steps.result.count() == 0
    spark.catalog.clearCache()


def test_sku_traffic_zero_days_having_and_filters(spark):
    fact = [("AU", "A", "ECOMM_SKU_TRAFFIC", "AU_C_S1", D(2021, 3, 1), "DSD")]
    z = Decimal("0")
    sku = [
        ("AU", "A", "C", "S1", "D", "Sku Traffic", None, D(2021, 3, 2), z, 1, 1),      # zero sales
        ("AU", "A", "C", "S1", "D", "SKU TRAFFIC", "sg", D(2021, 3, 3), None, 1, 1),   # NULL sum: not zero
        ("AU", "A", "C", "S1", "D", "SKU TRAFFIC", "ph", D(2021, 3, 4), z, 1, 1),      # signature PH: dropped
        ("AU", "A", "C", "S1", "W", "SKU TRAFFIC", None, D(2021, 3, 5), z, 1, 1),      # weekly period: dropped
        ("TW", "A", "C", "S1", "D", "SKU TRAFFIC", None, D(2021, 3, 6), z, 1, 1),      # market TW: dropped
        ("AU", "A", "C", "S1", "D", "SKU TRAFFIC", None, D(2021, 3, 7), Decimal("5"), 1, 1),
        ("AU", "A", "C", "S1", "D", "SKU TRAFFIC", None, D(2021, 3, 7), Decimal("-5"), 1, 1),  # sums to 0
    ]
    steps = mf.missing_files(inputs(spark, fact, sku=sku), D(2021, 4, 15), MFS)
    days = sorted(r["sellout_date"].day for r in steps.zero_sku_traffic.collect())
    assert days == [2, 7]
    av = steps.available_daily.first()
    assert list(av["available_array"]) == [1, 2, 7]
    spark.catalog.clearCache()


def test_marketplace_zero_rows_sp_only(spark):
    fact = [("AU", "A", "ECOM_AMZ", "AU_C_S1", D(2021, 3, 1), "DSD"),
            ("SG", "A", "ECOM_AMZ", "SG_C_S9", D(2021, 3, 1), "DSD")]
    pos = [("AU_C_S1", "C", "L1", "L2"), ("SG_C_S9", "C", "L1", "L2")]
    one, zero = Decimal("1"), Decimal("0")
    amz = [
        # AU with shipped units: zero shipped units -> zero-sale day
        ("AU", "A", "c", "D", "s1", None, "1", None, D(2021, 3, 2), 0, one, 5, one),
        # not AU: the ELSE branch holds only for NULL ordered units with zero revenue
        ("SG", "A", "c", "D", "s9", None, "1", None, D(2021, 3, 3), 5, one, None, zero),
        ("SG", "A", "c", "D", "s9", None, "1", None, D(2021, 3, 4), 5, one, 0, zero),
        ("SG", "A", "c", "d", "s9", None, "1", None, D(2021, 3, 5), 5, one, None, zero),  # lower-case period ok
    ]
    steps = mf.missing_files(inputs(spark, fact, pos=pos, amz=amz), D(2021, 4, 15), SP)
    got = sorted((r["point_of_sale_code"], r["sellout_date"].day) for r in steps.zero_marketplace.collect())
    assert got == [("AU_C_S1", 2), ("SG_C_S9", 3), ("SG_C_S9", 5)]
    mfs = mf.missing_files(inputs(spark, fact, pos=pos, amz=amz), D(2021, 4, 15), MFS)
    assert mfs.zero_marketplace is None
    spark.catalog.clearCache()


def test_unified_diff_matches_across_frequencies(spark):
    # One store delivers under Daily and Weekly sources; the unified join also pairs the daily
    # expectation (days 1..31) with the weekly availability (ISO week [10]), giving two rows for March:
    # days {1, 10} delivered -> 29 missing; week list [10] read as days -> 30 missing.
    fact = [("AU", "A", "P", "AU_C_S1", D(2021, 3, 1), "DSD"), ("AU", "A", "P", "AU_C_S1", D(2021, 3, 10), "DSD"),
            ("AU", "A", "P", "AU_C_S1", D(2021, 3, 8), "DSW")]
    steps = mf.missing_files(inputs(spark, fact), D(2021, 4, 15), MFS)
    march_daily = sorted(r["missing_file_count"] for r in steps.missing.collect()
                         if r["month"] == 3 and r["data_source_frequency"] == "DAILY")
    assert march_daily == [29, 30]
    sp = mf.missing_files(inputs(spark, fact), D(2021, 4, 15), SP)
    assert sorted(r["missing_file_count"] for r in sp.missing.collect()
                  if r["month"] == 3 and r["data_source_frequency"] == "Daily") == [29]
    spark.catalog.clearCache()


def test_month_collapsed_expected_days_equal_the_plain_range_join(spark, sf_small):
    from ledgerlint.plans import mf_queries

    steps = mf_queries.run(spark, sf_small)
    plain = mf.expected_daily_plain(steps.starts, steps.calendar, mf_queries.SP)
    key = lambda r: tuple(str(r[c]) for c in mf.EXPECTED_KEYS) + (tuple(r["expected_array"]),)
    a = sorted(map(key, steps.expected_daily.collect()))
    b = sorted(map(key, plain.collect()))
    assert a == b and len(a) > 0


def test_properties_and_variant_differences_on_driver_data(spark, sf_small):
    from pyspark.sql import functions as F

    from ledgerlint.operators.bagdiff import missing_count
    from ledgerlint.plans import mf_queries

    sp = mf_queries.run(spark, sf_small, mf_queries.SP)
    mfs = mf_queries.run(spark, sf_small, mf_queries.MFS)
    # missing never exceeds the expected list, and the flag follows the count
    for steps in (sp, mfs):
        e, a = steps.expected_daily.alias("e"), steps.available_daily.alias("a")
        j = e.join(a, [F.col(f"e.{k}") == F.col(f"a.{k}") for k in mf.DIFF_JOIN_KEYS], "left")
        bad = j.filter(missing_count("e.expected_array", "a.available_array") > F.size("e.expected_array"))
        assert bad.count() == 0
        res = steps.result
        assert res.filter((F.col("missing_file") == 1) != (F.col("missing_file_count") > 0)).count() == 0
    # 9: before-start flag 2 vs 0;  2: frequency text as is vs upper-cased
    assert {r[0] for r in sp.before_start.select("missing_file").distinct().collect()} <= {2}
    assert {r[0] for r in mfs.before_start.select("missing_file").distinct().collect()} <= {0}
    assert {r[0] for r in sp.result.select("data_source_frequency").distinct().collect()} <= {"Daily", "Weekly", "Monthly"}
    assert {r[0] for r in mfs.result.select("data_source_frequency").distinct().collect()} <= {"DAILY", "WEEKLY", "MONTHLY"}
    # 5: marketplace zero days count as delivered only in SP
    assert mfs.zero_marketplace is None and sp.zero_marketplace.count() > 0
    # 7: the list form of the monthly diff gives 0/1 just like the count form on unique stores
    mcount = {tuple(r[:7]): r[7] for r in mf.missing_monthly_by_count(sp.expected_monthly, sp.available_monthly)
              .select(*mf.RESULT[:7], "missing_file_count").collect()}
    assert set(mcount.values()) <= {0, 1}



def test_leap_february_expects_29_days(spark):
    cfg = mf.SP.with_floor(2024)
    fact = [("AU", "A", "P", "AU_C_S1", D(2024, 2, 1), "DSD"), ("AU", "A", "P", "AU_C_S1", D(2024, 2, 29), "DSD")]
    inp = inputs(spark, fact)
    inp = mf.MissingFileInputs(**{**inp.__dict__, "calendar": calendar_between(spark, "2024-01-01", "2024-12-31")})
    steps = mf.missing_files(inp, D(2024, 3, 15), cfg)
    exp = {r["month"]: list(r["expected_array"]) for r in steps.expected_daily.collect()}
    assert exp == {2: list(range(1, 30))}
    assert [(r["month"], r["missing_file_count"]) for r in steps.missing.collect()] == [(2, 27)]
    spark.catalog.clearCache()


def test_store_months_keep_the_sessions_partitions(spark):
    """AQE may not merge them: they are small in a shuffle and large in memory."""
    from pyspark.sql import functions as F

    months = spark.range(100).select(*[F.col("id").cast("string").alias(c) for c in mf.DIFF_JOIN_KEYS])
    assert mf.by_store_month(months).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_store_starts_join_stores_not_days(spark, sf_small):
    from ledgerlint.plans import mf_queries

    inp = mf_queries.inputs(spark, sf_small)
    m1 = mf.deliveries(inp, mf_queries.SP, mf_queries.AS_OF)
    starts = mf.store_starts(m1, inp, mf_queries.SP, mf.active_stores(m1, mf_queries.AS_OF))
    lines = starts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line)
    assert any("Aggregate" in line and "min(sellout_date" in line for line in lines[at + 1: at + 4]), lines[at: at + 4]
