"""Delivery completeness: per store and month, how many expected deliveries are missing.

One pipeline, two presets (``SP`` is the upserting procedure, ``MFS`` the
bare query); the nine ways they differ are fields of ``MissingFileConfig``.

Plan notes for large inputs:
- The facts are read once per step with pruned columns; the date predicates
  are written as plain ranges on the date column so parquet statistics prune.
- Dimensions (data source, POS, store starts, products, signatures) are joined
  without hints: Spark broadcasts them while under the broadcast threshold and
  shuffles otherwise; AQE re-plans from the measured sizes.
- M1 (distinct store-days) feeds five steps; it is staged as a parquet
  table under the checkpoint folder, so later plans start from it and a lost
  executor never sends the job back to the fact.  M4 and M5 (per store) are
  persisted.
- The calendar is collapsed to one row per month before it meets the stores
  (``operators.calendar``), so no day x store product is formed.
- Expected and available days and weeks are bitmaps: partial aggregation keeps one
  64-bit number a store-month (``bit_or``), and the bag difference is a
  ``bit_count``.  The list columns of the steps are only built where they are asked for.
- M1 and the monthly steps are made distinct before they are joined to stores or
  partitioned, so a store holding a third of all fact rows sends at most one
  row per day and frequency from each map task.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.functions.normalize import (
    marketplace_pos_code,
    normalize_product_code,
    prefixed_product_key,
    remap_division,
    sku_traffic_pos_code,
)
from ledgerlint.functions.scalar import bigint, concat_strict, ltrim_chars, month_start, week_start_sunday
from ledgerlint.operators import calendar as cal
from ledgerlint.operators.bagdiff import missing_bits


@dataclass(frozen=True)
class MissingFileConfig:
    """Switches between the two reference variants."""

    name: str
    # 1: SP keeps fact rows from the floor year on; MFS keeps complete months only
    fact_floor: bool
    # 2: MFS upper-cases the frequency text
    upper_frequency: bool
    # 3: SP takes the POS dimension DISTINCT
    distinct_pos: bool
    # 4: SP uses the creation date only for this project; MFS for any creation on or after the floor
    start_rule: str  # "project" or "created_after_floor"
    # 5: SP counts marketplace zero-sale days as delivered
    marketplace_zero: bool
    # 6: SP keeps the weekly available list as a bag (no effect on counts)
    weekly_available_bag: bool
    # 7: SP counts monthly matches; MFS compares the constant lists [1]
    monthly_by_count: bool
    # 8: SP diffs each frequency on its own; MFS unions them and joins across
    diff_per_frequency: bool
    # 9: flag of the months before a store's start
    before_start_flag: int
    start_project: str = "OMS_SFCC"
    floor_year: int = 2021

    @property
    def daily(self) -> str:
        return "DAILY" if self.upper_frequency else "Daily"

    @property
    def weekly(self) -> str:
        return "WEEKLY" if self.upper_frequency else "Weekly"

    @property
    def monthly(self) -> str:
        return "MONTHLY" if self.upper_frequency else "Monthly"

    def with_floor(self, year: int) -> "MissingFileConfig":
        return replace(self, floor_year=year)


SP = MissingFileConfig(
    name="SP", fact_floor=True, upper_frequency=False, distinct_pos=True, start_rule="project",
    marketplace_zero=True, weekly_available_bag=True, monthly_by_count=True, diff_per_frequency=True,
    before_start_flag=2,
)
MFS = MissingFileConfig(
    name="MFS", fact_floor=False, upper_frequency=True, distinct_pos=False, start_rule="created_after_floor",
    marketplace_zero=False, weekly_available_bag=False, monthly_by_count=False, diff_per_frequency=False,
    before_start_flag=0,
)


@dataclass(frozen=True)
class MissingFileInputs:
    """The tables the pipeline reads (logical names of the reference in comments)."""

    fact: DataFrame  # vw_fact_sellout
    datasource: DataFrame  # vw_dim_datasource
    pos: DataFrame  # vw_dim_point_of_sales
    calendar: DataFrame  # vw_dim_calendar
    store_start: DataFrame  # oms_store_start_dates
    sku_traffic: DataFrame  # fact_ecomm_sku_traffic_sellout
    amz: DataFrame | None = None  # fact_ecomm_amz (SP only)
    product: DataFrame | None = None  # vw_dim_product (SP only)
    signature: DataFrame | None = None  # dim_group_signature (SP only)


DELIVERY = ["market_code", "division_code", "source_project", "point_of_sale_code", "sellout_date",
            "client_name", "channel_level1", "channel_level2"]
MARKET_DTL = ["market_code", "division_code", "point_of_sale_code", "client_name", "source_project",
              "channel_level1", "channel_level2", "data_source_frequency", "store_created_date"]
EXPECTED_KEYS = ["year", "month", "market_code", "division_code", "point_of_sale_code", "client_name",
                 "source_project", "channel_level1", "channel_level2", "data_source_frequency"]
AVAILABLE_KEYS = ["market_code", "division_code", "point_of_sale_code", "year", "month", "client_name",
                  "source_project", "channel_level1", "channel_level2"]
DIFF_JOIN_KEYS = ["division_code", "point_of_sale_code", "year", "month", "source_project", "client_name"]
#: A set of days or week numbers as a bitmap, and how many starts of a store expect it.
BITS, TIMES = "_bits", "_n"
RESULT = ["market_code", "division_code", "point_of_sale_code", "client_name", "source_project", "year", "month",
          "channel_level1", "channel_level2", "data_source_frequency", "missing_file_count", "missing_file"]


def by_store_month(df: DataFrame) -> DataFrame:
    """Hash-partition on the six diff-join keys (store and month).

    Every later grouping of the expected and available sides contains these
    keys, so the group-by, the LEFT join of M14-M17 and its DISTINCT reuse
    this one partitioning instead of shuffling again.  A store-month holds at
    most 31 days, so the partitioning cannot concentrate a hot store.

    The session's number of partitions is kept: store-months are a few bytes in a
    compressed shuffle and several hundred in each of the stage's ten hash maps and
    sorts, so partitions merged up to AQE's 64 MB of shuffle need gigabytes a task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *DIFF_JOIN_KEYS)


def _date(d: dt.date | str) -> Column:
    return F.lit(str(d)).cast("date")


def _floor_date(cfg: MissingFileConfig) -> Column:
    return F.make_date(F.lit(cfg.floor_year), F.lit(1), F.lit(1))


def store_key(division: str = "division_code", pos: str = "point_of_sale_code", client: str = "client_name",
              project: str = "source_project") -> Column:
    """``division_pos_client_project`` (NULL if any part is NULL)."""
    return concat_strict(F.col(division), F.lit("_"), F.col(pos), F.lit("_"), F.col(client), F.lit("_"),
                         F.col(project))


# ---------------------------------------------------------------------------
# M1-M5 inputs
# ---------------------------------------------------------------------------

def deliveries(inp: MissingFileInputs, cfg: MissingFileConfig, as_of: dt.date) -> DataFrame:
    """M1: distinct deliveries (store-days) with their frequency."""
    f = inp.fact.select("market_code", "division_code", "source_project", "point_of_sale_code", "sellout_date",
                        "data_source")
    if cfg.fact_floor:
        f = f.filter(F.col("sellout_date") >= _floor_date(cfg))
    else:
        # last_day(d) < as_of  <=>  d < first day of the as-of month
        f = f.filter(F.col("sellout_date") < month_start(_date(as_of)))
    ds = inp.datasource.select("data_source_code", "data_source_frequency").filter(
        F.col("data_source_frequency").isNotNull() & (F.col("data_source_frequency") != "")
        & (F.col("data_source_code") != "-1")
    )
    pos = inp.pos.select(F.col("point_of_sale_code").alias("_pos"), "client_name", "channel_level1",
                         "channel_level2")
    freq = F.upper("data_source_frequency") if cfg.upper_frequency else F.col("data_source_frequency")
    ds = ds.withColumn("data_source_frequency", freq).distinct()
    # DISTINCT before POS is joined: it then sees one row per store-day and frequency, not per fact row.  Distinct rows of
    # both sides, the join's key among their columns, give distinct rows: the wide result needs no shuffle of its own.
    days = f.join(ds, f.data_source == ds.data_source_code).select(*DELIVERY[:5], "data_source_frequency").distinct()
    j = days.join(pos.distinct(), F.col("point_of_sale_code") == F.col("_pos"))
    return j.select(*DELIVERY, "data_source_frequency")


def pos_attributes(inp: MissingFileInputs, cfg: MissingFileConfig) -> DataFrame:
    """M2: POS attributes (DISTINCT in SP)."""
    p = inp.pos.select("client_name", "channel_level1", "channel_level2", "point_of_sale_code")
    return p.distinct() if cfg.distinct_pos else p


def complete_months_calendar(inp: MissingFileInputs, cfg: MissingFileConfig, as_of: dt.date) -> DataFrame:
    """M3: calendar days of complete months from the floor year on."""
    c = inp.calendar.select(
        F.to_date("date_time").alias("cal_date"), bigint("year").alias("year"), bigint("month").alias("month"),
        "week_start_date", bigint("week_num").alias("week_num"),
    )
    return c.filter((F.col("year") >= cfg.floor_year) & (F.col("cal_date") < month_start(_date(as_of))))


def active_stores(m1: DataFrame, as_of: dt.date) -> DataFrame:
    """M4: store keys with a delivery since the first day of the month six months before."""
    since = F.trunc(F.add_months(_date(as_of), -6), "month")
    return m1.filter(F.col("sellout_date") >= since).select(store_key().alias("unq_col")).distinct()


def store_starts(m1: DataFrame, inp: MissingFileInputs, cfg: MissingFileConfig, active: DataFrame) -> DataFrame:
    """M5: effective start per active store (creation-based or first delivery)."""
    ss = inp.store_start.select(
        concat_strict(F.col("market"), F.lit("_"), F.col("platform"), F.lit("_"), F.col("oms_store_code"))
        .alias("_oms_key"),
        "store_created_date",
    )
    # One row per store and frequency before the joins: neither depends on the day.
    first = m1.groupBy(*[c for c in MARKET_DTL if c != "store_created_date"]).agg(F.min("sellout_date").alias("sellout_date"))
    j = first.join(ss, first.point_of_sale_code == ss._oms_key, "left")
    j = j.join(active, store_key() == active.unq_col, "left_semi")
    created = F.col("store_created_date")
    if cfg.start_rule == "project":
        use_created = (F.col("source_project") == cfg.start_project) & created.isNotNull()
    else:
        use_created = created.isNotNull() & (created >= _floor_date(cfg))
    g = j.groupBy(*MARKET_DTL).agg(F.min("sellout_date").alias("_first_delivery"))
    start = F.when(use_created, F.trunc(F.add_months(created, 1), "month")).otherwise(F.col("_first_delivery"))
    return g.select(*MARKET_DTL, start.alias("effective_store_start_date"))


# ---------------------------------------------------------------------------
# M6-M8 expected
# ---------------------------------------------------------------------------

def weekly_window(cfg: MissingFileConfig, as_of: dt.date) -> tuple[Column, Column]:
    """Second Monday-week of the floor year .. Sunday on or before the first of the as-of month."""
    lo = F.date_add(F.trunc(_floor_date(cfg), "week"), 7)
    hi = week_start_sunday(month_start(_date(as_of)))
    return lo, hi


def _month_bounds(cfg: MissingFileConfig, as_of: dt.date) -> tuple[Column, Column]:
    """The calendar's months (its ``year`` may differ from a date's own at the turn of a year)."""
    return F.add_months(_floor_date(cfg), -1), F.add_months(month_start(_date(as_of)), -1)


def _stores(m5: DataFrame, frequency: str) -> DataFrame:
    return m5.filter(F.col("data_source_frequency") == frequency)


def expected_daily(m5: DataFrame, months: DataFrame, cfg: MissingFileConfig, as_of: dt.date) -> DataFrame:
    """M6: per store and calendar month, the bag of days on or after the start, as bitmaps with their multiplicity."""
    j = cal.from_start(_stores(m5, cfg.daily), months, "effective_store_start_date", *_month_bounds(cfg, as_of))
    return by_store_month(j).groupBy(*EXPECTED_KEYS, F.col(cal.DAYS).alias(BITS)).agg(F.sum(cal.TIMES).alias(TIMES))


def expected_daily_plain(m5: DataFrame, m3: DataFrame, cfg: MissingFileConfig) -> DataFrame:
    """M6 in the reference's shape: every calendar day joined to every daily store on ``cal_date >= start``.

    Not used by the pipeline (``expected_daily`` gives the same rows from about
    30x fewer joined rows); kept to check and measure the collapsed form.
    """
    stores = m5.filter(F.col("data_source_frequency") == cfg.daily)
    days = F.broadcast(m3.select("cal_date", "year", "month"))
    j = stores.join(days, F.col("cal_date") >= F.col("effective_store_start_date"))
    return j.groupBy(*EXPECTED_KEYS).agg(
        F.sort_array(F.collect_list(bigint(F.dayofmonth("cal_date")))).alias("expected_array")
    )


def expected_weekly(m5: DataFrame, m3: DataFrame, cfg: MissingFileConfig, as_of: dt.date) -> DataFrame:
    """M7: the set of week numbers as a bitmap, grouped by the year and month of the week start."""
    lo, hi = weekly_window(cfg, as_of)
    weeks = cal.week_days(m3.filter(F.col("cal_date").between(lo, hi)))
    j = cal.from_start(_stores(m5, cfg.weekly), weeks, "effective_store_start_date", *_month_bounds(cfg, as_of))
    return by_store_month(j).groupBy(*EXPECTED_KEYS).agg(F.bit_or(cal.bit("week_num")).alias(BITS)).withColumn(TIMES, bigint(F.lit(1)))


def expected_monthly(m5: DataFrame, months: DataFrame, cfg: MissingFileConfig, as_of: dt.date) -> DataFrame:
    """M8: store x calendar months on or after the start (MFS compares them as the list [1])."""
    j = cal.from_start(_stores(m5, cfg.monthly), months, "effective_store_start_date", *_month_bounds(cfg, as_of))
    out = by_store_month(j.select(*EXPECTED_KEYS).distinct())
    if not cfg.monthly_by_count:
        out = out.withColumn(BITS, cal.bit(F.lit(1))).withColumn(TIMES, bigint(F.lit(1)))
    return out


def expected_lists(expected: DataFrame) -> DataFrame:
    """The ordered bag of each expected row as a list (for reports; the pipeline compares bitmaps)."""
    values = F.flatten(F.transform(cal.bit_values(BITS), lambda v: F.array_repeat(v, F.col(TIMES).cast("int"))))
    return expected.groupBy(*EXPECTED_KEYS).agg(F.sort_array(F.flatten(F.collect_list(values))).alias("expected_array"))


# ---------------------------------------------------------------------------
# M9, M10 zero-sale deliveries
# ---------------------------------------------------------------------------

#: Parts of a marketplace feed's rows without a product code, so that these don't meet in one task.
UNKNOWN_PARTS = 64


def marketplace_divisions(codes: DataFrame, product: DataFrame, signature: DataFrame) -> DataFrame:
    """Each distinct (market, product code, signature) with the divisions that the lookups give it.

    Repeated lookup rows give several divisions; NULL where none is found.
    """
    p360 = product.filter(F.col("source_project") == "P360").select("product_code", "division_code")
    elix = p360.select(F.col("product_code").alias("_elix_code"), F.col("division_code").alias("_elix_div"))
    ecc = p360.select(F.col("product_code").alias("_ecc_code"), F.col("division_code").alias("_ecc_div"))
    grp = signature.select(
        ltrim_chars(F.col("signature_code"), "0").alias("_sig"), F.col("division").alias("_grp_div")
    )
    j = (
        codes.distinct().join(elix, normalize_product_code("sap_product_code") == F.col("_elix_code"), "left")
        .join(ecc, prefixed_product_key("market_code", "sap_product_code") == F.col("_ecc_code"), "left")
        .join(grp, ltrim_chars(F.col("sap_signature_code"), "0") == F.col("_sig"), "left")
    )
    return j.select(*codes.columns, F.coalesce("_elix_div", "_ecc_div", "_grp_div").alias("looked_up_division")).distinct()


def marketplace_zero_sales(inp: MissingFileInputs, cfg: MissingFileConfig, active: DataFrame) -> DataFrame:
    """M9: marketplace store-days whose rows report zero sales (SP only).

    The lookups see each (market, product code, signature) once, not each row, and
    their answer is joined back to the distinct rows.  Rows without a product code
    share few such keys, so these go in ``UNKNOWN_PARTS`` parts.  The EAN-to-SKU
    mapping join of the reference selects no column and its fan-out is removed by
    the final DISTINCT, so it cannot change the answer and is not part of the plan
    (``normalize.join_ean_mapping`` has it).
    """
    a = inp.amz
    units_zero = (F.col("shipped_units") == 0) | (F.col("shipped_revenue") == 0)
    # As written in the reference: true only when ordered units are NULL and revenue is 0.
    else_branch = F.col("ordered_units").isNull() & ((F.col("ordered_units") == 0) | (F.col("ordered_revenue") == 0))
    zero = F.when((F.col("market_code") == "AU") & F.col("shipped_units").isNotNull(), units_zero).otherwise(else_branch)
    codes = ["market_code", "sap_product_code", "sap_signature_code"]
    rows = a.filter((F.upper("period") == "D") & zero & (F.col("date_id") >= _floor_date(cfg))).select(
        *codes, "sap_division_name", "client", "channel_type", "date_id").distinct()
    unknown = normalize_product_code("sap_product_code") == "-1"
    part = F.when(unknown, F.pmod(F.xxhash64("client", "channel_type", "date_id"), F.lit(UNKNOWN_PARTS)).cast("int")).otherwise(F.lit(0))
    parts = F.when(unknown, F.sequence(F.lit(0), F.lit(UNKNOWN_PARTS - 1))).otherwise(F.array(F.lit(0)))
    found = marketplace_divisions(rows.select(*codes), inp.product, inp.signature).withColumn("_part", F.explode(parts))
    r, f = rows.withColumn("_part", part).alias("r"), found.alias("f")
    same = F.col("r._part") == F.col("f._part")
    for c in codes:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}"))
    j = r.join(f, same).select("r.*", "f.looked_up_division")
    market = F.coalesce(F.col("market_code"), F.lit("-1"))
    division = F.coalesce("looked_up_division", "sap_division_name", F.lit("-1"))
    sds = j.select(
        market.alias("market_code"),
        division.alias("division_code"),
        F.col("date_id").alias("sellout_date"),
        F.lit("ECOM_AMZ").alias("source_project"),
        marketplace_pos_code(market, F.col("client"), F.col("channel_type")).alias("point_of_sale_code"),
    )
    pos = inp.pos.select(F.col("point_of_sale_code").alias("_pos"), "client_name", "channel_level1",
                         "channel_level2")
    k = sds.join(pos, sds.point_of_sale_code == pos._pos).join(active, store_key() == active.unq_col, "left_semi")
    return k.select(
        "market_code", remap_division("division_code").alias("division_code"), "source_project",
        "point_of_sale_code", "sellout_date", "client_name", "channel_level1", "channel_level2",
    ).distinct()


def sku_traffic_zero_sales(inp: MissingFileInputs, cfg: MissingFileConfig, m2: DataFrame,
                           active: DataFrame) -> DataFrame:
    """SKU-traffic store-days whose sales, units or orders sum to 0."""
    s = inp.sku_traffic
    src = s.filter(
        ~F.col("market_code").isin("BR", "TW")
        & (F.col("date_id") >= _floor_date(cfg))
        & (F.col("period") == "D")
        & (F.upper("file_type") == "SKU TRAFFIC")
        & ~F.upper(F.coalesce(F.col("sap_signature_code"), F.lit("-1"))).isin("PH")
    ).select(
        "market_code",
        remap_division("division").alias("division_code"),
        "date_id",
        sku_traffic_pos_code("market_code", "client", "platform_store_id").alias("point_of_sale_code"),
        F.lit("ECOMM_SKU_TRAFFIC").alias("source_project"),
        "gross_sales", "gross_sold_units", "gross_orders",
    )
    # One row per store-day before POS is joined; duplicate POS rows then repeat its sums, summed again below.
    day = ["market_code", "division_code", "source_project", "point_of_sale_code", "date_id"]
    measures = ["gross_sales", "gross_sold_units", "gross_orders"]
    src = src.groupBy(*day).agg(*[F.sum(c).alias(c) for c in measures])
    types = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    pos = m2.select(F.col("point_of_sale_code").alias("_pos"), "client_name", "channel_level1", "channel_level2")
    j = src.join(pos, src.point_of_sale_code == pos._pos).join(active, store_key() == active.unq_col, "left_semi")
    g = j.groupBy(
        "market_code", "division_code", "source_project", "point_of_sale_code", F.col("date_id").alias("sellout_date"),
        "client_name", "channel_level1", "channel_level2",
    ).agg(
        F.sum("gross_sales").cast(types["gross_sales"]).alias("sales"),
        F.sum("gross_sold_units").cast(types["gross_sold_units"]).alias("units"),
        F.sum("gross_orders").cast(types["gross_orders"]).alias("orders"),
    )
    return g.filter((F.col("sales") == 0) | (F.col("units") == 0) | (F.col("orders") == 0))


# ---------------------------------------------------------------------------
# M11-M13 available
# ---------------------------------------------------------------------------

def available_daily(m1: DataFrame, cfg: MissingFileConfig, zero_days: list[DataFrame]) -> DataFrame:
    """The set of days delivered per store and month (zero-sale days included), as a bitmap."""
    days = m1.filter(F.col("data_source_frequency") == cfg.daily).select(*DELIVERY)
    for z in zero_days:
        days = days.unionByName(z.select(*DELIVERY))
    d = F.col("sellout_date")
    days = days.withColumn("year", bigint(F.year(d))).withColumn("month", bigint(F.month(d)))
    return by_store_month(days.groupBy(*AVAILABLE_KEYS).agg(F.bit_or(cal.bit(F.dayofmonth(d))).alias(BITS)))


def _weeks_delivered(m1: DataFrame, m3: DataFrame, cfg: MissingFileConfig, as_of: dt.date) -> DataFrame:
    lo, hi = weekly_window(cfg, as_of)
    f = m1.filter((F.col("data_source_frequency") == cfg.weekly) & F.col("sellout_date").between(lo, hi))
    c = m3.select("cal_date", "week_start_date", "week_num")
    return f.join(c, f.sellout_date == c.cal_date).withColumn("year", bigint(F.year("week_start_date"))).withColumn(
        "month", bigint(F.month("week_start_date")))


def available_weekly(m1: DataFrame, m3: DataFrame, cfg: MissingFileConfig, as_of: dt.date) -> DataFrame:
    """The set of week numbers delivered, by year and month of the week start, as a bitmap."""
    j = _weeks_delivered(m1, m3, cfg, as_of)
    return by_store_month(j.groupBy(*AVAILABLE_KEYS).agg(F.bit_or(cal.bit("week_num")).alias(BITS)))


def available_lists(available: DataFrame) -> DataFrame:
    """The ordered list of each available row (for reports; the pipeline compares bitmaps)."""
    return available.select(*AVAILABLE_KEYS, cal.bit_values(BITS).alias("available_array"))


def available_week_lists(m1: DataFrame, m3: DataFrame, cfg: MissingFileConfig, as_of: dt.date) -> DataFrame:
    """M12 as lists: a bag in SP (one entry a delivery), a set in MFS; the difference reads the set of both."""
    n = F.count(F.lit(1)) if cfg.weekly_available_bag else F.lit(1)
    weeks = _weeks_delivered(m1, m3, cfg, as_of).groupBy(*AVAILABLE_KEYS, "week_num").agg(n.cast("int").alias(TIMES))
    bag = F.flatten(F.sort_array(F.collect_list(F.array_repeat("week_num", F.col(TIMES)))))
    return weeks.groupBy(*AVAILABLE_KEYS).agg(bag.alias("available_array"))


def available_monthly(m1: DataFrame, cfg: MissingFileConfig) -> DataFrame:
    """Store-months with a monthly delivery (MFS adds the list [1])."""
    d = F.col("sellout_date")
    out = by_store_month(m1.filter(F.col("data_source_frequency") == cfg.monthly).select(
        "market_code", "division_code", "point_of_sale_code", bigint(F.year(d)).alias("year"),
        bigint(F.month(d)).alias("month"), "client_name", "source_project", "channel_level1", "channel_level2",
    ).distinct())
    if not cfg.monthly_by_count:
        out = out.withColumn(BITS, cal.bit(F.lit(1)))
    return out


# ---------------------------------------------------------------------------
# M14-M20 difference, flag, months before start
# ---------------------------------------------------------------------------

def _diff_join(expected: DataFrame, available: DataFrame) -> DataFrame:
    e, a = expected.alias("e"), available.alias("a")
    cond = [F.col(f"e.{k}") == F.col(f"a.{k}") for k in DIFF_JOIN_KEYS]
    return e.join(a, cond, "left")


def missing_by_bits(expected: DataFrame, available: DataFrame) -> DataFrame:
    """LEFT join on the six keys, bag-difference count, duplicates removed.

    Available rows with the same keys and bitmap give the same count, so one of them is enough;
    a store's starts that expect different bitmaps are summed for each available one.
    """
    j = _diff_join(expected, available.select(*DIFF_JOIN_KEYS, BITS).distinct())
    counted = j.groupBy(*[F.col(f"e.{c}").alias(c) for c in RESULT[:10]], F.col(f"a.{BITS}").alias("_have")).agg(
        F.sum(missing_bits(f"e.{BITS}", f"e.{TIMES}", f"a.{BITS}")).alias("missing_file_count"))
    return counted.select(*RESULT[:10], "missing_file_count").distinct()


def missing_monthly_by_count(expected: DataFrame, available: DataFrame) -> DataFrame:
    """Expected rows minus matched rows per expected store-month."""
    j = _diff_join(expected, available)
    return j.groupBy(*[F.col(f"e.{c}").alias(c) for c in RESULT[:10]]).agg(
        (F.count(F.col("e.source_project")) - F.count(F.col("a.source_project"))).alias("missing_file_count")
    )


def with_flag(df: DataFrame) -> DataFrame:
    """1 if anything is missing, else 0."""
    return df.withColumn(
        "missing_file", F.when(F.col("missing_file_count") > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    )


def before_start(m5: DataFrame, months: DataFrame, cfg: MissingFileConfig, as_of: dt.date) -> DataFrame:
    """Calendar months before a store's start; count NULL, flag 2 (SP) or 0 (MFS).

    Daily and monthly stores: months before the start month.  Any other
    frequency: months before the month of the Monday-week holding the start.
    The bound is always a first of month, so "some day of the month is before
    it" is "the month's first day is before it".
    """
    start = F.col("effective_store_start_date")
    bound = F.when(
        F.col("data_source_frequency").isin(cfg.daily, cfg.monthly), F.trunc(start, "month")
    ).otherwise(F.trunc(F.trunc(start, "week"), "month"))
    j = cal.before(m5, months, bound, _month_bounds(cfg, as_of)[0])
    return j.select(
        *[c for c in RESULT[:5]], "year", "month", "channel_level1", "channel_level2", "data_source_frequency",
        F.lit(None).cast("bigint").alias("missing_file_count"),
        F.lit(cfg.before_start_flag).cast("bigint").alias("missing_file"),
    ).distinct()


@dataclass
class MissingFileSteps:
    """Every intermediate of one run (each a lazy DataFrame).

    The daily and weekly steps are lists; ``bits`` holds the bitmaps that the result is computed
    from, by the step's name.
    """

    deliveries: DataFrame
    pos: DataFrame
    calendar: DataFrame
    active: DataFrame
    starts: DataFrame
    expected_daily: DataFrame
    expected_weekly: DataFrame
    expected_monthly: DataFrame
    zero_marketplace: DataFrame | None
    zero_sku_traffic: DataFrame
    available_daily: DataFrame
    available_weekly: DataFrame
    available_monthly: DataFrame
    missing: DataFrame
    before_start: DataFrame
    result: DataFrame
    bits: dict[str, DataFrame]
    staged: tuple[str, ...] = ()

    def close(self) -> None:
        """Release the cached steps (M1, M4, M5) and delete what this run staged; its frames can't be read after that."""
        from ledgerlint.sources.sinks import remove_path

        for df in (self.deliveries, self.active, self.starts):
            df.unpersist()
        for path in self.staged:
            remove_path(self.result.sparkSession, path)

    unpersist = close


def missing_files(inp: MissingFileInputs, as_of: dt.date, cfg: MissingFileConfig = SP,
                  materialize: str = "stage", m1: DataFrame | None = None) -> MissingFileSteps:
    """Run M1-M20 for one as-of date; ``.result`` holds the 12 result columns.

    A preset with a fact floor (SP) has the same M1 for every as-of date: pass the
    ``deliveries`` of an earlier run as ``m1`` and the fact isn't scanned again.

    M1 (distinct store-days, read by five steps), M4 (active stores) and M5
    (one row per store) feed several later steps.  ``materialize`` decides
    how they are kept:
    - ``"persist"``: cached lazily; a lost cached partition is recomputed
      from its lineage (which re-reads the fact);
    - ``"stage"``: M1 is written now as parquet under the session's
      checkpoint folder and read back, so later plans start from that table
      and a lost executor never sends the job back to the fact; M4 and M5,
      one row per store and cheap to rebuild from M1, are persisted;
    - ``"none"``: everything stays one lazy plan.
    """
    staged: list[str] = []

    def keep(df: DataFrame, name: str, small: bool) -> DataFrame:
        if materialize == "stage" and not small:
            from ledgerlint.sources.sinks import stage, stage_path

            staged.append(stage_path(df.sparkSession, f"missing-files-{name}"))
            return stage(df, path=staged[-1])
        if materialize in ("stage", "persist"):
            return df.persist()
        return df

    if m1 is not None and not cfg.fact_floor:
        raise ValueError(f"{cfg.name} deliveries depend on the as-of date; m1 can't be shared")
    m1 = keep(deliveries(inp, cfg, as_of), "m1", small=False) if m1 is None else m1
    m2 = pos_attributes(inp, cfg)
    m3 = complete_months_calendar(inp, cfg, as_of)
    m4 = keep(active_stores(m1, as_of), "m4", small=True)
    m5 = keep(store_starts(m1, inp, cfg, m4), "m5", small=True)
    months = cal.month_days(m3)
    e_d, e_w = expected_daily(m5, months, cfg, as_of), expected_weekly(m5, m3, cfg, as_of)
    e_m = expected_monthly(m5, months, cfg, as_of)
    m9 = marketplace_zero_sales(inp, cfg, m4) if cfg.marketplace_zero else None
    m10 = sku_traffic_zero_sales(inp, cfg, m2, m4)
    a_d = available_daily(m1, cfg, [z for z in (m9, m10) if z is not None])
    a_w, a_m = available_weekly(m1, m3, cfg, as_of), available_monthly(m1, cfg)
    if cfg.diff_per_frequency:
        monthly = missing_monthly_by_count(e_m, a_m) if cfg.monthly_by_count else missing_by_bits(e_m, a_m)
        missing = missing_by_bits(e_d, a_d).unionByName(missing_by_bits(e_w, a_w)).unionByName(monthly)
    else:
        exp = e_d.unionByName(e_w).unionByName(e_m)
        missing = missing_by_bits(exp, a_d.unionByName(a_w).unionByName(a_m))
    flagged = with_flag(missing).select(*RESULT)
    m19 = before_start(m5, months, cfg, as_of).select(*RESULT)
    return MissingFileSteps(
        deliveries=m1, pos=m2, calendar=m3, active=m4, starts=m5, expected_daily=expected_lists(e_d),
        expected_weekly=expected_lists(e_w), expected_monthly=e_m, zero_marketplace=m9, zero_sku_traffic=m10,
        available_daily=available_lists(a_d), available_weekly=available_week_lists(m1, m3, cfg, as_of),
        available_monthly=a_m, missing=flagged, before_start=m19, result=flagged.unionByName(m19),
        bits={"expected_daily": e_d, "expected_weekly": e_w, "available_daily": a_d, "available_weekly": a_w},
        staged=tuple(staged),
    )
