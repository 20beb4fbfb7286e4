"""Retail-shaped inputs built from the driver's TPC-H-like parquet tables.

Every fixture is a pure DataFrame function of the parquet files, so the
Spark queries and the DuckDB oracle (``ledgerlint.oracle``) build the same
rows.  The definitions follow FIXTURES.md section 2.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlint.sources.tables import read_table

# ---- fixed values of the fixtures --------------------------------------
# market code by region key 0..4 (covers every branch of the product-key rule)
MARKET_BY_REGION = ["AU", "IN", "SG", "SA", "XX"]
# project by supplier key modulo 3
PROJECT_BY_SUPP_MOD3 = ["ECOMM_SKU_TRAFFIC", "ECOM_AMZ", "OMS_SFCC"]
# delivery frequency of data source DS0..DS4
FREQUENCY_BY_DS = ["Daily", "Daily", "Weekly", "Monthly", ""]
# division letters by a modulo 3
DIVISION_BY_MOD3 = ["A", "N", "R"]
# the not-a-space pair that a wrong encoding makes of U+00A0
GARBLED_NBSP = "┬á"
STORE_CREATED = "2000-03-15"
STORE_CREATED_EARLY = "1999-06-15"
# -------------------------------------------------------------------------


def _s(c: Column) -> Column:
    return c.cast("string")


def _pick(key: Column, values: list[str]) -> Column:
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(key == i, F.lit(values[i])).otherwise(out)
    return out


def fx_pos(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, d, "region").select("r_regionkey", "r_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    market = _pick(F.col("r_regionkey"), MARKET_BY_REGION)
    return j.select(
        F.col("s_suppkey").alias("suppkey"),
        F.col("n_nationkey").alias("nationkey"),
        F.col("s_name"),
        market.alias("market_code"),
        F.concat(market, F.lit("_N"), _s(F.col("n_nationkey")), F.lit("_S"), _s(F.col("s_suppkey"))).alias(
            "point_of_sale_code"
        ),
        F.col("n_name").alias("client_name"),
        F.col("r_name").alias("channel_level1"),
        F.concat(F.lit("L"), _s(F.col("s_suppkey") % 3)).alias("channel_level2"),
    )


def dim_pos(pos: DataFrame) -> DataFrame:
    return pos.select("point_of_sale_code", "client_name", "channel_level1", "channel_level2")


def fx_pos_dup(pos: DataFrame) -> DataFrame:
    return pos.unionByName(pos.filter(F.col("suppkey") % 10 == 0))


def sales_amount(price: Column, discount: Column) -> Column:
    """price * (1 - discount) computed exactly from cents and whole percents."""
    cents = F.round(price * 100).cast("bigint")
    pct = F.round(discount * 100).cast("bigint")
    return ((cents * (F.lit(100) - pct)).cast("decimal(18,4)") / F.lit(10000)).cast("decimal(18,4)")


def fx_fact_sellout(spark: SparkSession, d: str, pos: DataFrame) -> DataFrame:
    l = read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate",
    )
    pos = pos.select("suppkey", "nationkey", "market_code", "point_of_sale_code")
    j = l.join(pos, l.l_suppkey == pos.suppkey)
    amount = sales_amount(F.col("l_extendedprice"), F.col("l_discount"))
    return j.select(
        F.col("market_code"),
        F.col("l_returnflag").alias("division_code"),
        _pick(F.col("l_suppkey") % 3, PROJECT_BY_SUPP_MOD3).alias("source_project"),
        F.col("point_of_sale_code"),
        F.to_date("l_shipdate").alias("sellout_date"),
        F.concat(F.lit("DS"), _s(F.col("l_suppkey") % 5)).alias("data_source"),
        F.concat(F.lit("P"), _s(F.col("l_partkey"))).alias("product_code"),
        F.concat(_s(F.col("l_orderkey")), F.lit("_"), _s(F.col("l_linenumber"))).alias("unique_id"),
        F.concat(F.lit("O"), _s(F.col("l_orderkey"))).alias("order_number"),
        F.when(F.col("l_linenumber") == 1, -amount).otherwise(amount).alias("consolidated_sales_eur"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("nationkey"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_quantity").alias("quantity"),
    )


def fx_fact_hot_key(f: DataFrame) -> DataFrame:
    """The sell-out fact with a hot key: a third of all rows (part key divisible by 3) share ``unique_id = '-1'``."""
    return f.withColumn("unique_id", F.when(F.col("partkey") % 3 == 0, F.lit("-1")).otherwise(F.col("unique_id")))


def fx_fact_nonzero(f: DataFrame) -> DataFrame:
    """The sell-out fact without the low-quantity lines of the two e-commerce projects."""
    return f.filter(~((F.col("quantity") <= 5) & ((F.col("suppkey") % 3).isin(0, 1))))


def fx_mixed_freq(f: DataFrame) -> DataFrame:
    """Like the pipeline fact, but a store's lines spread over several data sources."""
    return f.withColumn(
        "data_source", F.concat(F.lit("DS"), _s((F.col("suppkey") + F.col("linenumber")) % 5))
    )


def fx_datasource(spark: SparkSession, d: str, duplicate_ds1: bool = False) -> DataFrame:
    """Data-source dimension for every DS code the fact uses, plus a '-1' row."""
    ks = read_table(spark, d, "lineitem").select((F.col("l_suppkey") % 5).alias("k")).distinct()
    ds = ks.select(
        F.concat(F.lit("DS"), _s(F.col("k"))).alias("data_source_code"),
        _pick(F.col("k"), FREQUENCY_BY_DS).alias("data_source_frequency"),
    )
    extra = ks.filter(F.col("k") == 0).select(
        F.lit("-1").alias("data_source_code"), F.lit("Daily").alias("data_source_frequency")
    )
    out = ds.unionByName(extra)
    if duplicate_ds1:
        out = out.unionByName(ds.filter(F.col("data_source_code") == "DS1"))
    return out


def _part(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")


def fx_product(spark: SparkSession, d: str) -> DataFrame:
    """Product dimension: parts up to size 45 (larger ones are orphans), sizes up to 5 twice."""
    p = _part(spark, d)
    rows = p.filter(F.col("p_size") <= 45).unionByName(p.filter(F.col("p_size") <= 5))
    return rows.select(
        F.concat(F.lit("P"), _s(F.col("p_partkey"))).alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("signature_name"),
        F.col("p_brand").alias("brand_name"),
        F.concat(F.lit("MG"), _s(F.col("p_size") % 7)).alias("material_group_code"),
        F.lit("P360").alias("source_project"),
        _pick(F.col("p_size") % 3, DIVISION_BY_MOD3).alias("division_code"),
    )


def sap_product_code(partkey: Column) -> Column:
    """Raw product code of the marketplace feed: 5, 8 or 14 characters, sometimes 'NA'."""
    k = _s(partkey)
    code = (
        F.when(partkey % 3 == 0, F.lpad(k, 5, "0"))
        .when(partkey % 3 == 1, F.lpad(k, 8, "0"))
        .otherwise(F.concat(F.lit("SAP"), F.lpad(k, 11, "0")))
    )
    return F.when(partkey % 13 == 0, F.lit("NA")).otherwise(code)


def ean_code(partkey: Column) -> Column:
    """Raw EAN text in the shapes the normaliser handles."""
    k = _s(partkey)
    m = partkey % 6
    return (
        F.when(m == 0, F.lit("(blank)"))
        .when(m == 1, F.lpad(k, 13, "0"))
        .when(m == 2, F.concat(F.lit("3."), k, F.lit("E+12")))
        .when(m == 3, F.concat(k, F.lit(GARBLED_NBSP)))
        .when(m == 4, F.lit("--"))
        .otherwise(F.concat(F.lit(" 00"), k, F.lit("\u00a0")))
    )


def fx_product_sap(spark: SparkSession, d: str) -> DataFrame:
    """Product dimension keyed the way the marketplace lookups key it."""
    p = _part(spark, d)
    k = F.col("p_partkey")
    padded = F.lpad(_s(k), 8, "0")
    m = F.col("p_size") % 4
    code = (
        F.when(m == 0, padded)
        .when(m == 1, F.concat(F.lit("P54_"), padded))
        .when(m == 2, F.concat(F.lit("P05_"), padded))
        .otherwise(F.concat(F.lit("P65_"), sap_product_code(k)))
    )
    return p.select(
        code.alias("product_code"),
        F.when(F.col("p_size") > 40, F.lit("LEGACY")).otherwise(F.lit("P360")).alias("source_project"),
        _pick(F.col("p_size") % 3, ["A", "N", "ACD"]).alias("division_code"),
    )


def fx_signature(spark: SparkSession, d: str) -> DataFrame:
    ks = read_table(spark, d, "lineitem").select((F.col("l_partkey") % 7).alias("k")).distinct()
    return ks.filter(F.col("k") <= 4).select(
        F.concat(F.lit("00"), _s(F.col("k"))).alias("signature_code"),
        _pick(F.col("k") % 3, DIVISION_BY_MOD3).alias("division"),
    )


def calendar_days(bounds: DataFrame) -> DataFrame:
    """Calendar rows (date, year, month, Monday week start, ISO week) for each day of ``lo``..``hi``."""
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_time"))
    return days.select(
        "date_time",
        F.year("date_time").cast("bigint").alias("year"),
        F.month("date_time").cast("bigint").alias("month"),
        F.trunc("date_time", "week").alias("week_start_date"),
        F.weekofyear("date_time").cast("bigint").alias("week_num"),
    )


def calendar_between(spark: SparkSession, lo: str, hi: str) -> DataFrame:
    """Calendar dimension for the dates ``lo``..``hi`` (inclusive)."""
    return calendar_days(spark.range(1).select(F.lit(lo).cast("date").alias("lo"), F.lit(hi).cast("date").alias("hi")))


def fx_calendar(spark: SparkSession, d: str) -> DataFrame:
    """One row a day over the whole fact: from the Monday before the first shipment's year to the last one's end."""
    ship = F.to_date("l_shipdate")
    ends = read_table(spark, d, "lineitem").agg(F.year(F.min(ship)).alias("a"), F.year(F.max(ship)).alias("b"))
    return calendar_days(ends.select(
        F.trunc(F.make_date(F.col("a"), F.lit(1), F.lit(1)), "week").alias("lo"),
        F.make_date(F.col("b"), F.lit(12), F.lit(31)).alias("hi"),
    ))


def fx_store_start(pos: DataFrame) -> DataFrame:
    pos = pos.filter(F.col("suppkey") % 4 == 0)
    return pos.select(
        F.col("market_code").alias("market"),
        F.concat(F.lit("N"), _s(F.col("nationkey"))).alias("platform"),
        F.concat(F.lit("S"), _s(F.col("suppkey"))).alias("oms_store_code"),
        F.when(F.col("suppkey") % 8 == 0, F.lit(STORE_CREATED_EARLY))
        .otherwise(F.lit(STORE_CREATED))
        .cast("date")
        .alias("store_created_date"),
    )


def fx_sku_traffic(fact: DataFrame) -> DataFrame:
    f = fact.filter(F.col("source_project") == "ECOMM_SKU_TRAFFIC")
    pk = F.col("partkey")
    signature = (
        F.when(pk % 50 == 0, F.lit("PH"))
        .when(pk % 50 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("S"), _s(pk % 7)))
    )
    return f.select(
        "market_code",
        F.col("division_code").alias("division"),
        F.concat(F.lit("N"), _s(F.col("nationkey"))).alias("client"),
        F.concat(F.lit("S"), _s(F.col("suppkey"))).alias("platform_store_id"),
        F.lit("D").alias("period"),
        F.lit("sku traffic").alias("file_type"),
        signature.alias("sap_signature_code"),
        F.col("sellout_date").alias("date_id"),
        F.when(F.col("quantity") <= 5, F.lit(0).cast("decimal(18,4)"))
        .otherwise(F.abs("consolidated_sales_eur"))
        .alias("gross_sales"),
        F.col("quantity").cast("bigint").alias("gross_sold_units"),
        F.lit(1).cast("bigint").alias("gross_orders"),
    )


def fx_amz(fact: DataFrame) -> DataFrame:
    f = fact.filter(F.col("source_project") == "ECOM_AMZ")
    low = F.col("quantity") <= 5
    qty = F.col("quantity").cast("bigint")
    revenue = F.abs("consolidated_sales_eur")
    au = F.col("market_code") == "AU"
    return f.select(
        "market_code",
        F.col("division_code").alias("sap_division_name"),
        F.concat(F.lit("n"), _s(F.col("nationkey"))).alias("client"),
        F.lit("D").alias("period"),
        F.concat(F.lit("s"), _s(F.col("suppkey"))).alias("channel_type"),
        ean_code(F.col("partkey")).alias("ean_code"),
        sap_product_code(F.col("partkey")).alias("sap_product_code"),
        F.concat(F.lit("000"), _s(F.col("partkey") % 7)).alias("sap_signature_code"),
        F.col("sellout_date").alias("date_id"),
        F.when(au & low, F.lit(0).cast("bigint")).otherwise(qty).alias("shipped_units"),
        revenue.alias("shipped_revenue"),
        F.when(~au & low, F.lit(None).cast("bigint")).otherwise(qty).alias("ordered_units"),
        F.when(~au & low, F.lit(0).cast("decimal(18,4)")).otherwise(revenue).alias("ordered_revenue"),
    )


def fx_fact_sellthrough(f: DataFrame) -> DataFrame:
    return f.select(
        "division_code",
        "market_code",
        F.concat(F.lit("D"), _s(F.col("suppkey"))).alias("distributor_code"),
        "product_code",
        "data_source",
        "unique_id",
        F.col("sellout_date").alias("sellthrough_date"),
        "consolidated_sales_eur",
    )


def fx_distributor(spark: SparkSession, d: str, duplicate: bool = False) -> DataFrame:
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_name")
    rows = s.unionByName(s.filter(F.col("s_suppkey") % 10 == 0)) if duplicate else s
    return rows.select(
        F.concat(F.lit("D"), _s(F.col("s_suppkey"))).alias("distributor_code"),
        F.col("s_name").alias("distributor_name"),
        F.concat(F.lit("L"), _s(F.col("s_suppkey") % 3)).alias("channel_level2"),
    )


def fx_stock(spark: SparkSession, d: str, f: DataFrame, pos: DataFrame) -> DataFrame:
    """Stock-in-trade rows in the nested (struct) shape of the reference.

    The supplier is joined before the part: the fact's own join is on the supplier too, so one shuffle serves both.
    """
    p = _part(spark, d).drop("p_name")
    pos = pos.select("suppkey", "s_name", "channel_level1")
    j = f.join(pos, "suppkey").join(p, F.col("partkey") == F.col("p_partkey"))
    size = F.col("p_size")
    brand = (
        F.when(size == 1, F.lit(""))
        .when(size == 2, F.lit("-1"))
        .when(size == 3, F.lit("unspecified"))
        .when(size == 4, F.lit(None).cast("string"))
        .otherwise(F.col("p_brand"))
    )
    qty = F.col("quantity").cast("bigint")
    units = F.when(F.col("linenumber") == 7, F.lit(None).cast("bigint")).when(
        F.col("linenumber") == 1, -qty
    ).otherwise(qty)
    return j.select(
        F.col("division_code").alias("division_amaas"),
        F.col("sellout_date").alias("tech_period_end_date"),
        F.struct(
            F.col("market_code").alias("orga_country_alpha2"),
            F.col("channel_level1").alias("orga_region_description"),
        ).alias("GEOGRAPHY"),
        F.struct(
            F.col("s_name").alias("distributor_name"),
            F.concat(F.lit("D"), _s(F.col("suppkey"))).alias("distributor_code"),
        ).alias("DISTRIBUTOR"),
        F.struct(F.col("data_source").alias("data_file_provider")).alias("METADATA_TECHNICAL"),
        F.struct(units.alias("total_stock_units")).alias("FACT_VALUE"),
        F.struct(
            _pick(size % 3, DIVISION_BY_MOD3).alias("orga_division"),
            F.concat(F.lit("00"), _s(F.col("partkey") % 7)).alias("signature_code"),
            F.col("p_type").alias("signature_desc"),
            F.concat(F.lit("AX"), _s(size % 4)).alias("axis_code"),
            F.concat(F.lit("Axis "), _s(size % 4)).alias("axis_desc"),
            brand.alias("brand_code"),
            F.col("p_brand").alias("brand_desc"),
            F.concat(F.lit("SX"), _s(size % 6)).alias("subaxis_code"),
            F.concat(F.lit("Sub axis "), _s(size % 6)).alias("subaxis_desc"),
            F.concat(F.lit("SB"), _s(size % 5)).alias("subbrand_code"),
            F.concat(F.lit("Sub brand "), _s(size % 5)).alias("subbrand_desc"),
        ).alias("PRODUCT"),
        F.struct((F.lit(1.0) + (F.col("suppkey") % 4) * F.lit(0.25)).alias("conversion_rate")).alias("CURRENCY"),
    )


def fx_ref_rate(spark: SparkSession, d: str) -> DataFrame:
    """Reference exchange rates, DECIMAL(38,9): those of supplier keys 0-2 modulo 4 (rate 1.75 is an orphan)."""
    s = read_table(spark, d, "supplier").select("s_suppkey")
    return s.filter(F.col("s_suppkey") % 4 != 3).select(
        (F.lit(1.0) + (F.col("s_suppkey") % 4) * F.lit(0.25)).cast("decimal(38,9)").alias("exchange_rate")
    )


def fx_ref_product(spark: SparkSession, d: str) -> DataFrame:
    """Reference products with every catalogued column; some values are left out (NULL), so stock rows are orphans."""
    p, size = _part(spark, d), F.col("p_size")
    sig = F.col("p_partkey") % 7
    known = ~F.col("p_brand").isin("Brand#1", "Brand#2")
    return p.select(
        F.when(size % 3 < 2, _pick(size % 3, DIVISION_BY_MOD3)).alias("division_code"),
        F.when(sig <= 4, F.concat(F.lit("00"), _s(sig))).alias("signature_code"),
        F.when(size % 2 == 0, F.col("p_type")).alias("signature_name"),
        F.when(size % 4 < 3, F.concat(F.lit("AX"), _s(size % 4))).alias("axe_code"),
        F.when(size % 4 < 3, F.concat(F.lit("Axis "), _s(size % 4))).alias("axe_name"),
        F.when(known, F.col("p_brand")).alias("brand_code"),
        F.when(known, F.col("p_brand")).alias("brand_name"),
        F.when(size % 6 < 4, F.concat(F.lit("SX"), _s(size % 6))).alias("sub_axe_code"),
        F.when(size % 6 < 4, F.concat(F.lit("Sub axis "), _s(size % 6))).alias("sub_axe_name"),
        F.when(size % 5 != 2, F.concat(F.lit("SB"), _s(size % 5))).alias("sub_brand_code"),
        F.when(size % 5 != 2, F.concat(F.lit("Sub brand "), _s(size % 5))).alias("sub_brand_name"),
    )


def fx_general_data(spark: SparkSession, d: str) -> DataFrame:
    s = read_table(spark, d, "supplier").select("s_suppkey", "s_name")
    return s.select(
        F.when(F.col("s_suppkey") % 10 != 3, F.concat(F.lit("D"), _s(F.col("s_suppkey")))).alias("business_partner_number_external_system"),
        F.when(F.col("s_suppkey") % 4 != 1, F.col("s_name")).alias("organization_legal_name_1"),
    )


def fx_ref_market(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "region").filter(F.col("r_regionkey") != 2).select(F.col("r_name").alias("zone_code"))


def fx_fact_exact(fact: DataFrame) -> DataFrame:
    """The sell-out fact with a DECIMAL(38,9) measure that uses all nine decimals."""
    nine = F.lit("0.123456789").cast("decimal(10,9)") * F.col("linenumber").cast("decimal(2,0)")
    return fact.withColumn("consolidated_sales_eur",
                           (F.col("consolidated_sales_eur").cast("decimal(20,9)") + nine).cast("decimal(38,9)"))


def fx_fact_nulls(fact: DataFrame) -> DataFrame:
    """The sell-out fact with NULL keys, markets, sources and measures."""
    k = F.col("partkey")
    def hole(c: str, n: int):
        return F.when(k % n != 0, F.col(c)).alias(c)

    holes = {"unique_id": 7, "product_code": 11, "point_of_sale_code": 13, "data_source": 17, "market_code": 19,
             "division_code": 23, "consolidated_sales_eur": 5}
    return fact.select(*[hole(c, holes[c]) if c in holes else F.col(c) for c in fact.columns])


def fx_datasource_nulls(ds: DataFrame) -> DataFrame:
    """The data sources, with one more of NULL frequency and one without a code."""
    more = ds.filter(F.col("data_source_code") == "DS1").select(
        F.explode(F.array(F.struct(F.lit("DS4").alias("c"), F.lit(None).cast("string").alias("f")),
                          F.struct(F.lit(None).cast("string").alias("c"), F.lit("Daily").alias("f")))).alias("x")
    ).select(F.col("x.c").alias("data_source_code"), F.col("x.f").alias("data_source_frequency"))
    return ds.unionByName(more)


def fx_sku_traffic_nulls(sku: DataFrame) -> DataFrame:
    """SKU traffic with NULL markets, clients, stores and measures, and division ``ACD``."""
    k = F.col("gross_sold_units")
    return sku.select(*[
        F.when(k % 11 != 3, F.col(c)).alias(c) if c == "market_code"
        else F.when(k % 13 != 4, F.col(c)).alias(c) if c == "client"
        else F.when(k % 7 != 5, F.col(c)).alias(c) if c == "platform_store_id"
        else F.when(k % 5 != 1, F.col(c)).alias(c) if c in ("gross_sales", "gross_orders")
        else F.when(k % 3 == 0, F.lit("ACD")).otherwise(F.col(c)).alias(c) if c == "division"
        else F.col(c)
        for c in sku.columns])


def fx_amz_nulls(amz: DataFrame) -> DataFrame:
    """Marketplace rows with NULL markets, clients, channels and signatures; AU rows with NULL shipped units."""
    q = F.coalesce("shipped_units", "ordered_units", F.lit(0))
    au_blank = (F.col("market_code") == "AU") & (q == 0)
    return amz.select(*[
        F.when(q % 11 != 3, F.col(c)).alias(c) if c == "market_code"
        else F.when(q % 13 != 4, F.col(c)).alias(c) if c == "client"
        else F.when(q % 7 != 5, F.col(c)).alias(c) if c == "channel_type"
        else F.when(q % 5 != 2, F.col(c)).alias(c) if c in ("sap_signature_code", "sap_product_code")
        else F.when(~au_blank | F.col("sap_product_code").endswith("1"), F.col(c)).alias(c) if c in ("shipped_units", "ordered_units")
        else F.when(au_blank & F.col("sap_product_code").endswith("3"), F.lit(0).cast("decimal(18,4)")).otherwise(F.col(c)).alias(c)
        if c == "ordered_revenue"
        else F.when(q % 4 == 1, F.lit("ACD")).otherwise(F.col(c)).alias(c) if c == "sap_division_name"
        else F.col(c)
        for c in amz.columns])


def fx_ref_brand(spark: SparkSession, d: str) -> DataFrame:
    """Reference product table: every brand except two, so some stock rows are orphans."""
    p = _part(spark, d)
    return p.filter(~F.col("p_brand").isin("Brand#1", "Brand#2")).select(F.col("p_brand").alias("brand_code"))


def fx_fact_sellthrough_nulls(fact_nulls: DataFrame) -> DataFrame:
    """The sell-through fact with the holes of ``fx_fact_nulls``, and no distributor where that has no store."""
    return fx_fact_sellthrough(fact_nulls.withColumn("suppkey", F.when(F.col("point_of_sale_code").isNotNull(), F.col("suppkey"))))


def fx_ean_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Prioritised EAN mapping: three source markets a part, a third of them not prioritised, some junk EANs, some repeated."""
    k = F.col("p_partkey")
    m = _part(spark, d).select("p_partkey", F.posexplode(F.array(F.lit("AU"), F.lit("SG"), F.lit("SA"))).alias("i", "market_code"))
    ean = F.when(k % 9 == 0, F.lit("0000000000000")).when(k % 9 == 1, F.lit("  ")).when(k % 9 != 2, F.lpad(_s(k), 13, "0"))
    copies = F.when(k % 10 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    return m.select(
        ean.alias("ean_code"), F.col("market_code").alias("src_market_code"), "market_code",
        F.when((k + F.col("i")) % 3 != 0, F.col("market_code")).otherwise(F.lit("ZZ")).alias("prioritized_market_code"),
        F.explode(copies).alias("copy"), k.alias("k"),
    ).select("ean_code", "src_market_code", "market_code", "prioritized_market_code",
             F.concat(F.lit("SKU"), _s(F.col("k")), F.col("copy")).alias("sku_code"))


class FixtureSet:
    """The fixtures of one driver directory, each built once per session.

    With ``materialize`` (the default) the fixtures that are expensive to
    derive are written once as parquet under the session's checkpoint folder
    and read back, so every query scans a plain table (with column pruning
    and filter pushdown) instead of re-deriving it from the TPC-H tables.
    The sell-out fact is written by the tasks that scan its source, without a shuffle
    while the stores are small enough to broadcast; projections of it are not written
    again.  Neither is the stock: its readers take a year and a few columns, and only
    those rows are joined to the stores and the parts.
    """

    _sets: dict[tuple[str, str, bool], "FixtureSet"] = {}
    _lock = threading.RLock()

    def __init__(self, spark: SparkSession, d: str, materialize: bool = True):
        self.spark, self.d, self.materialize = spark, d.rstrip("/"), materialize
        self._frames: dict[str, DataFrame] = {}
        self._id = uuid.uuid4().hex  # a further set of the folder never overwrites files that this one reads

    @classmethod
    def of(cls, spark: SparkSession, d: str, materialize: bool = True) -> "FixtureSet":
        key = (spark.sparkContext.applicationId, d.rstrip("/"), materialize)
        with cls._lock:
            if key not in cls._sets:
                cls._sets[key] = cls(spark, d, materialize)
            return cls._sets[key]

    def _root(self) -> str:
        from ledgerlint.session import ensure_checkpoint_dir

        tag = "".join(ch if ch.isalnum() else "_" for ch in self.d)
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/fixtures/{self.spark.sparkContext.applicationId}/{tag}-{self._id}"

    def _get(self, name: str, build, store: bool = True, large: bool = False) -> DataFrame:
        """Build (and materialise) a fixture once.

        A ``large`` fixture (the sell-out fact) whose source is too small to give
        each of the session's cores a split (a few MB a core) is spread over as
        many files, so that its scans run in parallel.  A larger source is not
        shuffled: its splits are.
        """
        with self._lock:
            return self._get_locked(name, build, store, large)

    def _get_locked(self, name: str, build, store: bool, large: bool) -> DataFrame:
        if name not in self._frames:
            df = build()
            if self.materialize and store:
                path = f"{self._root()}/{name}"
                cores = self.spark.sparkContext.defaultParallelism
                if large and read_table(self.spark, self.d, "lineitem").rdd.getNumPartitions() < cores:
                    df = df.repartition(cores)
                df.write.mode("overwrite").parquet(path)
                df = self.spark.read.parquet(path)
            self._frames[name] = df
        return self._frames[name]

    def pos(self) -> DataFrame:
        return self._get("pos", lambda: fx_pos(self.spark, self.d))

    def pos_dup(self) -> DataFrame:
        return fx_pos_dup(self.pos())

    def fact_sellout(self) -> DataFrame:
        return self._get("fact_sellout", lambda: fx_fact_sellout(self.spark, self.d, self.pos()), large=True)

    def fact_hot_key(self) -> DataFrame:
        return fx_fact_hot_key(self.fact_sellout())

    def fact_nonzero(self) -> DataFrame:
        return fx_fact_nonzero(self.fact_sellout())

    def mixed_freq(self) -> DataFrame:
        return fx_mixed_freq(self.fact_nonzero())

    def fact_sellthrough(self) -> DataFrame:
        return self._get("fact_sellthrough", lambda: fx_fact_sellthrough(self.fact_sellout()), store=False)

    def datasource(self, duplicate_ds1: bool = False) -> DataFrame:
        ds = self._get("datasource", lambda: fx_datasource(self.spark, self.d))
        return ds.unionByName(ds.filter(F.col("data_source_code") == "DS1")) if duplicate_ds1 else ds

    def product(self) -> DataFrame:
        return self._get("product", lambda: fx_product(self.spark, self.d))

    def product_sap(self) -> DataFrame:
        return self._get("product_sap", lambda: fx_product_sap(self.spark, self.d))

    def signature(self) -> DataFrame:
        return self._get("signature", lambda: fx_signature(self.spark, self.d))

    def calendar(self) -> DataFrame:
        return self._get("calendar", lambda: fx_calendar(self.spark, self.d))

    def store_start(self) -> DataFrame:
        return self._get("store_start", lambda: fx_store_start(self.pos()))

    def sku_traffic(self) -> DataFrame:
        return self._get("sku_traffic", lambda: fx_sku_traffic(self.fact_sellout()), store=False)

    def amz(self) -> DataFrame:
        return self._get("amz", lambda: fx_amz(self.fact_sellout()), store=False)

    def distributor(self, duplicate: bool = False) -> DataFrame:
        name = "distributor_dup" if duplicate else "distributor"
        return self._get(name, lambda: fx_distributor(self.spark, self.d, duplicate))

    def _fact_rows(self) -> DataFrame:
        """The rows of ``fact_sellout``, not written: a reader's filters and columns reach the scan of the lines."""
        return self._get("fact_rows", lambda: fx_fact_sellout(self.spark, self.d, self.pos()), store=False)

    def stock(self) -> DataFrame:
        return self._get("stock", lambda: fx_stock(self.spark, self.d, self._fact_rows(), self.pos()), store=False)

    def ref_product(self) -> DataFrame:
        return self._get("ref_product", lambda: fx_ref_product(self.spark, self.d))

    def general_data(self) -> DataFrame:
        return self._get("general_data", lambda: fx_general_data(self.spark, self.d))

    def ref_market(self) -> DataFrame:
        return self._get("ref_market", lambda: fx_ref_market(self.spark, self.d))

    def fact_exact(self) -> DataFrame:
        return fx_fact_exact(self.fact_sellout())

    def fact_nulls(self) -> DataFrame:
        return fx_fact_nulls(self.fact_sellout())

    def fact_sellthrough_nulls(self) -> DataFrame:
        return fx_fact_sellthrough_nulls(self.fact_nulls())

    def stock_nulls(self) -> DataFrame:
        return fx_stock(self.spark, self.d, fx_fact_nulls(self._fact_rows()), self.pos())

    def ean_mapping(self) -> DataFrame:
        return self._get("ean_mapping", lambda: fx_ean_mapping(self.spark, self.d))

    def ref_brand(self) -> DataFrame:
        return self._get("ref_brand", lambda: fx_ref_brand(self.spark, self.d))

    def ref_rate(self) -> DataFrame:
        return self._get("ref_rate", lambda: fx_ref_rate(self.spark, self.d))
