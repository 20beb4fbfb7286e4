"""Code normalisers of the marketplace feeds (A1, A3, A5, A9 and the SKU-traffic POS key).

Pure column expressions over built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.functions.scalar import ColumnOrName, col, ltrim_chars, sql_trim

# ---- fixed values that must equal the reference's ------------------------
# EAN texts that mean "no EAN"
EAN_JUNK = ["0", "--", "", "-", "(blank)", '""']
# the two characters a wrong encoding makes of U+00A0, removed from EANs
GARBLED_NBSP = "┬á"
# product-code values that mean "unknown"
PRODUCT_CODE_UNKNOWN = ["NA", "-1", ""]
# market prefixes of the product lookup
MARKETS_P65 = ["IN"]
MARKETS_P54 = ["AU", "NZ", "MY", "SG", "TH", "ID", "VN", "PH", "LB", "PK", "EG", "MA"]
MARKETS_P05 = ["SA", "AE", "QA", "KW", "BH", "OM", "JO", "IQ"]
PREFIX_P65, PREFIX_P54, PREFIX_P05 = "P65", "P54", "P05"
# --------------------------------------------------------------------------

#: Parts of the rows that have no EAN or market to look up.
NULL_KEY_PARTS = 1024


def _strip_decimal_zeros(text: Column) -> Column:
    """'8900000000000.000000000' -> '8900000000000'; '1.250' -> '1.25'."""
    return F.regexp_replace(text, r"\.0*$|(\.\d*?[1-9])0+$", "$1")


def normalize_ean(ean: ColumnOrName) -> Column:
    """A1: junk -> NULL; ``E+`` notation -> integer text; else drop the garbled space and trim.

    Then strip leading zeros and trim.  Scientific text that is not a number
    gives NULL (``try_cast``).
    """
    e = col(ean)
    dec = e.try_cast("decimal(38,9)")
    sci = sql_trim(_strip_decimal_zeros(dec.cast("string")))
    plain = sql_trim(F.replace(e, F.lit(GARBLED_NBSP), F.lit("")))
    first = (
        F.when(sql_trim(e).isin(*EAN_JUNK), F.lit(None).cast("string"))
        .when(e.rlike(r"E\+"), sci)
        .otherwise(plain)
    )
    return sql_trim(ltrim_chars(first, "0"))


def join_ean_mapping(amz: DataFrame, mapping: DataFrame) -> DataFrame:
    """A2: LEFT join of marketplace rows to the prioritised EAN-to-SKU mapping.

    Five conditions: normalised EAN equal to the mapping EAN without leading
    zeros, same source market, prioritised market equal to market, mapping
    EAN not all zeros and not blank.  The mapping's columns come back with a
    ``map_`` prefix.  The missing-file pipeline selects none of them and drops
    the fan-out with DISTINCT, so it does not use this join.
    """
    ean = normalize_ean("ean_code")
    # a row without a key can't match; its key is extended by a part number, so that such rows don't meet in one task
    nobody = F.concat(F.lit("?"), F.pmod(F.xxhash64(*amz.columns), F.lit(NULL_KEY_PARTS)).cast("string"))
    keyed = amz.withColumn("_ean", F.when(ean.isNotNull() & F.col("market_code").isNotNull(), F.concat(F.lit("="), ean)).otherwise(nobody))
    m = mapping.filter(
        (F.col("prioritized_market_code") == F.col("market_code"))
        & (F.col("ean_code") != "0000000000000")
        & (sql_trim("ean_code") != "")
    ).select(*[F.col(c).alias(f"map_{c}") for c in mapping.columns],
             F.concat(F.lit("="), sql_trim(ltrim_chars("ean_code", "0"))).alias("_map_ean"))
    # the second key of a row without a market is its part's too, as NULL never equals
    market = F.coalesce(keyed["market_code"], keyed["_ean"])
    joined = keyed.join(m, (keyed["_ean"] == m["_map_ean"]) & (market == m["map_src_market_code"]), "left")
    return joined.drop("_ean", "_map_ean")


def normalize_product_code(code: ColumnOrName) -> Column:
    """A3: longer than 13 -> last 8; NULL/NA/-1/'' -> '-1'; shorter than 8 -> left-pad '0'; else trim."""
    c = col(code)
    return (
        F.when(F.length(c) > 13, F.right(c, F.lit(8)))
        .when(c.isNull() | c.isin(*PRODUCT_CODE_UNKNOWN), F.lit("-1"))
        .when(F.length(c) < 8, F.lpad(c, 8, "0"))
        .otherwise(sql_trim(c))
    )


def prefixed_product_key(market: ColumnOrName, code: ColumnOrName) -> Column:
    """A5: market-specific product key; NULL for markets without a prefix."""
    m, c = col(market), col(code)
    norm = normalize_product_code(c)
    return (
        F.when(m.isin(*MARKETS_P65), F.concat(F.lit(PREFIX_P65 + "_"), c))
        .when(m.isin(*MARKETS_P54), F.concat(F.lit(PREFIX_P54 + "_"), norm))
        .when(m.isin(*MARKETS_P05), F.concat(F.lit(PREFIX_P05 + "_"), norm))
    )


def marketplace_pos_code(market: ColumnOrName, client: ColumnOrName, channel: ColumnOrName) -> Column:
    """``UPPER(market_CLIENT_channel)``, channel default ``NA``; ``-1`` without market or client."""
    m, cl, ch = col(market), col(client), col(channel)
    code = F.concat(m, F.lit("_"), F.upper(cl), F.lit("_"), F.coalesce(ch, F.lit("NA")))
    return F.upper(F.when(m.isNotNull() & cl.isNotNull(), code).otherwise(F.lit("-1")))


def sku_traffic_pos_code(market: ColumnOrName, client: ColumnOrName, store: ColumnOrName) -> Column:
    """``market_client_store`` with store default ``NA``; ``-1`` if market or client is NULL or empty."""
    m, cl, st = col(market), col(client), col(store)
    blank = (F.coalesce(m, F.lit("")) == "") | (F.coalesce(cl, F.lit("")) == "")
    return F.when(blank, F.lit("-1")).otherwise(F.concat(m, F.lit("_"), cl, F.lit("_"), F.coalesce(st, F.lit("NA"))))


def remap_division(division: ColumnOrName) -> Column:
    """Division ``ACD`` is reported as ``LDB``."""
    d = col(division)
    return F.when(d == "ACD", F.lit("LDB")).otherwise(d)
