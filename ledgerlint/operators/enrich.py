"""Hierarchy enrichment (stages S4, S4a, S4b).

Dimensions are joined as they are (duplicates fan out, as in the reference).
Join strategy is left to Spark: a dimension under the broadcast threshold is
broadcast, a larger one is shuffled; AQE re-plans from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HIERARCHY = ["channel_level1", "channel_level2", "client_name"]


def enrich_pos(df: DataFrame, pos: DataFrame, how: str = "left", key: str = "point_of_sale_code") -> DataFrame:
    """Add channel levels and client from the point-of-sale dimension (S4 left, S4a inner)."""
    p = pos.select(
        F.col("point_of_sale_code").alias("_pos_key"), "channel_level1", "channel_level2", "client_name"
    )
    return df.join(p, df[key] == p["_pos_key"], how).drop("_pos_key")


def enrich_distributor(df: DataFrame, dis: DataFrame, key: str = "distributor_code") -> DataFrame:
    """Sell-through hierarchy: level 1 is ``B2B``, client is the distributor name (S4b, inner)."""
    d = dis.select(
        F.col("distributor_code").alias("_dis_key"),
        F.lit("B2B").alias("channel_level1"),
        F.col("channel_level2"),
        F.col("distributor_name").alias("client_name"),
    )
    return df.join(d, df[key] == d["_dis_key"], "inner").drop("_dis_key")
