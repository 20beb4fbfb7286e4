"""Key multiplicity (stages S3, S3a).

The reference counts a key with ``COUNT(*) OVER (PARTITION BY key)`` and joins
the window output *without* DISTINCT, so a fact row whose key occurs n times in
the dimension is repeated n times, each copy carrying ``cnt = n``.

Here the dimension is first reduced to one row per key (``groupBy().count()``,
partial aggregation, no fan-out rows).  The join then carries ``cnt`` and a
``_copies`` column: the number of copies the reference would have made.  The
measures multiply rows and values by it, which gives the same sums and counts
without materialising the copies and keeps the joined side one row per key.

A frame may also carry ``_rows``: the number of original rows one row stands
for after a pre-aggregation (its value columns are then sums over those rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COPIES = "_copies"
ROWS = "_rows"
CNT = "cnt"
#: Parts of the rows without a key, so that these, all of one group, don't meet in one task.
NULL_PARTS = 64


def key_counts(dim: DataFrame, key: str, out_key: str | None = None) -> DataFrame:
    """One row per key with its multiplicity ``cnt``."""
    out_key = out_key or key
    return dim.groupBy(F.col(key).alias(out_key)).agg(F.count(F.lit(1)).alias(CNT))


def join_key_counts(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, how: str = "inner",
                    fan_out: bool = True) -> DataFrame:
    """Attach ``cnt`` of ``fact_key`` in ``dim``; with ``fan_out`` also the copy weight (S3 join).

    ``how`` is ``inner`` (facts without a key drop out) or ``left`` (they stay
    with ``cnt`` NULL and weight 1).  Without ``fan_out`` (the DISTINCT form)
    every matched fact row counts once.
    """
    counts = key_counts(dim, dim_key, "_dim_key")
    j = fact.join(counts, fact[fact_key] == counts["_dim_key"], how).drop("_dim_key")
    if not fan_out:
        return j
    w = F.coalesce(F.col(CNT), F.lit(1))
    prev = F.col(COPIES) if COPIES in fact.columns else F.lit(1).cast("bigint")
    return j.withColumn(COPIES, (prev * w).cast("bigint"))


def window_key_count(df: DataFrame, key: str) -> DataFrame:
    """``cnt`` = rows per key, every row kept (S3 on the same relation)."""
    return df.withColumn(CNT, F.count(F.lit(1)).over(Window.partitionBy(key)))


def fact_key_count(fact: DataFrame, key: str, group_cols: list[str], sum_cols: list[str]) -> DataFrame:
    """``cnt`` of ``key`` over the whole fact, returned pre-aggregated.

    Equivalent to S3 on the fact followed by an aggregation by ``group_cols``.
    The keys that occur more than once are counted from a scan of the key column
    alone (partial aggregation, so a hot key moves one row a task).  They are
    joined back null-safely: few of them are broadcast by Spark, many are shuffled
    and Spark splits a skewed key, for no window needs all rows of a key together.
    Rows with a NULL key, which may be any share of the fact, go in ``NULL_PARTS`` parts.
    Rows without a match have ``cnt`` 1.
    """
    repeated = fact.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias(CNT)).filter(F.col(CNT) > 1)
    parts = F.when(F.col("_key").isNull(), F.sequence(F.lit(0), F.lit(NULL_PARTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = repeated.withColumn("_key_part", F.explode(parts))
    part = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*group_cols, *sum_cols), F.lit(NULL_PARTS)).cast("int")).otherwise(F.lit(0))
    rows = fact.withColumn("_part", part)
    joined = rows.join(repeated, rows[key].eqNullSafe(repeated["_key"]) & (rows["_part"] == repeated["_key_part"]), "left")
    return joined.groupBy(F.coalesce(CNT, F.lit(1)).alias(CNT), *group_cols).agg(
        F.count(F.lit(1)).alias(ROWS), *[F.sum(c).alias(c) for c in sum_cols]
    )
