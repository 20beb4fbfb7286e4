"""Conditional measures and the uniform DQ result (stages S5-S8)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlint.functions.scalar import attribute_array, dq_score
from ledgerlint.operators.keycount import COPIES, ROWS
from ledgerlint.params import RunParams

# The result table holds every rule's rows, so its value columns have one type
# (the warehouse NUMERIC: 38 digits, 9 decimals), whatever the measure's type.
VALUE_TYPE = "decimal(38,9)"

#: Place of a rule in a fused run of several.
RULE = "_rule"

RESULT_COLUMNS = [
    "dq_id", "run_timestamp", "attribute_arr", "dq_score", "invalid_rows",
    "total_rows", "invalid_value", "total_value", "param_date",
]


def measure(df: DataFrame, keys: Sequence[str], invalid: Column, value: Column) -> DataFrame:
    """Per group: invalid/total value and invalid/total rows.

    ``invalid`` is a boolean column: a NULL condition counts as valid.  The value
    sum has ELSE 0, the invalid row count counts TRUE only.  When the frame has
    copy or row weights (see ``keycount``) rows count ``_rows * _copies`` and
    values count ``_copies`` times, exactly; value sums have the type that an
    unweighted sum would have.
    """
    has_rows, has_copies = ROWS in df.columns, COPIES in df.columns
    if not (has_rows or has_copies):
        return df.groupBy(*keys).agg(
            F.sum(F.when(invalid, value).otherwise(F.lit(0))).alias("invalid_value"),
            F.sum(value).alias("total_value"),
            F.count(F.when(invalid, F.lit(1))).alias("invalid_rows"),
            F.count(F.lit(1)).alias("total_rows"),
        )
    # Sum the unweighted rows of each copy weight first, then weight the sums: exact
    # in the measure's own type, and the partial aggregation sees plain sums.
    copies = F.col(COPIES) if has_copies else F.lit(1).cast("bigint")
    part = df.withColumn("_inv", F.coalesce(invalid, F.lit(False))).groupBy(*keys, "_inv", copies.alias("_w")).agg(
        F.sum(value).alias("_v"),
        F.sum(F.col(ROWS)).alias("_n") if has_rows else F.count(F.lit(1)).alias("_n"),
    )
    sum_type = part.schema["_v"].dataType.simpleString()
    v, n = times(F.col("_v"), F.col("_w"), sum_type), F.col("_n") * F.col("_w")
    return part.groupBy(*keys).agg(
        F.sum(F.when(F.col("_inv"), v).otherwise(F.lit(0))).cast(sum_type).alias("invalid_value"),
        F.sum(v).cast(sum_type).alias("total_value"),
        F.sum(F.when(F.col("_inv"), n).otherwise(F.lit(0))).cast("bigint").alias("invalid_rows"),
        F.sum(n).cast("bigint").alias("total_rows"),
    )


def times(value: Column, weight: Column, value_type: str) -> Column:
    """``value * weight`` without losing a decimal; raises where 28 integer digits don't hold it.

    Spark cuts the product of DECIMAL(38,9) and BIGINT to six decimals.  The
    fraction (one integer digit at most) times the weight keeps all its decimals,
    and so does the whole part, which has none.
    """
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", value_type)
    if not m or int(m[2]) == 0:
        return value * weight
    fraction = value % F.lit(1)
    whole = (value - fraction).cast("decimal(28,0)")
    return ((whole * weight).cast("decimal(28,0)") + fraction * weight).cast(value_type)


def combine_measures(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum partial measures (from ``measure`` at a finer grain) up to ``keys``.

    Sums of partial sums equal the row-level sums, NULL included: a NULL
    partial comes only from rows that were all NULL, and SUM skips it.  This
    lets a rule aggregate *before* joining a hierarchy whose key is a group
    key (eager aggregation): the join then sees one row per store instead of
    one per fact row, whether or not the dimension is small enough to
    broadcast.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.groupBy(*keys).agg(
        F.sum("invalid_value").cast(types["invalid_value"]).alias("invalid_value"),
        F.sum("total_value").cast(types["total_value"]).alias("total_value"),
        F.sum("invalid_rows").cast("bigint").alias("invalid_rows"),
        F.sum("total_rows").cast("bigint").alias("total_rows"),
    )


def finalize(spark: SparkSession, agg: DataFrame, params: RunParams, attributes: Sequence[tuple[str, str]],
             keep_empty: bool = True, safe_score: bool = False) -> DataFrame:
    """Attach run parameters, build the attribute array and the score.

    ``attributes`` pairs an output key with the group column holding its
    value.  The parameters are literal columns on the aggregate.  With
    ``keep_empty`` an empty aggregate yields one row (NULL metrics, keys with
    NULL values): a one-row frame without a match in the aggregate's first row is
    added, so only that row, never the aggregate, goes through a broadcast.
    Without it empty input yields none.
    """
    joined = agg.select(*params.columns(), *agg.columns)
    if keep_empty:
        blank = params.frame(spark).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in agg.schema.fields])
        joined = joined.unionByName(_if_empty(blank, agg))
    return _result(joined, attributes, safe_score)


def finalize_rules(spark: SparkSession, agg: DataFrame, rules: Sequence[RunParams], attributes: Sequence[tuple[str, str]],
                   keep_empty: bool = True, safe_score: bool = False) -> DataFrame:
    """``finalize`` for several rules of one aggregate, whose ``RULE`` column holds a rule's place in ``rules``.

    With ``keep_empty`` an empty aggregate yields one row for each rule.
    """
    listed = F.array(*[F.struct(*r.columns()) for r in rules])
    joined = agg.select(F.inline(F.array(F.get(listed, F.col(RULE)))), *[c for c in agg.columns if c != RULE])
    if keep_empty:
        blank = spark.range(1).select(F.inline(listed)).select(
            "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in agg.schema.fields if f.name != RULE])
        joined = joined.unionByName(_if_empty(blank, agg))
    return _result(joined, attributes, safe_score)


def _if_empty(rows: DataFrame, agg: DataFrame) -> DataFrame:
    """The rows if the aggregate has none, else nothing; only the aggregate's first row is looked at.

    The check reads every column, always true, so that both branches of a union with the aggregate have the same
    shuffles and Spark runs them once (ReusedExchange).
    """
    first = agg.limit(1).select(F.xxhash64(*agg.columns).alias("_any"))
    return rows.join(first, F.col("_any") >= F.lit(-(1 << 63)), "left_anti")


def _result(joined: DataFrame, attributes: Sequence[tuple[str, str]], safe_score: bool) -> DataFrame:
    return joined.select(
        "dq_id",
        "run_timestamp",
        attribute_array(list(attributes)).alias("attribute_arr"),
        dq_score("invalid_rows", "total_rows", safe=safe_score).alias("dq_score"),
        "invalid_rows",
        "total_rows",
        F.col("invalid_value").cast(VALUE_TYPE).alias("invalid_value"),
        F.col("total_value").cast(VALUE_TYPE).alias("total_value"),
        "param_date",
    )


def flatten_result(df: DataFrame, keys: Sequence[str], exact: bool = False) -> DataFrame:
    """The result with scalar columns only (``attr_<key>``), for comparison and reports.

    Values are doubles, or with ``exact`` decimal text with all nine decimals.
    """
    value_type = "string" if exact else "double"

    def value_of(key: str) -> Column:
        return F.get(F.filter("attribute_arr", lambda x: x["key"] == F.lit(key)), 0)["value"]

    attrs = [value_of(k).alias(f"attr_{k}") for k in keys]
    return df.select(
        "dq_id",
        F.date_format("run_timestamp", "yyyy-MM-dd HH:mm:ss").alias("run_timestamp"),
        *attrs,
        F.col("dq_score").cast("double").alias("dq_score"),
        F.col("invalid_rows").cast("bigint").alias("invalid_rows"),
        F.col("total_rows").cast("bigint").alias("total_rows"),
        F.col("invalid_value").cast(value_type).alias("invalid_value"),
        F.col("total_value").cast(value_type).alias("total_value"),
        "param_date",
    )
