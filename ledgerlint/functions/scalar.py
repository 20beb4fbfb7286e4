"""Column functions shared by the rules and the missing-file pipeline.

All are compositions of built-in Spark functions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

SCORE_TYPE = "decimal(38,9)"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_text(date_col: ColumnOrName) -> Column:
    """Calendar year of a date as text."""
    return F.year(col(date_col)).cast("string")


def abs_measure(c: ColumnOrName, null_as_zero: bool = True) -> Column:
    """Absolute measure; NULL becomes 0 unless ``null_as_zero`` is off."""
    a = F.abs(col(c))
    return F.coalesce(a, F.lit(0)) if null_as_zero else a


def dq_score(invalid_rows: ColumnOrName, total_rows: ColumnOrName, safe: bool = False) -> Column:
    """``(1 - invalid/total) * 100`` as DECIMAL(38,9); NULL when total is NULL or 0.

    ``safe`` mirrors the variant written with a safe division defaulting to 1;
    since the CASE already excludes a zero total both give the same value.
    """
    inv, tot = col(invalid_rows), col(total_rows)
    ratio = F.try_divide(inv, tot) if safe else inv / tot
    if safe:
        ratio = F.coalesce(ratio, F.lit(1.0))
    score = (F.lit(1.0) - ratio) * F.lit(100)
    return F.when(tot.isNotNull() & (tot != 0), score).cast(SCORE_TYPE)


def attribute_array(pairs: Sequence[tuple[str, ColumnOrName]]) -> Column:
    """``[struct(key, value), ...]`` from (name, column) pairs, values as text."""
    return F.array(*[F.struct(F.lit(k).alias("key"), col(v).cast("string").alias("value")) for k, v in pairs])


def sql_trim(c: ColumnOrName) -> Column:
    """TRIM that strips all Unicode white space at both ends, not only blanks."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def ltrim_chars(c: ColumnOrName, chars: str) -> Column:
    """Strip the given characters from the left (``LTRIM(x, '0')``)."""
    cls = "".join(ch if ch.isalnum() else "\\" + ch for ch in chars)
    return F.regexp_replace(col(c), "^[" + cls + "]+", "")


def concat_strict(*cols: ColumnOrName) -> Column:
    """CONCAT that is NULL as soon as one input is NULL (never ``concat_ws``)."""
    return F.concat(*[col(c).cast("string") for c in cols])


def week_start_monday(d: ColumnOrName) -> Column:
    """Monday on or before the date (``DATE_TRUNC(d, WEEK(MONDAY))``)."""
    return F.trunc(col(d), "week")


def week_start_sunday(d: ColumnOrName) -> Column:
    """Sunday on or before the date (``DATE_TRUNC(d, WEEK(SUNDAY))``)."""
    return F.date_sub(col(d), F.dayofweek(col(d)) - 1)


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(col(d), "month")


def bigint(c: ColumnOrName) -> Column:
    return col(c).cast("bigint")
