"""Calendar x store range joins (M6-M8, M19) as month generators and equi-joins.

The reference cross-joins every calendar day with every store and filters on
``cal_date >= start``.  Here the calendar is collapsed to bitmaps: a row per
month (or per month and week) whose ``_days`` has bit d set for each day d of
the month.  Each store generates the months from its start to the last one,
they meet the collapsed calendar by equality, and the days before the start
are cut off the first month's bitmap.  That is about 30x fewer rows than day x
store, and no list is gathered: every state is one 64-bit number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.functions.scalar import ColumnOrName, bigint, col

MONTH = "_cal_month"
DAYS = "_days"
#: How often the calendar lists a day (1 in a clean one); it counts in the bag of expected days.
TIMES = "_times"


def bit(value: ColumnOrName) -> Column:
    """The 64-bit number with bit ``value`` set (days of a month, week numbers: below 63)."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), col(value).cast("int"))


def bit_values(bits: ColumnOrName) -> Column:
    """The numbers of the set bits, in order."""
    b = col(bits)
    return F.filter(F.sequence(F.lit(0).cast("bigint"), F.lit(62).cast("bigint")), lambda v: F.getbit(b, v.cast("int")) == 1)


def month_days(calendar: DataFrame, date: str = "cal_date") -> DataFrame:
    """(month, year, month, _times, _days): the days of each month that the calendar lists so often."""
    by_day = calendar.groupBy(F.trunc(date, "month").alias(MONTH), "year", "month", bit(F.dayofmonth(date)).alias("_bit")).agg(
        F.count(F.lit(1)).alias(TIMES))
    return by_day.groupBy(MONTH, "year", "month", TIMES).agg(F.bit_or("_bit").alias(DAYS))


def week_days(calendar: DataFrame, date: str = "cal_date", week_start: str = "week_start_date", week: str = "week_num") -> DataFrame:
    """(month, year, month of the week's start, week, _days): the days of each month that belong to a week."""
    return calendar.groupBy(
        F.trunc(date, "month").alias(MONTH), bigint(F.year(week_start)).alias("year"), bigint(F.month(week_start)).alias("month"), week,
    ).agg(F.bit_or(bit(F.dayofmonth(date))).alias(DAYS))


def _months(first: Column, last: Column) -> Column:
    return F.explode(F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))))


def from_start(stores: DataFrame, collapsed: DataFrame, start: str, first: Column, last: Column) -> DataFrame:
    """Stores x collapsed calendar rows that hold a day on or after the start; ``_days`` keeps these days only.

    ``first`` and ``last`` bound the calendar's months.  A NULL start matches nothing.
    """
    s = F.col(start)
    own = F.trunc(s, "month")
    months = stores.filter(s.isNotNull()).withColumn(MONTH, _months(F.greatest(own, first), last))
    left = F.col(DAYS).bitwiseAND(F.when(F.col(MONTH) == own, -bit(F.dayofmonth(s))).otherwise(F.lit(-1).cast("bigint")))
    return months.join(collapsed, MONTH).withColumn(DAYS, left).filter(F.col(DAYS) != 0).drop(MONTH)


def before(stores: DataFrame, collapsed: DataFrame, bound: Column, first: Column) -> DataFrame:
    """Stores x calendar months before ``bound``, which is the first day of a month."""
    months = stores.withColumn(MONTH, _months(first, F.add_months(bound, -1)))
    return months.join(collapsed.select(MONTH, "year", "month").distinct(), MONTH).drop(MONTH)
