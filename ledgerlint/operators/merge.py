"""Upsert of the missing-file status (M22, M23) as a full outer join.

Per row, with plain ``=`` on the six keys (a NULL key never matches):
- target and source: if ``t.count != s.count OR t.flag != s.flag`` is TRUE
  (NULL is not), take the source's count and flag and stamp
  ``last_updated_timestamp``; otherwise keep the target row as it is;
- source only: insert it, stamped;
- target only: keep it (nothing is ever deleted);
then every row gets ``last_invoked_timestamp``.

More than one source row for one target row is an error, as for a MERGE
with an update clause.  ``merge_rows`` says of each row where it comes from, so
that a writer can count the target's rows as it writes them (more than the
target has: the error); ``check_source_keys`` raises with sample keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["division_code", "point_of_sale_code", "client_name", "source_project", "year", "month"]
SOURCE_COLUMNS = ["market_code", "division_code", "point_of_sale_code", "client_name", "source_project", "year",
                  "month", "channel_level1", "channel_level2", "data_source_frequency", "missing_file_count",
                  "missing_file"]
STATUS_COLUMNS = SOURCE_COLUMNS + ["last_updated_timestamp", "last_invoked_timestamp"]
STATUS_SCHEMA = (
    "market_code string, division_code string, point_of_sale_code string, client_name string, "
    "source_project string, year bigint, month bigint, channel_level1 string, channel_level2 string, "
    "data_source_frequency string, missing_file_count bigint, missing_file bigint, "
    "last_updated_timestamp timestamp, last_invoked_timestamp timestamp"
)


class DuplicateSourceKeys(ValueError):
    """The source holds several rows for one target row."""


def _ts(ts: dt.datetime | str) -> Column:
    if isinstance(ts, dt.datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(ts).cast("timestamp")


def check_source_keys(target: DataFrame, source: DataFrame, sample: int = 5) -> None:
    """Raise if a target row would be matched by more than one source row.

    Only non-NULL keys can match; the check aggregates the source by key
    (partial aggregation) and semi-joins the repeated keys with the target.
    """
    not_null = F.lit(True)
    for k in KEYS:
        not_null = not_null & F.col(k).isNotNull()
    rep = source.filter(not_null).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    hit = rep.join(target.select(*KEYS), KEYS, "left_semi")
    rows = hit.limit(sample).collect()
    if rows:
        raise DuplicateSourceKeys(f"several source rows for one target row, e.g. {[r.asDict() for r in rows]}")


def merge_status(target: DataFrame | None, source: DataFrame, run_ts: dt.datetime | str,
                 check: bool = True) -> DataFrame:
    """New status snapshot from the current one (``None`` = empty table) and a run's result."""
    if check and target is not None:
        check_source_keys(target, source)
    return merge_rows(target, source, run_ts).select(*STATUS_COLUMNS)


def merge_rows(target: DataFrame | None, source: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """The snapshot's rows, with ``in_target``, ``in_source`` and ``changed``; repeated source keys repeat a target row."""
    ts = _ts(run_ts)
    src = source.select(*SOURCE_COLUMNS)
    if target is None:
        no, yes = F.lit(False), F.lit(True)
        return src.select(*SOURCE_COLUMNS, ts.alias("last_updated_timestamp"), ts.alias("last_invoked_timestamp"),
                          no.alias("in_target"), yes.alias("in_source"), no.alias("changed"))
    t = target.select(*STATUS_COLUMNS, F.lit(True).alias("_in_t")).alias("t")
    s = src.select(*SOURCE_COLUMNS, F.lit(True).alias("_in_s")).alias("s")
    cond = None
    for k in KEYS:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    changed = in_t & in_s & F.coalesce(
        (F.col("t.missing_file_count") != F.col("s.missing_file_count"))
        | (F.col("t.missing_file") != F.col("s.missing_file")),
        F.lit(False),
    )
    out = []
    for c in SOURCE_COLUMNS:
        if c in ("missing_file_count", "missing_file"):
            out.append(F.when(in_t & ~changed, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        else:
            out.append(F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    updated = F.when(in_t & ~changed, F.col("t.last_updated_timestamp")).otherwise(ts)
    return j.select(*out, updated.alias("last_updated_timestamp"), ts.alias("last_invoked_timestamp"),
                    in_t.alias("in_target"), in_s.alias("in_source"), changed.alias("changed"))
