"""Run parameters of a data-quality rule (stage S1)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunParams:
    """The three bound parameters every rule carries into its result rows."""

    dq_id: str
    run_timestamp: dt.datetime | str
    param_date: str | None = None

    def columns(self) -> list[Column]:
        ts = self.run_timestamp
        if isinstance(ts, dt.datetime):
            ts = ts.strftime("%Y-%m-%d %H:%M:%S.%f")
        return [
            F.lit(self.dq_id).cast("string").alias("dq_id"),
            F.lit(ts).cast("timestamp").alias("run_timestamp"),
            F.lit(self.param_date).cast("string").alias("param_date"),
        ]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The parameters as a one-row relation (used to keep a row on empty input)."""
        return spark.range(1).select(*self.columns())
