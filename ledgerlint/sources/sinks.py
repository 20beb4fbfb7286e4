"""Sinks: DQ result append (S9), status-table snapshots (M21-M23), the timestamp view.

The status table has no row-level update on plain parquet, and overwriting
the path being read loses the input.  Each upsert therefore writes a new
snapshot directory and then appends one row to a manifest; readers take the
newest version listed in the manifest, so a failed write is never visible.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlint.operators.measure import RESULT_COLUMNS
from ledgerlint.operators.merge import KEYS, STATUS_COLUMNS, STATUS_SCHEMA, DuplicateSourceKeys, check_source_keys, merge_rows


def append_results(df: DataFrame, path: str) -> None:
    """Append DQ results to a parquet table."""
    df.write.mode("append").parquet(path)


#: Folders of one recorded run; times are microseconds, so they don't depend on the session's time zone.
RUN_FOLDERS = ["run_dq_id", "run_micros"]


def record_run(df: DataFrame, path: str) -> None:
    """S9, idempotent: the rows of each (dq_id, run_timestamp) in ``df`` replace what the table has of that run.

    A repeated run (a retry after a failure, say) leaves its rows once; other runs aren't touched.
    """
    keyed = df.withColumns({"run_dq_id": F.col("dq_id"), "run_micros": F.unix_micros("run_timestamp")})
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN_FOLDERS).parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The recorded results, with the columns of a rule's result."""
    return spark.read.parquet(path).select(*RESULT_COLUMNS)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written (local or on the cluster's file system)."""
    target, fs = _file_system(spark, path)
    fs.delete(target, True)


def stage_path(spark: SparkSession, name: str = "staged") -> str:
    """A fresh path for one staged result, below the session's checkpoint folder."""
    from ledgerlint.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "staged", path: str | None = None) -> DataFrame:
    """Write a result once as parquet under the session's checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()`` but computes the plan only
    once (a reliable RDD checkpoint of an uncached plan computes it twice) and
    keeps file statistics for the planner.  On a cluster the checkpoint folder
    is the shared one named by ``spark.checkpoint.dir``.  A caller that passes
    ``path`` (from ``stage_path``) can delete it with ``remove_path`` when done.
    """
    spark = df.sparkSession
    path = path or stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


class ConcurrentUpsert(RuntimeError):
    """Another upsert committed the version that this one was about to commit."""


class StatusTable:
    """Versioned status table under ``root``: one folder for each attempt in ``data/``, and ``_manifest/``.

    An attempt writes a folder of its own and then appends one manifest row with
    the version and that folder.  Readers only follow the manifest, so an attempt
    that died before its manifest row is never seen and never in the way of the
    next one.  Of two rows for one version the earlier commit counts.
    ``vacuum`` deletes what the manifest's newest versions don't need.
    """

    MANIFEST = "version bigint, path string, committed_at timestamp, n_rows bigint"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.observed: dict[str, dict[str, int]] = {}  # by attempt: what its writes counted
        self.manifest = f"{self.root}/_manifest"

    def _versions(self) -> DataFrame | None:
        if not path_exists(self.spark, self.manifest):  # the table is empty
            return None
        return self.spark.read.schema(self.MANIFEST).parquet(self.manifest)

    def current_version(self) -> int:
        v = self._versions()
        return 0 if v is None else int(v.agg(F.max("version").alias("v")).first()["v"] or 0)

    def _entry(self, version: int):
        return self._versions().filter(F.col("version") == version).orderBy("committed_at", "path").first()

    def _folder(self, version: int) -> str:
        return f"{self.root}/{self._entry(version)['path']}"

    def _n_rows(self, version: int) -> int:
        """Rows of a version, as its write counted them."""
        known = self._entry(version)["n_rows"] if version else 0
        return self.read(version).count() if known is None else known

    def read(self, version: int | None = None) -> DataFrame:
        version = self.current_version() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], STATUS_SCHEMA)
        return self.spark.read.parquet(self._folder(version))

    def write_attempt(self, source: DataFrame, run_ts: dt.datetime | str, current: int) -> str:
        """Merge ``source`` into version ``current`` and write the outcome to a folder of its own; not yet visible.

        The source is computed once (staged) and read once (merged).  Both writes count their rows as they go
        (``DataFrame.observe``, in the writing stage, so a repeated task counts once): if several source rows met
        one row of the current version, that row is written several times, and the written rows that come from
        the version outnumber its rows.  Then the attempt fails, as a MERGE does.
        """
        staged_at = stage_path(self.spark, "status-source")
        attempt = f"data/{uuid.uuid4().hex}"
        null_key = F.lit(False)
        for k in KEYS:
            null_key = null_key | F.col(k).isNull()
        try:
            sourced, merged = Observation(), Observation()
            staged = stage(source.observe(sourced, F.count(F.lit(1)).alias("source_rows"), F.count_if(null_key).alias("null_keys")),
                           path=staged_at)
            target = self.read(current) if current else None
            merge_rows(target, staged, run_ts).observe(
                merged, F.count(F.lit(1)).alias("n_rows"), F.count_if("in_target").alias("from_target"),
                F.count_if(F.col("in_target") & F.col("in_source")).alias("matched"), F.count_if("changed").alias("updated"),
                F.count_if(~F.col("in_target")).alias("inserted"),
            ).select(*STATUS_COLUMNS).write.mode("errorifexists").parquet(f"{self.root}/{attempt}")
            seen = self.observed[attempt] = sourced.get | merged.get
            if seen["from_target"] != self._n_rows(current):
                check_source_keys(target, staged)  # names some of the keys
                raise DuplicateSourceKeys("several source rows for one target row")
        finally:
            remove_path(self.spark, staged_at)
        return attempt

    def commit(self, attempt: str, current: int) -> int:
        """Make an attempt on top of ``current`` visible as the next version."""
        if self.current_version() != current:
            raise ConcurrentUpsert(f"version {current + 1} exists already; upsert again")
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = self.observed.get(attempt, {}).get("n_rows")
        entry = self.spark.createDataFrame([(current + 1, attempt, now, rows)], self.MANIFEST)
        entry.coalesce(1).write.mode("append").parquet(self.manifest)
        return current + 1

    def upsert(self, source: DataFrame, run_ts: dt.datetime | str) -> int:
        """Stage ``source``, merge it into the current snapshot, write the next one; return its version."""
        current = self.current_version()
        return self.commit(self.write_attempt(source, run_ts, current), current)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders of all but the ``keep`` newest versions and of attempts without a manifest row.

        Not to be run beside an upsert.  Returns the deleted folders.
        """
        current = self.current_version()
        needed = {self._folder(v) for v in range(max(1, current - keep + 1), current + 1)}
        top, fs = _file_system(self.spark, f"{self.root}/data")
        folders = [f"{self.root}/data/{f.getPath().getName()}" for f in fs.listStatus(top)] if fs.exists(top) else []
        gone = sorted(f for f in folders if f not in needed)
        for f in gone:
            remove_path(self.spark, f)
        return gone


def timestamp_view(spark: SparkSession, name: str = "missing") -> DataFrame:
    """A view holding one row with the current timestamp as ``dt``."""
    df = spark.sql("SELECT current_timestamp() AS dt")
    df.createOrReplaceTempView(name)
    return df
