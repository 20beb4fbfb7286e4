"""Exact dedup (operator 6): stateful streaming with disk-backed keyed state.

Texts are equal when identical after deleting every white-space character
(``[\\x20\\x09-\\x0D]``).  ``StreamDedup`` keeps one state row per digest in a
RocksDB state store, without expiry: the number of rows seen, and of the row that
stays its code points, its stable identifier (doc_id) and its content locator
(file and row number).  New documents are appended with ``ingest``; a restarted
stream goes on from its checkpoint in the shared folder.  Before the shuffle each
task aggregates its own rows, so a digest that a third of all rows share moves
one row per task.

A hit (a digest with more than one row) is confirmed on the full bytes: the text
at the kept locator is compared with every member's text.  Should a digest ever
join different texts, its rows are grouped again by the whole text itself.

Of equal texts the row with the most code points stays, then the smallest doc_id,
then the smallest locator (rows repeated with their id).

Defined results: null text counts as empty; a null doc_id is larger than all
others; all columns other than doc_id and text are carried along untouched, whatever their
names; a very long text is one row like any other, compared in the JVM; an empty
table gives no rows.
"""

from __future__ import annotations

import contextlib
import functools
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, stage

#: State on disk, and closed after each batch: an open store holds a few MB of disk, whatever its size.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
DIGESTS = "digest string, n_points int, neg_id decimal(20,0), doc_id bigint, file string, row bigint"


def normalise(text: Column) -> Column:
    """The text without white space."""
    out = F.coalesce(text, F.lit(""))
    for c in " \n\t\r\x0b\x0c":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


#: The place of a row, while a filter works on a table.
PLACE = ("__file", "__row")


def keeping_names(drop):
    """A filter of documents, made safe for input columns that are named like the place of a row."""

    @functools.wraps(drop)
    def run(docs: DataFrame, *more, **options) -> DataFrame:
        names, taken = docs.columns, {c.lower() for c in docs.columns} | set(PLACE)
        safe = []
        for c in names:
            new = c
            while c.lower() in PLACE and new.lower() in taken:
                new += "_"
            taken.add(new.lower())
            safe.append(new)
        return drop(docs, *more, **options) if safe == names else drop(docs.toDF(*safe), *more, **options).toDF(*names)

    return run


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with its file and row number as ``__file`` and ``__row``.

    Anything but a scan with filters and projections is written to the shared folder
    first, since only a scan's rows have a number of their own.
    """
    nodes = set(re.findall(r"^[ :+-]*'?(\w+)", docs._jdf.queryExecution().analyzed().toString(), re.M))
    if nodes <= {"Project", "Filter", "Relation"}:
        with contextlib.suppress(AnalysisException):
            return docs.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    return located(stage(docs, "located"))


class StreamDedup:
    """Duplicate groups over everything ingested so far.  ``root``: a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str | None = None, digest=sha256):
        self.spark, self.root, self.digest = spark, root or scratch(spark, "dedup"), digest

    def _digests(self, docs: DataFrame) -> DataFrame:
        return docs.select(
            self.digest(normalise(F.col("text"))).alias("digest"),
            F.coalesce(F.char_length("text"), F.lit(0)).alias("n_points"),
            (-F.col("doc_id").cast("decimal(20,0)")).alias("neg_id"), F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("__file").alias("file"), F.col("__row").alias("row"))

    def ingest(self, docs: DataFrame) -> None:
        """Feed located documents through the stream; returns when all of them are in the state."""
        self._digests(docs).write.mode("append").parquet(f"{self.root}/in")
        before = {k: self.spark.conf.get(k, None) for k in STATE_CONF}
        for k, v in STATE_CONF.items():
            self.spark.conf.set(k, v)
        try:
            query = (
                self.spark.readStream.schema(DIGESTS).parquet(f"{self.root}/in")
                .groupBy("digest")
                .agg(F.count("*").alias("group_size"),
                     F.max(F.struct("n_points", "neg_id", (-F.xxhash64("file").cast("decimal(20,0)")).alias("tie"),
                                    (-F.col("row")).alias("neg_row"), "file", "row", "doc_id")).alias("keep"))
                .writeStream.outputMode("update").option("checkpointLocation", f"{self.root}/state")
                .foreachBatch(self._publish)
                .trigger(availableNow=True).start()
            )
            query.awaitTermination()
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def _publish(self, batch: DataFrame, batch_id: int) -> None:
        """The state rows that the batch changed; a batch that is run again writes the same folder again."""
        batch.write.mode("overwrite").parquet(f"{self.root}/changed/batch={batch_id}")

    def groups(self) -> DataFrame:
        """digest, group_size, keep (struct with doc_id, file, row): the newest state of every digest."""
        changed = self.spark.read.parquet(f"{self.root}/changed")
        if changed.agg(F.max("batch")).first()[0] in (0, None):
            return changed.drop("batch")
        return changed.groupBy("digest").agg(F.max_by(F.struct("group_size", "keep"), "batch").alias("s")).select("digest", "s.*")


def _kept_row() -> Column:
    return (F.col("__file") == F.col("keep.file")) & (F.col("__row") == F.col("keep.row"))


def _false_hits(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests under which the bytes of some member differ from those at the kept locator."""
    hits = stage(rows.join(groups.where("group_size > 1"), "digest").select(
        "digest", normalise(F.col("text")).alias("norm"), _kept_row().alias("kept")), "dedup-hits")
    kept = hits.where("kept").select("digest", F.col("norm").alias("kept_norm"))
    return stage(hits.where("not kept").join(kept, "digest").where("norm <> kept_norm").select("digest").distinct(), "dedup-false")


def dedup_groups(docs: DataFrame, digest=sha256) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, place and digest of located documents, digest -> group_size and keep), checked on full bytes."""
    docs = docs.select("doc_id", "text", "__file", "__row")
    stream = StreamDedup(docs.sparkSession, digest=digest)
    stream.ingest(docs)
    rows = docs.withColumn("digest", digest(normalise(F.col("text"))))
    groups = stream.groups()
    false = _false_hits(rows, groups)
    if not false.isEmpty():  # different texts under one digest: the whole text is the key for these
        rows = rows.join(false.withColumn("clash", F.lit(True)), "digest", "left").withColumn(
            "digest", F.when(F.col("clash"), F.concat(F.lit("text:"), normalise(F.col("text")))).otherwise(F.col("digest")))
        again = StreamDedup(docs.sparkSession, digest=lambda norm: F.concat(F.lit("text:"), norm))
        again.ingest(rows.where("clash"))
        groups = groups.join(false, "digest", "left_anti").unionByName(again.groups())
        rows = rows.drop("clash")
    return rows, groups


def exact_groups(docs: DataFrame, digest=sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, groups = dedup_groups(located(docs.select("doc_id", "text")), digest)
    sha = F.col("digest") if digest is sha256 else sha256(normalise(F.col("text")))
    narrow = rows.select("doc_id", "digest", "__file", "__row", sha.alias("text_sha256"))
    return narrow.join(groups, "digest").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
        _kept_row().alias("kept"), "text_sha256")


@keeping_names
def drop_exact_duplicates(docs: DataFrame, digest=sha256) -> DataFrame:
    """The documents that stay, with their own columns."""
    docs, columns = located(docs), docs.columns
    _, groups = dedup_groups(docs, digest)
    kept = groups.select(F.col("keep.file").alias("__file"), F.col("keep.row").alias("__row"))
    return docs.join(kept, ["__file", "__row"], "left_semi").select(*(F.col(f"`{c}`") for c in columns))
