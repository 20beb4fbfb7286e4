"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlint.session import configure, ensure_checkpoint_dir
from ledgerlint.sources.tables import read_table

#: The white space that separates words, as a Java and RE2 character class.
SPACE = r"[\x20\x09-\x0D]"


#: Rows of an Arrow batch, where the session leaves Spark's default of 10,000: whole texts are long rows.
BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def settle(spark: SparkSession) -> SparkSession:
    """The library's session defaults, and small Arrow batches, where the session doesn't set them."""
    configure(spark)
    if spark.conf.get(BATCH[0], "10000") == "10000":
        spark.conf.set(*BATCH)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    settle(spark)
    return read_table(spark, sf_dir, "documents")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that ``spark.checkpoint.dir`` names (shared on a cluster).

    All paths of an application are in one folder of its name, to delete when it has ended.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs the running tasks only, and every
    later reader scans the table instead of computing ``df`` again.
    """
    path = scratch(settle(df.sparkSession), name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of ``text`` (``[^\\x20\\x09-\\x0D]+``), unchanged; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def once(df: DataFrame, *keep: str, **made: Column) -> DataFrame:
    """Columns that are computed once a row: a generator of one row, which the optimizer doesn't merge with later steps."""
    return df.select(*keep, F.inline(F.array(F.struct(*(c.alias(n) for n, c in made.items())))))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, wherever the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


#: Elements of a block of ``running``.
BLOCK = 64


def add(a: Column, b: Column) -> Column:
    return a + b


def larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def running(numbers: Column, combine=add) -> Column:
    """For each element of an array of ints, the sum (0 at first; or another ``combine`` from 0 on) of those before it.

    By blocks, since a growing array would be copied for every element: sums of blocks, then sums inside each.
    """
    zero = F.lit(0)

    def before_blocks(n: Column) -> Column:
        sums = F.transform(F.sequence(zero, F.floor(F.size(n) / BLOCK).cast("int")),
                           lambda b: F.aggregate(F.slice(n, b * BLOCK + 1, F.lit(BLOCK)), zero, combine))
        return F.aggregate(sums, F.array(zero), lambda out, x: F.concat(out, F.array(combine(F.element_at(out, -1), x))))

    return let(numbers, lambda n: let(before_blocks(n), lambda before: F.transform(
        n, lambda _, i: F.aggregate(F.slice(n, i - i % BLOCK + 1, i % BLOCK), F.get(before, F.floor(i / BLOCK).cast("int")), combine))))
