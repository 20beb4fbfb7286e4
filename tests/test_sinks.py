"""Result append (S9) and the timestamp view."""

import datetime as dt
import os
import tempfile

from ledgerlint.plans import dq_queries
from ledgerlint.plans import rules as R
from ledgerlint.sources.fixtures import FixtureSet, dim_pos
from ledgerlint.sources.sinks import append_results, timestamp_view


def test_append_results_accumulates_runs(spark, sf_small):
    f = FixtureSet.of(spark, sf_small)
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlint-results-", dir="/tmp"), "dq_run_result")
    for ts in (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)):
        res = R.fact_uniqueness_sellout(spark, dq_queries.RunParams("DQ1091", ts, "2024-01-01"), f.fact_sellout(),
                                        dim_pos(f.pos()))
        append_results(res, path)
    back = spark.read.parquet(path)
    assert back.columns == ["dq_id", "run_timestamp", "attribute_arr", "dq_score", "invalid_rows", "total_rows",
                            "invalid_value", "total_value", "param_date"]
    per_run = {r["run_timestamp"]: r["n"] for r in back.groupBy("run_timestamp").count().withColumnRenamed("count", "n")
               .collect()}
    assert len(per_run) == 2 and len(set(per_run.values())) == 1


def test_timestamp_view(spark):
    df = timestamp_view(spark, "missing")
    assert df.columns == ["dt"]
    row = spark.sql("SELECT dt FROM missing").first()
    assert isinstance(row["dt"], dt.datetime)


def test_every_rule_returns_the_same_result_schema(spark, sf_small):
    from ledgerlint.plans import registry as reg

    f = FixtureSet.of(spark, sf_small)
    p = dq_queries.RunParams("X", dt.datetime(2024, 1, 1), "2024-01-01")
    tables = {reg.FACT_SELLOUT: f.fact_sellout(), reg.DIM_PRODUCT: f.product(), reg.DIM_POS: dim_pos(f.pos()),
              reg.DIM_DATASOURCE: f.datasource()}
    results = [
        R.fact_uniqueness_sellout(spark, p, f.fact_sellout(), dim_pos(f.pos())),
        R.product_uniqueness_sellout(spark, p, f.fact_sellout(), f.product(), dim_pos(f.pos())),
        R.reference_integrity_stock(spark, p, f.stock(), f.ref_brand(), "PRODUCT.brand_code", 2000,
                                    reference_column="brand_code"),
        R.reference_integrity_key(spark, p, tables, "PRODUCT.product_code"),
        R.dimension_key_uniqueness(spark, p, tables, "product_code"),
        R.attribute_condition(spark, p, tables, reg.FACT_SELLOUT, "market_code", "source_column = 'XX'"),
    ]
    schemas = {r.schema.simpleString() for r in results}
    assert len(schemas) == 1, schemas


def test_a_recorded_run_replaces_its_own_rows_only(spark):
    from ledgerlint.sources.sinks import read_results, record_run

    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlint-results-", dir="/tmp"), "runs")
    schema = ("dq_id string, run_timestamp timestamp, attribute_arr array<struct<key:string,value:string>>, dq_score decimal(38,9), "
              "invalid_rows bigint, total_rows bigint, invalid_value decimal(38,9), total_value decimal(38,9), param_date string")

    def run(dq_id, day, *rows):
        return spark.createDataFrame([(dq_id, dt.datetime(2024, 1, day), None, None, n, 9, None, None, None) for n in rows], schema)

    def found():
        return sorted((r["dq_id"], r["run_timestamp"].day, r["invalid_rows"]) for r in read_results(spark, path).collect())

    record_run(run("1091", 1, 1, 2), path)
    record_run(run("1091", 2, 3), path)
    record_run(run("007", 1, 4), path)
    record_run(run("1091", 1, 1, 2), path)
    assert found() == [("007", 1, 4), ("1091", 1, 1), ("1091", 1, 2), ("1091", 2, 3)]
    record_run(run("1091", 1, 5), path)  # a corrected run
    assert found() == [("007", 1, 4), ("1091", 1, 5), ("1091", 2, 3)]
    assert read_results(spark, path).schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
