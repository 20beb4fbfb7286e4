"""Command line and the rule catalogue, on fixture tables written as parquet."""

import os
import tempfile

import pytest

from ledgerlint.__main__ import main
from ledgerlint.plans import catalog
from ledgerlint.sources.sinks import StatusTable
from ledgerlint.sources.fixtures import FixtureSet, dim_pos


def _write(df, root, name):
    path = os.path.join(root, name)
    df.write.parquet(path)
    return path


def test_catalogue_covers_the_eight_concrete_rules():
    assert sorted(catalog.RULES) == ["1032", "1083", "1084", "1091", "1238", "1239", "1240", "1241"]


def test_cli_rule_and_missing_files(spark, sf_small):
    f = FixtureSet.of(spark, sf_small)
    root = tempfile.mkdtemp(prefix="ledgerlint-cli-", dir="/tmp")
    fact = _write(f.fact_nonzero(), root, "fact")
    pos = _write(dim_pos(f.pos()), root, "pos")
    results = os.path.join(root, "results")
    out = main(["rule", "--id", "1091", "--table", f"vw_fact_sellout={fact}",
                "--table", f"vw_dim_point_of_sales={pos}", "--results", results,
                "--run-ts", "2024-01-01T00:00:00", "--param-date", "2024-01-01"], spark=spark)
    assert out["rule"] == "1091" and spark.read.parquet(results).count() > 0

    tables = {"vw_fact_sellout": fact, "vw_dim_point_of_sales": pos,
              "vw_dim_datasource": _write(f.datasource(), root, "ds"),
              "vw_dim_calendar": _write(f.calendar(), root, "cal"),
              "oms_store_start_dates": _write(f.store_start(), root, "ss"),
              "fact_ecomm_sku_traffic_sellout": _write(f.sku_traffic(), root, "sku"),
              "fact_ecomm_amz": _write(f.amz(), root, "amz"),
              "vw_dim_product": _write(f.product_sap(), root, "prod"),
              "dim_group_signature": _write(f.signature(), root, "sig")}
    args = ["missing-files", "--preset", "SP", "--floor-year", "2000", "--status", os.path.join(root, "status")]
    for k, v in tables.items():
        args += ["--table", f"{k}={v}"]
    first = main(args + ["--as-of", "2001-06-15", "--run-ts", "2001-06-15T06:00:00"], spark=spark)
    second = main(args + ["--as-of", "2001-08-15", "--run-ts", "2001-08-15T06:00:00"], spark=spark)
    assert (first["version"], second["version"]) == (1, 2)
    status = StatusTable(spark, os.path.join(root, "status")).read(2)
    assert status.count() > 0
    assert {r[0] for r in status.select("last_invoked_timestamp").distinct().collect()} == {
        __import__("datetime").datetime(2001, 8, 15, 6, 0)}
    bare = [a if a != "SP" else "MFS" for a in args]
    i = bare.index("--status")
    out = main(bare[:i] + bare[i + 2:] + ["--as-of", "2001-08-15", "--out", os.path.join(root, "mfs")], spark=spark)
    assert "version" not in out and spark.read.parquet(out["out"]).count() > 0


def test_cli_templates(spark, sf_small):
    f = FixtureSet.of(spark, sf_small)
    root = tempfile.mkdtemp(prefix="ledgerlint-cli-", dir="/tmp")
    tables = []
    for name, df in {"vw_fact_sellout": f.fact_sellout(), "vw_dim_point_of_sales": dim_pos(f.pos()), "vw_dim_product": f.product(),
                     "stock_in_trade": f.stock(), "dim_product_reference": f.ref_product()}.items():
        tables += ["--table", f"{name}={_write(df, root, name)}"]
    results = os.path.join(root, "results")
    for extra in (["--template", "attribute", "--id", "A", "--on", "vw_dim_product", "--column", "brand_name", "--condition", "source_column IS NULL"],
                  ["--template", "stock", "--id", "B", "--column", "PRODUCT.axis_code", "--year", "2000"],
                  ["--template", "reference-key", "--id", "C", "--column", "PRODUCT.product_code"],
                  ["--template", "dimension-key", "--id", "D", "--column", "product_code"]):
        main(["template", *extra, "--results", results, "--run-ts", "2024-01-01T00:00:00", *tables], spark=spark)
    assert {r.dq_id for r in spark.read.parquet(results).select("dq_id").distinct().collect()} == {"A", "B", "C", "D"}


def test_rule_specs_are_checked_against_the_catalogue():
    for bad in (("nothing", "X", "product_code"), ("stock", "X", "PRODUCT.nope"), ("stock", "X", "PRODUCT.brand_code"),
                ("attribute", "X", "brand_name", "vw_dim_product")):
        with pytest.raises(ValueError):
            catalog.RuleSpec(*bad)


def test_every_catalogued_rule_runs_by_id(spark, sf_small):
    import datetime as dt

    from ledgerlint.plans import registry as reg

    f = FixtureSet.of(spark, sf_small)
    tables = {reg.FACT_SELLOUT: f.fact_sellout(), reg.FACT_SELLTHROUGH: f.fact_sellthrough(),
              reg.DIM_PRODUCT: f.product(), reg.DIM_POS: dim_pos(f.pos()), reg.DIM_DATASOURCE: f.datasource(),
              reg.DIM_DISTRIBUTOR: f.distributor()}
    schemas = set()
    for dq_id in catalog.RULES:
        res = catalog.run_rule(spark, dq_id, tables, dt.datetime(2024, 1, 1), "2024-01-01")
        rows = res.collect()
        assert rows and all(r["dq_id"] == dq_id for r in rows)
        assert all(r["invalid_rows"] <= r["total_rows"] for r in rows)
        schemas.add(res.schema.simpleString())
    assert len(schemas) == 1
