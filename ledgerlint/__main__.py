"""Command line: run a rule into the result table, or a missing-file run into the status table.

Tables are parquet paths given as ``--table <logical name>=<path>``.

    python -m ledgerlint rule --id 1091 --table vw_fact_sellout=... --table vw_dim_point_of_sales=... \\
        --results <path> [--run-ts 2024-05-01T06:00:00] [--param-date 2024-05-01]

    python -m ledgerlint template --template attribute --id DQ_X --on vw_dim_product --column brand_name \\
        --condition "source_column IS NULL" --table vw_fact_sellout=... --table vw_dim_product=... \\
        --table vw_dim_point_of_sales=... --results <path>
    python -m ledgerlint template --template stock --id DQ_Y --column PRODUCT.brand_code --year 2024 \\
        --table stock_in_trade=... --table dim_product_reference=... --results <path>

    python -m ledgerlint missing-files --preset SP --as-of 2024-05-01 --status <root> \\
        --table vw_fact_sellout=... --table vw_dim_datasource=... --table vw_dim_point_of_sales=... \\
        --table vw_dim_calendar=... --table oms_store_start_dates=... --table fact_ecomm_sku_traffic_sellout=... \\
        [--table fact_ecomm_amz=... --table vw_dim_product=... --table dim_group_signature=...] [--floor-year 2021]

``missing-files --out <path>`` writes the bare result rows instead of upserting them (``--status``).
The session comes from ``SparkSession.builder.getOrCreate()`` (so a cluster's
settings apply); only unset library defaults are filled in.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from ledgerlint.plans import catalog
from ledgerlint.plans import missing_files as mf
from ledgerlint.session import configure, ensure_checkpoint_dir
from ledgerlint.sources.sinks import StatusTable, append_results

# logical names of the missing-file inputs
MF_TABLES = {
    "fact": "vw_fact_sellout",
    "datasource": "vw_dim_datasource",
    "pos": "vw_dim_point_of_sales",
    "calendar": "vw_dim_calendar",
    "store_start": "oms_store_start_dates",
    "sku_traffic": "fact_ecomm_sku_traffic_sellout",
    "amz": "fact_ecomm_amz",
    "product": "vw_dim_product",
    "signature": "dim_group_signature",
}


def _tables(spark: SparkSession, pairs: list[str]) -> dict:
    out = {}
    for p in pairs:
        name, _, path = p.partition("=")
        if not path:
            raise SystemExit(f"--table expects name=path, got {p!r}")
        out[name] = spark.read.parquet(path)
    return out


def run_rule(spark: SparkSession, args) -> dict:
    tables = _tables(spark, args.table)
    ts = dt.datetime.fromisoformat(args.run_ts) if args.run_ts else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    res = catalog.run_rule(spark, args.id, tables, ts, args.param_date)
    append_results(res, args.results)
    return {"rule": args.id, "results": args.results, "run_timestamp": ts.isoformat()}


def run_template(spark: SparkSession, args) -> dict:
    spec = catalog.RuleSpec(args.template, args.id, args.column, args.on, args.condition, year=args.year,
                            **({"value": args.value} if args.value else {}))
    ts = dt.datetime.fromisoformat(args.run_ts) if args.run_ts else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    append_results(catalog.run_spec(spark, spec, _tables(spark, args.table), ts, args.param_date), args.results)
    return {"rule": args.id, "template": args.template, "results": args.results, "run_timestamp": ts.isoformat()}


def run_missing_files(spark: SparkSession, args) -> dict:
    tables = _tables(spark, args.table)
    cfg = (mf.SP if args.preset.upper() == "SP" else mf.MFS).with_floor(args.floor_year)
    inp = mf.MissingFileInputs(**{field: tables.get(name) for field, name in MF_TABLES.items()})
    as_of = dt.date.fromisoformat(args.as_of)
    steps = mf.missing_files(inp, as_of, cfg)
    ts = dt.datetime.fromisoformat(args.run_ts) if args.run_ts else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = {"preset": cfg.name, "as_of": as_of.isoformat()}
    if args.out:
        steps.result.write.mode("errorifexists").parquet(args.out)
        out["out"] = args.out
    if args.status:
        out |= {"status": args.status, "version": StatusTable(spark, args.status).upsert(steps.result, ts)}
    steps.close()
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="ledgerlint")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("rule")
    r.add_argument("--id", required=True, choices=sorted(catalog.RULES))
    r.add_argument("--table", action="append", default=[])
    r.add_argument("--results", required=True)
    r.add_argument("--run-ts")
    r.add_argument("--param-date")
    t = sub.add_parser("template")
    t.add_argument("--template", required=True, choices=catalog.TEMPLATES)
    t.add_argument("--id", required=True)
    t.add_argument("--column", required=True)
    t.add_argument("--on", help="source table of an attribute rule")
    t.add_argument("--condition")
    t.add_argument("--value")
    t.add_argument("--year", type=int)
    t.add_argument("--table", action="append", default=[])
    t.add_argument("--results", required=True)
    t.add_argument("--run-ts")
    t.add_argument("--param-date")
    m = sub.add_parser("missing-files")
    m.add_argument("--preset", default="SP", choices=["SP", "MFS", "sp", "mfs"])
    m.add_argument("--as-of", required=True)
    m.add_argument("--floor-year", type=int, default=2021)
    m.add_argument("--status")
    m.add_argument("--out")
    m.add_argument("--table", action="append", default=[])
    m.add_argument("--run-ts")
    args = ap.parse_args(argv)
    if args.cmd == "missing-files" and not (args.status or args.out):
        ap.error("missing-files needs --status, --out or both")
    spark = spark or SparkSession.builder.appName("ledgerlint").getOrCreate()
    configure(spark)
    ensure_checkpoint_dir(spark)
    out = {"rule": run_rule, "template": run_template, "missing-files": run_missing_files}[args.cmd](spark, args)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
