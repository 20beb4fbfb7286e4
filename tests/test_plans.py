"""Plan guards on the registered rule and pipeline queries."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = sorted(n for n in entry.queries() if n.startswith(("dq_", "mf_")))


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_product_and_no_broadcast_of_an_aggregate(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name.startswith("dq_"):
        # the one loop join left asks whether the result is empty: its broadcast side is one row
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "BroadcastNestedLoopJoin" in line:
                assert "LeftAnti" in line
                below = "\n".join(lines[i: i + 12])
                assert re.search(r"BroadcastExchange[^\n]*\n[^\n]*(Project|GlobalLimit|CollectLimit|LocalLimit)", below), below
                assert "Limit 1" in below


def test_the_aggregate_runs_once(spark):
    df = entry.queries()["dq_uniq_1032"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall("FileScan parquet", plan)) == 3  # the fact, the product and the POS dimension


def test_the_fact_is_aggregated_before_a_large_dimension_is_joined(spark):
    from ledgerlint.plans import rules as R
    from ledgerlint.plans.dq_queries import RunParams
    from ledgerlint.sources.fixtures import FixtureSet, dim_pos

    f = FixtureSet.of(spark, SF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = R.product_uniqueness_sellout(spark, RunParams("X", "2024-01-01 00:00:00"), f.fact_sellout(), f.product(), dim_pos(f.pos()))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line]
    assert joins and any("Aggregate" in line for line in plan.splitlines()[joins[0]: joins[0] + 3])


def _optimized(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _joined(lines: list[str], kind: str) -> list[tuple[str, str]]:
    """The first operators (projections and filters left out) below each side of the joins of a kind."""
    out = []
    for i, line in enumerate(lines):
        if f"Join {kind}" not in line:
            continue
        depth = len(line) - len(line.lstrip(" :+-"))
        sides = [j for j in range(i + 1, len(lines)) if len(lines[j]) - len(lines[j].lstrip(" :+-")) == depth + 3]
        first = []
        for j in sides[:2]:
            while re.search(r"[:+\- ](Project|Filter|SubqueryAlias)\b", lines[j]):
                j += 1
            first.append(lines[j].lstrip(" :+-").split()[0])
        out.append(tuple(first))
    return out


@pytest.mark.parametrize("name", ["dq_attr_fact", "dq_attr_dim", "dq_attr_pos", "dq_uniq_generic_pos", "dq_uniq_generic_product",
                                  "dq_attr_catalogue"])
def test_attribute_and_dimension_rules_aggregate_before_the_hierarchy_join(spark, no_broadcast, name):
    lines = _optimized(entry.queries()[name](spark, SF))
    joins = _joined(lines, "LeftOuter")
    assert joins and all(left in ("Aggregate", "Join") for left, _ in joins), joins
    assert joins[0][0] == "Aggregate"
    inner = _joined(lines, "Inner")
    assert all("Aggregate" in pair for pair in inner), inner


@pytest.mark.parametrize("name", ["dq_ref_stock", "dq_ref_key_product", "dq_ref_stock_catalogue"])
def test_reference_rules_aggregate_before_the_reference_join(spark, no_broadcast, name):
    joins = _joined(_optimized(entry.queries()[name](spark, SF)), "LeftOuter")
    assert joins and all(left == "Aggregate" for left, _ in joins), joins


def test_a_condition_on_the_hierarchy_joins_it_first(spark):
    joins = _joined(_optimized(entry.queries()["dq_attr_hierarchy"](spark, SF)), "LeftOuter")
    assert joins[0][0] == "Join"


@pytest.mark.parametrize("name, measure, others", [("dq_attr_catalogue", "consolidated_sales_eur", 3), ("dq_ref_stock_catalogue", "FACT_VALUE", 4)])
def test_a_catalogue_scans_its_fact_once(spark, name, measure, others):
    df = entry.queries()[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert sum(measure in s for s in scans) == 1, scans
    # each dimension once, and the POS dimension again for the hierarchy
    assert len(scans) == 1 + others


@pytest.mark.parametrize("name", ["mf_missing_daily", "mf_missing_weekly", "mf_missing_monthly", "mf_missing_unified", "mf_final_sp",
                                  "mf_final_mfs", "mf_before_start"])
def test_missing_files_gather_no_lists_and_loop_over_no_ranges(spark, name):
    plan = "\n".join(_optimized(entry.queries()[name](spark, SF)))
    assert "collect_list" not in plan and "collect_set" not in plan
    assert "NestedLoop" not in entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_calendar_joins_have_no_hint():
    import inspect

    from ledgerlint.operators import calendar

    assert "broadcast" not in inspect.getsource(calendar)


def test_marketplace_lookups_see_distinct_codes(spark, no_broadcast):
    lines = _optimized(entry.queries()["mf_zero_amz"](spark, SF))
    joins = _joined(lines, "LeftOuter")
    assert len(joins) == 3 and joins[-1][0] == "Aggregate", joins


def test_rows_without_an_ean_are_spread(spark, sf_small):
    """A third of the rows have no EAN: they join by part numbers, not by one NULL key."""
    from pyspark.sql import functions as F

    from ledgerlint.functions.normalize import join_ean_mapping, normalize_ean
    from ledgerlint.sources.fixtures import FixtureSet

    f = FixtureSet.of(spark, sf_small)
    amz = f.amz()
    keys = re.findall(r"_ean#\d+", "\n".join(_optimized(join_ean_mapping(amz, f.ean_mapping()))))
    assert keys
    blank = amz.where(normalize_ean("ean_code").isNull())
    parts = blank.select(F.pmod(F.xxhash64(*amz.columns), F.lit(1024)).alias("p")).groupBy("p").count()
    assert blank.count() > amz.count() / 4 and parts.agg(F.max("count")).first()[0] < blank.count() / 50


def test_rows_with_a_null_unique_id_are_spread(spark, no_broadcast):
    """NULL ids are one group, which may not be one task's."""
    from pyspark.sql import functions as F

    from ledgerlint.operators.keycount import fact_key_count, window_key_count

    ids = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.col("id") % 50).otherwise(F.col("id") + 1000)
    fact = spark.range(3000).select(ids.cast("string").alias("k"), (F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    out = fact_key_count(fact, "k", ["g"], ["v"])
    keys = [line for line in _optimized(out) if "Join LeftOuter" in line]
    assert len(keys) == 1 and "_part" in keys[0], keys
    expected = window_key_count(fact, "k").groupBy("cnt", "g").agg(F.count(F.lit(1)).alias("_rows"), F.sum("v").alias("v"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, expected.collect()))


def test_the_attribute_catalogue_keeps_one_sum_a_store_and_key(spark):
    """The fact's own attributes are flags in the key of the large aggregate, not sums in it."""
    lines = _optimized(entry.queries()["dq_attr_catalogue"](spark, SF))
    large = next(line for line in lines if "Aggregate" in line and "AS _rows#" in line)
    outputs = large.split("], [", 1)[1]
    assert outputs.count("sum(") + outputs.count("count(") <= 2, large


@pytest.mark.parametrize("name", ["dq_ref_stock", "dq_ref_stock_rate", "dq_ref_stock_nulls", "dq_empty_cross", "dq_ref_stock_catalogue"])
def test_only_the_years_stock_rows_are_joined(spark, no_broadcast, monkeypatch, name):
    """The year meets the lines before they are joined to stores and parts, and no fact of all years is written."""
    from ledgerlint.plans import dq_queries
    from ledgerlint.sources.fixtures import FixtureSet

    staged = []

    def unwritten(*_):
        raise AssertionError("the sell-out fact is not needed whole")

    monkeypatch.setattr(FixtureSet, "fact_sellout", unwritten)
    monkeypatch.setattr(FixtureSet, "_sets", {})
    if name == "dq_ref_stock_catalogue":
        stage = dq_queries.stage
        monkeypatch.setattr(dq_queries, "stage", lambda df, name: staged.append(df) or stage(df, name))
    df = entry.queries()[name](spark, SF)
    lines = _optimized(staged[0] if staged else df)
    scan = next(i for i, line in enumerate(lines) if "l_shipdate" in line and "Relation" in line)
    year = 2100 if name == "dq_empty_cross" else 2000
    assert "Filter" in lines[scan - 1] and f"{year}-01-01" in lines[scan - 1] and f"{year + 1}-01-01" in lines[scan - 1], lines[scan - 1]


def test_distinct_deliveries_are_not_shuffled_again_once_they_are_wide(spark, no_broadcast):
    """M1 is made distinct before POS is joined, and not again after it."""
    lines = _optimized(entry.queries()["mf_deliveries_nulls"](spark, SF))
    top = next(i for i, line in enumerate(lines) if "Join Inner" in line)
    assert not any("Aggregate" in line for line in lines[:top]), lines[:top]
    assert _joined(lines, "Inner")[0] == ("Aggregate", "Aggregate"), lines


def test_deliveries_of_repeated_dimension_rows_are_distinct(spark):
    """Repeated stores and sources, two sources of one frequency (in another case for MFS), a store without attributes."""
    import datetime as dt
    from types import SimpleNamespace

    from ledgerlint.plans import missing_files as mf

    fact = spark.createDataFrame(
        [("AU", "A", "P", s, dt.date(2022, 1, 3), src) for s in ("s1", "s2", None) for src in ("d1", "d2", "d3", None) for _ in (1, 2)],
        "market_code string, division_code string, source_project string, point_of_sale_code string, sellout_date date, data_source string")
    ds = spark.createDataFrame([("d1", "Daily"), ("d1", "Daily"), ("d2", "DAILY"), ("d3", "Daily"), ("d1", "Weekly"), (None, "Daily")],
                               "data_source_code string, data_source_frequency string")
    pos = spark.createDataFrame([("s1", "c", "x", None), ("s1", "c", "x", None), ("s1", "c2", "x", "y"), ("s2", None, None, None), (None, "c", "x", "y")],
                                "point_of_sale_code string, client_name string, channel_level1 string, channel_level2 string")
    inp = SimpleNamespace(fact=fact, datasource=ds, pos=pos)
    for cfg, frequencies in ((mf.SP, ["DAILY", "Daily", "Weekly"]), (mf.MFS, ["DAILY", "WEEKLY"])):
        got = sorted(map(str, (tuple(r)[3:] for r in mf.deliveries(inp, cfg, dt.date(2022, 3, 1)).collect())))
        day = dt.date(2022, 1, 3)
        want = sorted(str((s, day, *a, f)) for s, a in (("s1", ("c", "x", None)), ("s1", ("c2", "x", "y")), ("s2", (None, None, None))) for f in frequencies)
        assert got == want, cfg.name
