"""Registered DQ-rule queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query runs a rule on the fixtures of ``sources.fixtures`` and returns the
result flattened to scalar columns (see ``operators.measure.flatten_result``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlint.operators.measure import flatten_result
from ledgerlint.params import RunParams
from ledgerlint.plans import registry as reg
from ledgerlint.plans import rules as R
from ledgerlint.sources.fixtures import FixtureSet, dim_pos
from ledgerlint.sources.sinks import append_results, read_results, record_run, stage, stage_path

RUN_TS = dt.datetime(2001, 8, 31, 6, 0, 0)
PARAM_DATE = "2001-08-31"
STOCK_YEAR = 2000

Query = Callable[[SparkSession, str], DataFrame]


def _p(dq_id: str) -> RunParams:
    return RunParams(dq_id, RUN_TS, PARAM_DATE)


def _fx(spark: SparkSession, d: str) -> FixtureSet:
    return FixtureSet.of(spark, d)


def _pos(f: FixtureSet, dup: bool = False) -> DataFrame:
    return dim_pos(f.pos_dup() if dup else f.pos())


def _tables(spark: SparkSession, d: str, pos_dup: bool = False, ds_dup: bool = False) -> dict[str, DataFrame]:
    f = _fx(spark, d)
    return {
        reg.FACT_SELLOUT: f.fact_sellout(),
        reg.DIM_PRODUCT: f.product(),
        reg.DIM_POS: _pos(f, pos_dup),
        reg.DIM_DATASOURCE: f.datasource(duplicate_ds1=ds_dup),
    }


def q_uniq_1032(spark, d):
    r = R.product_uniqueness_sellout(spark, _p("DQ1032"), _fx(spark, d).fact_sellout(), _fx(spark, d).product(),
                                     _pos(_fx(spark, d)))
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_1083(spark, d):
    r = R.pos_uniqueness_sellout(spark, _p("DQ1083"), _fx(spark, d).fact_sellout(), _pos(_fx(spark, d), dup=True))
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_1084(spark, d):
    r = R.datasource_uniqueness_sellout(spark, _p("DQ1084"), _fx(spark, d).fact_sellout(),
                                        _fx(spark, d).datasource(duplicate_ds1=True), _pos(_fx(spark, d)))
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_1091(spark, d):
    r = R.fact_uniqueness_sellout(spark, _p("DQ1091"), _fx(spark, d).fact_sellout(), _pos(_fx(spark, d)))
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_1091_hot_key(spark, d):
    """R8 on a fact where a third of all rows share one ``unique_id``."""
    r = R.fact_uniqueness_sellout(spark, _p("DQ1091"), _fx(spark, d).fact_hot_key(), _pos(_fx(spark, d)))
    return flatten_result(r, R.SELLOUT_KEYS)


def q_empty_left(spark, d):
    """R8 for a period without deliveries: one row with NULL metrics."""
    fact = _fx(spark, d).fact_sellout().filter(F.col("sellout_date") >= F.lit("2101-01-01").cast("date"))
    r = R.fact_uniqueness_sellout(spark, _p("DQ1091"), fact, _pos(_fx(spark, d)))
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_1238(spark, d):
    r = R.distributor_uniqueness_sellthrough(spark, _p("DQ1238"), _fx(spark, d).fact_sellthrough(),
                                             _fx(spark, d).distributor(duplicate=True))
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_1239(spark, d):
    r = R.fact_uniqueness_sellthrough(spark, _p("DQ1239"), _fx(spark, d).fact_sellthrough(), _fx(spark, d).distributor())
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_1240(spark, d):
    r = R.product_uniqueness_sellthrough(spark, _p("DQ1240"), _fx(spark, d).fact_sellthrough(),
                                         _fx(spark, d).product(), _fx(spark, d).distributor())
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_1241(spark, d):
    r = R.datasource_uniqueness_sellthrough(spark, _p("DQ1241"), _fx(spark, d).fact_sellthrough(),
                                            _fx(spark, d).datasource(duplicate_ds1=True), _fx(spark, d).distributor())
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_generic_product(spark, d):
    r = R.dimension_key_uniqueness(spark, _p("DQ_UNQ_PRODUCT"), _tables(spark, d), "product_code", "cnt > 1")
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_generic_pos(spark, d):
    r = R.dimension_key_uniqueness(spark, _p("DQ_UNQ_POS"), _tables(spark, d, pos_dup=True), "point_of_sale_code",
                                   F.col("cnt") > 1)
    return flatten_result(r, R.SELLOUT_KEYS)


def q_attr_fact(spark, d):
    r = R.attribute_condition(spark, _p("DQ_ATTR_MARKET"), _tables(spark, d), reg.FACT_SELLOUT, "market_code",
                              "source_column = 'XX'")
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_generic_datasource(spark, d):
    """R4 on the data-source key: the fact's ``data_source`` against the dimension's ``data_source_code``."""
    r = R.dimension_key_uniqueness(spark, _p("DQ_UNQ_DS"), _tables(spark, d, ds_dup=True), "data_source_code")
    return flatten_result(r, R.SELLOUT_KEYS)


def q_attr_pos(spark, d):
    """R1 on a POS attribute: POS joined for the value and again for the hierarchy (duplicates fan out twice)."""
    r = R.attribute_condition(spark, _p("DQ_ATTR_CHANNEL"), _tables(spark, d, pos_dup=True), reg.DIM_POS,
                              "channel_level2", "source_column = 'L0'")
    return flatten_result(r, R.SELLOUT_KEYS)


def q_attr_dim(spark, d):
    r = R.attribute_condition(spark, _p("DQ_ATTR_BRAND"), _tables(spark, d), reg.DIM_PRODUCT, "brand_name",
                              "source_column IS NULL OR source_column IN ('Brand#1', 'Brand#2')")
    return flatten_result(r, R.SELLOUT_KEYS)


def _stock(spark, d, year: int):
    r = R.reference_integrity_stock(spark, _p("DQ_REF_BRAND"), _fx(spark, d).stock(), _fx(spark, d).ref_brand(),
                                    "PRODUCT.brand_code", year, reference_column="brand_code")
    return flatten_result(r, R.STOCK_KEYS)


def q_ref_stock(spark, d):
    return _stock(spark, d, STOCK_YEAR)


def q_empty_cross(spark, d):
    """R2 for a year without stock rows: no result row."""
    return _stock(spark, d, 2100)


def q_ref_stock_rate(spark, d):
    """R2 on a numeric struct value: DOUBLE conversion rates against DECIMAL(38,9) reference rates."""
    r = R.reference_integrity_stock(spark, _p("DQ_REF_RATE"), _fx(spark, d).stock(), _fx(spark, d).ref_rate(),
                                    "CURRENCY.conversion_rate", STOCK_YEAR)
    return flatten_result(r, R.STOCK_KEYS)


def q_ref_key_datasource(spark, d):
    r = R.reference_integrity_key(spark, _p("DQ_REF_DS"), _tables(spark, d), "DATA_SOURCE.data_source_code")
    return flatten_result(r, R.INTEGRITY_KEYS)


def q_ref_key_product(spark, d):
    r = R.reference_integrity_key(spark, _p("DQ_REF_PRODUCT"), _tables(spark, d), "PRODUCT.product_code")
    return flatten_result(r, R.INTEGRITY_KEYS)


def q_ref_stock_catalogue(spark, d):
    """R2 for every path of the catalogue.

    The stock is a join of the lines to the stores and the parts: the year's rows are staged, so that it is made once
    and the catalogue scans one table.
    """
    f = _fx(spark, d)
    stock = stage(R.stock_of_year(f.stock(), STOCK_YEAR), "stock")
    refs = {reg.GENERAL_DATA: f.general_data(), reg.EXCHANGE_RATE: f.ref_rate(), reg.DIM_MARKET: f.ref_market(),
            reg.REF_PRODUCT: f.ref_product()}
    rules = [R.StockRule(_p("DQ_REF_" + path), path) for path in reg.STOCK_REFERENCES]
    return flatten_result(R.stock_reference_catalogue(spark, rules, stock, refs, STOCK_YEAR), R.STOCK_KEYS)


#: The condition of the attribute catalogue query, for every entry.
ATTR_CONDITION = "source_column IS NULL OR source_column = '' OR source_column LIKE '%1%'"


def q_attr_catalogue(spark, d):
    """R1 for every entry of the attribute catalogue."""
    rules = [R.AttributeRule(_p(f"DQ_ATTR_{column}"), table, column, ATTR_CONDITION)
             for table, columns in reg.ATTRIBUTE_SOURCES.items() for column in columns]
    return flatten_result(R.attribute_catalogue(spark, rules, _tables(spark, d)), R.SELLOUT_KEYS)


def q_attr_catalogue_dup(spark, d):
    """C1 with repeated POS and product rows, a condition that holds for NULL, and NULL keys and measures in the fact."""
    tables = _tables(spark, d, pos_dup=True) | {reg.FACT_SELLOUT: _fx(spark, d).fact_nulls()}
    rules = [R.AttributeRule(_p(f"DQ_ATTR_{column}"), table, column, ATTR_CONDITION)
             for table, columns in reg.ATTRIBUTE_SOURCES.items() for column in columns]
    return flatten_result(R.attribute_catalogue(spark, rules, tables, "abs(consolidated_sales_eur)"), R.SELLOUT_KEYS)


def q_attr_hierarchy(spark, d):
    """R1 with a condition that reads the hierarchy and row values: joined at row level."""
    r = R.attribute_condition(spark, _p("DQ_ATTR_CLIENT"), _tables(spark, d, pos_dup=True), reg.DIM_PRODUCT, "brand_name",
                              "channel_level2 = 'L0' AND (source_column IS NULL OR val_column > 1000)")
    return flatten_result(r, R.SELLOUT_KEYS)


def q_ref_key_pos(spark, d):
    """R3 on the point-of-sale key, with NULL keys in the fact."""
    tables = _tables(spark, d) | {reg.FACT_SELLOUT: _fx(spark, d).fact_nulls()}
    r = R.reference_integrity_key(spark, _p("DQ_REF_POS"), tables, "POINT_OF_SALE.point_of_sale_code")
    return flatten_result(r, R.INTEGRITY_KEYS)


def q_uniq_1032_exact(spark, d):
    """R5 on a DECIMAL(38,9) measure that uses all nine decimals, values compared as decimal text."""
    r = R.product_uniqueness_sellout(spark, _p("DQ1032"), _fx(spark, d).fact_exact(), _fx(spark, d).product(),
                                     _pos(_fx(spark, d)))
    return flatten_result(r, R.SELLOUT_KEYS, exact=True)


def q_uniq_1032_nulls(spark, d):
    """R5 with NULL keys, markets, divisions and measures in the fact."""
    r = R.product_uniqueness_sellout(spark, _p("DQ1032"), _fx(spark, d).fact_nulls(), _fx(spark, d).product(),
                                     _pos(_fx(spark, d)))
    return flatten_result(r, R.SELLOUT_KEYS)


def q_uniq_1091_nulls(spark, d):
    """R8 with NULL ``unique_id`` (one group of equal keys), markets, divisions and measures."""
    r = R.fact_uniqueness_sellout(spark, _p("DQ1091"), _fx(spark, d).fact_nulls(), _pos(_fx(spark, d)))
    return flatten_result(r, R.SELLOUT_KEYS)


def _sellthrough_nulls(spark, d, function, dq_id: str, *dims: DataFrame) -> DataFrame:
    return flatten_result(function(spark, _p(dq_id), _fx(spark, d).fact_sellthrough_nulls(), *dims), R.SELLOUT_KEYS)


def q_uniq_1238_nulls(spark, d):
    """R9 with NULL distributors, markets, divisions and measures."""
    return _sellthrough_nulls(spark, d, R.distributor_uniqueness_sellthrough, "DQ1238", _fx(spark, d).distributor(duplicate=True))


def q_uniq_1239_nulls(spark, d):
    """R10 with NULL ``unique_id`` (one group of equal keys)."""
    return _sellthrough_nulls(spark, d, R.fact_uniqueness_sellthrough, "DQ1239", _fx(spark, d).distributor())


def q_uniq_1240_nulls(spark, d):
    """R11 with NULL product codes."""
    f = _fx(spark, d)
    return _sellthrough_nulls(spark, d, R.product_uniqueness_sellthrough, "DQ1240", f.product(), f.distributor())


def q_uniq_1241_nulls(spark, d):
    """R12 with NULL data sources."""
    f = _fx(spark, d)
    return _sellthrough_nulls(spark, d, R.datasource_uniqueness_sellthrough, "DQ1241", f.datasource(duplicate_ds1=True), f.distributor())


def q_ref_stock_nulls(spark, d):
    """R2 with NULL divisions, markets, sources and units."""
    f = _fx(spark, d)
    r = R.reference_integrity_stock(spark, _p("DQ_REF_BRAND"), f.stock_nulls(), f.ref_brand(), "PRODUCT.brand_code", STOCK_YEAR,
                                    reference_column="brand_code")
    return flatten_result(r, R.STOCK_KEYS)


def q_uniq_generic_nulls(spark, d):
    """R4 with NULL keys, markets, divisions and measures in the fact."""
    tables = _tables(spark, d) | {reg.FACT_SELLOUT: _fx(spark, d).fact_nulls()}
    return flatten_result(R.dimension_key_uniqueness(spark, _p("DQ_UNQ_PRODUCT"), tables, "product_code", "cnt > 1"), R.SELLOUT_KEYS)


def q_append_idempotent(spark, d):
    """One run of R8 recorded twice and one of R3; each run's rows are there once."""
    path = stage_path(spark, "dq-runs")
    run = R.fact_uniqueness_sellout(spark, _p("DQ1091"), _fx(spark, d).fact_sellout(), _pos(_fx(spark, d)))
    record_run(run, path)
    record_run(R.reference_integrity_key(spark, _p("DQ_REF_PRODUCT"), _tables(spark, d), "PRODUCT.product_code"), path)
    record_run(run, path)
    return flatten_result(read_results(spark, path), R.SELLOUT_KEYS)


def q_append_two_runs(spark, d):
    """R8 and R3 appended to one result table, read back."""
    path = stage_path(spark, "dq-results")
    append_results(R.fact_uniqueness_sellout(spark, _p("DQ1091"), _fx(spark, d).fact_sellout(), _pos(_fx(spark, d))), path)
    append_results(R.reference_integrity_key(spark, _p("DQ_REF_PRODUCT"), _tables(spark, d), "PRODUCT.product_code"), path)
    return flatten_result(spark.read.parquet(path), R.SELLOUT_KEYS)


def queries() -> dict[str, Query]:
    return {
        "dq_uniq_1091": q_uniq_1091,
        "dq_uniq_1091_hot_key": q_uniq_1091_hot_key,
        "dq_uniq_1032": q_uniq_1032,
        "dq_uniq_1083": q_uniq_1083,
        "dq_uniq_1084": q_uniq_1084,
        "dq_uniq_1238": q_uniq_1238,
        "dq_uniq_1239": q_uniq_1239,
        "dq_uniq_1240": q_uniq_1240,
        "dq_uniq_1241": q_uniq_1241,
        "dq_empty_left": q_empty_left,
        "dq_empty_cross": q_empty_cross,
        "dq_uniq_generic_product": q_uniq_generic_product,
        "dq_uniq_generic_pos": q_uniq_generic_pos,
        "dq_attr_fact": q_attr_fact,
        "dq_attr_dim": q_attr_dim,
        "dq_ref_stock": q_ref_stock,
        "dq_ref_key_product": q_ref_key_product,
        "dq_uniq_generic_datasource": q_uniq_generic_datasource,
        "dq_attr_pos": q_attr_pos,
        "dq_ref_stock_rate": q_ref_stock_rate,
        "dq_ref_key_datasource": q_ref_key_datasource,
        "dq_ref_stock_catalogue": q_ref_stock_catalogue,
        "dq_attr_catalogue": q_attr_catalogue,
        "dq_ref_key_pos": q_ref_key_pos,
        "dq_uniq_1032_exact": q_uniq_1032_exact,
        "dq_uniq_1032_nulls": q_uniq_1032_nulls,
        "dq_uniq_1091_nulls": q_uniq_1091_nulls,
        "dq_append_two_runs": q_append_two_runs,
        "dq_append_idempotent": q_append_idempotent,
        "dq_attr_catalogue_dup": q_attr_catalogue_dup,
        "dq_attr_hierarchy": q_attr_hierarchy,
        "dq_uniq_1238_nulls": q_uniq_1238_nulls,
        "dq_uniq_1239_nulls": q_uniq_1239_nulls,
        "dq_uniq_1240_nulls": q_uniq_1240_nulls,
        "dq_uniq_1241_nulls": q_uniq_1241_nulls,
        "dq_ref_stock_nulls": q_ref_stock_nulls,
        "dq_uniq_generic_nulls": q_uniq_generic_nulls,
    }
