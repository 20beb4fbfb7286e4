"""The concrete rules by DQ id, and the template rules (R1-R4) by specification.

``run_rule(spark, "1091", tables, run_ts, param_date)`` runs a rule the way a
scheduled INSERT of the reference would, on the DataFrames found in
``tables`` (logical name -> DataFrame).  ``run_spec`` runs a template rule with
the arguments that the reference fills in by template.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlint.params import RunParams
from ledgerlint.plans import registry as reg
from ledgerlint.plans import rules as R


@dataclass(frozen=True)
class ConcreteRule:
    dq_id: str
    function: Callable[..., DataFrame]
    tables: tuple[str, ...]  # logical names, in the order of the function's table arguments
    description: str


RULES: dict[str, ConcreteRule] = {
    r.dq_id: r
    for r in [
        ConcreteRule("1032", R.product_uniqueness_sellout, (reg.FACT_SELLOUT, reg.DIM_PRODUCT, reg.DIM_POS),
                     "sell-out product key repeated in the product dimension"),
        ConcreteRule("1083", R.pos_uniqueness_sellout, (reg.FACT_SELLOUT, reg.DIM_POS),
                     "sell-out point-of-sale key repeated in the POS dimension"),
        ConcreteRule("1084", R.datasource_uniqueness_sellout, (reg.FACT_SELLOUT, reg.DIM_DATASOURCE, reg.DIM_POS),
                     "sell-out data source repeated in the data-source dimension"),
        ConcreteRule("1091", R.fact_uniqueness_sellout, (reg.FACT_SELLOUT, reg.DIM_POS),
                     "sell-out unique_id repeated in the fact"),
        ConcreteRule("1238", R.distributor_uniqueness_sellthrough, (reg.FACT_SELLTHROUGH, reg.DIM_DISTRIBUTOR),
                     "sell-through distributor repeated in the distributor dimension"),
        ConcreteRule("1239", R.fact_uniqueness_sellthrough, (reg.FACT_SELLTHROUGH, reg.DIM_DISTRIBUTOR),
                     "sell-through unique_id repeated in the fact"),
        ConcreteRule("1240", R.product_uniqueness_sellthrough,
                     (reg.FACT_SELLTHROUGH, reg.DIM_PRODUCT, reg.DIM_DISTRIBUTOR),
                     "sell-through product key repeated in the (sell-out) product dimension"),
        ConcreteRule("1241", R.datasource_uniqueness_sellthrough,
                     (reg.FACT_SELLTHROUGH, reg.DIM_DATASOURCE, reg.DIM_DISTRIBUTOR),
                     "sell-through data source repeated in the (sell-out) data-source dimension"),
    ]
}


def run_rule(spark: SparkSession, dq_id: str, tables: Mapping[str, DataFrame], run_timestamp: dt.datetime | str,
             param_date: str | None = None) -> DataFrame:
    """Run the concrete rule ``dq_id`` and return its result rows."""
    rule = RULES[dq_id]
    missing = [t for t in rule.tables if t not in tables]
    if missing:
        raise KeyError(f"rule {dq_id} needs tables {missing}")
    params = RunParams(dq_id, run_timestamp, param_date)
    return rule.function(spark, params, *[tables[t] for t in rule.tables])


TEMPLATES = ("attribute", "stock", "dimension-key", "reference-key")


@dataclass(frozen=True)
class RuleSpec:
    """Arguments of a template rule.

    template: ``attribute`` (R1: table, column, condition, value), ``stock`` (R2: column, year),
    ``reference-key`` (R3: column) or ``dimension-key`` (R4: column, condition, value).
    ``column`` is a catalogue entry (C1, C2, C4, C3); conditions and values are SQL expressions.
    """

    template: str
    dq_id: str
    column: str
    table: str | None = None
    condition: str | None = None
    value: str = "coalesce(abs(consolidated_sales_eur), 0)"
    year: int | None = None

    def __post_init__(self):
        catalogue = {
            "attribute": reg.ATTRIBUTE_SOURCES.get(self.table or "", {}), "stock": reg.STOCK_REFERENCES,
            "dimension-key": reg.UNIQUENESS_KEYS, "reference-key": reg.INTEGRITY_KEYS,
        }
        if self.template not in catalogue:
            raise ValueError(f"template is one of {TEMPLATES}")
        if self.column not in catalogue[self.template]:
            raise ValueError(f"{self.column!r} is not in the catalogue of {self.template}: {sorted(catalogue[self.template])}")
        if self.template == "attribute" and not self.condition:
            raise ValueError("an attribute rule needs a condition")
        if self.template == "stock" and self.year is None:
            raise ValueError("a stock rule needs a year")


def run_spec(spark: SparkSession, spec: RuleSpec, tables: Mapping[str, DataFrame], run_timestamp: dt.datetime | str,
             param_date: str | None = None) -> DataFrame:
    """Run a template rule and return its result rows."""
    params = RunParams(spec.dq_id, run_timestamp, param_date)
    if spec.template == "attribute":
        return R.attribute_condition(spark, params, tables, spec.table, spec.column, spec.condition, spec.value)
    if spec.template == "stock":
        reference = tables[reg.STOCK_REFERENCES[spec.column].table]
        return R.reference_integrity_stock(spark, params, tables[reg.STOCK], reference, spec.column, spec.year)
    if spec.template == "dimension-key":
        return R.dimension_key_uniqueness(spark, params, tables, spec.column, spec.condition or "cnt > 1", spec.value)
    return R.reference_integrity_key(spark, params, tables, spec.column)
