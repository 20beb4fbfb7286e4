"""Data-quality rules R1-R12.  Each returns the uniform result DataFrame.

Plan shape shared by all rules: scan the fact with only the columns the rule
needs (Catalyst prunes the rest), join small dimensions (broadcast when their
measured size is under the threshold, shuffled otherwise), and aggregate to
one row per attribute group with map-side partial aggregation.  The rules on a
dimension key (R5-R7, R9, R11, R12) reduce the fact to one row per store and key
before any join; those on the fact's own key (R8, R10) count the keys from a scan
of that column alone (see ``operators.keycount.fact_key_count``).

The rules aggregate per store before joining the POS or distributor hierarchy,
whose key is a group key: the hierarchy join then reads one row per store and
year, so a hierarchy too large to broadcast never causes a shuffle of the fact.
R1 and R4 take a caller's condition; it is analysed on fewer and fewer columns
to see what it reads (``reads_only``).  One that reads hierarchy columns joins the
hierarchy at row level; one that reads the attribute alone is settled in the
dimension, and the fact is aggregated before it meets that.  R2 and R3 aggregate
by group and key before the reference is joined.

``attribute_catalogue`` and ``stock_reference_catalogue`` run many rules of one
fact from one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlint.functions.scalar import abs_measure, year_text
from ledgerlint.operators.enrich import enrich_distributor, enrich_pos
from ledgerlint.operators.keycount import CNT, ROWS, fact_key_count, join_key_counts, key_counts
from ledgerlint.operators.measure import RULE, combine_measures, finalize, finalize_rules, measure, times
from ledgerlint.params import RunParams
from ledgerlint.plans import registry as reg

SALES = "consolidated_sales_eur"

SELLOUT_GROUP = ["division_code", "market_code", "sellout_year", "channel_level1", "channel_level2", "client_name"]
SELLTHROUGH_GROUP = [
    "division_code", "market_code", "sellthrough_year", "channel_level1", "channel_level2", "client_name",
]
# Output keys of the attribute array.  The sell-through rules keep the key
# ``sellout_year`` for the sell-through year, as the reference does.
SELLOUT_ATTRS = [(k, k) for k in SELLOUT_GROUP]
SELLTHROUGH_ATTRS = [(k if k != "sellthrough_year" else "sellout_year", k) for k in SELLTHROUGH_GROUP]
SELLOUT_KEYS = [k for k, _ in SELLOUT_ATTRS]
STOCK_ATTRS = [(k, k) for k in ["division_code", "market_code", "sit_year", "data_source", "source_type", "client_name"]]
STOCK_KEYS = [k for k, _ in STOCK_ATTRS]
INTEGRITY_ATTRS = [(k, k) for k in ["division_code", "market_code", "sellout_year"]]
INTEGRITY_KEYS = [k for k, _ in INTEGRITY_ATTRS]

Condition = Column | str | Callable[[], Column]


def _cond(c: Condition) -> Column:
    if isinstance(c, str):
        return F.expr(c)
    if callable(c) and not isinstance(c, Column):
        return c()
    return c


def _val(c: Column | str) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def reads_only(df: DataFrame, condition: Condition, columns: Sequence[str]) -> bool:
    """Whether the condition can be analysed on these columns of the frame alone."""
    try:
        df.select(*columns).select(_cond(condition))
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise
    return True


#: Columns of the store grain, on which the hierarchy's key depends.
STORE = ["division_code", "market_code", "sellout_year", "point_of_sale_code"]


def _by_hierarchy(rows: DataFrame, condition: Condition, pos: DataFrame) -> DataFrame:
    """Measures by SELLOUT_GROUP of rows with the STORE columns, ``val_column`` and what else the condition reads.

    The measures are taken per store and then joined to the hierarchy, unless the condition reads that.
    """
    if reads_only(rows, condition, rows.columns):
        per_store = measure(rows, STORE, _cond(condition), F.col("val_column"))
        return combine_measures(enrich_pos(per_store, pos, "left"), SELLOUT_GROUP)
    return measure(enrich_pos(rows, pos, "left"), SELLOUT_GROUP, _cond(condition), F.col("val_column"))


# ---------------------------------------------------------------------------
# Key uniqueness on the sell-out and sell-through facts
# ---------------------------------------------------------------------------

def key_uniqueness(
    spark: SparkSession,
    params: RunParams,
    fact: DataFrame,
    *,
    fact_key: str,
    hierarchy: DataFrame,
    sellthrough: bool = False,
    dim: DataFrame | None = None,
    dim_key: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """A fact row is invalid when its key occurs more than once.

    With ``dim`` the key is counted in that dimension and joined (``how``) with
    fan-out; without it the key is counted over the fact itself.  The hierarchy
    is the point-of-sale dimension (sell-out) or the distributor dimension
    (sell-through), joined INNER.
    """
    date_col, year_name, entity = (
        ("sellthrough_date", "sellthrough_year", "distributor_code")
        if sellthrough
        else ("sellout_date", "sellout_year", "point_of_sale_code")
    )
    base = fact.select(
        "division_code",
        "market_code",
        year_text(date_col).alias(year_name),
        entity,
        *([fact_key] if fact_key != entity else []),
        abs_measure(SALES).alias("soval"),
    )
    store_grain = ["division_code", "market_code", year_name, entity]
    if dim is not None:
        # One row per store and key before the dimension is joined: a dimension too large
        # to broadcast then shuffles those, pre-aggregated in each task, not the fact's rows.
        grain = [*store_grain, *([fact_key] if fact_key not in store_grain else [])]
        rows = base.groupBy(*grain).agg(F.count(F.lit(1)).alias(ROWS), F.sum("soval").alias("soval"))
        keyed = join_key_counts(rows, fact_key, dim, dim_key or fact_key, how=how)
    else:
        keyed = fact_key_count(base, fact_key, store_grain, ["soval"])
    # Eager aggregation: the measures per store first, then the hierarchy join on one row per store.
    per_store = measure(keyed, store_grain, F.col(CNT) > 1, F.col("soval"))
    enriched = enrich_distributor(per_store, hierarchy) if sellthrough else enrich_pos(per_store, hierarchy, "inner")
    group = SELLTHROUGH_GROUP if sellthrough else SELLOUT_GROUP
    agg = combine_measures(enriched, group)
    return finalize(spark, agg, params, SELLTHROUGH_ATTRS if sellthrough else SELLOUT_ATTRS)


def product_uniqueness_sellout(spark, params, fact, product, pos):
    """R5 (1032): product key counted in the product dimension, LEFT join."""
    return key_uniqueness(spark, params, fact, fact_key="product_code", dim=product, how="left", hierarchy=pos)


def pos_uniqueness_sellout(spark, params, fact, pos):
    """R6 (1083): point-of-sale key counted in the POS dimension, INNER join; POS joined twice."""
    return key_uniqueness(spark, params, fact, fact_key="point_of_sale_code", dim=pos, hierarchy=pos)


def datasource_uniqueness_sellout(spark, params, fact, datasource, pos):
    """R7 (1084): data-source key counted in the data-source dimension, INNER join."""
    return key_uniqueness(spark, params, fact, fact_key="data_source", dim=datasource,
                          dim_key="data_source_code", hierarchy=pos)


def fact_uniqueness_sellout(spark, params, fact, pos):
    """R8 (1091): ``unique_id`` counted over the sell-out fact."""
    return key_uniqueness(spark, params, fact, fact_key="unique_id", hierarchy=pos)


def distributor_uniqueness_sellthrough(spark, params, fact, distributor):
    """R9 (1238): distributor key counted in the distributor dimension; joined twice."""
    return key_uniqueness(spark, params, fact, fact_key="distributor_code", dim=distributor,
                          hierarchy=distributor, sellthrough=True)


def fact_uniqueness_sellthrough(spark, params, fact, distributor):
    """R10 (1239): ``unique_id`` counted over the sell-through fact."""
    return key_uniqueness(spark, params, fact, fact_key="unique_id", hierarchy=distributor, sellthrough=True)


def product_uniqueness_sellthrough(spark, params, fact, product, distributor):
    """R11 (1240): product key counted in the (sell-out) product dimension, LEFT join."""
    return key_uniqueness(spark, params, fact, fact_key="product_code", dim=product, how="left",
                          hierarchy=distributor, sellthrough=True)


def datasource_uniqueness_sellthrough(spark, params, fact, datasource, distributor):
    """R12 (1241): data-source key counted in the (sell-out) data-source dimension."""
    return key_uniqueness(spark, params, fact, fact_key="data_source", dim=datasource,
                          dim_key="data_source_code", hierarchy=distributor, sellthrough=True)


# ---------------------------------------------------------------------------
# Dimension key uniqueness with a caller's condition
# ---------------------------------------------------------------------------

def dimension_key_uniqueness(
    spark: SparkSession,
    params: RunParams,
    tables: Mapping[str, DataFrame],
    source_column: str,
    condition: Condition = "cnt > 1",
    val_column: Column | str = "coalesce(abs(consolidated_sales_eur), 0)",
) -> DataFrame:
    """Fact INNER joined to the distinct (key, cnt) of a dimension; no fan-out.

    ``condition`` may use ``cnt``, ``source_column``, ``val_column`` and the
    group columns.
    """
    ref = reg.UNIQUENESS_KEYS[source_column]
    fact = tables[reg.FACT_SELLOUT]
    base = fact.select(
        "division_code",
        "market_code",
        year_text("sellout_date").alias("sellout_year"),
        "point_of_sale_code",
        F.col(ref.fact_column).alias("source_column"),
        _val(val_column).alias("val_column"),
    )
    keys = key_counts(tables[ref.dim], ref.dim_column, "_dim_key").select("_dim_key", CNT)
    if reads_only(base.crossJoin(keys), condition, [*STORE, "source_column", CNT]):
        # neither row values nor the hierarchy: one row per store and key before the dimension is joined
        base = base.groupBy(*STORE, "source_column").agg(F.count(F.lit(1)).alias(ROWS), F.sum("val_column").alias("val_column"))
    keyed = base.join(keys, base["source_column"] == keys["_dim_key"]).drop("_dim_key")
    agg = _by_hierarchy(keyed, condition, tables[reg.DIM_POS])
    return finalize(spark, agg, params, SELLOUT_ATTRS, keep_empty=True, safe_score=True)


# ---------------------------------------------------------------------------
# Attribute condition
# ---------------------------------------------------------------------------

def attribute_condition(
    spark: SparkSession,
    params: RunParams,
    tables: Mapping[str, DataFrame],
    source_table: str,
    source_column: str,
    condition: Condition,
    val_column: Column | str = "coalesce(abs(consolidated_sales_eur), 0)",
) -> DataFrame:
    """The caller's condition on one attribute of the fact, product or POS.

    A dimension attribute is taken through a LEFT join on the catalogue key
    (duplicated keys fan out).  ``condition`` may use ``source_column``,
    ``val_column`` and the group columns.
    """
    return attribute_catalogue(spark, [AttributeRule(params, source_table, source_column, condition)], tables, val_column)


@dataclass(frozen=True)
class AttributeRule:
    """R1 on one entry of the attribute catalogue."""

    params: RunParams
    source_table: str
    source_column: str
    condition: Condition

    @property
    def source(self) -> reg.AttributeSource:
        return reg.ATTRIBUTE_SOURCES[self.source_table][self.source_column]


def attribute_catalogue(
    spark: SparkSession,
    rules: Sequence[AttributeRule],
    tables: Mapping[str, DataFrame],
    val_column: Column | str = "coalesce(abs(consolidated_sales_eur), 0)",
) -> DataFrame:
    """R1 for many attributes: the rules whose condition reads the attribute alone share one scan of the fact."""
    def alone(r: AttributeRule) -> bool:
        frame = tables[r.source.dim or reg.FACT_SELLOUT]
        return reads_only(frame.select(F.col(r.source.column).alias("source_column")), r.condition, ["source_column"])

    fused = [r for r in rules if alone(r)]
    frames = [_attribute_by_rows(spark, r, tables, val_column) for r in rules if r not in fused]
    if fused:
        agg = _attribute_measures(fused, tables, val_column)
        frames.append(finalize_rules(spark, agg, [r.params for r in fused], SELLOUT_ATTRS, keep_empty=True, safe_score=True))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _attribute_by_rows(spark: SparkSession, rule: AttributeRule, tables: Mapping[str, DataFrame], val_column: Column | str) -> DataFrame:
    """R1 with a condition that reads row values, group columns or the hierarchy."""
    src, fact = rule.source, tables[reg.FACT_SELLOUT]
    value, joined = F.col(src.column), fact
    if src.dim is not None:
        dim = tables[src.dim].select(F.col(src.join_key).alias("_k"), F.col(src.column).alias("_attr"))
        joined = fact.join(dim, fact[src.join_key] == dim["_k"], "left")
        value = F.col("_attr")
    base = joined.select(
        "division_code",
        "market_code",
        year_text("sellout_date").alias("sellout_year"),
        "point_of_sale_code",
        value.alias("source_column"),
        _val(val_column).alias("val_column"),
    )
    agg = _by_hierarchy(base, rule.condition, tables[reg.DIM_POS])
    return finalize(spark, agg, rule.params, SELLOUT_ATTRS, keep_empty=True, safe_score=True)


def _flagged(df: DataFrame, value: Column, condition: Condition, name: str) -> DataFrame:
    """``df`` with the condition on one value, as a column; unknown counts as valid."""
    return df.withColumn("source_column", value).withColumn(name, F.coalesce(_cond(condition), F.lit(False))).drop("source_column")


def _attribute_measures(rules: Sequence[AttributeRule], tables: Mapping[str, DataFrame], val_column: Column | str) -> DataFrame:
    """Measures of many attributes by RULE and SELLOUT_GROUP, from one scan of the fact.

    An attribute of the fact is judged row by row.  One of a dimension is judged in the dimension: per key, how
    many rows it has and how many of them are invalid.  The fact is aggregated by store, dimension key and the flags of
    the rules on its own attributes (8 bytes a rule in a row, where a pair of sums takes 40, and most pairs of store
    and key have few rows), meets the dimensions' counts, and is aggregated by store; the hierarchy
    is joined to that.  A key without a row in the dimension has one copy with a NULL attribute.
    """
    fact = tables[reg.FACT_SELLOUT]
    dims = {r.source.dim: r.source.join_key for r in rules if r.source.dim is not None}
    keys = list(dict.fromkeys(k for k in dims.values() if k not in STORE))
    own = [i for i, r in enumerate(rules) if r.source.dim is None]
    base = fact.select(
        "division_code", "market_code", year_text("sellout_date").alias("sellout_year"), "point_of_sale_code", *keys,
        _val(val_column).alias("val_column"), *[F.col(rules[i].source.column).alias(f"_own{i}") for i in own])
    for i in own:
        base = _flagged(base, F.col(f"_own{i}"), rules[i].condition, f"_f{i}")
    rows = base.groupBy(*STORE, *keys, *[f"_f{i}" for i in own]).agg(F.count(F.lit(1)).alias(ROWS), F.sum("val_column").alias("_v"))
    value_type = rows.schema["_v"].dataType.simpleString()
    zero = F.lit(0).cast(value_type)
    # per rule: copies of a row, invalid copies of it
    weights = {}
    for d, (dim, key) in enumerate(dims.items()):
        mine = [i for i, r in enumerate(rules) if r.source.dim == dim]
        source = tables[dim]
        judged = source.select(F.col(key).alias(f"_k{d}"), *[F.col(rules[i].source.column).alias(f"_own{i}") for i in mine])
        for i in mine:
            judged = _flagged(judged, F.col(f"_own{i}"), rules[i].condition, f"_f{i}")
            blank = F.lit(None).cast(source.schema[rules[i].source.column].dataType)
            rows = _flagged(rows, blank, rules[i].condition, f"_z{i}")
        counts = judged.groupBy(f"_k{d}").agg(F.count(F.lit(1)).alias(f"_n{d}"), *[F.count_if(f"_f{i}").alias(f"_c{i}") for i in mine])
        rows = rows.join(counts, rows[key] == counts[f"_k{d}"], "left")
        for i in mine:
            weights[i] = (F.coalesce(F.col(f"_n{d}"), F.lit(1)).cast("bigint"),
                          F.coalesce(F.col(f"_c{i}"), F.col(f"_z{i}").cast("bigint")))
    sums = []
    for i in range(len(rules)):
        if i in weights:
            n, c = weights[i]
            v = F.col("_v")
            bad = times(v, c, value_type)
            bad = F.when(c == 0, zero).when(c == n, bad).otherwise(F.coalesce(bad, zero))  # an all-NULL row is 0 beside a valid copy
            parts = (bad, times(v, n, value_type), F.col(ROWS) * c, F.col(ROWS) * n)
        else:
            f = F.col(f"_f{i}")
            parts = (F.when(f, F.col("_v")).otherwise(zero), F.col("_v"), F.when(f, F.col(ROWS)).otherwise(F.lit(0)), F.col(ROWS))
        sums += [F.sum(x).cast(t).alias(f"{name}{i}") for x, name, t in zip(
            parts, ("invalid_value", "total_value", "invalid_rows", "total_rows"), (value_type, value_type, "bigint", "bigint"))]
    per_store = rows.groupBy(*STORE).agg(*sums)
    types = {f.name: f.dataType.simpleString() for f in per_store.schema.fields}
    wide = enrich_pos(per_store, tables[reg.DIM_POS], "left").groupBy(*SELLOUT_GROUP).agg(
        *[F.sum(c).cast(types[c]).alias(c) for c in per_store.columns if c not in STORE])
    each = F.array(*[F.struct(F.lit(i).alias(RULE), *[F.col(f"{m}{i}").alias(m) for m in (
        "invalid_value", "total_value", "invalid_rows", "total_rows")]) for i in range(len(rules))])
    return wide.select(*SELLOUT_GROUP, F.inline(each))


# ---------------------------------------------------------------------------
# Reference integrity
# ---------------------------------------------------------------------------

def _is_blank_key(c: Column, extra: tuple[str, ...] = ()) -> Column:
    return c.isNull() | (c == "") | (c.isin(*extra) if extra else F.lit(False))


def reference_integrity_stock(
    spark: SparkSession,
    params: RunParams,
    stock: DataFrame,
    reference: DataFrame,
    source_column: str,
    year: int,
    reference_column: str | None = None,
) -> DataFrame:
    """R2: a stock struct value must occur in the distinct reference column.

    Invalid when unmatched, NULL, ``''``, ``'-1'`` or ``'unspecified'``.  Only
    rows of ``year`` count; the filter is a date range so parquet statistics
    can skip row groups.  Values compare in their own, coerced types, so numbers
    of different types match by value; the blank tests read their text.  No row is
    produced for an empty input.
    """
    ref_col = reference_column or reg.STOCK_REFERENCES[source_column].column
    src = _stock_rows(stock, year).withColumn("source_column", F.col(source_column))
    ref = reference.select(F.col(ref_col).alias("parent_column")).distinct()
    agg = _reference_measures(src, ref, STOCK_KEYS, F.col("total_units"), ("-1", "unspecified"))
    return finalize(spark, agg, params, STOCK_ATTRS, keep_empty=False)


def stock_of_year(stock: DataFrame, year: int) -> DataFrame:
    """The stock rows of a year; the filter is a date range so parquet statistics can skip."""
    d = F.col("tech_period_end_date")
    return stock.filter(
        (d >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (d < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))))


def _stock_rows(stock: DataFrame, year: int) -> DataFrame:
    """The stock rows of a year with their group columns."""
    groups = {
        "division_code": F.col("division_amaas"), "market_code": F.col("GEOGRAPHY.orga_country_alpha2"),
        "sit_year": year_text("tech_period_end_date"),
        "client_name": F.col("DISTRIBUTOR.distributor_name"), "data_source": F.col("METADATA_TECHNICAL.data_file_provider"),
        "source_type": F.lit("Distributor"), "total_units": abs_measure("FACT_VALUE.total_stock_units", null_as_zero=False),
    }
    return stock_of_year(stock, year).withColumns(groups)


def _reference_measures(src: DataFrame, ref: DataFrame, keys: Sequence[str], value: Column, blank: tuple[str, ...] = (),
                        also: Sequence[str] = ()) -> DataFrame:
    """Measures by ``keys`` of rows whose ``source_column`` must occur in the distinct ``parent_column``.

    One row per group and value before the reference is joined, so a hot value is one row a task.  ``also``: further
    columns of both sides that must agree.
    """
    rows = src.groupBy(*keys, "source_column").agg(F.count(F.lit(1)).alias(ROWS), F.sum(value).alias("_value"))
    same = rows["source_column"] == ref["parent_column"]
    for c in also:
        same = same & (rows[c] == ref[f"_ref{c}"])
    joined = rows.join(ref, same, "left")
    s = F.col("source_column").cast("string")
    return measure(joined, keys, F.col("parent_column").isNull() | _is_blank_key(s, blank), F.col("_value"))


@dataclass(frozen=True)
class StockRule:
    """R2 on one path of the stock catalogue."""

    params: RunParams
    source_column: str


def _as_text(stock_type: str, reference_type: str) -> Callable[[Column], Column] | None:
    """How values of these types compare as text; None if they don't."""
    def numeric(t: str) -> bool:
        return t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")

    if stock_type == reference_type == "string":
        return lambda c: c
    if stock_type == "double" and numeric(reference_type):
        return lambda c: (c.cast("double") + F.lit(0.0)).cast("string")  # as Spark compares them; 0.0 for -0.0
    return None


def stock_reference_catalogue(
    spark: SparkSession,
    rules: Sequence[StockRule],
    stock: DataFrame,
    references: Mapping[str, DataFrame],
    year: int,
) -> DataFrame:
    """R2 for many paths from one scan of the stock and one of each reference table.

    Every stock row yields a (rule, value) pair for each path; these are counted per group in each task, and one
    shuffle brings them together.  Paths whose types can't be compared as text run by themselves.
    """
    fused, frames = [], []
    for r in rules:
        ref = reg.STOCK_REFERENCES[r.source_column]
        types = (stock.select(F.col(r.source_column).alias("c")).schema["c"].dataType.simpleString(),
                 references[ref.table].schema[ref.column].dataType.simpleString())
        text = _as_text(*types)
        if text is None:
            frames.append(reference_integrity_stock(spark, r.params, stock, references[ref.table], r.source_column, year))
        else:
            fused.append((r, ref, text))
    if fused:
        pairs = F.array(*[F.struct(F.lit(i).alias(RULE), text(F.col(r.source_column)).alias("source_column"))
                          for i, (r, _, text) in enumerate(fused)])
        src = _stock_rows(stock, year).select(*STOCK_KEYS, "total_units", F.inline(pairs))
        known = None
        for table in dict.fromkeys(ref.table for _, ref, _ in fused):
            listed = F.array(*[F.struct(F.lit(i).alias(f"_ref{RULE}"), text(F.col(ref.column)).alias("parent_column"))
                               for i, (_, ref, text) in enumerate(fused) if ref.table == table])
            part = references[table].select(F.inline(listed)).filter("parent_column is not null")
            known = part if known is None else known.unionByName(part)
        agg = _reference_measures(src, known.distinct(), [RULE, *STOCK_KEYS], F.col("total_units"), ("-1", "unspecified"), also=[RULE])
        frames.append(finalize_rules(spark, agg, [r.params for r, _, _ in fused], STOCK_ATTRS, keep_empty=False))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def reference_integrity_key(
    spark: SparkSession,
    params: RunParams,
    tables: Mapping[str, DataFrame],
    include_column: str,
) -> DataFrame:
    """A fact key must occur in its dimension; invalid when unmatched, NULL or ``''``.

    Three group columns; no row for an empty input.
    """
    ref = reg.INTEGRITY_KEYS[include_column]
    fact = tables[reg.FACT_SELLOUT]
    dim = tables[ref.dim].select(F.col(ref.dim_column).alias("parent_column")).distinct()
    base = fact.select(
        "division_code",
        "market_code",
        year_text("sellout_date").alias("sellout_year"),
        abs_measure(SALES).alias("soval"),
        F.col(ref.fact_column).alias("source_column"),
    )
    agg = _reference_measures(base, dim, INTEGRITY_KEYS, F.col("soval"))
    return finalize(spark, agg, params, INTEGRITY_ATTRS, keep_empty=False)
