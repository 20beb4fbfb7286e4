"""DuckDB oracle statements for the DQ-rule queries.

Written directly from the rule semantics (window count joined with fan-out,
grouped conditional sums), independent of the Spark plans they check.
"""

from __future__ import annotations

from ledgerlint.oracle.fixtures_sql import with_fixtures

RUN_TS = "2001-08-31 06:00:00"
PARAM_DATE = "2001-08-31"

SELLOUT_KEYS = ["division_code", "market_code", "sellout_year", "channel_level1", "channel_level2", "client_name"]


def _final(dq_id: str, cols: list[tuple[str, str]], keep_empty: bool, value_type: str = "DOUBLE") -> str:
    attrs = ", ".join(f"g.{c} AS attr_{k}" for k, c in cols)
    src = "(SELECT 1 AS one) p LEFT JOIN g ON TRUE" if keep_empty else "g"
    return f"""
SELECT '{dq_id}' AS dq_id, '{RUN_TS}' AS run_timestamp, {attrs},
       CAST(CAST(CASE WHEN g.total_rows IS NOT NULL AND g.total_rows <> 0
                      THEN (1 - g.invalid_rows / g.total_rows) * 100 END AS DECIMAL(38,9)) AS DOUBLE) AS dq_score,
       CAST(g.invalid_rows AS BIGINT) AS invalid_rows, CAST(g.total_rows AS BIGINT) AS total_rows,
       CAST(g.invalid_value AS {value_type}) AS invalid_value, CAST(g.total_value AS {value_type}) AS total_value,
       '{PARAM_DATE}' AS param_date
FROM {src}"""


def _group(keys: list[str], cond: str, val: str, src: str) -> str:
    k = ", ".join(keys)
    return f"""
        SELECT {k},
               SUM(CASE WHEN {cond} THEN {val} ELSE 0 END) AS invalid_value,
               SUM({val}) AS total_value,
               COUNT(CASE WHEN {cond} THEN 1 END) AS invalid_rows,
               COUNT(*) AS total_rows
        FROM {src} GROUP BY {k}"""


def uniqueness(dq_id: str, *, sellthrough: bool, key: str, dim: str | None, dim_key: str | None,
               how: str, hierarchy: str, fixtures: list[str], fact_filter: str = "TRUE",
               fact: str | None = None, value_type: str = "DOUBLE") -> str:
    """R5-R12 and the empty-input variant."""
    fact = fact or ("fx_fact_sellthrough" if sellthrough else "fx_fact_sellout")
    date_col = "sellthrough_date" if sellthrough else "sellout_date"
    year = "sellthrough_year" if sellthrough else "sellout_year"
    entity = "distributor_code" if sellthrough else "point_of_sale_code"
    if dim is None:
        src = f"""
        SELECT division_code, market_code, CAST(year({date_col}) AS VARCHAR) AS {year}, {entity},
               COUNT(*) OVER (PARTITION BY {key}) AS cnt,
               COALESCE(abs(consolidated_sales_eur), 0) AS soval
        FROM (SELECT * FROM {fact} WHERE {fact_filter})"""
    else:
        src = f"""
        SELECT f.division_code, f.market_code, CAST(year(f.{date_col}) AS VARCHAR) AS {year}, f.{entity},
               d.cnt, COALESCE(abs(f.consolidated_sales_eur), 0) AS soval
        FROM (SELECT * FROM {fact} WHERE {fact_filter}) f
        {how} JOIN (SELECT {dim_key} AS k, COUNT(*) OVER (PARTITION BY {dim_key}) AS cnt FROM {dim}) d
          ON f.{key} = d.k"""
    if sellthrough:
        hier = f"""
        SELECT s.*, 'B2B' AS channel_level1, h.channel_level2, h.distributor_name AS client_name
        FROM src s JOIN {hierarchy} h ON s.distributor_code = h.distributor_code"""
    else:
        hier = f"""
        SELECT s.*, h.channel_level1, h.channel_level2, h.client_name
        FROM src s JOIN {hierarchy} h ON s.point_of_sale_code = h.point_of_sale_code"""
    keys = ["division_code", "market_code", year, "channel_level1", "channel_level2", "client_name"]
    cols = [(k if k != "sellthrough_year" else "sellout_year", k) for k in keys]
    extra = [("src", src), ("hier", hier), ("g", _group(keys, "cnt > 1", "soval", "hier"))]
    return with_fixtures(_final(dq_id, cols, True, value_type), *fixtures, extra=extra)


def dimension_uniqueness(dq_id: str, *, fact_col: str, dim: str, dim_key: str, pos: str, fixtures: list[str],
                         fact: str = "fx_fact_sellout") -> str:
    """R4 with condition ``cnt > 1``."""
    src = f"""
        SELECT f.division_code, f.market_code, CAST(year(f.sellout_date) AS VARCHAR) AS sellout_year,
               f.point_of_sale_code, f.{fact_col} AS source_column, d.cnt,
               COALESCE(abs(f.consolidated_sales_eur), 0) AS val_column
        FROM {fact} f
        JOIN (SELECT DISTINCT {dim_key} AS k, COUNT(*) OVER (PARTITION BY {dim_key}) AS cnt FROM {dim}) d
          ON f.{fact_col} = d.k"""
    hier = f"""
        SELECT s.*, h.channel_level1, h.channel_level2, h.client_name
        FROM src s LEFT JOIN {pos} h ON s.point_of_sale_code = h.point_of_sale_code"""
    extra = [("src", src), ("hier", hier), ("g", _group(SELLOUT_KEYS, "cnt > 1", "val_column", "hier"))]
    return with_fixtures(_final(dq_id, [(k, k) for k in SELLOUT_KEYS], True), *fixtures, extra=extra)


def attribute_condition(dq_id: str, *, value_expr: str, dim_join: str, cond: str, fixtures: list[str],
                        pos: str = "dim_pos", fact: str = "fx_fact_sellout",
                        measure: str = "COALESCE(abs(f.consolidated_sales_eur), 0)") -> str:
    """``value_expr`` over ``f`` (fact) or ``d`` (dimension joined by ``dim_join``)."""
    src = f"""
        SELECT f.division_code, f.market_code, CAST(year(f.sellout_date) AS VARCHAR) AS sellout_year,
               f.point_of_sale_code, {value_expr} AS source_column, {measure} AS val_column
        FROM {fact} f {dim_join}"""
    hier = f"""
        SELECT s.*, h.channel_level1, h.channel_level2, h.client_name
        FROM src s LEFT JOIN {pos} h ON s.point_of_sale_code = h.point_of_sale_code"""
    extra = [("src", src), ("hier", hier), ("g", _group(SELLOUT_KEYS, cond, "val_column", "hier"))]
    return with_fixtures(_final(dq_id, [(k, k) for k in SELLOUT_KEYS], True), *fixtures, extra=extra)


def reference_integrity_stock(dq_id: str, year: int, value: str = "brand_code", ref: str = "fx_ref_brand",
                              ref_col: str = "brand_code", stock: str = "fx_stock_flat") -> str:
    """R2: a stock value against the distinct reference column, in their own types."""
    src = f"""
        SELECT division_amaas AS division_code, orga_country_alpha2 AS market_code,
               CAST(year(tech_period_end_date) AS VARCHAR) AS sit_year, distributor_name AS client_name,
               data_file_provider AS data_source, 'Distributor' AS source_type,
               {value} AS source_column, abs(total_stock_units) AS total_units
        FROM {stock} WHERE year(tech_period_end_date) = {year}"""
    joined = f"""
        SELECT s.*, r.parent_column FROM src s
        LEFT JOIN (SELECT DISTINCT {ref_col} AS parent_column FROM {ref}) r
          ON s.source_column = r.parent_column"""
    keys = ["division_code", "market_code", "sit_year", "data_source", "source_type", "client_name"]
    cond = "parent_column IS NULL OR coalesce(CAST(source_column AS VARCHAR), '') IN ('', '-1', 'unspecified')"
    extra = [("src", src), ("j", joined), ("g", _group(keys, cond, "total_units", "j"))]
    return with_fixtures(_final(dq_id, [(k, k) for k in keys], False), stock, ref, extra=extra)


def reference_integrity_key(dq_id: str, fact_col: str = "product_code", dim: str = "fx_product",
                            dim_col: str = "product_code", fact: str = "fx_fact_sellout") -> str:
    """A fact key against the distinct keys of its dimension."""
    src = f"""
        SELECT f.division_code, f.market_code, CAST(year(f.sellout_date) AS VARCHAR) AS sellout_year,
               COALESCE(abs(f.consolidated_sales_eur), 0) AS soval, f.{fact_col} AS source_column, d.parent_column
        FROM {fact} f
        LEFT JOIN (SELECT DISTINCT {dim_col} AS parent_column FROM {dim}) d ON f.{fact_col} = d.parent_column"""
    keys = ["division_code", "market_code", "sellout_year"]
    cond = "parent_column IS NULL OR source_column IS NULL OR source_column = ''"
    extra = [("src", src), ("g", _group(keys, cond, "soval", "src"))]
    return with_fixtures(_final(dq_id, [(k, k) for k in keys], False), fact, dim, extra=extra)


#: C2 paths: column of the flat stock fixture, reference fixture and column.
STOCK_PATHS = {
    "DISTRIBUTOR.distributor_code": ("fx_general_data", "business_partner_number_external_system"),
    "DISTRIBUTOR.distributor_name": ("fx_general_data", "organization_legal_name_1"),
    "CURRENCY.conversion_rate": ("fx_ref_rate", "exchange_rate"),
    "GEOGRAPHY.orga_region_description": ("fx_ref_market", "zone_code"),
    "PRODUCT.orga_division": ("fx_ref_product", "division_code"),
    "PRODUCT.signature_code": ("fx_ref_product", "signature_code"),
    "PRODUCT.signature_desc": ("fx_ref_product", "signature_name"),
    "PRODUCT.axis_code": ("fx_ref_product", "axe_code"),
    "PRODUCT.axis_desc": ("fx_ref_product", "axe_name"),
    "PRODUCT.brand_code": ("fx_ref_product", "brand_code"),
    "PRODUCT.brand_desc": ("fx_ref_product", "brand_name"),
    "PRODUCT.subaxis_code": ("fx_ref_product", "sub_axe_code"),
    "PRODUCT.subaxis_desc": ("fx_ref_product", "sub_axe_name"),
    "PRODUCT.subbrand_code": ("fx_ref_product", "sub_brand_code"),
    "PRODUCT.subbrand_desc": ("fx_ref_product", "sub_brand_name"),
}

ATTR_CONDITION = "coalesce(source_column, '') = '' OR contains(source_column, '1')"
#: C1 entries: columns by table, with the join that provides them as ``d``.
ATTR_COLUMNS = {
    "": ["market_code", "order_number", "data_source"],
    "LEFT JOIN fx_product d ON f.product_code = d.product_code":
        ["product_name", "signature_name", "brand_name", "material_group_code"],
    "LEFT JOIN dim_pos d ON f.point_of_sale_code = d.point_of_sale_code":
        ["point_of_sale_code", "channel_level2", "channel_level1"],
}


def union(statements: list[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({s})" for s in statements)


def queries() -> dict[str, str]:
    so = ["fx_fact_sellout", "dim_pos"]
    st = ["fx_fact_sellthrough", "fx_distributor"]
    two_runs = union([
            uniqueness("DQ1091", sellthrough=False, key="unique_id", dim=None, dim_key=None, how="",
                       hierarchy="dim_pos", fixtures=so),
            f"""SELECT dq_id, run_timestamp, attr_division_code, attr_market_code, attr_sellout_year,
                       CAST(NULL AS VARCHAR) AS attr_channel_level1, CAST(NULL AS VARCHAR) AS attr_channel_level2,
                       CAST(NULL AS VARCHAR) AS attr_client_name, dq_score, invalid_rows, total_rows, invalid_value,
                       total_value, param_date FROM ({reference_integrity_key("DQ_REF_PRODUCT")})"""])
    return {
        "dq_uniq_1032": uniqueness("DQ1032", sellthrough=False, key="product_code", dim="fx_product",
                                   dim_key="product_code", how="LEFT", hierarchy="dim_pos",
                                   fixtures=so + ["fx_product"]),
        "dq_uniq_1083": uniqueness("DQ1083", sellthrough=False, key="point_of_sale_code", dim="dim_pos_dup",
                                   dim_key="point_of_sale_code", how="INNER", hierarchy="dim_pos_dup",
                                   fixtures=so + ["dim_pos_dup"]),
        "dq_uniq_1084": uniqueness("DQ1084", sellthrough=False, key="data_source", dim="fx_datasource_dup",
                                   dim_key="data_source_code", how="INNER", hierarchy="dim_pos",
                                   fixtures=so + ["fx_datasource_dup"]),
        "dq_uniq_1091": uniqueness("DQ1091", sellthrough=False, key="unique_id", dim=None, dim_key=None,
                                   how="", hierarchy="dim_pos", fixtures=so),
        "dq_uniq_1091_hot_key": uniqueness("DQ1091", sellthrough=False, key="unique_id", dim=None, dim_key=None,
                                           how="", hierarchy="dim_pos", fixtures=so + ["fx_fact_hot_key"],
                                           fact="fx_fact_hot_key"),
        "dq_uniq_1238": uniqueness("DQ1238", sellthrough=True, key="distributor_code", dim="fx_distributor_dup",
                                   dim_key="distributor_code", how="INNER", hierarchy="fx_distributor_dup",
                                   fixtures=st + ["fx_distributor_dup"]),
        "dq_uniq_1239": uniqueness("DQ1239", sellthrough=True, key="unique_id", dim=None, dim_key=None,
                                   how="", hierarchy="fx_distributor", fixtures=st),
        "dq_uniq_1240": uniqueness("DQ1240", sellthrough=True, key="product_code", dim="fx_product",
                                   dim_key="product_code", how="LEFT", hierarchy="fx_distributor",
                                   fixtures=st + ["fx_product"]),
        "dq_uniq_1241": uniqueness("DQ1241", sellthrough=True, key="data_source", dim="fx_datasource_dup",
                                   dim_key="data_source_code", how="INNER", hierarchy="fx_distributor",
                                   fixtures=st + ["fx_datasource_dup"]),
        "dq_empty_left": uniqueness("DQ1091", sellthrough=False, key="unique_id", dim=None, dim_key=None,
                                    how="", hierarchy="dim_pos", fixtures=so,
                                    fact_filter="sellout_date >= DATE '2101-01-01'"),
        "dq_uniq_generic_product": dimension_uniqueness("DQ_UNQ_PRODUCT", fact_col="product_code", dim="fx_product",
                                                        dim_key="product_code", pos="dim_pos",
                                                        fixtures=so + ["fx_product"]),
        "dq_uniq_generic_pos": dimension_uniqueness("DQ_UNQ_POS", fact_col="point_of_sale_code", dim="dim_pos_dup",
                                                    dim_key="point_of_sale_code", pos="dim_pos_dup",
                                                    fixtures=so + ["dim_pos_dup"]),
        "dq_attr_fact": attribute_condition("DQ_ATTR_MARKET", value_expr="f.market_code", dim_join="",
                                            cond="source_column = 'XX'", fixtures=so),
        "dq_attr_dim": attribute_condition(
            "DQ_ATTR_BRAND", value_expr="d.brand_name",
            dim_join="LEFT JOIN fx_product d ON f.product_code = d.product_code",
            cond="source_column IS NULL OR source_column IN ('Brand#1', 'Brand#2')", fixtures=so + ["fx_product"]),
        "dq_ref_stock": reference_integrity_stock("DQ_REF_BRAND", 2000),
        "dq_empty_cross": reference_integrity_stock("DQ_REF_BRAND", 2100),
        "dq_ref_key_product": reference_integrity_key("DQ_REF_PRODUCT"),
        "dq_uniq_generic_datasource": dimension_uniqueness("DQ_UNQ_DS", fact_col="data_source",
                                                           dim="fx_datasource_dup", dim_key="data_source_code",
                                                           pos="dim_pos", fixtures=so + ["fx_datasource_dup"]),
        "dq_attr_pos": attribute_condition(
            "DQ_ATTR_CHANNEL", value_expr="d.channel_level2",
            dim_join="LEFT JOIN dim_pos_dup d ON f.point_of_sale_code = d.point_of_sale_code",
            cond="source_column = 'L0'", fixtures=so + ["dim_pos_dup"], pos="dim_pos_dup"),
        "dq_ref_stock_rate": reference_integrity_stock("DQ_REF_RATE", 2000, value="conversion_rate",
                                                       ref="fx_ref_rate", ref_col="exchange_rate"),
        "dq_ref_stock_catalogue": union([
            reference_integrity_stock("DQ_REF_" + path, 2000, value=path.split(".")[1], ref=ref, ref_col=col)
            for path, (ref, col) in STOCK_PATHS.items()]),
        "dq_attr_catalogue": union([
            attribute_condition(f"DQ_ATTR_{c}", value_expr=f"{'d' if join else 'f'}.{c}", dim_join=join,
                                cond=ATTR_CONDITION, fixtures=so + ["fx_product"])
            for join, columns in ATTR_COLUMNS.items() for c in columns]),
        "dq_ref_key_pos": reference_integrity_key("DQ_REF_POS", fact_col="point_of_sale_code", dim="dim_pos",
                                                  dim_col="point_of_sale_code", fact="fx_fact_nulls"),
        "dq_uniq_1032_exact": uniqueness("DQ1032", sellthrough=False, key="product_code", dim="fx_product",
                                         dim_key="product_code", how="LEFT", hierarchy="dim_pos",
                                         fixtures=so + ["fx_product", "fx_fact_exact"], fact="fx_fact_exact",
                                         value_type="VARCHAR"),
        "dq_uniq_1032_nulls": uniqueness("DQ1032", sellthrough=False, key="product_code", dim="fx_product",
                                         dim_key="product_code", how="LEFT", hierarchy="dim_pos",
                                         fixtures=so + ["fx_product", "fx_fact_nulls"], fact="fx_fact_nulls"),
        "dq_uniq_1091_nulls": uniqueness("DQ1091", sellthrough=False, key="unique_id", dim=None, dim_key=None,
                                         how="", hierarchy="dim_pos", fixtures=so + ["fx_fact_nulls"],
                                         fact="fx_fact_nulls"),
        "dq_append_two_runs": two_runs,
        "dq_append_idempotent": two_runs,
        "dq_attr_catalogue_dup": union([
            attribute_condition(f"DQ_ATTR_{c}", value_expr=f"{'d' if join else 'f'}.{c}", dim_join=join.replace("dim_pos", "dim_pos_dup"),
                                cond=ATTR_CONDITION, fixtures=so + ["fx_product", "fx_fact_nulls", "dim_pos_dup"], pos="dim_pos_dup",
                                fact="fx_fact_nulls", measure="abs(f.consolidated_sales_eur)")
            for join, columns in ATTR_COLUMNS.items() for c in columns]),
        "dq_attr_hierarchy": attribute_condition(
            "DQ_ATTR_CLIENT", value_expr="d.brand_name", dim_join="LEFT JOIN fx_product d ON f.product_code = d.product_code",
            cond="channel_level2 = 'L0' AND (source_column IS NULL OR val_column > 1000)", fixtures=so + ["fx_product", "dim_pos_dup"],
            pos="dim_pos_dup"),
        "dq_uniq_1238_nulls": uniqueness("DQ1238", sellthrough=True, key="distributor_code", dim="fx_distributor_dup",
                                         dim_key="distributor_code", how="INNER", hierarchy="fx_distributor_dup",
                                         fixtures=st + ["fx_distributor_dup", "fx_fact_sellthrough_nulls"],
                                         fact="fx_fact_sellthrough_nulls"),
        "dq_uniq_1239_nulls": uniqueness("DQ1239", sellthrough=True, key="unique_id", dim=None, dim_key=None, how="",
                                         hierarchy="fx_distributor", fixtures=st + ["fx_fact_sellthrough_nulls"],
                                         fact="fx_fact_sellthrough_nulls"),
        "dq_uniq_1240_nulls": uniqueness("DQ1240", sellthrough=True, key="product_code", dim="fx_product", dim_key="product_code",
                                         how="LEFT", hierarchy="fx_distributor",
                                         fixtures=st + ["fx_product", "fx_fact_sellthrough_nulls"], fact="fx_fact_sellthrough_nulls"),
        "dq_uniq_1241_nulls": uniqueness("DQ1241", sellthrough=True, key="data_source", dim="fx_datasource_dup",
                                         dim_key="data_source_code", how="INNER", hierarchy="fx_distributor",
                                         fixtures=st + ["fx_datasource_dup", "fx_fact_sellthrough_nulls"],
                                         fact="fx_fact_sellthrough_nulls"),
        "dq_ref_stock_nulls": reference_integrity_stock("DQ_REF_BRAND", 2000, stock="fx_stock_flat_nulls"),
        "dq_uniq_generic_nulls": dimension_uniqueness("DQ_UNQ_PRODUCT", fact_col="product_code", dim="fx_product",
                                                      dim_key="product_code", pos="dim_pos",
                                                      fixtures=so + ["fx_product", "fx_fact_nulls"], fact="fx_fact_nulls"),
        "dq_ref_key_datasource": reference_integrity_key("DQ_REF_DS", fact_col="data_source", dim="fx_datasource",
                                                         dim_col="data_source_code"),
    }
