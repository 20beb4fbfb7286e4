"""The fixtures of ``ledgerlint.sources.fixtures`` as DuckDB CTEs.

Used only to build the independent oracle SQL the driver runs next to the
Spark queries.  Each entry is ``name AS (...)``; ``with_fixtures`` prepends the
ones a statement needs (dependencies first).
"""

from __future__ import annotations

import re

GARBLED_NBSP = "┬á"

_AMOUNT = (
    "CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))"
    " AS DECIMAL(18,4)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4))"
)

_SAP_CODE = """CASE WHEN {k} % 13 = 0 THEN 'NA'
          WHEN {k} % 3 = 0 THEN lpad(CAST({k} AS VARCHAR), 5, '0')
          WHEN {k} % 3 = 1 THEN lpad(CAST({k} AS VARCHAR), 8, '0')
          ELSE 'SAP' || lpad(CAST({k} AS VARCHAR), 11, '0') END"""

FIXTURES: dict[str, tuple[list[str], str]] = {
    "fx_pos": ([], """
        SELECT s.s_suppkey AS suppkey, n.n_nationkey AS nationkey, s.s_name,
               m.market_code,
               m.market_code || '_N' || CAST(n.n_nationkey AS VARCHAR) || '_S' || CAST(s.s_suppkey AS VARCHAR)
                   AS point_of_sale_code,
               n.n_name AS client_name, r.r_name AS channel_level1,
               'L' || CAST(s.s_suppkey % 3 AS VARCHAR) AS channel_level2
        FROM supplier s
        JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey
        JOIN (SELECT * FROM (VALUES (0, 'AU'), (1, 'IN'), (2, 'SG'), (3, 'SA'), (4, 'XX')) t(rk, market_code)) m
          ON m.rk = r.r_regionkey"""),
    "dim_pos": (["fx_pos"], "SELECT point_of_sale_code, client_name, channel_level1, channel_level2 FROM fx_pos"),
    "dim_pos_dup": (["fx_pos"], """
        SELECT point_of_sale_code, client_name, channel_level1, channel_level2 FROM fx_pos
        UNION ALL
        SELECT point_of_sale_code, client_name, channel_level1, channel_level2 FROM fx_pos WHERE suppkey % 10 = 0"""),
    "fx_fact_sellout": (["fx_pos"], f"""
        SELECT p.market_code, l.l_returnflag AS division_code,
               CASE l.l_suppkey % 3 WHEN 0 THEN 'ECOMM_SKU_TRAFFIC' WHEN 1 THEN 'ECOM_AMZ' ELSE 'OMS_SFCC' END
                   AS source_project,
               p.point_of_sale_code,
               CAST(l.l_shipdate AS DATE) AS sellout_date,
               'DS' || CAST(l.l_suppkey % 5 AS VARCHAR) AS data_source,
               'P' || CAST(l.l_partkey AS VARCHAR) AS product_code,
               CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS unique_id,
               'O' || CAST(l.l_orderkey AS VARCHAR) AS order_number,
               CASE WHEN l.l_linenumber = 1 THEN -{_AMOUNT} ELSE {_AMOUNT} END AS consolidated_sales_eur,
               l.l_suppkey AS suppkey, p.nationkey, l.l_partkey AS partkey, l.l_linenumber AS linenumber,
               l.l_quantity AS quantity
        FROM lineitem l JOIN fx_pos p ON l.l_suppkey = p.suppkey"""),
    "fx_fact_hot_key": (["fx_fact_sellout"], """
        SELECT * REPLACE (CASE WHEN partkey % 3 = 0 THEN '-1' ELSE unique_id END AS unique_id) FROM fx_fact_sellout"""),
    "fx_fact_nonzero": (["fx_fact_sellout"], """
        SELECT * FROM fx_fact_sellout WHERE NOT (quantity <= 5 AND suppkey % 3 IN (0, 1))"""),
    "fx_mixed_freq": (["fx_fact_nonzero"], """
        SELECT * REPLACE ('DS' || CAST((suppkey + linenumber) % 5 AS VARCHAR) AS data_source) FROM fx_fact_nonzero"""),
    "fx_datasource": ([], """
        SELECT 'DS' || CAST(k AS VARCHAR) AS data_source_code,
               CASE k WHEN 0 THEN 'Daily' WHEN 1 THEN 'Daily' WHEN 2 THEN 'Weekly' WHEN 3 THEN 'Monthly' ELSE '' END
                   AS data_source_frequency
        FROM (SELECT DISTINCT l_suppkey % 5 AS k FROM lineitem)
        UNION ALL
        SELECT '-1', 'Daily' FROM (SELECT DISTINCT l_suppkey % 5 AS k FROM lineitem) WHERE k = 0"""),
    "fx_datasource_dup": (["fx_datasource"], """
        SELECT * FROM fx_datasource UNION ALL SELECT * FROM fx_datasource WHERE data_source_code = 'DS1'"""),
    "fx_product": ([], """
        SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_code, p_name AS product_name,
               p_type AS signature_name, p_brand AS brand_name,
               'MG' || CAST(p_size % 7 AS VARCHAR) AS material_group_code, 'P360' AS source_project,
               CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS division_code
        FROM (SELECT * FROM part WHERE p_size <= 45 UNION ALL SELECT * FROM part WHERE p_size <= 5)"""),
    "fx_product_sap": ([], f"""
        SELECT CASE p_size % 4 WHEN 0 THEN lpad(CAST(p_partkey AS VARCHAR), 8, '0')
                               WHEN 1 THEN 'P54_' || lpad(CAST(p_partkey AS VARCHAR), 8, '0')
                               WHEN 2 THEN 'P05_' || lpad(CAST(p_partkey AS VARCHAR), 8, '0')
                               ELSE 'P65_' || ({_SAP_CODE.format(k='p_partkey')}) END AS product_code,
               CASE WHEN p_size > 40 THEN 'LEGACY' ELSE 'P360' END AS source_project,
               CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'ACD' END AS division_code
        FROM part"""),
    "fx_signature": ([], """
        SELECT '00' || CAST(k AS VARCHAR) AS signature_code,
               CASE k % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS division
        FROM (SELECT DISTINCT l_partkey % 7 AS k FROM lineitem) WHERE k <= 4"""),
    "fx_calendar": ([], """
        SELECT d AS date_time, CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month,
               CAST(d - (isodow(d) - 1) * INTERVAL 1 DAY AS DATE) AS week_start_date,
               CAST(weekofyear(d) AS BIGINT) AS week_num
        FROM (SELECT CAST(unnest(generate_series(date_trunc('week', make_date(CAST(a AS BIGINT), 1, 1)),
                                                 make_date(CAST(b AS BIGINT), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT year(min(CAST(l_shipdate AS DATE))) AS a, year(max(CAST(l_shipdate AS DATE))) AS b
                    FROM lineitem))"""),
    "fx_store_start": (["fx_pos"], """
        SELECT market_code AS market, 'N' || CAST(nationkey AS VARCHAR) AS platform,
               'S' || CAST(suppkey AS VARCHAR) AS oms_store_code,
               CASE WHEN suppkey % 8 = 0 THEN DATE '1999-06-15' ELSE DATE '2000-03-15' END AS store_created_date
        FROM fx_pos WHERE suppkey % 4 = 0"""),
    "fx_sku_traffic": (["fx_fact_sellout"], """
        SELECT market_code, division_code AS division, 'N' || CAST(nationkey AS VARCHAR) AS client,
               'S' || CAST(suppkey AS VARCHAR) AS platform_store_id, 'D' AS period, 'sku traffic' AS file_type,
               CASE WHEN partkey % 50 = 0 THEN 'PH' WHEN partkey % 50 = 1 THEN NULL
                    ELSE 'S' || CAST(partkey % 7 AS VARCHAR) END AS sap_signature_code,
               sellout_date AS date_id,
               CASE WHEN quantity <= 5 THEN CAST(0 AS DECIMAL(18,4)) ELSE abs(consolidated_sales_eur) END
                   AS gross_sales,
               CAST(quantity AS BIGINT) AS gross_sold_units, CAST(1 AS BIGINT) AS gross_orders
        FROM fx_fact_sellout WHERE source_project = 'ECOMM_SKU_TRAFFIC'"""),
    "fx_amz": (["fx_fact_sellout"], f"""
        SELECT market_code, division_code AS sap_division_name, 'n' || CAST(nationkey AS VARCHAR) AS client,
               'D' AS period, 's' || CAST(suppkey AS VARCHAR) AS channel_type,
               CASE partkey % 6 WHEN 0 THEN '(blank)'
                                WHEN 1 THEN lpad(CAST(partkey AS VARCHAR), 13, '0')
                                WHEN 2 THEN '3.' || CAST(partkey AS VARCHAR) || 'E+12'
                                WHEN 3 THEN CAST(partkey AS VARCHAR) || '{GARBLED_NBSP}'
                                WHEN 4 THEN '--'
                                ELSE ' 00' || CAST(partkey AS VARCHAR) || chr(160) END AS ean_code,
               {_SAP_CODE.format(k='partkey')} AS sap_product_code,
               '000' || CAST(partkey % 7 AS VARCHAR) AS sap_signature_code,
               sellout_date AS date_id,
               CASE WHEN market_code = 'AU' AND quantity <= 5 THEN CAST(0 AS BIGINT)
                    ELSE CAST(quantity AS BIGINT) END AS shipped_units,
               abs(consolidated_sales_eur) AS shipped_revenue,
               CASE WHEN market_code <> 'AU' AND quantity <= 5 THEN NULL
                    ELSE CAST(quantity AS BIGINT) END AS ordered_units,
               CASE WHEN market_code <> 'AU' AND quantity <= 5 THEN CAST(0 AS DECIMAL(18,4))
                    ELSE abs(consolidated_sales_eur) END AS ordered_revenue
        FROM fx_fact_sellout WHERE source_project = 'ECOM_AMZ'"""),
    "fx_fact_sellthrough": (["fx_fact_sellout"], """
        SELECT division_code, market_code, 'D' || CAST(suppkey AS VARCHAR) AS distributor_code, product_code,
               data_source, unique_id, sellout_date AS sellthrough_date, consolidated_sales_eur
        FROM fx_fact_sellout"""),
    "fx_distributor": ([], """
        SELECT 'D' || CAST(s_suppkey AS VARCHAR) AS distributor_code, s_name AS distributor_name,
               'L' || CAST(s_suppkey % 3 AS VARCHAR) AS channel_level2
        FROM supplier"""),
    "fx_distributor_dup": (["fx_distributor"], """
        SELECT * FROM fx_distributor
        UNION ALL
        SELECT * FROM fx_distributor WHERE CAST(substr(distributor_code, 2) AS BIGINT) % 10 = 0"""),
    "fx_stock_flat": (["fx_fact_sellout", "fx_pos"], """
        SELECT f.division_code AS division_amaas, f.sellout_date AS tech_period_end_date,
               f.market_code AS orga_country_alpha2, p.s_name AS distributor_name,
               f.data_source AS data_file_provider,
               CASE WHEN f.linenumber = 7 THEN NULL
                    WHEN f.linenumber = 1 THEN -CAST(f.quantity AS BIGINT)
                    ELSE CAST(f.quantity AS BIGINT) END AS total_stock_units,
               CASE pt.p_size WHEN 1 THEN '' WHEN 2 THEN '-1' WHEN 3 THEN 'unspecified' WHEN 4 THEN NULL
                    ELSE pt.p_brand END AS brand_code,
               CAST(1.0 + (f.suppkey % 4) * 0.25 AS DOUBLE) AS conversion_rate,
               'D' || CAST(f.suppkey AS VARCHAR) AS distributor_code, p.channel_level1 AS orga_region_description,
               CASE pt.p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS orga_division,
               '00' || CAST(f.partkey % 7 AS VARCHAR) AS signature_code, pt.p_type AS signature_desc,
               'AX' || CAST(pt.p_size % 4 AS VARCHAR) AS axis_code, 'Axis ' || CAST(pt.p_size % 4 AS VARCHAR) AS axis_desc,
               pt.p_brand AS brand_desc,
               'SX' || CAST(pt.p_size % 6 AS VARCHAR) AS subaxis_code,
               'Sub axis ' || CAST(pt.p_size % 6 AS VARCHAR) AS subaxis_desc,
               'SB' || CAST(pt.p_size % 5 AS VARCHAR) AS subbrand_code,
               'Sub brand ' || CAST(pt.p_size % 5 AS VARCHAR) AS subbrand_desc
        FROM fx_fact_sellout f JOIN part pt ON f.partkey = pt.p_partkey JOIN fx_pos p ON f.suppkey = p.suppkey"""),
    "fx_ref_brand": ([], "SELECT p_brand AS brand_code FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2')"),
    "fx_ref_rate": ([], """
        SELECT CAST(1.0 + (s_suppkey % 4) * 0.25 AS DECIMAL(38,9)) AS exchange_rate FROM supplier
        WHERE s_suppkey % 4 <> 3"""),
    "fx_ref_product": ([], """
        SELECT CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' END AS division_code,
               CASE WHEN p_partkey % 7 <= 4 THEN '00' || CAST(p_partkey % 7 AS VARCHAR) END AS signature_code,
               CASE WHEN p_size % 2 = 0 THEN p_type END AS signature_name,
               CASE WHEN p_size % 4 < 3 THEN 'AX' || CAST(p_size % 4 AS VARCHAR) END AS axe_code,
               CASE WHEN p_size % 4 < 3 THEN 'Axis ' || CAST(p_size % 4 AS VARCHAR) END AS axe_name,
               CASE WHEN p_brand NOT IN ('Brand#1', 'Brand#2') THEN p_brand END AS brand_code,
               CASE WHEN p_brand NOT IN ('Brand#1', 'Brand#2') THEN p_brand END AS brand_name,
               CASE WHEN p_size % 6 < 4 THEN 'SX' || CAST(p_size % 6 AS VARCHAR) END AS sub_axe_code,
               CASE WHEN p_size % 6 < 4 THEN 'Sub axis ' || CAST(p_size % 6 AS VARCHAR) END AS sub_axe_name,
               CASE WHEN p_size % 5 <> 2 THEN 'SB' || CAST(p_size % 5 AS VARCHAR) END AS sub_brand_code,
               CASE WHEN p_size % 5 <> 2 THEN 'Sub brand ' || CAST(p_size % 5 AS VARCHAR) END AS sub_brand_name
        FROM part"""),
    "fx_general_data": ([], """
        SELECT CASE WHEN s_suppkey % 10 <> 3 THEN 'D' || CAST(s_suppkey AS VARCHAR) END
                   AS business_partner_number_external_system,
               CASE WHEN s_suppkey % 4 <> 1 THEN s_name END AS organization_legal_name_1
        FROM supplier"""),
    "fx_ref_market": ([], "SELECT r_name AS zone_code FROM region WHERE r_regionkey <> 2"),
    "fx_fact_exact": (["fx_fact_sellout"], """
        SELECT * REPLACE (CAST(CAST(consolidated_sales_eur AS DECIMAL(20,9))
                               + CAST(CAST('0.123456789' AS DECIMAL(10,9)) * CAST(linenumber AS DECIMAL(2,0)) AS DECIMAL(20,9))
                          AS DECIMAL(38,9)) AS consolidated_sales_eur) FROM fx_fact_sellout"""),
    "fx_datasource_nulls": (["fx_datasource"], """
        SELECT * FROM fx_datasource
        UNION ALL SELECT 'DS4', NULL FROM fx_datasource WHERE data_source_code = 'DS1'
        UNION ALL SELECT NULL, 'Daily' FROM fx_datasource WHERE data_source_code = 'DS1'"""),
    "fx_sku_traffic_nulls": (["fx_sku_traffic"], """
        SELECT * REPLACE (
            CASE WHEN gross_sold_units % 11 <> 3 THEN market_code END AS market_code,
            CASE WHEN gross_sold_units % 13 <> 4 THEN client END AS client,
            CASE WHEN gross_sold_units % 7 <> 5 THEN platform_store_id END AS platform_store_id,
            CASE WHEN gross_sold_units % 5 <> 1 THEN gross_sales END AS gross_sales,
            CASE WHEN gross_sold_units % 5 <> 1 THEN gross_orders END AS gross_orders,
            CASE WHEN gross_sold_units % 3 = 0 THEN 'ACD' ELSE division END AS division) FROM fx_sku_traffic"""),
    "fx_amz_nulls": (["fx_amz"], """
        SELECT * EXCLUDE (q, blank) REPLACE (
            CASE WHEN q % 11 <> 3 THEN market_code END AS market_code,
            CASE WHEN q % 13 <> 4 THEN client END AS client,
            CASE WHEN q % 7 <> 5 THEN channel_type END AS channel_type,
            CASE WHEN q % 5 <> 2 THEN sap_signature_code END AS sap_signature_code,
            CASE WHEN q % 5 <> 2 THEN sap_product_code END AS sap_product_code,
            CASE WHEN NOT blank OR sap_product_code LIKE '%1' THEN shipped_units END AS shipped_units,
            CASE WHEN NOT blank OR sap_product_code LIKE '%1' THEN ordered_units END AS ordered_units,
            CASE WHEN blank AND sap_product_code LIKE '%3' THEN 0 ELSE ordered_revenue END AS ordered_revenue,
            CASE WHEN q % 4 = 1 THEN 'ACD' ELSE sap_division_name END AS sap_division_name)
        FROM (SELECT *, coalesce(shipped_units, ordered_units, 0) AS q,
                     market_code = 'AU' AND coalesce(shipped_units, ordered_units, 0) = 0 AS blank FROM fx_amz)"""),
    "fx_fact_nulls": (["fx_fact_sellout"], """
        SELECT * REPLACE (
            CASE WHEN partkey % 7 <> 0 THEN unique_id END AS unique_id,
            CASE WHEN partkey % 11 <> 0 THEN product_code END AS product_code,
            CASE WHEN partkey % 13 <> 0 THEN point_of_sale_code END AS point_of_sale_code,
            CASE WHEN partkey % 17 <> 0 THEN data_source END AS data_source,
            CASE WHEN partkey % 19 <> 0 THEN market_code END AS market_code,
            CASE WHEN partkey % 23 <> 0 THEN division_code END AS division_code,
            CASE WHEN partkey % 5 <> 0 THEN consolidated_sales_eur END AS consolidated_sales_eur) FROM fx_fact_sellout"""),
}


FIXTURES["fx_fact_sellthrough_nulls"] = (["fx_fact_nulls"], """
        SELECT division_code, market_code,
               CASE WHEN point_of_sale_code IS NOT NULL THEN 'D' || CAST(suppkey AS VARCHAR) END AS distributor_code, product_code,
               data_source, unique_id, sellout_date AS sellthrough_date, consolidated_sales_eur
        FROM fx_fact_nulls""")
FIXTURES["fx_stock_flat_nulls"] = (["fx_fact_nulls", "fx_pos"],
                                   FIXTURES["fx_stock_flat"][1].replace("fx_fact_sellout", "fx_fact_nulls"))
FIXTURES["fx_ean_mapping"] = ([], """
        SELECT CASE WHEN k % 9 = 0 THEN '0000000000000' WHEN k % 9 = 1 THEN '  ' WHEN k % 9 <> 2 THEN lpad(CAST(k AS VARCHAR), 13, '0') END
                   AS ean_code,
               m AS src_market_code, m AS market_code, CASE WHEN (k + i) % 3 <> 0 THEN m ELSE 'ZZ' END AS prioritized_market_code,
               'SKU' || CAST(k AS VARCHAR) || copy AS sku_code
        FROM (SELECT p_partkey AS k, unnest(if(p_partkey % 10 = 0, ['a', 'b'], ['a'])) AS copy FROM part)
        CROSS JOIN (VALUES (0, 'AU'), (1, 'SG'), (2, 'SA')) markets(i, m)""")


def with_fixtures(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause holding the named fixtures (and their dependencies), then ``extra`` CTEs, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in FIXTURES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    facts = {"fx_pos", "fx_fact_sellout", "fx_fact_nonzero", "fx_sku_traffic", "fx_amz"} if extra and len(extra) > 5 else set()
    ctes = [f"{n} AS {'MATERIALIZED ' if n in facts else ''}({FIXTURES[n][1]}\n)" for n in order]
    # steps that several later ones read are computed once
    once = re.compile(r"(m[1-5]|[ea]_[dwm]|z_(sku|amz)|final|was|now_)$")
    ctes += [f"{n} AS {'MATERIALIZED ' if once.search(n) else ''}({sql}\n)" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body
