"""Rule catalogues (C1-C4): which table and column a rule parameter resolves to.

Logical table names are looked up in a ``tables`` mapping (name -> DataFrame)
that the caller supplies, so no catalog or storage naming is baked in.
"""

from __future__ import annotations

from dataclasses import dataclass

FACT_SELLOUT = "vw_fact_sellout"
FACT_SELLTHROUGH = "vw_fact_sellthrough"
DIM_PRODUCT = "vw_dim_product"
DIM_POS = "vw_dim_point_of_sales"
DIM_DATASOURCE = "vw_dim_datasource"
DIM_DISTRIBUTOR = "vw_dim_distributor"
STOCK = "stock_in_trade"


@dataclass(frozen=True)
class AttributeSource:
    """C1 entry: the dimension to LEFT join (None for a fact column), its key, the value column."""

    dim: str | None
    join_key: str | None
    column: str


@dataclass(frozen=True)
class KeyReference:
    """C3/C4 entry: fact column, the dimension holding the key, and the dimension column."""

    fact_column: str
    dim: str
    dim_column: str


@dataclass(frozen=True)
class ReferenceColumn:
    """C2 entry: the reference table and the column the struct value must occur in."""

    table: str
    column: str


# Attribute-condition sources, by source table and column.
ATTRIBUTE_SOURCES: dict[str, dict[str, AttributeSource]] = {
    FACT_SELLOUT: {
        "market_code": AttributeSource(None, None, "market_code"),
        "order_number": AttributeSource(None, None, "order_number"),
        "data_source": AttributeSource(None, None, "data_source"),
    },
    DIM_PRODUCT: {
        "product_name": AttributeSource(DIM_PRODUCT, "product_code", "product_name"),
        "signature_name": AttributeSource(DIM_PRODUCT, "product_code", "signature_name"),
        "brand_name": AttributeSource(DIM_PRODUCT, "product_code", "brand_name"),
        "material_group_code": AttributeSource(DIM_PRODUCT, "product_code", "material_group_code"),
    },
    DIM_POS: {
        "point_of_sale_code": AttributeSource(DIM_POS, "point_of_sale_code", "point_of_sale_code"),
        "channel_level2": AttributeSource(DIM_POS, "point_of_sale_code", "channel_level2"),
        "channel_level1": AttributeSource(DIM_POS, "point_of_sale_code", "channel_level1"),
    },
}

# Stock struct path -> reference table and column.
GENERAL_DATA = "general_data"
EXCHANGE_RATE = "fact_exchange_rate"
DIM_MARKET = "dim_market"
REF_PRODUCT = "dim_product_reference"
STOCK_REFERENCES: dict[str, ReferenceColumn] = {
    "DISTRIBUTOR.distributor_code": ReferenceColumn(GENERAL_DATA, "business_partner_number_external_system"),
    "DISTRIBUTOR.distributor_name": ReferenceColumn(GENERAL_DATA, "organization_legal_name_1"),
    "CURRENCY.conversion_rate": ReferenceColumn(EXCHANGE_RATE, "exchange_rate"),
    "GEOGRAPHY.orga_region_description": ReferenceColumn(DIM_MARKET, "zone_code"),
    "PRODUCT.orga_division": ReferenceColumn(REF_PRODUCT, "division_code"),
    "PRODUCT.signature_code": ReferenceColumn(REF_PRODUCT, "signature_code"),
    "PRODUCT.signature_desc": ReferenceColumn(REF_PRODUCT, "signature_name"),
    "PRODUCT.axis_code": ReferenceColumn(REF_PRODUCT, "axe_code"),
    "PRODUCT.axis_desc": ReferenceColumn(REF_PRODUCT, "axe_name"),
    "PRODUCT.brand_code": ReferenceColumn(REF_PRODUCT, "brand_code"),
    "PRODUCT.brand_desc": ReferenceColumn(REF_PRODUCT, "brand_name"),
    "PRODUCT.subaxis_code": ReferenceColumn(REF_PRODUCT, "sub_axe_code"),
    "PRODUCT.subaxis_desc": ReferenceColumn(REF_PRODUCT, "sub_axe_name"),
    "PRODUCT.subbrand_code": ReferenceColumn(REF_PRODUCT, "sub_brand_code"),
    "PRODUCT.subbrand_desc": ReferenceColumn(REF_PRODUCT, "sub_brand_name"),
}

# Keys of the dimension-uniqueness rule.  The fact names the data-source
# key ``data_source`` while the dimension names it ``data_source_code``.
UNIQUENESS_KEYS: dict[str, KeyReference] = {
    "product_code": KeyReference("product_code", DIM_PRODUCT, "product_code"),
    "point_of_sale_code": KeyReference("point_of_sale_code", DIM_POS, "point_of_sale_code"),
    "data_source_code": KeyReference("data_source", DIM_DATASOURCE, "data_source_code"),
}

# C4: keys of the reference-integrity rule.  The catalogue names them with a
# struct prefix; on the flat sell-out fact they resolve to the plain column.
INTEGRITY_KEYS: dict[str, KeyReference] = {
    "PRODUCT.product_code": KeyReference("product_code", DIM_PRODUCT, "product_code"),
    "POINT_OF_SALE.point_of_sale_code": KeyReference("point_of_sale_code", DIM_POS, "point_of_sale_code"),
    "DATA_SOURCE.data_source_code": KeyReference("data_source", DIM_DATASOURCE, "data_source_code"),
}
