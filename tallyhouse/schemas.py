"""Fixed schemas: the given star tables, the landing table and the region seed."""

from __future__ import annotations

RAW_COLUMNS = [
    "invoice",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "price",
    "customer_id",
    "country",
    "_source_sheet",
    "_loaded_at",
]

RAW_SCHEMA = (
    "invoice string, stock_code string, description string, quantity bigint,"
    " invoice_date timestamp_ntz, price double, customer_id string, country string,"
    " _source_sheet string, _loaded_at timestamp_ntz"
)

COUNTRY_REGION_SCHEMA = "country string, region string"

LINE_FACT_SCHEMA = (
    "invoice_line_id string, invoice_id string, customer_id string, stock_code string,"
    " invoice_date date, invoice_month date, quantity int, unit_price double,"
    " line_revenue double, is_cancellation boolean, is_return boolean, is_guest boolean"
)

STAR_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
        " c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}
