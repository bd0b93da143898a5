"""All models over tables in which single keys hold a third of the rows and more."""

from pathlib import Path

import duckdb
import pytest
from compare import connect, differences

from tallyhouse.plans.oracle import ORACLE
from tallyhouse.plans.registry import QUERIES
from tallyhouse.plans.warehouse import MODELS

HOT = {
    # one order with one product in a third of the lines, and one line repeated 3,000 times
    "lineitem": """
        WITH numbered AS (SELECT *, row_number() OVER () AS n FROM lineitem),
        hot AS (
            SELECT * EXCLUDE (n) REPLACE (
                if(n % 3 = 0, 42, l_orderkey) AS l_orderkey,
                if(n % 3 = 0, 7, l_partkey) AS l_partkey)
            FROM numbered
        )
        FROM hot UNION ALL FROM hot WHERE l_orderkey = 42
        UNION ALL (SELECT once.* FROM (FROM hot LIMIT 1) once, range(3000))""",
    # one customer with a third of the orders, on one day
    "orders": """
        SELECT * REPLACE (
            if(o_orderkey % 3 = 1, 11, o_custkey) AS o_custkey,
            if(o_orderkey % 3 = 1, TIMESTAMP '1997-07-07', o_orderdate) AS o_orderdate)
        FROM orders""",
    # one country with half of the customers
    "customer": """
        SELECT * REPLACE (if(c_custkey % 2 = 1, 3, c_nationkey) AS c_nationkey)
        FROM customer""",
}


@pytest.fixture(scope="module")
def skewed(small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    given = connect(small)
    for path in Path(small).glob("*.parquet"):
        sql = HOT.get(path.stem, f"FROM {path.stem}")
        given.execute(f"COPY ({sql}) TO '{folder}/{path.name}' (FORMAT parquet)")
    return str(folder)


def test_fixture_is_skewed(skewed):
    lines, orders = (f"'{skewed}/{name}.parquet'" for name in ("lineitem", "orders"))
    share = duckdb.sql(
        f"SELECT (SELECT count(*) FILTER (l_orderkey = 42) / count(*) FROM {lines}),"
        f" (SELECT count(*) FILTER (o_custkey = 11) / count(*) FROM {orders})"
    ).fetchall()[0]
    assert min(share) > 0.3


@pytest.mark.parametrize(
    "name", ["raw_dedup", *MODELS, "revenue_concentration", "fct_invoice_lines_lookback"]
)
def test_models_under_skew(spark, skewed, name):
    assert differences(QUERIES[name](spark, skewed), connect(skewed), ORACLE[name]) == []
