"""DuckDB SQL that states what each registered query must return.

Written from the business rules, not from the Spark plans: windows instead of
two-step aggregates, plain sums of doubles instead of cents, ntile and row_number as
such. Every statement starts from the given tables.

Totals that are rounded to whole units are added as decimals: they can be an exact
half, and then the order in which doubles are added would decide the result.
"""

from __future__ import annotations


# name of each step, and the select behind it; a step may use the ones before it
STEPS: dict[str, str] = {}

STEPS["shop"] = """
    SELECT
        concat(if(o_orderkey % 25 = 0, 'C', ''), o_orderkey::VARCHAR) AS invoice,
        concat(' sku', l_partkey::VARCHAR, ' ') AS stock_code,
        CASE l_partkey % 50 WHEN 0 THEN ' ' WHEN 1 THEN p_name || chr(10) || '"boxed", new'
            ELSE p_name END AS description,
        (if(o_orderkey % 25 = 0 OR l_partkey % 97 = 0 OR (l_returnflag = 'R' AND l_tax = 0.08),
            -1, 1) * l_quantity)::INTEGER AS quantity,
        o_orderdate + to_minutes(o_orderkey % 1440) AS invoice_date,
        if(l_discount = 0.10, 0.0::DOUBLE, round(l_extendedprice / l_quantity, 2)) AS price,
        if(o_custkey % 5 = 0, NULL, concat(o_custkey::VARCHAR, '.0')) AS customer_id,
        ' ' || n_name AS country,
        if(year(o_orderdate) < 1999, 'Year A', 'Year B') AS _source_sheet,
        o_orderkey % 97 = 0 AS repeated
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN part ON l_partkey = p_partkey"""

STEPS["sheets"] = """
    SELECT * EXCLUDE (repeated) FROM shop
    UNION ALL
    SELECT * EXCLUDE (repeated) REPLACE ('Year C' AS _source_sheet) FROM shop WHERE repeated"""

STEPS["typed"] = """
    SELECT
        trim(invoice) AS invoice,
        trim(stock_code) AS stock_code,
        trim(description) AS description,
        quantity::BIGINT AS quantity,
        invoice_date,
        price,
        customer_id::DOUBLE::BIGINT::VARCHAR AS customer_id,
        trim(country) AS country,
        _source_sheet
    FROM sheets"""

STEPS["damaged"] = """
    SELECT
        l_orderkey::VARCHAR AS invoice, l_linenumber::VARCHAR AS stock_code,
        NULL::VARCHAR AS description,
        if(l_partkey % 8 IN (0, 1), NULL, l_quantity::BIGINT) AS quantity,
        CASE l_partkey % 8 WHEN 5 THEN NULL WHEN 6 THEN TIMESTAMP '2011-03-13 02:30:00'
            WHEN 7 THEN NULL ELSE date_trunc('day', l_shipdate)::TIMESTAMP END AS invoice_date,
        if(l_partkey % 8 IN (2, 3, 4, 5), NULL, l_extendedprice::DECIMAL(18, 2)::DOUBLE) AS price,
        if(l_partkey % 8 IN (1, 2), NULL, l_suppkey::VARCHAR) AS customer_id,
        'Nowhere' AS country, 'Damaged' AS _source_sheet
    FROM lineitem"""

STEPS["rejections"] = """
    SELECT
        count(*) FILTER (l_partkey % 8 IN (0, 1)) AS quantity,
        count(*) FILTER (l_partkey % 8 IN (2, 3, 4, 5)) AS price,
        count(*) FILTER (l_partkey % 8 IN (5, 7)) AS invoice_date,
        count(*) FILTER (l_partkey % 8 IN (1, 2)) AS customer_id
    FROM lineitem"""

STEPS["scanned_once"] = """
    SELECT * FROM typed
    QUALIFY row_number() OVER (
        PARTITION BY invoice, stock_code, quantity, price, invoice_date, customer_id
        ORDER BY _source_sheet NULLS FIRST, description NULLS FIRST, country NULLS FIRST
    ) = 1"""

STEPS["landed"] = """
    SELECT *, TIMESTAMP '2001-12-01 06:00:00' AS _loaded_at FROM scanned_once"""

STEPS["staged"] = """
    WITH words AS (
        SELECT
            trim(invoice) AS invoice_id, upper(trim(stock_code)) AS stock_code,
            if(trim(description) = '', NULL, trim(description)) AS description,
            customer_id,
            if(trim(country) = '', NULL, trim(country)) AS country,
            quantity::INTEGER AS quantity, price AS unit_price,
            invoice_date AS invoiced_at, invoice_date::DATE AS invoice_date,
            _source_sheet, _loaded_at
        FROM landed
        WHERE invoice IS NOT NULL AND stock_code IS NOT NULL
    )
    SELECT
        md5(concat_ws('-', invoice_id, stock_code,
            ifnull(invoiced_at::VARCHAR, '_dbt_utils_surrogate_key_null_'),
            ifnull(quantity::VARCHAR, '_dbt_utils_surrogate_key_null_'),
            ifnull(unit_price::VARCHAR, '_dbt_utils_surrogate_key_null_'),
            ifnull(customer_id, '_dbt_utils_surrogate_key_null_'))) AS invoice_line_id,
        invoice_id, stock_code, description, customer_id, country, quantity, unit_price,
        round(quantity * unit_price, 2) + 0.0::DOUBLE AS line_revenue,
        invoiced_at, invoice_date,
        starts_with(invoice_id, 'C') AS is_cancellation,
        quantity < 0 AS is_return,
        customer_id IS NULL AS is_guest,
        unit_price <= 0 AS is_non_revenue,
        _source_sheet, _loaded_at
    FROM words"""

STEPS["revenue_lines"] = """
    SELECT
        * EXCLUDE (is_non_revenue, _source_sheet, _loaded_at),
        date_trunc('month', invoice_date)::DATE AS invoice_month
    FROM staged
    WHERE unit_price > 0 AND quantity IS NOT NULL"""

STEPS["line_facts"] = """
    SELECT * EXCLUDE (description, country, invoiced_at) FROM revenue_lines"""

STEPS["invoices"] = """
    SELECT
        invoice_id,
        min(customer_id) AS customer_id,
        min(country) AS country,
        min(invoiced_at) AS ordered_at,
        min(invoice_date) AS order_date,
        min(invoice_month) AS order_month,
        count(*) AS n_lines,
        sum(quantity)::BIGINT AS total_quantity,
        round(sum(line_revenue), 2) AS order_revenue,
        max(is_cancellation::INTEGER) = 1 AS is_cancellation,
        min(is_guest::INTEGER) = 1 AS is_guest
    FROM revenue_lines
    GROUP BY invoice_id"""

STEPS["sales"] = "SELECT * FROM invoices WHERE is_cancellation = false"

STEPS["buyers"] = """
    WITH own AS (
        SELECT
            *,
            max(order_date) OVER () AS today,
            row_number() OVER (
                PARTITION BY customer_id
                ORDER BY country IS NULL, ordered_at DESC, country DESC
            ) AS newest
        FROM sales
        WHERE customer_id IS NOT NULL
    )
    SELECT
        customer_id,
        max(country) FILTER (newest = 1) AS country,
        min(order_date) AS first_order_date,
        max(order_date) AS last_order_date,
        date_trunc('month', min(order_date))::DATE AS cohort_month,
        count(DISTINCT invoice_id) AS lifetime_orders,
        sum(total_quantity)::BIGINT AS lifetime_units,
        round(sum(order_revenue), 2) AS lifetime_revenue,
        round(round(sum(order_revenue), 2) / count(DISTINCT invoice_id), 2) AS avg_order_value,
        (any_value(today) - max(order_date))::BIGINT AS recency_days,
        (max(order_date) - min(order_date))::BIGINT AS tenure_days
    FROM own
    GROUP BY customer_id"""

STEPS["goods"] = """
    WITH named AS (
        SELECT stock_code, description FROM revenue_lines
        WHERE description IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY stock_code ORDER BY invoice_date DESC, description DESC
        ) = 1
    ),
    moved AS (
        SELECT
            stock_code,
            count(DISTINCT invoice_id) AS n_orders,
            ifnull(sum(quantity) FILTER (quantity > 0), 0)::BIGINT AS units_sold,
            ifnull(-sum(quantity) FILTER (quantity < 0), 0)::BIGINT AS units_returned,
            round(sum(line_revenue), 2) AS total_revenue
        FROM revenue_lines
        GROUP BY stock_code
    )
    SELECT
        stock_code, description, n_orders, units_sold, units_returned, total_revenue,
        if(units_sold = 0, NULL, round(units_returned / units_sold, 4)) AS return_rate
    FROM moved LEFT JOIN named USING (stock_code)"""

STEPS["calendar"] = """
    SELECT
        day::DATE AS date_key,
        year(day) AS year,
        quarter(day) AS quarter,
        month(day) AS month,
        day(day) AS day_of_month,
        date_trunc('month', day)::DATE AS month_start,
        strftime(day, '%Y-%m') AS year_month,
        dayofweek(day) AS day_of_week,
        dayofweek(day) IN (0, 6) AS is_weekend
    FROM (
        SELECT unnest(generate_series(
            date_trunc('year', min(order_date))::TIMESTAMP,
            date_trunc('year', max(order_date))::TIMESTAMP + INTERVAL 1 YEAR - INTERVAL 1 DAY,
            INTERVAL 1 DAY)) AS day
        FROM invoices
    )"""

STEPS["by_day"] = """
    WITH sold AS (
        SELECT
            order_date,
            count(*) AS n_orders,
            count(DISTINCT customer_id) AS n_active_customers,
            count(DISTINCT customer_id) FILTER (order_date = first_order_date)
                AS n_new_customers,
            sum(total_quantity)::BIGINT AS n_units,
            round(sum(order_revenue), 2) AS revenue
        FROM sales LEFT JOIN (SELECT customer_id, first_order_date FROM buyers)
            USING (customer_id)
        GROUP BY order_date
    )
    SELECT
        date_key AS order_date,
        ifnull(n_orders, 0) AS n_orders,
        ifnull(n_active_customers, 0) AS n_active_customers,
        ifnull(n_new_customers, 0) AS n_new_customers,
        ifnull(n_active_customers - n_new_customers, 0) AS n_returning_customers,
        ifnull(n_units, 0) AS n_units,
        ifnull(revenue, 0.0::DOUBLE) AS revenue,
        round(revenue / n_orders, 2) AS avg_order_value
    FROM calendar LEFT JOIN sold ON date_key = order_date
    WHERE date_key >= (SELECT min(order_date) FROM sales)
      AND date_key <= (SELECT max(order_date) FROM sales)"""

STEPS["by_month"] = """
    WITH sold AS (
        SELECT
            order_month AS month,
            count(*) AS n_orders,
            count(DISTINCT customer_id) AS n_active_customers,
            count(DISTINCT customer_id) FILTER (order_date = first_order_date)
                AS n_new_customers,
            round(sum(order_revenue), 2) AS revenue
        FROM sales LEFT JOIN (SELECT customer_id, first_order_date FROM buyers)
            USING (customer_id)
        GROUP BY order_month
    ),
    paired AS (SELECT *, lag(revenue) OVER (ORDER BY month) AS earlier FROM sold)
    SELECT
        month, n_orders, n_active_customers, n_new_customers,
        n_active_customers - n_new_customers AS n_returning_customers,
        revenue,
        round(revenue / n_orders, 2) AS avg_order_value,
        round(revenue - earlier, 2) AS revenue_mom_change,
        if(earlier = 0, NULL, round((revenue - earlier) / earlier * 100, 1)) AS revenue_mom_pct
    FROM paired"""

STEPS["retention"] = """
    WITH active AS (
        SELECT
            cohort_month, order_month AS activity_month,
            count(DISTINCT customer_id) AS n_active_customers
        FROM sales JOIN (SELECT customer_id, cohort_month FROM buyers) USING (customer_id)
        GROUP BY ALL
    ),
    sized AS (SELECT cohort_month, count(*) AS cohort_customers FROM buyers GROUP BY ALL)
    SELECT
        cohort_month, cohort_customers,
        date_diff('month', cohort_month, activity_month) AS months_since_cohort,
        activity_month, n_active_customers,
        round(n_active_customers / cohort_customers, 4) AS retention_rate
    FROM active JOIN sized USING (cohort_month)"""

STEPS["scores"] = """
    WITH tiles AS (
        SELECT
            customer_id, country, recency_days,
            lifetime_orders AS frequency, lifetime_revenue AS monetary,
            6 - ntile(5) OVER (ORDER BY recency_days, customer_id) AS r_score,
            ntile(5) OVER (ORDER BY lifetime_orders, customer_id) AS f_score,
            ntile(5) OVER (ORDER BY lifetime_revenue, customer_id) AS m_score
        FROM buyers
    )
    SELECT
        *,
        r_score + f_score + m_score AS rfm_total,
        CASE
            WHEN f_score >= 4 AND r_score >= 4 THEN 'Champions'
            WHEN f_score >= 4 AND r_score = 1 THEN 'Cannot Lose Them'
            WHEN f_score = 3 AND r_score = 1 THEN 'Needs Attention'
            WHEN f_score >= 3 AND r_score = 2 THEN 'At Risk'
            WHEN f_score >= 3 THEN 'Loyal Customers'
            WHEN r_score >= 4 THEN 'New / Promising'
            WHEN r_score = 3 THEN 'Potential Loyalists'
            ELSE 'Hibernating / Lost'
        END AS rfm_segment
    FROM tiles"""

STEPS["regions"] = """
    SELECT n_name AS country, r_name AS region
    FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE n_nationkey % 10 <> 7"""


def _by_country(regions: str) -> str:
    return f"""
    WITH sold AS (
        SELECT
            country,
            count(DISTINCT customer_id) AS n_customers,
            count(*) AS n_orders,
            round(sum(order_revenue), 2) AS revenue
        FROM sales
        GROUP BY country
    )
    SELECT
        sold.country,
        ifnull(seed.region, 'Other') AS region,
        n_customers, n_orders, revenue,
        round(revenue / n_orders, 2) AS avg_order_value,
        round(revenue / (SELECT sum(revenue) FROM sold) * 100, 2) AS revenue_share_pct
    FROM sold
    LEFT JOIN {regions} seed ON lower(trim(seed.country)) = lower(trim(sold.country))"""


STEPS["by_country"] = _by_country("regions")

STEPS["leaders"] = """
    SELECT
        *,
        row_number() OVER (ORDER BY total_revenue DESC, stock_code) AS revenue_rank,
        round(total_revenue / (SELECT sum(total_revenue) FROM goods WHERE total_revenue > 0)
            * 100, 2) AS revenue_share_pct
    FROM goods
    WHERE total_revenue > 0"""

STEPS["health"] = """
    SELECT
        count(*) AS n_rows,
        count(DISTINCT invoice_id) AS n_invoices,
        count(DISTINCT customer_id) AS n_customers,
        count(DISTINCT stock_code) AS n_products,
        round(100.0::DOUBLE * count(*) FILTER (is_guest) / count(*), 2) AS pct_guest_lines,
        round(100.0::DOUBLE * count(*) FILTER (is_cancellation) / count(*), 2)
            AS pct_cancellation_lines,
        round(100.0::DOUBLE * count(*) FILTER (is_return) / count(*), 2) AS pct_return_lines,
        count(*) FILTER (is_non_revenue) AS n_non_revenue_lines,
        min(invoice_date) AS min_invoice_date,
        max(invoice_date) AS max_invoice_date,
        max(_loaded_at) AS last_loaded_at,
        (max(_loaded_at)::DATE - max(invoice_date))::BIGINT AS source_lag_days
    FROM staged"""

STEPS["first_delivery"] = """
    SELECT * FROM line_facts WHERE invoice_date <= DATE '1999-12-31' AND NOT is_return"""


STEPS["damaged_orders"] = """
    SELECT * EXCLUDE (n) REPLACE (
        if(n % 13 = 0, NULL, invoice_id) AS invoice_id,
        if(n % 11 = 0 AND customer_id IS NOT NULL, 'nobody', customer_id) AS customer_id)
    FROM (SELECT *, regexp_extract(invoice_id, '[0-9]+')::BIGINT AS n FROM invoices),
        LATERAL (SELECT unnest(range(if(n % 7 = 0, 2, 1)))) copies(c)"""

STEPS["damaged_buyers"] = """
    SELECT * REPLACE (
        if(customer_id::BIGINT % 5 = 1, -1, recency_days) AS recency_days,
        if(customer_id::BIGINT % 6 = 1, NULL, cohort_month) AS cohort_month)
    FROM buyers"""

STEPS["damaged_scores"] = """
    SELECT * REPLACE (
        if(customer_id::BIGINT % 4 = 1, 9, r_score) AS r_score,
        if(customer_id::BIGINT % 3 = 1, 'Lost', rfm_segment) AS rfm_segment)
    FROM scores"""


def _query(final: str) -> str:
    steps = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in STEPS.items())
    return f"WITH {steps}\n{final}"


# failing rows of each check, by kind ------------------------------------------------


def _unique(step: str, column: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {column} FROM {step} WHERE {column} IS NOT NULL"
        f" GROUP BY {column} HAVING count(*) > 1)"
    )


def _where(step: str, condition: str) -> str:
    return f"SELECT count(*) FROM {step} WHERE {condition}"


def _orphans(step: str, column: str, parent: str, scope: str = "true") -> str:
    return (
        f"SELECT count(*) FROM {step} child WHERE {column} IS NOT NULL AND {scope}"
        f" AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = child.{column})"
    )


def _report(failures: dict[str, str]) -> str:
    rows = [
        f"SELECT '{check}' AS check_id, ({sql})::BIGINT AS failures"
        for check, sql in failures.items()
    ]
    return _query("\nUNION ALL\n".join(rows))


def _key(table: str, step: str, column: str) -> dict[str, str]:
    return {
        f"{table}.{column}.unique": _unique(step, column),
        **_filled(table, step, column),
    }


def _filled(table: str, step: str, *columns: str) -> dict[str, str]:
    return {f"{table}.{c}.not_null": _where(step, f"{c} IS NULL") for c in columns}


_SEGMENTS = (
    "'Champions', 'Loyal Customers', 'New / Promising', 'Potential Loyalists', 'At Risk',"
    " 'Cannot Lose Them', 'Hibernating / Lost', 'Needs Attention'"
)

CHECK_SQL: dict[str, dict[str, str]] = {
    "dq_stg_online_retail": {
        **_key("stg_online_retail", "staged", "invoice_line_id"),
        **_filled(
            "stg_online_retail",
            "staged",
            "invoice_id",
            "stock_code",
            "quantity",
            "unit_price",
            "invoice_date",
        ),
        "stg_online_retail.is_cancellation.accepted_values": _where(
            "staged", "is_cancellation NOT IN (true, false)"
        ),
        "stg_online_retail.is_return.accepted_values": _where(
            "staged", "is_return NOT IN (true, false)"
        ),
    },
    "dq_int_invoice_lines": {
        **_key("int_invoice_lines_cleaned", "revenue_lines", "invoice_line_id"),
        "int_invoice_lines_cleaned.line_revenue.accepted_range": _where(
            "revenue_lines", "abs(line_revenue) > 200000"
        ),
    },
    "dq_int_orders": {
        **_key("int_orders", "invoices", "invoice_id"),
        **_filled("int_orders", "invoices", "order_date"),
    },
    "dq_fct_invoice_lines": {
        **_key("fct_invoice_lines", "line_facts", "invoice_line_id"),
        **_filled("fct_invoice_lines", "line_facts", "invoice_id", "stock_code"),
        "fct_invoice_lines.invoice_id.relationships": _orphans(
            "line_facts", "invoice_id", "invoices"
        ),
        "fct_invoice_lines.stock_code.relationships": _orphans(
            "line_facts", "stock_code", "goods"
        ),
    },
    "dq_fct_orders": {
        **_key("fct_orders", "invoices", "invoice_id"),
        "fct_orders.customer_id.relationships": _orphans(
            "invoices", "customer_id", "buyers", "NOT is_cancellation"
        ),
    },
    "dq_dim_customers": {
        **_key("dim_customers", "buyers", "customer_id"),
        **_filled("dim_customers", "buyers", "cohort_month"),
        "dim_customers.recency_days.accepted_range": _where("buyers", "recency_days < 0"),
    },
    "dq_dim_products": _key("dim_products", "goods", "stock_code"),
    "dq_dim_dates": _key("dim_dates", "calendar", "date_key"),
    "dq_mart_revenue_daily": {
        **_key("mart_revenue_daily", "by_day", "order_date"),
        **_filled("mart_revenue_daily", "by_day", "revenue"),
    },
    "dq_mart_revenue_monthly": _key("mart_revenue_monthly", "by_month", "month"),
    "dq_mart_customer_cohorts": {
        **_filled("mart_customer_cohorts", "retention", "retention_rate"),
        "mart_customer_cohorts.retention_rate.accepted_range": _where(
            "retention", "retention_rate NOT BETWEEN 0 AND 1"
        ),
        "mart_customer_cohorts.months_since_cohort.accepted_range": _where(
            "retention", "months_since_cohort < 0"
        ),
    },
    "dq_mart_rfm_segments": {
        **_key("mart_rfm_segments", "scores", "customer_id"),
        "mart_rfm_segments.r_score.accepted_range": _where(
            "scores", "r_score NOT BETWEEN 1 AND 5"
        ),
        "mart_rfm_segments.rfm_segment.accepted_values": _where(
            "scores", f"rfm_segment NOT IN ({_SEGMENTS})"
        ),
    },
    "dq_mart_country_performance": {
        **_key("mart_country_performance", "by_country", "country"),
        **_filled("mart_country_performance", "by_country", "region"),
    },
    "dq_mart_product_performance": {
        **_key("mart_product_performance", "leaders", "stock_code"),
        **_key("mart_product_performance", "leaders", "revenue_rank"),
    },
    "dq_mart_data_quality": {
        **_filled("mart_data_quality", "health", "n_rows"),
        "mart_data_quality.n_rows.accepted_range": _where("health", "n_rows < 1"),
        "mart_data_quality.pct_cancellation_lines.accepted_range": _where(
            "health", "pct_cancellation_lines NOT BETWEEN 0 AND 100"
        ),
    },
    "dq_country_region": {
        **_key("country_region", "regions", "country"),
        **_filled("country_region", "regions", "region"),
    },
    "dq_cohort_not_over_100": {
        "cohort_not_over_100": _where("retention", "n_active_customers > cohort_customers")
    },
    "dq_no_future_dates": {
        "no_future_dates": _where("line_facts", "invoice_date > today()")
    },
    "dq_order_revenue_reconciles": {
        "order_revenue_reconciles": (
            "SELECT count(*) FROM invoices JOIN (SELECT invoice_id, sum(line_revenue) AS total"
            " FROM line_facts GROUP BY ALL) USING (invoice_id)"
            " WHERE abs(order_revenue - round(total, 2)) > 0.01"
        )
    },
}


# fixed values: the region of each country, stated apart from the seed that is checked
_BUILTIN_SEED = """(SELECT * FROM (VALUES
    ('United Kingdom', 'UK & Ireland'),
    ('EIRE', 'UK & Ireland'),
    ('Channel Islands', 'UK & Ireland'),
    ('France', 'Western Europe'),
    ('Germany', 'Western Europe'),
    ('Netherlands', 'Western Europe'),
    ('Belgium', 'Western Europe'),
    ('Switzerland', 'Western Europe'),
    ('Austria', 'Western Europe'),
    ('Luxembourg', 'Western Europe'),
    ('Denmark', 'Northern Europe'),
    ('Finland', 'Northern Europe'),
    ('Norway', 'Northern Europe'),
    ('Sweden', 'Northern Europe'),
    ('Iceland', 'Northern Europe'),
    ('Lithuania', 'Northern Europe'),
    ('Poland', 'Eastern Europe'),
    ('Czech Republic', 'Eastern Europe'),
    ('Greece', 'Southern Europe'),
    ('Italy', 'Southern Europe'),
    ('Spain', 'Southern Europe'),
    ('Portugal', 'Southern Europe'),
    ('Malta', 'Southern Europe'),
    ('Cyprus', 'Southern Europe'),
    ('European Community', 'Other Europe'),
    ('USA', 'North America'),
    ('Canada', 'North America'),
    ('Brazil', 'South America'),
    ('Australia', 'Asia Pacific'),
    ('Japan', 'Asia Pacific'),
    ('Hong Kong', 'Asia Pacific'),
    ('Singapore', 'Asia Pacific'),
    ('Korea', 'Asia Pacific'),
    ('Thailand', 'Asia Pacific'),
    ('Israel', 'Middle East'),
    ('Lebanon', 'Middle East'),
    ('Bahrain', 'Middle East'),
    ('Saudi Arabia', 'Middle East'),
    ('United Arab Emirates', 'Middle East'),
    ('RSA', 'Africa'),
    ('Nigeria', 'Africa'),
    ('West Indies', 'Other'),
    ('Unspecified', 'Other')
) built_in(country, region))"""


_MATRIX = ", ".join(
    f"max(retention_rate) FILTER (months_since_cohort = {age}) AS month_{age}"
    for age in range(13)
)

_RETENTION = (
    "SELECT cohort_month, months_since_cohort, cohort_customers, n_active_customers,"
    " retention_rate FROM retention WHERE months_since_cohort BETWEEN 0 AND "
)

_INCREMENTAL = _query(
    """SELECT * FROM first_delivery
UNION ALL
SELECT * FROM line_facts WHERE invoice_date > (SELECT max(invoice_date) FROM first_delivery)"""
)

ORACLE: dict[str, str] = {
    "raw_union": _query("SELECT * FROM sheets"),
    "raw_typed": _query("SELECT * FROM typed"),
    "raw_dedup": _query("SELECT * FROM scanned_once"),
    "raw_online_retail": _query("SELECT * FROM landed"),
    "raw_sample": _query(
        "SELECT * REPLACE ('sample' AS _source_sheet),"
        " TIMESTAMP '2001-12-01 06:00:00' AS _loaded_at FROM typed"
    ),
    "raw_rejected": _query(
        """SELECT
    count(*) FILTER (quantity IS NOT NULL AND TRY_CAST(quantity AS BIGINT) IS NULL) AS quantity,
    count(*) FILTER (price IS NOT NULL AND isnan(price)) AS price,
    count(*) FILTER (invoice_date IS NOT NULL
        AND TRY_CAST(invoice_date AS TIMESTAMP) IS NULL) AS invoice_date,
    count(*) FILTER (customer_id IS NOT NULL
        AND ifnull(TRY_CAST(customer_id AS DOUBLE) % 1, 1) <> 0) AS customer_id
FROM sheets"""
    ),
    "raw_typed_damaged": _query("SELECT * FROM damaged"),
    "raw_rejected_damaged": _query("SELECT * FROM rejections"),
    "load_report": _query(
        """SELECT part, lines, all_lines - landed AS dropped, quantity AS rejected_quantity,
    price AS rejected_price, invoice_date AS rejected_invoice_date,
    customer_id AS rejected_customer_id
FROM (SELECT _source_sheet AS part, count(*) AS lines
    FROM (SELECT _source_sheet FROM typed UNION ALL SELECT _source_sheet FROM damaged) GROUP BY 1),
    (SELECT count(*) AS all_lines FROM (SELECT 1 FROM typed UNION ALL SELECT 1 FROM damaged)),
    (SELECT count(*) AS landed FROM (
        SELECT DISTINCT invoice, stock_code, quantity, price, invoice_date, customer_id
        FROM (SELECT * FROM typed UNION ALL BY NAME SELECT * FROM damaged))),
    rejections"""
    ),
    "seed_country_region": _query("SELECT * FROM regions"),
    "stg_online_retail": _query("SELECT * FROM staged"),
    "int_invoice_lines_cleaned": _query("SELECT * FROM revenue_lines"),
    "int_orders": _query("SELECT * FROM invoices"),
    "fct_orders": _query("SELECT * FROM invoices"),
    "fct_invoice_lines": _query("SELECT * FROM line_facts"),
    "fct_invoice_lines_incremental": _INCREMENTAL,
    "fct_invoice_lines_streamed": _INCREMENTAL,
    "fct_invoice_lines_full_refresh": _query("SELECT * FROM line_facts"),
    "fct_invoice_lines_lookback": _query(
        """SELECT * FROM first_delivery
WHERE invoice_date <= (SELECT max(invoice_date) FROM first_delivery) - 365
UNION ALL
SELECT * FROM line_facts
WHERE invoice_date > (SELECT max(invoice_date) FROM first_delivery) - 365"""
    ),
    "dim_customers": _query("SELECT * FROM buyers"),
    "dim_products": _query("SELECT * FROM goods"),
    "dim_dates": _query("SELECT * FROM calendar"),
    "mart_revenue_daily": _query("SELECT * FROM by_day"),
    "mart_revenue_monthly": _query("SELECT * FROM by_month"),
    "mart_customer_cohorts": _query("SELECT * FROM retention"),
    "mart_rfm_segments": _query("SELECT * FROM scores"),
    "mart_country_performance": _query("SELECT * FROM by_country"),
    "mart_country_performance_builtin_seed": _query(
        f"SELECT * FROM ({_by_country(_BUILTIN_SEED)})"
    ),
    "mart_product_performance": _query("SELECT * FROM leaders"),
    "mart_data_quality": _query("SELECT * FROM health"),
    "kpi_headline": _query(
        """SELECT
    round(sum(revenue::DECIMAL(18, 2))::DOUBLE, 0) AS total_net_revenue,
    sum(n_orders)::BIGINT AS total_orders,
    sum(n_new_customers)::BIGINT AS total_new_customers,
    round(sum(revenue) / sum(n_orders), 2) AS avg_order_value
FROM by_day"""
    ),
    "revenue_trend": _query(
        "SELECT month, revenue, revenue_mom_pct, n_new_customers, n_returning_customers,"
        " avg_order_value FROM by_month ORDER BY month"
    ),
    "revenue_trend_short": _query("SELECT month, revenue, revenue_mom_pct FROM by_month"),
    "new_vs_returning": _query(
        """SELECT month, 'New' AS type, n_new_customers AS customers FROM by_month
UNION ALL
SELECT month, 'Returning' AS type, n_returning_customers AS customers FROM by_month"""
    ),
    "cohort_retention": _query(_RETENTION + "18"),
    "cohort_retention_one_year": _query(_RETENTION + "12"),
    "cohort_matrix": _query(
        f"SELECT cohort_month, {_MATRIX} FROM retention"
        " WHERE months_since_cohort <= 12 GROUP BY cohort_month"
    ),
    "rfm_segment_rollup": _query(
        """SELECT
    rfm_segment,
    count(*) AS n_customers,
    round(sum(monetary::DECIMAL(18, 2))::DOUBLE, 0) AS total_monetary,
    round(avg(monetary), 2) AS avg_monetary,
    round(avg(frequency), 2) AS avg_frequency,
    round(avg(recency_days), 1) AS avg_recency_days
FROM scores
GROUP BY rfm_segment"""
    ),
    "rfm_segment_sizes": _query(
        "SELECT rfm_segment, count(*) AS customers,"
        " round(sum(monetary::DECIMAL(18, 2))::DOUBLE, 0) AS revenue"
        " FROM scores GROUP BY rfm_segment"
    ),
    "country_performance": _query(
        "SELECT region, country, n_customers, n_orders, revenue, avg_order_value,"
        " revenue_share_pct FROM by_country"
    ),
    "region_rollup": _query(
        "SELECT region, round(sum(revenue::DECIMAL(18, 2))::DOUBLE, 0) AS revenue"
        " FROM by_country GROUP BY region"
    ),
    "region_rollup_exact": _query(
        "SELECT region, round(sum(revenue), 2) AS revenue FROM by_country GROUP BY region"
    ),
    "top_products": _query(
        "SELECT revenue_rank, stock_code, description, units_sold, total_revenue,"
        " revenue_share_pct, return_rate FROM leaders WHERE revenue_rank <= 25"
    ),
    "top_products_short": _query(
        "SELECT revenue_rank, stock_code, description, units_sold, total_revenue, return_rate"
        " FROM leaders WHERE revenue_rank <= 25"
    ),
    "revenue_concentration": _query(
        """SELECT
    revenue_decile,
    count(*) AS n_customers,
    round(sum(lifetime_revenue::DECIMAL(18, 2))::DOUBLE, 0) AS revenue,
    round(100.0::DOUBLE * sum(lifetime_revenue)
        / (SELECT sum(lifetime_revenue) FROM buyers), 2) AS pct_of_total_revenue
FROM (
    SELECT *, ntile(10) OVER (ORDER BY lifetime_revenue DESC, customer_id) AS revenue_decile
    FROM buyers
)
GROUP BY revenue_decile"""
    ),
    "quality_snapshot": _query("SELECT * FROM health"),
    "export_roundtrip": _query("SELECT * FROM leaders"),
    "source_freshness": _query(
        """SELECT
    max(_loaded_at) AS max_loaded_at,
    date_diff('second', max(_loaded_at), TIMESTAMP '2001-12-03 00:00:00') AS age_seconds,
    CASE
        WHEN TIMESTAMP '2001-12-03 00:00:00' - max(_loaded_at) > INTERVAL 7 DAY THEN 'error'
        WHEN TIMESTAMP '2001-12-03 00:00:00' - max(_loaded_at) > INTERVAL 36 HOUR THEN 'warn'
        ELSE 'pass'
    END AS status
FROM landed"""
    ),
    **{key: _report(failures) for key, failures in CHECK_SQL.items()},
    "dq_damaged": _report(
        {
            **_key("fct_orders", "damaged_orders", "invoice_id"),
            "fct_orders.customer_id.relationships": _orphans(
                "damaged_orders", "customer_id", "buyers", "NOT is_cancellation"
            ),
            **_key("dim_customers", "damaged_buyers", "customer_id"),
            **_filled("dim_customers", "damaged_buyers", "cohort_month"),
            "dim_customers.recency_days.accepted_range": _where("damaged_buyers", "recency_days < 0"),
            **_key("mart_rfm_segments", "damaged_scores", "customer_id"),
            "mart_rfm_segments.r_score.accepted_range": _where("damaged_scores", "r_score NOT BETWEEN 1 AND 5"),
            "mart_rfm_segments.rfm_segment.accepted_values": _where(
                "damaged_scores", f"rfm_segment NOT IN ({_SEGMENTS})"
            ),
        }
    ),
    "dq_all": _report({c: sql for checks in CHECK_SQL.values() for c, sql in checks.items()}),
}
