"""The same results in plain SQL over the test tables, to check the queries against."""

from __future__ import annotations

from collections.abc import Sequence

from saleslane.catalog.queries import AS_OF, LAST_YEARS, PROCESSING_DATE, TABLES, URL_PATTERN

# Fixed text: the sales table with its deterministic defects.
SALES = """
sales_raw AS (
 SELECT l_orderkey * 10 + l_linenumber AS id,
  CASE WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN NULL ELSE concat('CUST', CAST(o_custkey AS STRING)) END AS customer_id,
  CASE WHEN (l_orderkey + l_partkey) % 103 = 0 THEN NULL ELSE concat('PROD', CAST(l_partkey AS STRING)) END AS product_id,
  CAST(CASE WHEN (l_orderkey + l_suppkey) % 107 = 0 THEN -l_quantity WHEN (l_orderkey + l_suppkey) % 109 = 0 THEN 0 ELSE l_quantity END AS INT) AS quantity,
  CASE WHEN (l_orderkey + l_partkey) % 113 = 0 THEN -floor(p_retailprice) / 100 WHEN (l_orderkey + l_partkey) % 127 = 0 THEN NULL ELSE floor(p_retailprice) / 100 END AS price,
  CASE WHEN (l_orderkey + l_linenumber) % 131 = 0 THEN o_orderdate + INTERVAL '100' YEAR WHEN (l_orderkey + l_linenumber) % 137 = 0 THEN NULL ELSE o_orderdate END AS transaction_date,
  CASE WHEN l_partkey % 139 = 0 THEN NULL ELSE p_type END AS category,
  CASE WHEN (l_orderkey + l_suppkey) % 149 = 0 THEN NULL ELSE r_name END AS region
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
sales_clean AS (
 SELECT id, customer_id, product_id, quantity, price, transaction_date,
  coalesce(category, 'UNKNOWN') AS category, coalesce(region, 'UNKNOWN') AS region
 FROM sales_raw
 WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND quantity > 0 AND price > 0
),
sales_lines AS (
 SELECT *, quantity * price AS total_amount,
  CAST(year(transaction_date) AS INT) AS year, CAST(month(transaction_date) AS INT) AS month,
  CAST(day(transaction_date) AS INT) AS day
 FROM sales_clean
),
sales_totals AS (
 SELECT *, round(sum(total_amount) OVER (PARTITION BY customer_id), 2) AS customer_total_spent
 FROM sales_lines
),
transformed_sales AS (
 SELECT *, CASE WHEN customer_total_spent > 10000 THEN 'Premium'
  WHEN customer_total_spent > 5000 THEN 'Gold'
  WHEN customer_total_spent > 1000 THEN 'Silver' ELSE 'Bronze' END AS customer_category
 FROM sales_totals
),
daily_sales_summary AS (
 SELECT year, month, day, region, round(sum(total_amount), 2) AS daily_revenue,
  count(id) AS daily_transactions,
  round(sum(total_amount), 2) / count(id) AS avg_transaction_amount
 FROM sales_lines GROUP BY year, month, day, region
),
customer_summary AS (
 SELECT customer_id, customer_category, region, round(sum(total_amount), 2) AS total_spent,
  count(id) AS total_transactions,
  round(sum(total_amount), 2) / count(id) AS avg_transaction_amount,
  max(transaction_date) AS last_purchase_date
 FROM transformed_sales GROUP BY customer_id, customer_category, region
),
product_summary AS (
 SELECT product_id, category, region, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
  round(sum(total_amount), 2) AS total_revenue, count(id) AS total_orders,
  round(sum(price), 2) / count(id) AS avg_price
 FROM sales_lines GROUP BY product_id, category, region
)
"""

# Columns of the checked tables.
RAW_COLUMNS = [
    "id", "customer_id", "product_id", "quantity", "price", "transaction_date", "category", "region",
]
COLUMNS = {
    "transformed_sales": [
        "id", "customer_id", "product_id", "quantity", "price", "transaction_date", "category",
        "region", "total_amount", "year", "month", "day", "customer_total_spent",
        "customer_category",
    ],
    "daily_sales_summary": [
        "year", "month", "day", "region", "daily_revenue", "daily_transactions",
        "avg_transaction_amount",
    ],
    "customer_summary": [
        "customer_id", "customer_category", "region", "total_spent", "total_transactions",
        "avg_transaction_amount", "last_purchase_date",
    ],
    "product_summary": [
        "product_id", "category", "region", "total_quantity_sold", "total_revenue",
        "total_orders", "avg_price",
    ],
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority",
    ],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
DOUBLES = {
    "price", "total_amount", "customer_total_spent", "daily_revenue", "avg_transaction_amount",
    "total_spent", "total_revenue", "avg_price", "c_acctbal", "s_acctbal", "p_retailprice",
    "o_totalprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "value",
}


def text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def check(
    source: str,
    table: str,
    check_type: str,
    name: str | None = None,
    column: str | None = None,
    rule: str | None = None,
    total: str = "NULL",
    nulls: str = "NULL",
    failed: str = "NULL",
    rate: str = "NULL",
) -> str:
    """SQL of one check row over ``source``."""
    return (
        f"SELECT {text(table)} AS table_name, {text(check_type)} AS check_type,"
        f" {text(name)} AS check_name, {text(column)} AS column_name, {text(rule)} AS rule,"
        f" CAST({total} AS BIGINT) AS total_records, CAST({nulls} AS BIGINT) AS null_count,"
        f" CAST({failed} AS BIGINT) AS failed_records,"
        f" CAST({rate} AS DOUBLE) AS completeness_rate FROM {source}"
    )


def union(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def completeness(table: str, columns: Sequence[str], label: str | None = None) -> str:
    parts = []
    for name in columns:
        missing = f"{name} IS NULL" + (f" OR isnan({name})" if name in DOUBLES else "")
        nulls = f"count(CASE WHEN {missing} THEN 1 END)"
        rate = f"CASE WHEN count(*) > 0 THEN (count(*) - {nulls}) / count(*) * 100 ELSE 0 END"
        parts.append(
            check(table, label or table, "completeness", column=name, total="count(*)",
                  nulls=nulls, rate=rate)
        )
    return union(parts)


def failing(
    source: str, table: str, check_type: str, name: str, rule: str, condition: str,
    column: str | None = None,
) -> str:
    failed = f"count(CASE WHEN {condition} THEN 1 END)"
    return check(source, table, check_type, name, column, rule, failed=failed)


def validity(table: str, columns: Sequence[str]) -> list[str]:
    late = f"transaction_date > TIMESTAMP '{AS_OF}'"
    rules = [
        ("quantity", "negative_quantity", "quantity >= 0", "quantity < 0"),
        ("price", "negative_price", "price >= 0", "price < 0"),
        ("transaction_date", "future_transaction_date", "transaction_date <= current_date", late),
    ]
    return [
        failing(table, table, "validity", name, rule, condition)
        for column, name, rule, condition in rules
        if column in columns
    ]


def amounts(source: str) -> str:
    return failing(
        source, "transformed_sales", "consistency", "total_amount_calculation",
        "total_amount = quantity * price", "abs(total_amount - quantity * price) > 0.01",
    )


def duplicates(table: str) -> str:
    return check(
        f"(SELECT id, count(*) AS n FROM {table} GROUP BY id)", table, "integrity",
        "duplicate_ids", rule="id should be unique", failed="coalesce(sum(n), 0) - count(*)",
    )


def counts(
    stage: str, output: str, source: str, target: str, filters: bool, malformed: str = "NULL"
) -> str:
    """Rows that a stage reads and writes, and, where it filters rows, how many it drops."""
    rows_in, rows_out = (f"(SELECT count(*) FROM {x})" for x in (source, target))
    rejected = f"{rows_in} - {rows_out}" if filters else "NULL"
    return (
        f"SELECT '{stage}' AS stage, '{output}' AS output, {rows_in} AS rows_in,"
        f" {rows_out} AS rows_out, CAST({rejected} AS BIGINT) AS rows_rejected,"
        f" CAST({malformed} AS BIGINT) AS rows_malformed, '{PROCESSING_DATE}' AS processing_date"
    )


def sales_query(body: str) -> str:
    return f"WITH {SALES}\n{body}"


REPORT_TABLES = (
    "transformed_sales", "daily_sales_summary", "customer_summary", "product_summary",
)


def report_rows(*more: str) -> str:
    parts = [*more]
    for table in REPORT_TABLES:
        parts.append(completeness(table, COLUMNS[table]))
        parts += validity(table, COLUMNS[table])
    parts += [amounts("transformed_sales"), duplicates("transformed_sales")]
    return (
        f"SELECT *, '{PROCESSING_DATE}' AS processing_date FROM (\n{union(parts)}\n) AS report"
    )


def profile(table: str, columns: Sequence[str], column_count: int) -> str:
    return union(
        [
            f"SELECT '{table}' AS table_name, '{name}' AS column_name,"
            f" count(*) AS total_records, CAST({column_count} AS INT) AS column_count,"
            f" round(CAST(min({name}) AS DOUBLE), 2) AS min_val,"
            f" round(CAST(max({name}) AS DOUBLE), 2) AS max_val,"
            f" round(CAST(sum({name}) AS DOUBLE), 2) / count({name}) AS avg_val,"
            f" count({name}) AS non_null_count FROM {table}"
            for name in columns
        ]
    )


def profiles(fact_columns: int) -> str:
    """The profiles of the four tables; the fact has so many columns."""
    return union(
        [
            profile(
                "transformed_sales",
                ["id", "quantity", "price", "total_amount", "year", "month", "day",
                 "customer_total_spent"],
                fact_columns,
            ),
            profile(
                "daily_sales_summary",
                ["year", "month", "day", "daily_revenue", "daily_transactions",
                 "avg_transaction_amount"],
                7,
            ),
            profile(
                "customer_summary",
                ["total_spent", "total_transactions", "avg_transaction_amount"],
                7,
            ),
            profile(
                "product_summary",
                ["total_quantity_sold", "total_revenue", "total_orders", "avg_price"],
                7,
            ),
        ]
    )


# The written fact has a column more than the query's: the time of processing, which is never missing.
PROCESSED_AT = check(
    "transformed_sales", "transformed_sales", "completeness", column="processed_at",
    total="count(*)", nulls="0", rate="CASE WHEN count(*) > 0 THEN 100 ELSE 0 END",
)
WHY = ", ".join(
    [f"CASE WHEN {c} IS NULL THEN '{c} is missing' END" for c in ("customer_id", "product_id")]
    + [
        f"CASE WHEN {c} IS NULL THEN '{c} is missing' WHEN NOT {c} > 0 THEN '{c} is not above zero' END"
        for c in ("quantity", "price")
    ]
)
SALES_DAY = (
    f"CASE WHEN year(transaction_date) <= {LAST_YEARS[0]} THEN 1"
    f" WHEN year(transaction_date) <= {LAST_YEARS[1]} THEN 2 ELSE 3 END"
)
TIER = (
    "CASE WHEN customer_total_spent > 10000 THEN 'Premium' WHEN customer_total_spent > 5000"
    " THEN 'Gold' WHEN customer_total_spent > 1000 THEN 'Silver' ELSE 'Bronze' END"
)
DELIVERED = f"""
 SELECT sales_day, id FROM (SELECT id, {SALES_DAY} AS sales_day FROM sales_raw)
 UNION ALL SELECT sales_day + 1, id FROM (SELECT id, {SALES_DAY} AS sales_day FROM sales_raw)
 WHERE sales_day < 3 AND id % 97 = 0
"""


def repeated_over_days(day: int) -> str:
    """Rows of a day less the ids that it is the first to bring."""
    first = f"(SELECT min(sales_day) AS first_day FROM ({DELIVERED}) GROUP BY id)"
    return check(
        f"({DELIVERED}) WHERE sales_day = {day}", f"sales_day_{day}", "integrity",
        "duplicate_ids_over_days", rule="id should be unique over days",
        failed=f"count(*) - (SELECT count(*) FROM {first} WHERE first_day = {day})",
    )


LINE_RULES = "(l_quantity < 1 OR l_quantity > 45 OR l_discount > 0.08)"
GOOD_ROW = (
    "customer_id IS NOT NULL AND product_id IS NOT NULL AND quantity > 0 AND price > 0"
)
MISSING = " + ".join(
    f"CAST({c} IS NULL{f' OR isnan({c})' if c in DOUBLES else ''} AS INT)" for c in RAW_COLUMNS
).replace("CAST(price IS NULL OR isnan(price) AS INT)",
          "CASE WHEN price IS NULL OR isnan(price) THEN 1 ELSE 0 END")
ORPHANS = """
 SELECT customer_id, count(*) AS row_count FROM sales_raw
 WHERE customer_id IS NOT NULL AND customer_id NOT IN
  (SELECT concat('CUST', CAST(c_custkey AS VARCHAR)) FROM customer WHERE c_acctbal >= 0)
 GROUP BY customer_id
"""
REPEATED_LINES = """
 SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
 GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""


def oracle_queries() -> dict[str, str]:
    sql = {
        "scan_sales": "SELECT * FROM sales_raw",
        "clean_sales": "SELECT * FROM sales_clean",
        "valid_keys_and_quantity": "SELECT * FROM sales_raw WHERE customer_id IS NOT NULL"
        " AND product_id IS NOT NULL AND quantity > 0",
        "line_amount": "SELECT id, quantity, price, total_amount FROM sales_lines",
        "date_parts": "SELECT id, transaction_date, year, month, day FROM sales_lines",
        "distinct_customers": "SELECT DISTINCT customer_id FROM sales_raw",
        "customer_total_spent": "SELECT id, customer_id, total_amount, customer_total_spent"
        " FROM sales_totals",
        "customer_tier": "SELECT id, customer_id, customer_category FROM transformed_sales",
        "transformed_sales": "SELECT * FROM transformed_sales",
        "daily_sales_summary": "SELECT * FROM daily_sales_summary",
        "customer_summary": "SELECT * FROM customer_summary",
        "customer_summary_of_fact": "SELECT * FROM customer_summary",
        "product_summary": "SELECT * FROM product_summary",
        "completeness": completeness("sales_raw", RAW_COLUMNS),
        "validity_checks": union(validity("sales_raw", RAW_COLUMNS)),
        "consistency_check": amounts(
            "(SELECT * REPLACE (total_amount + CASE WHEN id % 151 = 0 THEN 0.05 ELSE 0 END"
            " AS total_amount) FROM sales_lines)"
        ),
        "duplicate_ids": duplicates("sales_raw"),
        "numeric_profile": profiles(14),
        "wide_profile": "SELECT 'sales_raw' AS table_name, count(*) AS total_records,"
        " CAST(8 AS INT) AS column_count, min(id) AS id_min, max(id) AS id_max,"
        " avg(id) AS id_avg, count(id) AS id_non_null_count, min(quantity) AS quantity_min,"
        " max(quantity) AS quantity_max, avg(quantity) AS quantity_avg,"
        " count(quantity) AS quantity_non_null_count, min(price) AS price_min,"
        " max(price) AS price_max, round(sum(price), 2) / count(price) AS price_avg,"
        " count(price) AS price_non_null_count FROM sales_raw",
        "business_rules": union(
            [
                failing("sales_lines", "transformed_sales", "business", *rule)
                for rule in (
                    ("bulk_has_category", "lines of 40 pieces or more have a category",
                     "quantity >= 40 AND category = 'UNKNOWN'"),
                    ("amount_covers_price", "total_amount >= price", "total_amount < price"),
                    ("region_has_date", "lines with a region have a date",
                     "region <> 'UNKNOWN' AND transaction_date IS NULL"),
                )
            ]
        ),
        "missing_pattern": f"SELECT CAST({MISSING} AS INT) AS missing_values,"
        " count(*) AS row_count FROM sales_raw GROUP BY 1",
        "missing_pattern_check": "SELECT 'sales_raw' AS table_name,"
        " 'missing_data' AS check_type, 'rows_missing_' || missing_values AS check_name,"
        " CAST(NULL AS VARCHAR) AS column_name, 'no value is missing' AS rule,"
        " CAST(NULL AS BIGINT) AS total_records, CAST(NULL AS BIGINT) AS null_count,"
        " count(*) AS failed_records, CAST(NULL AS DOUBLE) AS completeness_rate"
        f" FROM (SELECT {MISSING} AS missing_values FROM sales_raw) WHERE missing_values > 0"
        " GROUP BY missing_values",
        "quality_score": "SELECT 'sales_raw' AS table_name, count(*) AS total_records,"
        f" count(CASE WHEN {GOOD_ROW} THEN 1 END) AS passing_records,"
        f" count(CASE WHEN {GOOD_ROW} THEN 1 END) / count(*) * 100 AS quality_score"
        " FROM sales_raw",
        "quality_score_check": check(
            "sales_raw", "sales_raw", "score", "quality_score", rule="row passes every rule",
            total="count(*)", failed=f"count(*) - count(CASE WHEN {GOOD_ROW} THEN 1 END)",
        ),
        "referential_integrity": check(
            f"({ORPHANS})", "sales_raw", "integrity", "orphan_customer_id",
            rule="(customer_id) should exist in customer", failed="coalesce(sum(row_count), 0)",
        ),
        "orphan_customers": ORPHANS,
        "orphan_rows": f"SELECT * FROM sales_raw WHERE customer_id IN (SELECT customer_id FROM ({ORPHANS}))",
        "input_precheck": union(
            [
                check("(SELECT 1)", "sales_raw", "precheck", "missing_columns",
                      rule="all sales columns are present", failed="0"),
                check("sales_raw", "sales_raw", "precheck", "empty_input", rule="input has rows",
                      failed="CAST(count(*) = 0 AS BIGINT)"),
                check("(SELECT 1)", "sales_raw", "precheck", "mismatched_files",
                      rule="every file has the sales columns in order", failed="0"),
                completeness("sales_raw", ["customer_id", "product_id"]),
            ]
        ),
        "quality_results": report_rows(),
        "failed_checks": f"SELECT * FROM ({report_rows()})"
        " WHERE failed_records > 0 OR completeness_rate < 95",
        "critical_failures": f"SELECT * FROM ({report_rows()}) WHERE failed_records > 100",
        "scan_sales_csv": "SELECT * FROM sales_raw",
        "layer_round_trip": "SELECT * FROM sales_clean",
        "stage_row_counts": union(
            [
                counts("ingestion", "processed", "sales_raw", "sales_clean", True, "0"),
                counts("transformation", "transformed_sales", "sales_clean", "sales_clean", True),
                *(
                    counts("transformation", name, "sales_clean", name, False)
                    for name in ("daily_sales_summary", "customer_summary", "product_summary")
                ),
            ]
        ),
        "job_fact": "SELECT * FROM transformed_sales",
        "job_daily_summary": "SELECT * FROM daily_sales_summary",
        "job_customer_summary": "SELECT * FROM customer_summary",
        "job_product_summary": "SELECT * FROM product_summary",
        "job_report": report_rows(PROCESSED_AT),
        "job_profiles": profiles(15),
        "rejected_lines": f"SELECT *, concat_ws('; ', {WHY}) AS reasons FROM sales_raw"
        f" WHERE NOT coalesce({GOOD_ROW}, false)",
        "running_customer_tier": f"SELECT *, {TIER} AS customer_category FROM ("
        " SELECT id, customer_id, sales_day, round(sum(total_amount) OVER (PARTITION BY customer_id"
        " ORDER BY sales_day RANGE UNBOUNDED PRECEDING), 2) AS customer_total_spent"
        f" FROM (SELECT *, {SALES_DAY} AS sales_day FROM sales_lines))",
        "duplicate_ids_over_days": union([repeated_over_days(day) for day in (1, 2, 3)]),
    }
    plain = {
        "completeness_by_table": union(
            [
                completeness(table, COLUMNS[table])
                for table in TABLES
            ]
        ),
        "type_validation": failing(
            "(SELECT CASE WHEN l_orderkey % 151 = 0 THEN 'bad' ELSE CAST(l_linenumber AS VARCHAR)"
            " END AS line_text FROM lineitem)", "lineitem", "type", "line_text_is_int",
            "line_text can be read as int",
            "line_text IS NOT NULL AND TRY_CAST(line_text AS INT) IS NULL", "line_text",
        ),
        "range_check": union(
            [
                failing("lineitem", "lineitem", "range", "l_quantity_in_range",
                        "1 <= l_quantity <= 45", "l_quantity < 1 OR l_quantity > 45",
                        "l_quantity"),
                failing("lineitem", "lineitem", "range", "l_discount_in_range",
                        "l_discount <= 0.08", "l_discount > 0.08", "l_discount"),
            ]
        ),
        "format_check": failing(
            "pages", "pages", "format", "url_format", f"url matches {URL_PATTERN}",
            f"NOT regexp_matches(url, '{URL_PATTERN}')", "url",
        ),
        "quality_score_by_rules": "SELECT 'lineitem' AS table_name, count(*) AS total_records,"
        f" count(CASE WHEN NOT {LINE_RULES} THEN 1 END) AS passing_records,"
        f" count(CASE WHEN NOT {LINE_RULES} THEN 1 END) / count(*) * 100 AS quality_score"
        " FROM lineitem",
        "uniqueness_check": check(
            f"({REPEATED_LINES})", "lineitem", "integrity", "unique_l_orderkey_l_linenumber",
            rule="(l_orderkey, l_linenumber) should be unique", failed="count(*)",
        ),
        "uniqueness_violations": REPEATED_LINES,
        "repeated_rows": "SELECT * FROM lineitem QUALIFY"
        " count(*) OVER (PARTITION BY l_partkey, l_suppkey, l_shipdate) > 1",
    }
    return {name: sales_query(body) for name, body in sql.items()} | plain
