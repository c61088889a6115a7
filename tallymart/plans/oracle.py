"""SQL for another engine (DuckDB) that states the expected result of every registered query.

Written from the definitions, not from the Spark code: views are common table expressions put in
front of each query. Decimals become the nearest double by way of their text.
"""

from __future__ import annotations

from tallymart.plans.catalog import GATE_MOMENT, PUBLISH_DAY, READ_COUNTRY
from tallymart.plans.retail_tables import (
    LAST_ORDER_DAY,
    RECENT_DAYS,
)


def _double(expression: str) -> str:
    return f"cast(cast({expression} AS varchar) AS double)"


def _day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def _time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


ORDER_LINES = """
order_lines AS (
  SELECT l.*, o.*, n.n_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

SALES = """
sales AS (
  SELECT o_orderkey AS ORDER_ID, o_custkey AS CUSTOMER_ID, l_partkey AS PRODUCT_ID,
         cast(l_quantity AS int) AS QUANTITY, cast(l_extendedprice AS decimal(12,2)) AS PRICE,
         o_orderdate AS ORDER_TIMESTAMP, n_name AS COUNTRY, cast(o_orderdate AS date) AS ORDER_DATE
  FROM order_lines
)"""

RECENT_SALES = f"""
sales AS (
  SELECT o_orderkey AS ORDER_ID, o_custkey AS CUSTOMER_ID, l_partkey AS PRODUCT_ID,
         cast(l_quantity AS int) AS QUANTITY, cast(l_extendedprice AS decimal(12,2)) AS PRICE,
         n_name AS COUNTRY,
         date '{LAST_ORDER_DAY}'
           - cast(datediff('day', cast(o_orderdate AS date), date '{LAST_ORDER_DAY}')
                  % {RECENT_DAYS} AS int) AS ORDER_DATE
  FROM order_lines
)"""

RATES = f"""
rates AS (
  SELECT cast(d AS date) AS RATE_DATE, n_name AS RATE_COUNTRY,
         cast((50 + (dayofyear(d) * 7 + n_nationkey * 13) % 100) / 100.0 AS decimal(10,6)) AS RATE
  FROM nation, (
    SELECT unnest(generate_series(
      least(min(cast(o_orderdate AS date)), date '{LAST_ORDER_DAY}'),
      greatest(max(cast(o_orderdate AS date)), date '{LAST_ORDER_DAY}'), interval 1 day)) AS d
    FROM orders) AS calendar
  WHERE dayofweek(d) <> n_regionkey
)"""

LINES = """
lines AS (
  SELECT s.*, p.p_type AS CATEGORY, r.RATE AS EXCHANGE_RATE_TO_USD,
         s.QUANTITY * s.PRICE AS REVENUE_LOCAL,
         cast(s.QUANTITY * s.PRICE AS decimal(23,2)) * r.RATE AS REVENUE_USD
  FROM sales s
  JOIN part p ON s.PRODUCT_ID = p.p_partkey
  JOIN rates r ON s.ORDER_DATE = r.RATE_DATE AND s.COUNTRY = r.RATE_COUNTRY
)"""

TIMESTAMP_TEXT = """
CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate + to_seconds(o_custkey % 86400), '%Y-%m-%d %H:%M:%S')
  WHEN '2-HIGH' THEN strftime(o_orderdate + to_seconds(o_custkey % 86400), '%-m/%-d/%Y %-H:%M')
  WHEN '3-MEDIUM' THEN strftime(o_orderdate + to_seconds(o_custkey % 86400), '%m/%d/%Y %H:%M:%S')
  WHEN '4-NOT SPECIFIED'
    THEN strftime(o_orderdate + to_seconds(o_custkey % 86400), '%Y/%m/%d %H:%M:%S')
  ELSE 'n/a' END"""

DATE_TEXT = """
CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  WHEN '2-HIGH' THEN strftime(o_orderdate, '%-m/%-d/%Y')
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%m/%d/%Y %H:%M:%S')
  WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%-m/%-d/%Y %-H:%M')
  ELSE strftime(o_orderdate, '%Y-%m-%d') END"""

QUANTITY_TEXT = """
CASE WHEN l_returnflag = 'R' AND l_linenumber = 5 THEN NULL
  WHEN l_returnflag = 'R' AND l_linenumber = 6 THEN 'n/a'
  WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN '0'
  WHEN l_returnflag = 'N' THEN cast(cast(l_quantity AS int) AS varchar) || '.7'
  ELSE cast(cast(l_quantity AS int) AS varchar) END"""

PRICE_TEXT = """
CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL
  WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN 'free'
  WHEN l_returnflag = 'R' AND l_linenumber = 3
    THEN '99999999' || cast(cast(l_extendedprice AS decimal(12,2)) AS varchar)
  WHEN l_returnflag = 'R' AND l_linenumber = 4
    THEN '-' || cast(cast(l_extendedprice AS decimal(12,2)) AS varchar)
  WHEN l_returnflag = 'N' THEN cast(cast(l_extendedprice AS decimal(12,2)) AS varchar) || '5'
  WHEN l_returnflag = 'A' THEN cast(cast(l_extendedprice AS decimal(12,2)) AS varchar) || '4'
  ELSE cast(cast(l_extendedprice AS decimal(12,2)) AS varchar) END"""

RAW = f"""
raw AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              ELSE cast(o_orderkey AS varchar) END AS ORDER_ID,
         cast(o_custkey AS varchar) AS CUSTOMER_ID,
         cast(l_partkey AS varchar) AS PRODUCT_ID,
         {QUANTITY_TEXT} AS QUANTITY,
         {PRICE_TEXT} AS PRICE,
         {TIMESTAMP_TEXT} AS ORDER_TIMESTAMP,
         n_name AS COUNTRY
  FROM order_lines
)"""


def _parsed_time(text: str) -> str:
    formats = ("%Y-%m-%d %H:%M:%S", "%m/%d/%Y %H:%M", "%m/%d/%Y %H:%M:%S", "%Y/%m/%d %H:%M:%S")
    return "coalesce(" + ", ".join(f"try_strptime({text}, '{fmt}')" for fmt in formats) + ")"


def _parsed_date(text: str, *extra: str) -> str:
    formats = ("%Y-%m-%d %H:%M:%S", "%m/%d/%Y", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M", *extra)
    tries = ", ".join(f"try_strptime({text}, '{fmt}')" for fmt in formats)
    return f"cast(coalesce({tries}) AS date)"


def _parsed_int(text: str) -> str:
    return f"cast(trunc(try_cast({text} AS double)) AS int)"


def _parsed_price(text: str) -> str:
    return f"try_cast({text} AS decimal(12,2))"


TYPED = f"""
typed AS (
  SELECT cast(ORDER_ID AS bigint) AS ORDER_ID, cast(CUSTOMER_ID AS bigint) AS CUSTOMER_ID,
         PRODUCT_ID, {_parsed_int("QUANTITY")} AS QUANTITY, {_parsed_price("PRICE")} AS PRICE,
         {_parsed_time("ORDER_TIMESTAMP")} AS ORDER_TIMESTAMP, COUNTRY
  FROM raw
)"""

TYPED_LINES = """
lines AS (
  SELECT t.*, cast(t.ORDER_TIMESTAMP AS date) AS ORDER_DATE, p.p_type AS CATEGORY,
         r.RATE AS EXCHANGE_RATE_TO_USD, t.QUANTITY * t.PRICE AS REVENUE_LOCAL,
         cast(t.QUANTITY * t.PRICE AS decimal(23,2)) * r.RATE AS REVENUE_USD
  FROM typed t
  JOIN part p ON t.PRODUCT_ID = cast(p.p_partkey AS varchar)
  JOIN rates r ON cast(t.ORDER_TIMESTAMP AS date) = r.RATE_DATE AND t.COUNTRY = r.RATE_COUNTRY
  WHERE t.QUANTITY IS NOT NULL AND t.PRICE IS NOT NULL
)"""

TYPED_RATED = """
lines AS (
  SELECT t.*, r.RATE AS EXCHANGE_RATE_TO_USD, t.QUANTITY * t.PRICE AS REVENUE_LOCAL,
         cast(t.QUANTITY * t.PRICE AS decimal(23,2)) * r.RATE AS REVENUE_USD
  FROM typed t
  LEFT JOIN rates r
    ON cast(t.ORDER_TIMESTAMP AS date) = r.RATE_DATE AND t.COUNTRY = r.RATE_COUNTRY
)"""


SPOILED_LINES = """
lines AS (
  SELECT s.*, CASE WHEN dayofyear(r.RATE_DATE) % 5 = 0 THEN r.RATE * 0
                   WHEN dayofyear(r.RATE_DATE) % 7 = 0 THEN -r.RATE ELSE r.RATE END
                AS EXCHANGE_RATE_TO_USD
  FROM sales s JOIN rates r ON s.ORDER_DATE = r.RATE_DATE AND s.COUNTRY = r.RATE_COUNTRY
)"""

CUSTOMER_TEXT = "'C-' || cast(CUSTOMER_ID AS varchar) AS"


def _with(*views: str) -> str:
    return "WITH " + ",".join(views)


RECENT = _with(ORDER_LINES, RECENT_SALES, RATES, LINES)
CLEAN = _with(ORDER_LINES, SALES, RATES, LINES)
DIRTY = _with(ORDER_LINES, RAW, TYPED, RATES, TYPED_LINES)
DIRTY_RATED = _with(ORDER_LINES, RAW, TYPED, RATES, TYPED_RATED)

SALES_COLUMNS = f"""
ORDER_ID AS ORDER_ID, CUSTOMER_ID AS CUSTOMER_ID, PRODUCT_ID AS PRODUCT_ID, QUANTITY AS QUANTITY,
{_double("PRICE")} AS PRICE, {_time("ORDER_TIMESTAMP")} AS ORDER_TIMESTAMP, COUNTRY AS COUNTRY"""

CATEGORY_ROWS = """
SELECT ORDER_DATE, COUNTRY, CATEGORY, count(DISTINCT ORDER_ID) AS orders, sum(QUANTITY) AS units,
       sum(REVENUE_LOCAL) AS local_total, sum(REVENUE_USD) AS usd_total
FROM {source} GROUP BY ORDER_DATE, COUNTRY, CATEGORY"""

CATEGORY_COLUMNS = f"""
{_day("ORDER_DATE")} AS ORDER_DATE, COUNTRY AS COUNTRY, CATEGORY AS CATEGORY,
cast(orders AS bigint) AS TOTAL_ORDERS, cast(units AS bigint) AS TOTAL_QUANTITY,
{_double("local_total")} AS TOTAL_REVENUE_LOCAL, {_double("usd_total")} AS TOTAL_REVENUE_USD"""

RANKED = """
SELECT CUSTOMER_ID, ORDER_DATE, COUNTRY, CATEGORY, total,
       row_number() OVER (PARTITION BY CUSTOMER_ID, ORDER_DATE, COUNTRY
                          ORDER BY total DESC NULLS LAST, CATEGORY ASC NULLS LAST) AS place
FROM (SELECT CUSTOMER_ID, ORDER_DATE, COUNTRY, CATEGORY, sum({measure}) AS total
      FROM {source} GROUP BY CUSTOMER_ID, ORDER_DATE, COUNTRY, CATEGORY) AS totals"""

ORDER_VALUE = f"""
SELECT CUSTOMER_ID, ORDER_DATE, COUNTRY, count(DISTINCT ORDER_ID) AS orders,
       {_double("sum(REVENUE_USD)")} / nullif(count(ORDER_ID), 0) AS mean_usd
FROM {{source}} GROUP BY CUSTOMER_ID, ORDER_DATE, COUNTRY"""


def _customer_rows(source: str) -> str:
    ranked = RANKED.format(measure="REVENUE_USD", source=source)
    return f"""
SELECT v.CUSTOMER_ID, v.ORDER_DATE, v.COUNTRY, v.orders, v.mean_usd, t.CATEGORY AS top
FROM ({ORDER_VALUE.format(source=source)}) AS v
JOIN ({ranked}) AS t
  ON v.CUSTOMER_ID = t.CUSTOMER_ID AND v.ORDER_DATE = t.ORDER_DATE AND v.COUNTRY = t.COUNTRY
WHERE t.place = 1"""


CUSTOMER_COLUMNS = f"""
CUSTOMER_ID AS CUSTOMER_ID, {_day("ORDER_DATE")} AS ORDER_DATE, COUNTRY AS COUNTRY,
cast(orders AS bigint) AS TOTAL_ORDERS, mean_usd AS AVG_ORDER_VALUE_USD, top AS TOP_CATEGORY"""

CUSTOMER_DAY_COLUMNS = f"""
CUSTOMER_ID AS CUSTOMER_ID, {_day("ORDER_DATE")} AS ORDER_DATE, COUNTRY AS COUNTRY"""

VIOLATIONS = {
    "missing": "{column} IS NULL",
    "non_positive": "{column} <= 0",
    "stale": "{column} IS NULL OR {column} < timestamp '" + GATE_MOMENT + "' - interval 90 day",
    "future": "{column} > timestamp '" + GATE_MOMENT + "'",
    "rate": "{column} IS NULL OR {column} <= 0",
}


def _report(views: str, source: str, *rules: tuple[str, str]) -> str:
    parts = [
        f"SELECT {at} AS position, '{kind}' AS rule, '{column}' AS \"column\", "
        f"count(*) FILTER (WHERE {VIOLATIONS[kind].format(column=column)}) AS violations "
        f"FROM {source}"
        for at, (kind, column) in enumerate(rules)
    ]
    return views + "\n" + "\nUNION ALL\n".join(parts)


MISSING = [("missing", name) for name in ("COUNTRY", "PRICE", "QUANTITY")]
NON_POSITIVE = [
    ("non_positive", name) for name in ("QUANTITY", "PRICE", "REVENUE_LOCAL", "REVENUE_USD")
]
STALE = ("stale", "ORDER_TIMESTAMP")
FUTURE = ("future", "ORDER_TIMESTAMP")
RATE = ("rate", "EXCHANGE_RATE_TO_USD")
GATE = (*MISSING, *NON_POSITIVE, STALE, FUTURE, RATE)


def _null_counts(rows: str, *columns: tuple[str, str]) -> str:
    counted = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"column\", count(*) FILTER (WHERE {source} IS NULL) AS nulls "
        "FROM published"
        for name, source in columns
    )
    return f"{DIRTY}, published AS ({rows})\n{counted}"


def oracle_sql() -> dict[str, str]:
    """Expected result per registered query."""
    categories = CATEGORY_ROWS.format(source="lines")
    customers = _customer_rows("lines")
    day = f"date '{PUBLISH_DAY}'"
    return {
        "ingest_csv": _with(ORDER_LINES, RAW)
        + """ SELECT ORDER_ID AS ORDER_ID, CUSTOMER_ID AS CUSTOMER_ID, PRODUCT_ID AS PRODUCT_ID,
              QUANTITY AS QUANTITY, PRICE AS PRICE, ORDER_TIMESTAMP AS ORDER_TIMESTAMP,
              COUNTRY AS COUNTRY FROM raw""",
        "parse_timestamp": f"""
            SELECT o_orderkey AS ORDER_ID, ORDER_TEXT AS ORDER_TEXT,
                   {_time(_parsed_time("ORDER_TEXT"))} AS ORDER_TIMESTAMP
            FROM (SELECT o_orderkey, {TIMESTAMP_TEXT} AS ORDER_TEXT FROM orders) AS texts""",
        "parse_date": f"""
            SELECT o_orderkey AS ORDER_ID, DATE_TEXT AS DATE_TEXT,
                   {_day(_parsed_date("DATE_TEXT"))} AS ORDER_DATE,
                   {_day(_parsed_date("DATE_TEXT", "%Y-%m-%d"))} AS ORDER_DATE_ISO
            FROM (SELECT o_orderkey, {DATE_TEXT} AS DATE_TEXT FROM orders) AS texts""",
        "order_date": f"""
            SELECT o_orderkey AS ORDER_ID, {_time("o_orderdate")} AS ORDER_TIMESTAMP,
                   {_day("cast(o_orderdate AS date)")} AS ORDER_DATE FROM orders""",
        "cast_int": f"""
            SELECT l_orderkey AS ORDER_ID, QUANTITY_TEXT AS QUANTITY_TEXT,
                   {_parsed_int("QUANTITY_TEXT")} AS QUANTITY
            FROM (SELECT l_orderkey, {QUANTITY_TEXT} AS QUANTITY_TEXT FROM lineitem) AS texts""",
        "cast_decimal": f"""
            SELECT l_orderkey AS ORDER_ID, PRICE_TEXT AS PRICE_TEXT,
                   {_double(_parsed_price("PRICE_TEXT"))} AS PRICE
            FROM (SELECT l_orderkey, {PRICE_TEXT} AS PRICE_TEXT FROM lineitem) AS texts""",
        "typed_sales": _with(ORDER_LINES, RAW, TYPED) + f" SELECT {SALES_COLUMNS} FROM typed",
        "prepared_sales": _with(ORDER_LINES, RAW, TYPED)
        + f""" SELECT {SALES_COLUMNS}, {_day("cast(ORDER_TIMESTAMP AS date)")} AS ORDER_DATE
               FROM typed WHERE QUANTITY IS NOT NULL AND PRICE IS NOT NULL""",
        "drop_nulls": _with(ORDER_LINES, RAW, TYPED)
        + f""" SELECT {SALES_COLUMNS} FROM typed
               WHERE QUANTITY IS NOT NULL AND PRICE IS NOT NULL""",
        "drop_audit": _with(ORDER_LINES, RAW, TYPED)
        + """ SELECT count(*) AS rows_before,
                     count(*) FILTER (WHERE QUANTITY IS NOT NULL AND PRICE IS NOT NULL)
                       AS rows_after,
                     count(*) FILTER (WHERE QUANTITY IS NULL OR PRICE IS NULL) AS rows_dropped
              FROM typed""",
        "join_product": _with(ORDER_LINES, SALES)
        + """ SELECT s.ORDER_ID AS ORDER_ID, s.PRODUCT_ID AS PRODUCT_ID,
                     p.p_name AS PRODUCT_NAME, p.p_type AS CATEGORY, s.QUANTITY AS QUANTITY
              FROM sales s JOIN part p ON s.PRODUCT_ID = p.p_partkey""",
        "join_fx": _with(ORDER_LINES, SALES, RATES)
        + f""" SELECT s.ORDER_ID AS ORDER_ID, {_day("s.ORDER_DATE")} AS ORDER_DATE,
                      s.COUNTRY AS COUNTRY, {_double("s.PRICE")} AS PRICE,
                      {_double("r.RATE")} AS EXCHANGE_RATE_TO_USD
               FROM sales s
               JOIN rates r ON s.ORDER_DATE = r.RATE_DATE AND s.COUNTRY = r.RATE_COUNTRY""",
        "revenue_local": _with(ORDER_LINES, SALES)
        + f""" SELECT ORDER_ID AS ORDER_ID, QUANTITY AS QUANTITY, {_double("PRICE")} AS PRICE,
                      {_double("QUANTITY * PRICE")} AS REVENUE_LOCAL FROM sales""",
        "revenue_usd": CLEAN
        + f""" SELECT ORDER_ID AS ORDER_ID, {_double("REVENUE_LOCAL")} AS REVENUE_LOCAL,
                      {_double("EXCHANGE_RATE_TO_USD")} AS EXCHANGE_RATE_TO_USD,
                      {_double("REVENUE_USD")} AS REVENUE_USD FROM lines""",
        "enrich_sales": CLEAN
        + f""" SELECT {SALES_COLUMNS}, {_day("ORDER_DATE")} AS ORDER_DATE, CATEGORY AS CATEGORY,
                      {_double("EXCHANGE_RATE_TO_USD")} AS EXCHANGE_RATE_TO_USD,
                      {_double("REVENUE_LOCAL")} AS REVENUE_LOCAL,
                      {_double("REVENUE_USD")} AS REVENUE_USD FROM lines""",
        "dq_missing": _report(_with(ORDER_LINES, RAW, TYPED), "typed", *MISSING),
        "dq_nonpositive": _report(DIRTY, "lines", *NON_POSITIVE),
        "dq_stale": _report(_with(ORDER_LINES, RAW, TYPED), "typed", STALE),
        "dq_future": _report(_with(ORDER_LINES, RAW, TYPED), "typed", FUTURE),
        "dq_rate": _report(DIRTY_RATED, "lines", RATE),
        "dq_report": _report(DIRTY, "lines", *GATE),
        "dq_report_before_joins": _report(DIRTY_RATED, "lines", *GATE),
        "output_null_scan": _null_counts(
            customers,
            ("CUSTOMER_ID", "CUSTOMER_ID"),
            ("COUNTRY", "COUNTRY"),
            ("TOTAL_ORDERS", "orders"),
            ("AVG_ORDER_VALUE_USD", "mean_usd"),
            ("TOP_CATEGORY", "top"),
            ("ORDER_DATE", "ORDER_DATE"),
        ),
        "sum_by_day": CLEAN
        + f""" SELECT {_day("ORDER_DATE")} AS ORDER_DATE,
                      cast(sum(QUANTITY) AS bigint) AS TOTAL_QUANTITY,
                      {_double("sum(REVENUE_LOCAL)")} AS TOTAL_REVENUE_LOCAL,
                      {_double("sum(REVENUE_USD)")} AS TOTAL_REVENUE_USD
               FROM lines GROUP BY lines.ORDER_DATE""",
        "distinct_orders": DIRTY
        + f""" SELECT {_day("ORDER_DATE")} AS ORDER_DATE, COUNTRY AS COUNTRY,
                      count(DISTINCT ORDER_ID) AS TOTAL_ORDERS
               FROM lines GROUP BY lines.ORDER_DATE, COUNTRY""",
        "avg_order_value": DIRTY
        + f""" SELECT {CUSTOMER_DAY_COLUMNS}, cast(orders AS bigint) AS TOTAL_ORDERS,
                      mean_usd AS AVG_ORDER_VALUE_USD
               FROM ({ORDER_VALUE.format(source="lines")}) AS v""",
        "category_summary": f"{CLEAN} SELECT {CATEGORY_COLUMNS} FROM ({categories}) AS c",
        "customer_category_revenue": CLEAN
        + f""" SELECT {CUSTOMER_DAY_COLUMNS}, CATEGORY AS CATEGORY,
                      {_double("total")} AS CATEGORY_REVENUE_USD
               FROM ({RANKED.format(measure="REVENUE_USD", source="lines")}) AS r""",
        "rank_categories": CLEAN
        + f""" SELECT {CUSTOMER_DAY_COLUMNS}, CATEGORY AS CATEGORY,
                      {_double("total")} AS CATEGORY_REVENUE_USD,
                      cast(place AS int) AS RANK_CATEGORY
               FROM ({RANKED.format(measure="REVENUE_USD", source="lines")}) AS r""",
        "top_category": CLEAN
        + f""" SELECT {CUSTOMER_DAY_COLUMNS}, CATEGORY AS TOP_CATEGORY
               FROM ({RANKED.format(measure="REVENUE_USD", source="lines")}) AS r
               WHERE place = 1""",
        "top_category_by_quantity": CLEAN
        + f""" SELECT {CUSTOMER_DAY_COLUMNS}, CATEGORY AS TOP_CATEGORY
               FROM ({RANKED.format(measure="QUANTITY", source="lines")}) AS r
               WHERE place = 1""",
        "customer_summary": f"{CLEAN} SELECT {CUSTOMER_COLUMNS} FROM ({customers}) AS c",
        "customer_summary_from_text": (
            f"{DIRTY} SELECT {CUSTOMER_COLUMNS} FROM ({customers}) AS c"
        ),
        "increment_filter": f"""{CLEAN} SELECT {CATEGORY_COLUMNS} FROM ({categories}) AS c
            WHERE c.ORDER_DATE = {day}""",
        "publish_initial": f"{CLEAN} SELECT {CUSTOMER_COLUMNS} FROM ({customers}) AS c",
        "read_published": f"{CLEAN} SELECT {CATEGORY_COLUMNS} FROM ({categories}) AS c",
        "partition_pruned_read": f"""{CLEAN} SELECT {CATEGORY_COLUMNS} FROM ({categories}) AS c
            WHERE c.COUNTRY = '{READ_COUNTRY}'""",
        "upsert_update": f"""{CLEAN}, dearer AS (
              SELECT ORDER_DATE, COUNTRY, CATEGORY, ORDER_ID, QUANTITY,
                     QUANTITY * (PRICE + 1) AS REVENUE_LOCAL,
                     cast(QUANTITY * (PRICE + 1) AS decimal(23,2)) * EXCHANGE_RATE_TO_USD
                       AS REVENUE_USD
              FROM lines)
            SELECT {CATEGORY_COLUMNS} FROM ({categories}) AS c WHERE c.ORDER_DATE <> {day}
            UNION ALL
            SELECT {CATEGORY_COLUMNS} FROM ({CATEGORY_ROWS.format(source="dearer")}) AS c
            WHERE c.ORDER_DATE = {day}""",
        "upsert_insert": f"""{CLEAN}, early AS (SELECT * FROM lines WHERE QUANTITY <= 25)
            SELECT {CUSTOMER_COLUMNS} FROM ({_customer_rows("early")}) AS c
            WHERE c.ORDER_DATE <> {day}
            UNION ALL
            SELECT {CUSTOMER_COLUMNS} FROM ({customers}) AS c WHERE c.ORDER_DATE = {day}""",
        "upsert_append": f"""{CLEAN} SELECT {CATEGORY_COLUMNS} FROM ({categories}) AS c
            WHERE c.ORDER_DATE <= {day}""",
        "upsert_by_day": f"""{CLEAN}, dearer AS (
              SELECT CUSTOMER_ID, ORDER_DATE, COUNTRY, CATEGORY, ORDER_ID,
                     cast(QUANTITY * (PRICE + 1) AS decimal(23,2)) * EXCHANGE_RATE_TO_USD
                       AS REVENUE_USD
              FROM lines)
            SELECT {CUSTOMER_COLUMNS} FROM ({customers}) AS c WHERE c.ORDER_DATE <> {day}
            UNION ALL
            SELECT {CUSTOMER_COLUMNS} FROM ({_customer_rows("dearer")}) AS c
            WHERE c.ORDER_DATE = {day}""",
        "join_product_gaps": _with(ORDER_LINES, SALES)
        + """ SELECT s.ORDER_ID AS ORDER_ID, s.PRODUCT_ID AS PRODUCT_ID,
                     p.p_name || n.ending AS PRODUCT_NAME, p.p_type AS CATEGORY,
                     s.QUANTITY AS QUANTITY
              FROM sales s JOIN part p ON s.PRODUCT_ID = p.p_partkey
              JOIN (VALUES (1, ''), (11, ' again')) AS n(step, ending)
                ON p.p_partkey % n.step = 0
              WHERE p.p_partkey % 7 <> 0""",
        "dq_rate_nonpositive": _report(
            _with(ORDER_LINES, SALES, RATES, SPOILED_LINES), "lines", RATE
        ),
        "loss_audit": _with(ORDER_LINES, RAW, TYPED, RATES)
        + """, met AS (
              SELECT cast(ORDER_TIMESTAMP AS date) AS day,
                     EXISTS (SELECT 1 FROM part p WHERE cast(p_partkey AS varchar) = t.PRODUCT_ID
                             AND p_partkey % 7 <> 0) AS listed,
                     EXISTS (SELECT 1 FROM rates r WHERE r.RATE_COUNTRY = t.COUNTRY
                             AND r.RATE_DATE = cast(t.ORDER_TIMESTAMP AS date)) AS quoted
              FROM typed t WHERE QUANTITY IS NOT NULL AND PRICE IS NOT NULL)
            SELECT count(*) AS lines, count(*) FILTER (WHERE day IS NULL) AS without_time,
                   count(*) FILTER (WHERE day IS NOT NULL AND NOT listed) AS without_product,
                   count(*) FILTER (WHERE day IS NOT NULL AND listed AND NOT quoted)
                     AS without_rate,
                   count(*) FILTER (WHERE day IS NOT NULL AND listed AND quoted) AS priced
            FROM met""",
        "gain_audit": _with(ORDER_LINES, RAW, TYPED, RATES)
        + """, met AS (
              SELECT CASE WHEN p.p_partkey % 11 = 0 THEN 2 ELSE 1 END AS listings
              FROM typed t JOIN part p ON cast(p.p_partkey AS varchar) = t.PRODUCT_ID
              JOIN rates r ON r.RATE_COUNTRY = t.COUNTRY
                AND r.RATE_DATE = cast(t.ORDER_TIMESTAMP AS date)
              WHERE QUANTITY IS NOT NULL AND PRICE IS NOT NULL AND p.p_partkey % 7 <> 0)
            SELECT count(*) AS matched, count(*) FILTER (WHERE listings > 1) AS of_repeated_products,
                   cast(0 AS bigint) AS of_repeated_rates, cast(sum(listings) AS bigint) AS priced,
                   cast(sum(listings) - count(*) AS bigint) AS gained
            FROM met""",
        "csv_malformed": _with(ORDER_LINES, SALES)
        + """ SELECT CASE WHEN ORDER_ID % 10 <> 3 THEN COUNTRY END AS COUNTRY, count(*) AS LINES,
                     count(*) FILTER (WHERE ORDER_ID % 10 IN (3, 7)) AS malformed,
                     cast(sum(QUANTITY) AS bigint) AS QUANTITY
              FROM sales GROUP BY 1""",
        "late_rows": f"""{CLEAN}, early AS (SELECT * FROM lines WHERE QUANTITY <= 25),
            fresh AS (SELECT * FROM ({categories}) AS c WHERE c.ORDER_DATE < {day}),
            held AS ({CATEGORY_ROWS.format(source="early")})
            SELECT count(*) AS late, count(*) FILTER (WHERE h.orders IS NULL) AS missing,
                   count(*) FILTER (WHERE h.orders <> f.orders OR h.units <> f.units
                     OR h.local_total <> f.local_total OR h.usd_total <> f.usd_total) AS differing
            FROM fresh f LEFT JOIN held h ON f.ORDER_DATE = h.ORDER_DATE
              AND f.COUNTRY = h.COUNTRY AND f.CATEGORY = h.CATEGORY""",
        "upsert_many_partitions": f"""{CLEAN}, one_day AS (
              SELECT {day} AS ORDER_DATE, COUNTRY, CATEGORY || '/' || (PRODUCT_ID % 12) AS CATEGORY,
                     ORDER_ID, QUANTITY, PRICE, EXCHANGE_RATE_TO_USD, REVENUE_LOCAL, REVENUE_USD
              FROM lines),
            dearer AS (
              SELECT ORDER_DATE, COUNTRY, CATEGORY, ORDER_ID, QUANTITY,
                     QUANTITY * (PRICE + 1) AS REVENUE_LOCAL,
                     cast(QUANTITY * (PRICE + 1) AS decimal(23,2)) * EXCHANGE_RATE_TO_USD
                       AS REVENUE_USD
              FROM one_day WHERE QUANTITY > 10),
            first_load AS ({CATEGORY_ROWS.format(source="one_day")}),
            second AS ({CATEGORY_ROWS.format(source="dearer")})
            SELECT {CATEGORY_COLUMNS} FROM (
              SELECT * FROM second UNION ALL
              SELECT f.* FROM first_load f ANTI JOIN second s
                ON f.COUNTRY = s.COUNTRY AND f.CATEGORY = s.CATEGORY) AS c""",
        "customer_summary_text_ids": (
            f"{DIRTY} SELECT {CUSTOMER_COLUMNS.replace('CUSTOMER_ID AS', CUSTOMER_TEXT)} "
            f"FROM ({customers}) AS c"
        ),
        "daily_job_second_run": f"""{RECENT}, more AS (
              SELECT ORDER_DATE, COUNTRY, CATEGORY, ORDER_ID, QUANTITY + 1 AS QUANTITY,
                     (QUANTITY + 1) * PRICE AS REVENUE_LOCAL,
                     cast((QUANTITY + 1) * PRICE AS decimal(23,2)) * EXCHANGE_RATE_TO_USD
                       AS REVENUE_USD
              FROM lines)
            SELECT {CATEGORY_COLUMNS} FROM ({categories}) AS c
            WHERE c.ORDER_DATE <> date '{LAST_ORDER_DAY}'
            UNION ALL
            SELECT {CATEGORY_COLUMNS} FROM ({CATEGORY_ROWS.format(source="more")}) AS c
            WHERE c.ORDER_DATE = date '{LAST_ORDER_DAY}'""",
        "daily_job_categories": f"{RECENT} SELECT {CATEGORY_COLUMNS} FROM ({categories}) AS c",
        "daily_job_customers": f"{RECENT} SELECT {CUSTOMER_COLUMNS} FROM ({customers}) AS c",
    }
