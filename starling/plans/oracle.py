"""Independent DuckDB SQL for every registered query.

Written from the rules, not from the Spark plans: the expected clean data is
derived from the driver tables' clean columns (e.g. a day-first date whose day
is at most 12 is expected with day and month swapped), never by re-parsing the
raw text.  Ratios are rounded half-up with exact integer arithmetic.
"""

from __future__ import annotations

# ------------------------------------------------------------------ shared CTEs

_STAR = """
geo AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
),
dim_customers AS (
  SELECT c_custkey AS customer_id, c_name AS name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         CAST(DATE '1993-01-01' + CAST((c_custkey * 37) % 1500 AS INTEGER) AS DATE) AS signup_date,
         n_name AS city, r_name AS state, 'United States' AS country
  FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey
),
dim_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price
  FROM part
),
fact_lines AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
         CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS item_total,
         o_orderdate + to_seconds(l_orderkey % 86400) AS order_date,
         l_linenumber AS line_number, l_suppkey AS supplier_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
fact_sales AS (
  SELECT *, SUM(item_total) OVER (PARTITION BY order_id) AS order_total FROM fact_lines
)"""

# Raw extracts as the cleaning step sees them (null tokens already NULL).
_RAW = """
c_base AS (
  SELECT c_custkey AS ck, c_name, n_name, r_name,
         CAST(DATE '1993-01-01' + CAST((c_custkey * 37) % 1500 AS INTEGER) AS DATE) AS d,
         c_custkey % 20 AS k,
         CASE WHEN c_custkey % 50 IN (0, 1, 2) THEN NULL
              WHEN c_custkey % 50 = 3 THEN '  '
              WHEN c_custkey % 40 = 7
                THEN lower(replace(printf('Customer#%09d', c_custkey - 1), '#', '.')) || '@example.com'
              ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email
  FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey
),
c_raw AS (
  SELECT * FROM c_base UNION ALL SELECT * FROM c_base WHERE ck % 101 = 5
),
c_first AS (
  SELECT email, MIN(ck) AS first_ck FROM c_base WHERE email IS NOT NULL GROUP BY email
),
c_after_email_dedupe AS (
  SELECT b.* FROM c_base b LEFT JOIN c_first f ON b.email = f.email
  WHERE b.email IS NULL OR b.ck = f.first_ck
),
c_with_email AS (
  SELECT * FROM c_after_email_dedupe
  WHERE email IS NOT NULL AND trim(email) <> '' AND lower(trim(email)) <> 'nan'
),
c_clean AS (
  SELECT *, CASE WHEN k = 1 AND day(d) <= 12 THEN make_date(year(d), day(d), month(d)) ELSE d END AS signup
  FROM c_with_email WHERE k <> 4
),
p_clean AS (
  SELECT CASE WHEN p_partkey % 223 = 0 THEN 'X' ELSE '' END || CAST(p_partkey AS VARCHAR) AS code, p_name, p_type,
         CASE WHEN p_partkey % 211 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS price
  FROM part
),
p_keys AS (SELECT p_partkey AS pk FROM part WHERE p_partkey % 223 <> 0),
o_lines AS (
  SELECT l_orderkey AS ok, l_partkey AS pk, l_linenumber AS ln, o_custkey AS ck,
         CAST(l_quantity AS BIGINT) AS qty, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
         o_orderdate + to_seconds(l_orderkey % 86400) AS ts,
         (l_orderkey * 7 + l_partkey) % 331 AS h,
         (l_orderkey + l_partkey * 3) % 337 AS g,
         l_orderkey % 20 AS k
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
o_raw AS (
  SELECT * FROM o_lines UNION ALL SELECT * FROM o_lines WHERE (ok + ln) % 97 = 0
),
o_distinct AS (
  SELECT DISTINCT ok, pk, ck, price, ts, h, g, k, CASE WHEN h < 4 THEN NULL ELSE qty END AS q FROM o_raw
),
o_valid AS (
  SELECT ok, pk, ck, q, price, CAST(q * price AS DECIMAL(18,2)) AS item_total,
         SUM(q * price) OVER (PARTITION BY ok) AS order_total,
         CASE WHEN k IN (0, 5) THEN date_trunc('minute', ts)
              WHEN k = 1 AND day(ts) <= 12
                THEN make_timestamp(year(ts), day(ts), month(ts), hour(ts), minute(ts), second(ts))
              ELSE ts END AS od
  FROM o_distinct WHERE k <> 4 AND h >= 4 AND g >= 3
),
o_fact AS (
  SELECT * FROM o_valid
  WHERE ck IN (SELECT ck FROM c_clean) AND pk IN (SELECT pk FROM p_keys)
)"""


def _with(*blocks: str) -> str:
    return "WITH " + ",".join(blocks) + "\n"


def _half_up(num_x100: str, den: str) -> str:
    """round(num/den, 2) half-up, exact; ``num_x100`` is an integer expression = num*100."""
    return f"(CAST(({num_x100}) AS HUGEINT) * 2 + ({den})) // (2 * ({den})) / 100.0"


# ------------------------------------------------------------------ KPIs

KPI_TOTALS = _with(_STAR) + f"""
SELECT CAST(SUM(item_total) AS DOUBLE) AS total_revenue,
       COUNT(DISTINCT order_id) AS total_orders,
       (SELECT COUNT(DISTINCT customer_id) FROM dim_customers) AS total_customers,
       {_half_up('SUM(item_total) * 100', 'COUNT(DISTINCT order_id)')} AS avg_order_value
FROM fact_sales"""

CATEGORY_SALES = _with(_STAR) + """
SELECT p.category, CAST(SUM(f.item_total) AS DOUBLE) AS revenue
FROM fact_sales f JOIN dim_products p ON f.product_id = p.product_id
WHERE p.category IS NOT NULL
GROUP BY p.category"""

MONTHLY_SALES = _with(_STAR) + """
SELECT strftime(order_date, '%Y-%m') AS month, CAST(SUM(item_total) AS DOUBLE) AS revenue
FROM fact_sales WHERE order_date IS NOT NULL GROUP BY 1"""

MONTHLY_SIGNUPS = _with(_STAR) + """
SELECT strftime(signup_date, '%Y-%m') AS month, COUNT(*) AS signups
FROM dim_customers WHERE signup_date IS NOT NULL GROUP BY 1"""

_RECENT = """
recent_top AS (
  SELECT * FROM (
    SELECT order_id, customer_id, product_id, quantity, item_total, order_date,
           row_number() OVER (ORDER BY order_date DESC NULLS LAST, order_id, product_id, quantity,
                                       item_total, customer_id) - 1 AS position
    FROM fact_sales) WHERE position < 10
),
recent AS (
  SELECT CAST(t.position AS BIGINT) AS position, CAST(t.order_id AS VARCHAR) AS order_id,
         coalesce(c.name, 'Unknown') AS customer_name,
         coalesce(p.product_name, 'Unknown Product') AS product_name,
         coalesce(p.category, 'General') AS category,
         coalesce(CAST(t.quantity AS BIGINT), 1) AS quantity,
         coalesce(CAST(t.item_total AS DOUBLE), 0.0) AS item_total,
         coalesce(strftime(t.order_date, '%Y-%m-%d %H:%M'), '') AS order_date
  FROM recent_top t
  LEFT JOIN dim_products p ON t.product_id = p.product_id
  LEFT JOIN dim_customers c ON t.customer_id = c.customer_id
)"""

RECENT_TRANSACTIONS = _with(_STAR, _RECENT) + "SELECT * FROM recent"

# ------------------------------------------------------------------ RFM

_RFM_P = """
rfm_per AS (
  SELECT customer_id, MAX(order_date) AS last_ts, COUNT(DISTINCT order_id) AS frequency,
         SUM(item_total) AS monetary
  FROM fact_sales WHERE customer_id IS NOT NULL GROUP BY customer_id
),
rfm_m AS (
  SELECT customer_id,
         CAST(floor((epoch(r.ref_ts) - epoch(p.last_ts)) / 86400) AS BIGINT) AS recency,
         CAST(frequency AS BIGINT) AS frequency, monetary
  FROM rfm_per p, (SELECT MAX(order_date) AS ref_ts FROM fact_sales) r
),
rfm_ranked AS (
  SELECT *,
         row_number() OVER (ORDER BY recency DESC, customer_id) AS rr,
         row_number() OVER (ORDER BY frequency, customer_id) AS fr,
         row_number() OVER (ORDER BY monetary, customer_id) AS mr,
         COUNT(*) OVER () AS n
  FROM rfm_m
),
rfm_scored AS (
  SELECT customer_id, recency, frequency, monetary, n,
         CAST(1 + (5 * (rr - 1) > 1 * (n - 1))::INT + (5 * (rr - 1) > 2 * (n - 1))::INT
                + (5 * (rr - 1) > 3 * (n - 1))::INT + (5 * (rr - 1) > 4 * (n - 1))::INT AS BIGINT) AS r_score,
         CAST(1 + (5 * (fr - 1) > 1 * (n - 1))::INT + (5 * (fr - 1) > 2 * (n - 1))::INT
                + (5 * (fr - 1) > 3 * (n - 1))::INT + (5 * (fr - 1) > 4 * (n - 1))::INT AS BIGINT) AS f_score,
         CAST(1 + (5 * (mr - 1) > 1 * (n - 1))::INT + (5 * (mr - 1) > 2 * (n - 1))::INT
                + (5 * (mr - 1) > 3 * (n - 1))::INT + (5 * (mr - 1) > 4 * (n - 1))::INT AS BIGINT) AS m_score
  FROM rfm_ranked
),
rfm_p AS (
  SELECT *,
         CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
              WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
              WHEN r_score >= 4 AND f_score <= 2 THEN 'New / Promising'
              WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
              ELSE 'Lost' END AS segment
  FROM rfm_scored
),
seg_labels(segment_order, segment) AS (
  VALUES (0, 'Champions'), (1, 'Loyal Customers'), (2, 'New / Promising'), (3, 'At Risk'), (4, 'Lost')
),
rfm_seg AS (
  SELECT l.segment, CAST(l.segment_order AS BIGINT) AS segment_order,
         CAST(coalesce(s.customers, 0) AS BIGINT) AS customers,
         coalesce(CAST(s.revenue AS DOUBLE), 0.0) AS revenue
  FROM seg_labels l
  LEFT JOIN (SELECT segment, COUNT(*) AS customers, SUM(monetary) AS revenue FROM rfm_p GROUP BY segment) s
    ON l.segment = s.segment
  WHERE (SELECT COUNT(*) FROM rfm_m) >= 5
)"""

RFM_METRICS_TS = _with(_STAR, _RFM_P) + """
SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary FROM rfm_m"""

RFM_SCORES_BINS = _with(_STAR, _RFM_P) + """
SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary,
       r_score, f_score, m_score, segment
FROM rfm_p"""

RFM_SEGMENTS = _with(_STAR, _RFM_P) + "SELECT * FROM rfm_seg"

def _fifth(place: str) -> str:
    """Which of five equal shares a place 1..total falls in; the first (total mod 5) shares hold one more."""
    return (f"CASE WHEN {place} <= (total % 5) * (total // 5 + 1) THEN ({place} - 1) // (total // 5 + 1) + 1 "
            f"ELSE total % 5 + ({place} - (total % 5) * (total // 5 + 1) - 1) // (total // 5) + 1 END")


def _people(fact: str, dims: str) -> str:
    """Per customer of ``dims`` found in ``fact``: days since the latest day, orders, spend, and their fifths."""
    return f"""
spend AS (
  SELECT customer_id, CAST(MAX(order_date) AS DATE) AS newest, COUNT(DISTINCT order_id) AS orders, SUM(item_total) AS paid
  FROM {fact} GROUP BY customer_id
),
latest AS (SELECT MAX(newest) AS day FROM spend),
person AS (SELECT customer_id, name, email, COUNT(*) AS copies FROM {dims} GROUP BY ALL),
profile AS (
  SELECT p.customer_id, p.name, p.email, (SELECT day FROM latest) - s.newest AS days, s.orders, ROUND(s.paid * p.copies, 2) AS paid
  FROM spend s JOIN person p USING (customer_id)
  WHERE s.newest IS NOT NULL AND s.paid IS NOT NULL
),
place AS (
  SELECT *, COUNT(*) OVER () AS total,
         row_number() OVER (ORDER BY -days, customer_id, name, email) AS by_days,
         row_number() OVER (ORDER BY orders, customer_id, name, email) AS by_orders,
         row_number() OVER (ORDER BY paid, customer_id, name, email) AS by_paid
  FROM profile
),
fifths AS (
  SELECT customer_id, name, email, days, orders, paid,
         CAST({_fifth('by_days')} AS BIGINT) AS r, CAST({_fifth('by_orders')} AS BIGINT) AS f,
         CAST({_fifth('by_paid')} AS BIGINT) AS m
  FROM place
)"""


# The label strings and score bounds of the report and of the documented tiers,
# as (order, label, least r, most r, least f, most f, least m, most m); the first that fits counts.
_BOUNDS = [(0, 4, 5, 4, 5, 4, 5), (1, 3, 5, 3, 5, 3, 5), (2, 4, 5, 1, 2, 1, 5), (3, 1, 2, 3, 5, 3, 5), (4, 1, 2, 1, 2, 1, 2),
           (5, 1, 5, 1, 5, 1, 5)]
_REPORT_LABELS = ["Champions", "Loyal Customers", "Promising / New Customers", "At Risk / Need Attention", "Lost Customers",
                  "Potential / Hibernating"]
_TIER_LABELS = ["Champions", "Loyal Customers", "New / Promising", "At Risk / Attention", "Lost Customers",
                "Potential / Hibernating"]


def _labelled(labels: list[str]) -> str:
    rows = ", ".join(str((b[0], label, *b[1:])) for b, label in zip(_BOUNDS, labels))
    return f"""
bounds(nr, label, r0, r1, f0, f1, m0, m1) AS (VALUES {rows}),
labelled AS (
  SELECT t.*, (SELECT arg_min(label, nr) FROM bounds b
               WHERE t.r BETWEEN b.r0 AND b.r1 AND t.f BETWEEN b.f0 AND b.f1 AND t.m BETWEEN b.m0 AND b.m1) AS label
  FROM fifths t
)"""


_REPORT_COLUMNS = """
SELECT customer_id, name AS customer_name, email, CAST(days AS BIGINT) AS recency_days, CAST(orders AS BIGINT) AS frequency_orders,
       CAST(paid AS DOUBLE) AS monetary_spend, r AS r_score, f AS f_score, m AS m_score,
       CAST(100 * r + 10 * f + m AS VARCHAR) AS rfm_cell, label AS customer_segmentation
FROM labelled"""

RFM_SQL = _with(_STAR, _people("fact_sales", "dim_customers"), _labelled(_REPORT_LABELS)) + _REPORT_COLUMNS

# The same two scorings over the cleaned fact: a population whose size is no multiple of five.
_CLEAN_STAR = """
clean_fact AS (
  SELECT CAST(ok AS VARCHAR) AS order_id, CAST(ck AS VARCHAR) AS customer_id, item_total, od AS order_date FROM o_fact
),
clean_dims AS (SELECT CAST(ck AS VARCHAR) AS customer_id, c_name AS name, email FROM c_clean)"""

RFM_CLEAN_NTILE = _with(_STAR, _RAW, _CLEAN_STAR, _people("clean_fact", "clean_dims"),
                        _labelled(_REPORT_LABELS)) + _REPORT_COLUMNS

RFM_CLEAN_BINS = _with(_STAR, _RAW, _CLEAN_STAR, _RFM_P.replace("FROM fact_sales", "FROM clean_fact")) + """
SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score, segment
FROM rfm_p"""

RFM_STRATEGY = _with(_STAR, _people("fact_sales", "dim_customers"), _labelled(_TIER_LABELS)) + """,
advice(nr, rule, strategy) AS (
  VALUES
    (0, 'R >= 4, F >= 4, M >= 4', 'VIP rewards, early product access, ambassador programs'),
    (1, 'R >= 3, F >= 3, M >= 3', 'Upsell higher-tier products, loyalty discounts'),
    (2, 'R >= 4, F <= 2', 'Onboarding email series, first-purchase follow-ups'),
    (3, 'R <= 2, F >= 3, M >= 3', 'Personalized win-back campaigns, limited-time offers'),
    (4, 'R <= 2, F <= 2, M <= 2', 'Re-engagement surveys, aggressive clearance promos'),
    (5, NULL, NULL)
)
SELECT b.label AS tier, CAST(b.nr AS BIGINT) AS tier_order, a.rule, a.strategy,
       COUNT(l.customer_id) AS customers, CAST(coalesce(SUM(l.paid), 0) AS DOUBLE) AS revenue
FROM bounds b JOIN advice a USING (nr) LEFT JOIN labelled l ON l.label = b.label
GROUP BY ALL"""

# ------------------------------------------------------------------ cleaning

_ORDER_TEXT = """
CASE WHEN k = 0 THEN strftime(ts, '%m/%d/%Y %H:%M')
     WHEN k = 1 THEN strftime(ts, '%d-%m-%Y %H:%M:%S')
     WHEN k = 2 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
     WHEN k = 3 THEN CAST(CAST(epoch(ts) AS BIGINT) AS VARCHAR)
     WHEN k = 4 THEN 'garbage'
     WHEN k = 5 THEN strftime(ts, '%d-%b-%Y %H:%M')
     WHEN k = 6 THEN strftime(ts, '%B %d, %Y %H:%M:%S')
     WHEN k = 7 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.123456789'
     WHEN k = 8 THEN strftime(ts, '%m/%d/%y ') || CAST((hour(ts) + 11) % 12 + 1 AS VARCHAR) || strftime(ts, ':%M:%S %p')
     WHEN k = 9 THEN chr(9) || strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(9) || ' '
     ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""

_SIGNUP_TEXT = """
CASE WHEN k = 0 THEN strftime(d, '%m/%d/%Y')
     WHEN k = 1 THEN strftime(d, '%d-%m-%Y')
     WHEN k = 2 THEN strftime(d, '%Y/%m/%d')
     WHEN k = 3 THEN strftime(d, '%B %d, %Y')
     WHEN k = 4 THEN ''
     ELSE strftime(d, '%Y-%m-%d') END"""

PARSE_DATES = _with(_STAR, _RAW) + f"""
SELECT DISTINCT 'orders' AS source, CAST(ok AS VARCHAR) AS record_id, CAST(pk AS VARCHAR) AS product_id,
       {_ORDER_TEXT} AS raw_text,
       CASE WHEN k = 4 THEN NULL
            WHEN k IN (0, 5) THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
            WHEN k = 1 AND day(ts) <= 12 THEN strftime(make_timestamp(year(ts), day(ts), month(ts), hour(ts),
                                                      minute(ts), second(ts)), '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
FROM o_lines
UNION ALL
SELECT 'customers', CAST(ck AS VARCHAR), NULL, {_SIGNUP_TEXT},
       CASE WHEN k = 4 THEN NULL
            WHEN k = 1 AND day(d) <= 12 THEN strftime(make_date(year(d), day(d), month(d)), '%Y-%m-%d 00:00:00')
            ELSE strftime(d, '%Y-%m-%d 00:00:00') END
FROM c_base"""

CLEAN_CUSTOMERS = _with(_STAR, _RAW) + """
SELECT CAST(ck AS VARCHAR) AS customer_id, c_name AS name, email, strftime(signup, '%Y-%m-%d') AS signup_date,
       n_name AS city, r_name AS state, 'United States' AS country
FROM c_clean"""

CLEAN_PRODUCTS = _with(_STAR, _RAW) + """
SELECT code AS product_id, p_name AS product_name, p_type AS category, CAST(price AS DOUBLE) AS price
FROM p_clean"""

_FACT_COLS = """
SELECT CAST(ok AS VARCHAR) AS order_id, CAST(ck AS VARCHAR) AS customer_id, CAST(pk AS VARCHAR) AS product_id,
       CAST(q AS BIGINT) AS quantity, CAST(price AS DOUBLE) AS unit_price, CAST(item_total AS DOUBLE) AS item_total,
       CAST(ROUND(order_total, 2) AS DOUBLE) AS order_total, strftime(od, '%Y-%m-%d %H:%M:%S') AS order_date"""

CLEAN_ORDERS = _with(_STAR, _RAW) + _FACT_COLS + "\nFROM o_valid"

FACT_SALES = _with(_STAR, _RAW) + _FACT_COLS + "\nFROM o_fact"

CLEAN_FROM_CSV = _with(_STAR, _RAW) + _FACT_COLS + """,
       c_name || ' "the' || chr(10) || '2nd", ' || CAST(ck AS VARCHAR) AS customer_name
FROM o_fact JOIN (SELECT ck, c_name FROM c_clean) USING (ck)"""

ORDER_TOTALS = _with(_STAR, _RAW) + """
SELECT CAST(ok AS VARCHAR) AS order_id, CAST(ROUND(MAX(order_total), 2) AS DOUBLE) AS order_total,
       CAST(SUM(item_total) AS DOUBLE) AS sum_item_totals, COUNT(*) AS lines
FROM o_valid GROUP BY ok"""

_ORPHANS = """
orphans AS (
  SELECT COUNT(*) FILTER (WHERE ck NOT IN (SELECT ck FROM c_clean)) AS orphan_customer_lines,
         COUNT(*) FILTER (WHERE pk NOT IN (SELECT pk FROM p_keys)) AS orphan_product_lines,
         COUNT(*) FILTER (WHERE ck IN (SELECT ck FROM c_clean) AND pk IN (SELECT pk FROM p_keys)) AS kept_lines
  FROM o_valid
)"""

ORPHAN_COUNTS = _with(_STAR, _RAW, _ORPHANS) + "SELECT * FROM orphans"

CLEANING_SUMMARY = _with(_STAR, _RAW, _ORPHANS) + """,
cust_counts AS (
  SELECT (SELECT COUNT(*) FROM c_raw) AS initial_rows,
         (SELECT COUNT(*) FROM c_raw) - (SELECT COUNT(*) FROM c_base) AS exact_dups,
         (SELECT COUNT(*) FROM c_base) - (SELECT COUNT(*) FROM c_after_email_dedupe) AS email_dups,
         (SELECT COUNT(*) FROM c_after_email_dedupe) - (SELECT COUNT(*) FROM c_with_email) AS missing,
         (SELECT COUNT(*) FROM c_with_email WHERE k IN (0, 1, 2, 3, 4)) AS nonstandard,
         (SELECT COUNT(*) FROM c_with_email WHERE k = 4) AS unparseable,
         (SELECT COUNT(*) FROM c_clean) AS final_rows
),
ord_counts AS (
  SELECT (SELECT COUNT(*) FROM o_raw) AS initial_rows,
         (SELECT COUNT(*) FROM o_raw) - (SELECT COUNT(*) FROM o_distinct) AS exact_dups,
         (SELECT COUNT(*) FROM o_distinct WHERE k < 10) AS nonstandard,
         (SELECT COUNT(*) FROM o_distinct WHERE k = 4) AS unparseable,
         (SELECT COUNT(*) FROM o_distinct WHERE k <> 4 AND NOT (h >= 4 AND g >= 3)) AS invalid
)
SELECT 'customers' AS table_name, CAST(step AS INTEGER) AS step, metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 0 AS step, 'initial_rows' AS metric, initial_rows AS value FROM cust_counts
  UNION ALL SELECT 1, 'exact_duplicates_removed', exact_dups FROM cust_counts
  UNION ALL SELECT 2, 'same_email_duplicates_removed', email_dups FROM cust_counts
  UNION ALL SELECT 3, 'missing_email_dropped', missing FROM cust_counts
  UNION ALL SELECT 4, 'nonstandard_dates_standardized', nonstandard FROM cust_counts
  UNION ALL SELECT 5, 'unparseable_dates_dropped', unparseable FROM cust_counts
  UNION ALL SELECT 6, 'final_rows', final_rows FROM cust_counts)
UNION ALL
SELECT 'products', CAST(step AS INTEGER), metric, CAST(value AS BIGINT) FROM (
  SELECT 0 AS step, 'initial_rows' AS metric, COUNT(*) AS value FROM p_clean
  UNION ALL SELECT 1, 'exact_duplicates_removed', 0
  UNION ALL SELECT 2, 'final_rows', COUNT(*) FROM p_clean)
UNION ALL
SELECT 'orders', CAST(step AS INTEGER), metric, CAST(value AS BIGINT) FROM (
  SELECT 0 AS step, 'initial_rows' AS metric, initial_rows AS value FROM ord_counts
  UNION ALL SELECT 1, 'exact_duplicates_removed', exact_dups FROM ord_counts
  UNION ALL SELECT 2, 'nonstandard_dates_standardized', nonstandard FROM ord_counts
  UNION ALL SELECT 3, 'unparseable_dates_dropped', unparseable FROM ord_counts
  UNION ALL SELECT 4, 'invalid_amounts_dropped', invalid FROM ord_counts
  UNION ALL SELECT 5, 'orphan_customer_lines_dropped', orphan_customer_lines FROM orphans
  UNION ALL SELECT 6, 'orphan_product_lines_dropped', orphan_product_lines FROM orphans
  UNION ALL SELECT 7, 'final_rows', kept_lines FROM orphans)"""

# ------------------------------------------------------------------ key checks

def _pk(table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    null = " OR ".join(f"{c} IS NULL" for c in keys)
    return f"""
SELECT '{table}' AS table_name, '{",".join(keys)}' AS key_columns,
       CAST(COUNT(*) FILTER (WHERE n > 1 AND NOT has_null) AS BIGINT) AS duplicate_keys,
       CAST(coalesce(SUM(n) FILTER (WHERE n > 1 AND NOT has_null), 0) AS BIGINT) AS rows_with_duplicate_keys,
       CAST(coalesce(SUM(n) FILTER (WHERE has_null), 0) AS BIGINT) AS null_key_rows
FROM (SELECT {k}, COUNT(*) AS n, bool_or({null}) AS has_null FROM {table} GROUP BY {k})"""


PK_VIOLATIONS = _with(_STAR) + "\nUNION ALL".join([
    _pk("dim_customers", ["customer_id"]),
    _pk("dim_products", ["product_id"]),
    _pk("fact_sales", ["order_id", "product_id"]),
])

NULL_VIOLATIONS = _with(_STAR, _RAW) + """
SELECT 'dim_customers' AS table_name, 'customer_id' AS column_name,
       CAST(COUNT(*) FILTER (WHERE ck IS NULL) AS BIGINT) AS null_rows FROM c_clean
UNION ALL SELECT 'dim_products', 'product_id', COUNT(*) FILTER (WHERE code IS NULL) FROM p_clean
UNION ALL SELECT 'fact_sales', 'order_id', COUNT(*) FILTER (WHERE ok IS NULL) FROM o_fact
UNION ALL SELECT 'fact_sales', 'customer_id', COUNT(*) FILTER (WHERE ck IS NULL) FROM o_fact
UNION ALL SELECT 'fact_sales', 'product_id', COUNT(*) FILTER (WHERE pk IS NULL) FROM o_fact
UNION ALL SELECT 'fact_sales', 'order_date', COUNT(*) FILTER (WHERE od IS NULL) FROM o_fact"""

FK_VIOLATIONS = _with(_STAR, _RAW) + """
SELECT 'fact_sales' AS table_name, 'customer_id' AS column_name, 'dim_customers' AS "references",
       CAST(COUNT(*) AS BIGINT) AS orphan_rows, CAST(COUNT(DISTINCT ck) AS BIGINT) AS orphan_keys
FROM o_valid WHERE ck NOT IN (SELECT ck FROM c_clean)
UNION ALL
SELECT 'fact_sales', 'product_id', 'dim_products', COUNT(*), COUNT(DISTINCT pk)
FROM o_valid WHERE pk NOT IN (SELECT pk FROM p_keys)"""

# ------------------------------------------------------------------ warehouse

_SUMMARY = """
SELECT 'dim_customers' AS table_name, COUNT(*) AS rows, CAST(NULL AS DOUBLE) AS amount FROM dim_customers
UNION ALL SELECT 'dim_products', COUNT(*), CAST(SUM(price) AS DOUBLE) FROM dim_products
UNION ALL SELECT 'fact_sales', COUNT(*), CAST(SUM(item_total) AS DOUBLE) FROM fact_sales"""

PUBLISH_STAR = _with(_STAR) + f"""
SELECT s.*, CASE WHEN s.table_name = 'fact_sales'
                 THEN (SELECT COUNT(DISTINCT strftime(order_date, '%Y%m')) FROM fact_sales) END AS partitions
FROM ({_SUMMARY}) s"""

LOAD_STAR = _with(_STAR) + _SUMMARY

_UPSERT_BASE = """
firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, product_id
                                 ORDER BY line_number, supplier_id, quantity, unit_price, customer_id,
                                          item_total, order_total, order_date) AS rn
    FROM fact_sales) WHERE rn = 1
),
ref AS (SELECT MAX(order_date) AS ref_ts FROM fact_sales),
target AS (SELECT firsts.* FROM firsts, ref WHERE order_date < ref_ts - INTERVAL 6 MONTH)"""


def _upsert(source: str) -> str:
    return _with(_STAR, _UPSERT_BASE) + f""",
staged0 AS (
  SELECT order_id, customer_id, product_id, quantity + 1 AS quantity, unit_price,
         CAST((quantity + 1) * unit_price AS DECIMAL(18,2)) AS item_total, order_date
  FROM {source}, ref WHERE order_date >= ref_ts - INTERVAL 18 MONTH
),
staged AS (SELECT *, SUM(item_total) OVER (PARTITION BY order_id) AS order_total FROM staged0),
merged AS (
  SELECT order_id, customer_id, product_id, quantity, unit_price, item_total, order_total, order_date
  FROM target t
  WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.order_id = t.order_id AND s.product_id = t.product_id)
  UNION ALL
  SELECT order_id, customer_id, product_id, quantity, unit_price, item_total, order_total, order_date FROM staged
)
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
       CAST(product_id AS VARCHAR) AS product_id, CAST(quantity AS BIGINT) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(item_total AS DOUBLE) AS item_total,
       CAST(order_total AS DOUBLE) AS order_total, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date
FROM merged"""


UPSERT_MERGE = _upsert("firsts")
REPLACE_BY_KEY = _upsert("fact_sales")


def _restated(days: int) -> str:
    """``merged``: the fact before its latest order, with its last ``days`` days restated."""
    return _with(_STAR, _UPSERT_BASE) + f""",
batch AS (
  SELECT f.order_id, f.customer_id, f.product_id, f.quantity + 1 AS quantity, f.unit_price,
         CAST((f.quantity + 1) * f.unit_price AS DECIMAL(18,2)) AS item_total, f.order_date
  FROM firsts f, ref WHERE f.order_date >= ref_ts - INTERVAL {days} DAY
),
merged AS (
  SELECT order_id, customer_id, product_id, quantity, unit_price, item_total,
         SUM(item_total) OVER (PARTITION BY order_id) AS order_total, order_date FROM batch
  UNION ALL
  SELECT order_id, customer_id, product_id, quantity, unit_price, item_total, order_total, order_date
  FROM firsts WHERE (order_id, product_id) NOT IN (SELECT (order_id, product_id) FROM batch)
)"""


UPSERT_BUCKETS = _restated(2) + """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
       CAST(product_id AS VARCHAR) AS product_id, CAST(quantity AS BIGINT) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(item_total AS DOUBLE) AS item_total,
       CAST(order_total AS DOUBLE) AS order_total, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date
FROM merged"""

MARTS_INCREMENTAL = _restated(90) + """
SELECT 'kpi_totals' AS mart, 'all' AS key, CAST(SUM(item_total) AS DOUBLE) AS revenue, COUNT(DISTINCT order_id) AS orders FROM merged
UNION ALL
SELECT 'category_sales', p.category, CAST(SUM(m.item_total) AS DOUBLE), NULL
FROM merged m JOIN dim_products p ON m.product_id = p.product_id GROUP BY p.category
UNION ALL
SELECT 'monthly_sales', strftime(order_date, '%Y-%m'), CAST(SUM(item_total) AS DOUBLE), NULL FROM merged GROUP BY 2"""

LOAD_RESUME = _with(_STAR) + f"SELECT s.*, CAST(1 AS BIGINT) AS version FROM ({_SUMMARY}) s"

DISTINCT_SKETCH = _with(_STAR) + """
SELECT coalesce(strftime(order_date, '%Y-%m'), 'all') AS month, COUNT(DISTINCT order_id) AS exact_orders,
       COUNT(DISTINCT customer_id) AS exact_customers, TRUE AS orders_near, TRUE AS customers_near
FROM fact_sales GROUP BY GROUPING SETS ((strftime(order_date, '%Y-%m')), ())"""

CSV_REJECTS = """
WITH lines AS (
  SELECT c_custkey AS k, c_custkey % 97 = 0 AS comma, c_custkey % 101 = 0 AS newline,
         CAST(c_custkey AS VARCHAR) || ',' || c_name || ',Jr,' || lower(replace(c_name, '#', '.')) || '@example.com,2024-01-05,' AS with_jr,
         CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || lower(replace(c_name, '#', '.')) || '@example.com,2024-01-05,' AS without,
         CAST(c_nationkey AS VARCHAR) AS city, c_mktsegment || ',US' AS rest
  FROM customer
),
-- A comma too many is one row of eight values.  A newline makes two rows; with a comma too many
-- in the first one as well, that one has six of the seven values, else five.
bad AS (
  SELECT with_jr || city || ',' || rest AS text FROM lines WHERE comma AND NOT newline
  UNION ALL SELECT CASE WHEN comma THEN with_jr ELSE without END || city FROM lines WHERE newline
  UNION ALL SELECT 'North,' || rest FROM lines WHERE newline
)
SELECT 'customers' AS table_name, text, COUNT(*) AS rows, CAST(NULL AS BIGINT) AS ids FROM bad GROUP BY text
UNION ALL
SELECT 'customers', NULL, COUNT(*), CAST(SUM(k) AS BIGINT) FROM lines WHERE NOT comma AND NOT newline"""

# ------------------------------------------------------------------ flat file, profiles, payload

FLAT_KPIS = _with(_STAR) + """
SELECT p.category, CAST(SUM(f.item_total) AS DOUBLE) AS revenue, COUNT(DISTINCT f.order_id) AS orders,
       COUNT(*) AS lines, COUNT(DISTINCT c.name) AS customers, CAST(SUM(f.quantity) AS BIGINT) AS units
FROM fact_sales f
LEFT JOIN dim_customers c ON f.customer_id = c.customer_id
LEFT JOIN dim_products p ON f.product_id = p.product_id
WHERE p.category IS NOT NULL
GROUP BY p.category"""

FLAT_KPIS_CUSTOMERS = _with(_STAR) + """
SELECT c.name AS customer_name, CAST(SUM(f.item_total) AS DOUBLE) AS revenue, COUNT(DISTINCT f.order_id) AS orders,
       COUNT(*) AS lines, COUNT(DISTINCT p.category) AS categories, CAST(SUM(f.quantity) AS BIGINT) AS units,
       strftime(MAX(f.order_date), '%Y-%m-%d %H:%M:%S') AS latest_order
FROM fact_sales f
JOIN dim_customers c ON f.customer_id = c.customer_id
LEFT JOIN dim_products p ON f.product_id = p.product_id
WHERE c.name IS NOT NULL
GROUP BY c.name"""

SEASONALITY_SHARE = _with(_STAR) + f""",
order_grain AS (
  SELECT order_id, MIN(order_date) AS d, COUNT(*) AS lines FROM fact_sales
  WHERE order_id IS NOT NULL GROUP BY order_id
),
agg AS (
  SELECT COUNT(*) AS n,
         COUNT(*) FILTER (WHERE dayofweek(d) IN (0, 6)) AS weekend,
         COUNT(*) FILTER (WHERE month(d) IN (11, 12)) AS holiday,
         SUM(lines) AS lines
  FROM order_grain
)
SELECT CAST(n AS BIGINT) AS orders,
       {_half_up('weekend * 100 * 100', 'n')} AS weekend_order_pct,
       {_half_up('holiday * 100 * 100', 'n')} AS holiday_order_pct,
       {_half_up('lines * 100', 'n')} AS lines_per_order
FROM agg"""

MESSINESS_PROFILE = _with(_STAR, _RAW) + """
SELECT 'customers' AS table_name, 'duplicate_rows' AS metric,
       CAST((SELECT COUNT(*) FROM c_raw) - (SELECT COUNT(*) FROM c_base) AS BIGINT) AS value
UNION ALL SELECT 'customers', 'missing_emails',
       (SELECT COUNT(*) FROM c_raw WHERE email IS NULL OR trim(email) = '' OR lower(trim(email)) = 'nan')
UNION ALL SELECT 'customers', 'nonstandard_dates', (SELECT COUNT(*) FROM c_raw WHERE k IN (0, 1, 2, 3, 4))
UNION ALL SELECT 'orders', 'duplicate_rows', (SELECT COUNT(*) FROM o_raw) - (SELECT COUNT(*) FROM o_distinct)
UNION ALL SELECT 'orders', 'nonstandard_dates', (SELECT COUNT(*) FROM o_raw WHERE k < 10)
UNION ALL SELECT 'orders', 'nonpositive_quantities', (SELECT COUNT(*) FROM o_raw WHERE h IN (0, 1))
UNION ALL SELECT 'orders', 'nonpositive_prices', (SELECT COUNT(*) FROM o_raw WHERE g IN (0, 1))"""

DASHBOARD_PAYLOAD = _with(_STAR, _RECENT, _RFM_P) + f"""
SELECT 'status' AS section, 'status' AS key, CAST(NULL AS DOUBLE) AS num_value, 'success' AS text_value
UNION ALL SELECT 'metrics', 'total_revenue', CAST(SUM(item_total) AS DOUBLE), NULL FROM fact_sales
UNION ALL SELECT 'metrics', 'total_orders', CAST(COUNT(DISTINCT order_id) AS DOUBLE), NULL FROM fact_sales
UNION ALL SELECT 'metrics', 'total_customers', CAST(COUNT(DISTINCT customer_id) AS DOUBLE), NULL FROM dim_customers
UNION ALL SELECT 'metrics', 'avg_order_value',
       {_half_up('SUM(item_total) * 100', 'COUNT(DISTINCT order_id)')}, NULL FROM fact_sales
UNION ALL SELECT 'category_sales', p.category, CAST(SUM(f.item_total) AS DOUBLE), NULL
  FROM fact_sales f JOIN dim_products p ON f.product_id = p.product_id
  WHERE p.category IS NOT NULL GROUP BY p.category
UNION ALL SELECT 'monthly_sales', strftime(order_date, '%Y-%m'), CAST(SUM(item_total) AS DOUBLE), NULL
  FROM fact_sales GROUP BY 2
UNION ALL SELECT 'monthly_signups', strftime(signup_date, '%Y-%m'), CAST(COUNT(*) AS DOUBLE), NULL
  FROM dim_customers GROUP BY 2
UNION ALL SELECT 'rfm_segments', segment || '.count', CAST(customers AS DOUBLE), NULL FROM rfm_seg
UNION ALL SELECT 'rfm_segments', segment || '.revenue', revenue, NULL FROM rfm_seg
UNION ALL SELECT 'recent_transactions', position || '.order_id', NULL, order_id FROM recent
UNION ALL SELECT 'recent_transactions', position || '.customer_name', NULL, customer_name FROM recent
UNION ALL SELECT 'recent_transactions', position || '.product_name', NULL, product_name FROM recent
UNION ALL SELECT 'recent_transactions', position || '.category', NULL, category FROM recent
UNION ALL SELECT 'recent_transactions', position || '.order_date', NULL, order_date FROM recent
UNION ALL SELECT 'recent_transactions', position || '.quantity', CAST(quantity AS DOUBLE), NULL FROM recent
UNION ALL SELECT 'recent_transactions', position || '.item_total', item_total, NULL FROM recent"""

DASHBOARD_ENTRIES = f"SELECT * FROM ({DASHBOARD_PAYLOAD}) WHERE section NOT IN ('status', 'rfm_segments')"

DASHBOARD_DOCUMENT = _with(_STAR, _RECENT, _RFM_P) + f"""
SELECT 'success' AS status, (SELECT CAST(SUM(item_total) AS DOUBLE) FROM fact_sales) AS total_revenue,
       (SELECT CAST(COUNT(DISTINCT order_id) AS DOUBLE) FROM fact_sales) AS total_orders,
       (SELECT CAST(COUNT(DISTINCT customer_id) AS DOUBLE) FROM dim_customers) AS total_customers,
       (SELECT {_half_up('SUM(item_total) * 100', 'COUNT(DISTINCT order_id)')} FROM fact_sales) AS avg_order_value,
       (SELECT order_id FROM recent WHERE position = 0) AS latest_order,
       (SELECT order_id FROM recent WHERE position = 9) AS tenth_order,
       (SELECT COUNT(DISTINCT p.category) FROM fact_sales f JOIN dim_products p ON f.product_id = p.product_id) AS categories,
       (SELECT COUNT(DISTINCT strftime(order_date, '%Y-%m')) FROM fact_sales) AS months,
       segment, customers AS segment_customers, revenue AS segment_revenue
FROM rfm_seg"""


ORACLE: dict[str, str] = {
    "kpi_totals": KPI_TOTALS,
    "category_sales": CATEGORY_SALES,
    "monthly_sales": MONTHLY_SALES,
    "monthly_signups": MONTHLY_SIGNUPS,
    "recent_transactions": RECENT_TRANSACTIONS,
    "rfm_metrics_ts": RFM_METRICS_TS,
    "rfm_scores_bins": RFM_SCORES_BINS,
    "rfm_segments": RFM_SEGMENTS,
    "rfm_sql": RFM_SQL,
    "rfm_strategy": RFM_STRATEGY,
    "rfm_clean_bins": RFM_CLEAN_BINS,
    "rfm_clean_ntile": RFM_CLEAN_NTILE,
    "parse_dates": PARSE_DATES,
    "clean_customers": CLEAN_CUSTOMERS,
    "clean_products": CLEAN_PRODUCTS,
    "clean_orders": CLEAN_ORDERS,
    "order_totals": ORDER_TOTALS,
    "fact_sales": FACT_SALES,
    "orphan_counts": ORPHAN_COUNTS,
    "cleaning_summary": CLEANING_SUMMARY,
    "clean_from_csv": CLEAN_FROM_CSV,
    "pk_violations": PK_VIOLATIONS,
    "null_violations": NULL_VIOLATIONS,
    "fk_violations": FK_VIOLATIONS,
    "publish_star": PUBLISH_STAR,
    "load_star": LOAD_STAR,
    "upsert_merge": UPSERT_MERGE,
    "replace_by_key": REPLACE_BY_KEY,
    "upsert_buckets": UPSERT_BUCKETS,
    "marts_incremental": MARTS_INCREMENTAL,
    "load_resume": LOAD_RESUME,
    "rfm_bucketed": RFM_SQL,
    "category_sales_replicated": CATEGORY_SALES,
    "distinct_sketch": DISTINCT_SKETCH,
    "csv_rejects": CSV_REJECTS,
    "flat_kpis_customers": FLAT_KPIS_CUSTOMERS,
    "dashboard_entries": DASHBOARD_ENTRIES,
    "flat_kpis": FLAT_KPIS,
    "seasonality_share": SEASONALITY_SHARE,
    "messiness_profile": MESSINESS_PROFILE,
    "dashboard_payload": DASHBOARD_PAYLOAD,
    "dashboard_document": DASHBOARD_DOCUMENT,
}
