"""Reference SQL for every registered query, for DuckDB over the given tables.

Written for DuckDB on its own: it shares no text with the Spark code. Ratios
that Spark rounds exactly are rounded with the same integer rule here, because
the two engines round half-way doubles differently.
"""

from __future__ import annotations

CHANNELS = """(VALUES (1,'Organic Search','Organic'),(2,'Paid Search','Paid'),(3,'Social Ads','Paid'),
  (4,'Email','Owned'),(5,'Referral','Referral'),(6,'Direct','Direct')) v(channel_id, channel_name, channel_type)"""

DIMENSIONS = f"""
dim_channel AS (SELECT * FROM {CHANNELS}),
span AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS first,
  last_day(CAST(max(o_orderdate) AS DATE)) AS last FROM orders),
dim_date AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
dim_product AS (
  SELECT *, (list_price * (40 + product_id % 50 + CASE WHEN category='PROMO' THEN 12 ELSE 0 END)) // 100 AS unit_cost
  FROM (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
    p_type || ' ' || CAST(p_size % 5 AS VARCHAR) AS subcategory, p_brand AS brand,
    CAST(round(p_retailprice*100, 0) AS BIGINT) AS list_price,
    'Supplier ' || CAST(p_partkey % 6 AS VARCHAR) AS supplier,
    CASE WHEN p_partkey % 10 <> 0 THEN 1 ELSE 0 END AS active_flag FROM part)),
dim_customer AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS customer_segment, n_name AS city, r_name AS region,
    (SELECT first + CAST((c_custkey*37) % (last - first + 181) - 180 AS INTEGER) FROM span) AS acquisition_date,
    channel_name AS acquisition_channel
  FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey
  JOIN dim_channel ON channel_id = 1 + c_custkey % 6),
fact_marketing AS (
  SELECT date, e.channel_id,
    channel_name || ' ' || CAST(year(date) AS VARCHAR) || 'Q' || CAST(quarter(date) AS VARCHAR) AS campaign_name,
    impressions, clicks, leads, conversions, marketing_spend
  FROM (SELECT (SELECT first + CAST(event_id % (last - first + 1) AS INTEGER) FROM span) AS date, CAST(2 + user_id % 4 AS INTEGER) AS channel_id,
      count(*)*20 AS impressions, CAST(sum(CASE WHEN event_type='click' THEN 4 ELSE 1 END) AS BIGINT) AS clicks,
      count(*) FILTER (event_type='signup') AS leads, count(*) FILTER (event_type='purchase') AS conversions,
      CAST(sum(CAST(round(value*100, 0) AS BIGINT)*10) AS BIGINT) AS marketing_spend
    FROM events GROUP BY ALL) e JOIN dim_channel c ON e.channel_id=c.channel_id)"""


LINES = """
base AS (
  SELECT l_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
    l_partkey AS product_id, l_linenumber AS ln, CAST(1 + l_orderkey % 6 AS INTEGER) AS channel_id,
    CAST(l_quantity AS INTEGER) AS quantity,
    CAST(round(l_extendedprice*100, 0) AS BIGINT) // nullif(CAST(l_quantity AS INTEGER), 0) AS unit_price,
    CAST(round(l_discount*100, 0) AS BIGINT) AS dp, l_returnflag,
    40 + p_partkey % 50 + CASE WHEN p_type='PROMO' THEN 12 ELSE 0 END AS cost_rate
  FROM lineitem LEFT JOIN orders ON l_orderkey=o_orderkey LEFT JOIN part ON l_partkey=p_partkey),
amounts AS (
  SELECT *, quantity*unit_price AS lst, (quantity*unit_price*dp*4) // 100 AS discount_amount,
    CASE WHEN (order_id*7+ln*3) % 10 < 4 THEN 0 ELSE 300 + (order_id*13+ln) % 600 END AS shipping_revenue,
    200 + (order_id*11+ln*5) % 500 + 40*(quantity-1) AS shipping_cost,
    CASE WHEN l_returnflag='R' AND (order_id+ln) % 4 = 0 THEN 1 ELSE 0 END AS returned_flag
  FROM base),
clean_sales AS (
  SELECT order_id, order_date, customer_id, product_id, channel_id, quantity, unit_price, discount_amount,
    shipping_revenue, (lst*cost_rate) // 100 AS product_cost, shipping_cost,
    ((lst - discount_amount + shipping_revenue)*29) // 1000 + 30 AS payment_fee, returned_flag,
    CASE WHEN returned_flag=1 THEN lst - discount_amount ELSE 0 END AS refund_amount, ln
  FROM amounts)"""


ECONOMICS = """
fact_sales AS (SELECT * EXCLUDE (ln) FROM clean_sales),
s AS (
  SELECT *, rev - product_cost - shipping_cost - payment_fee - refund_amount AS gp,
    strftime(order_date, '%Y-%m') AS ym
  FROM (SELECT *, quantity*unit_price AS lst, quantity*unit_price - discount_amount + shipping_revenue AS rev
        FROM fact_sales))"""


def whole(sql: str) -> str:
    return f"WITH {DIMENSIONS.strip()},{LINES},{ECONOMICS}{sql}"


RAW = """
raw_customer AS (
  SELECT customer_id, CASE WHEN customer_id % 50 = 1 THEN chr(9) || ' ' || customer_segment || '  '
      ELSE customer_segment END AS customer_segment,
    CASE WHEN customer_id % 100 <> 3 THEN city END AS city, CASE WHEN customer_id % 200 <> 5 THEN region END AS region,
    acquisition_date, acquisition_channel FROM dim_customer),
raw_product AS (
  SELECT * REPLACE (CASE WHEN product_id % 100 <> 7 THEN brand END AS brand,
    CASE WHEN product_id % 100 <> 9 THEN subcategory END AS subcategory) FROM dim_product),
spoiled AS (
  SELECT * REPLACE (CASE WHEN (order_id*31+ln) % 200 <> 11 THEN discount_amount END AS discount_amount,
    CASE WHEN (order_id*17+ln) % 200 <> 13 THEN shipping_cost END AS shipping_cost) FROM clean_sales),
raw_sales AS (
  SELECT * EXCLUDE (ln) FROM spoiled UNION ALL
  SELECT * EXCLUDE (ln) FROM spoiled WHERE (order_id*29+ln*7) % 1000 = 17),
dedup AS (SELECT DISTINCT * FROM raw_sales),
ranked AS (SELECT shipping_cost AS v, row_number() OVER (ORDER BY shipping_cost) AS i, count(*) OVER () AS n
  FROM dedup WHERE shipping_cost IS NOT NULL),
median AS (SELECT CAST((sum(v) FILTER (i = (n+1)//2) + sum(v) FILTER (i = n//2 + 1) + 1) // 2 AS BIGINT) AS m FROM ranked),
cleaned AS (
  SELECT * REPLACE (coalesce(discount_amount, 0) AS discount_amount, coalesce(shipping_cost, m) AS shipping_cost)
  FROM (SELECT dedup.*, m FROM dedup, median))"""


def raw(sql: str) -> str:
    return f"WITH {DIMENSIONS.strip()},{LINES},{RAW}{sql}"


# --- number helpers -------------------------------------------------------------------------------

def money(x: str) -> str:
    return f"CAST({x} AS DOUBLE)/100.0"


def quotient(num: str, den: str, scale: str = "1.0") -> str:
    return f"{scale}*CAST({num} AS DOUBLE)/nullif(CAST({den} AS DOUBLE), 0.0)"


def pct(num: str, den: str) -> str:
    return quotient(num, den, "100.0")


def exact(num: str, den: str, factor: int, places: int = 2) -> str:
    n, d = f"CAST({num} AS HUGEINT)", f"nullif(CAST({den} AS HUGEINT), 0)"
    sign = f"CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
    return f"CAST({sign} * (({2 * factor}*abs({n}) + abs({d})) // (2*abs({d}))) AS DOUBLE)/{float(10 ** places)}"


def pct2(num: str, den: str) -> str:
    return exact(num, den, 10000)


MONTHLY = """,
m AS (SELECT ym, count(DISTINCT order_id) AS orders, sum(rev) AS rev, sum(gp) AS gp FROM s GROUP BY ym),
mm AS (SELECT *, lag(rev) OVER (ORDER BY ym) AS prev, lag(gp) OVER (ORDER BY ym) AS pgp FROM m)"""

BY_CATEGORY = """,
c AS (SELECT category, count(DISTINCT order_id) AS orders, sum(quantity) AS units, sum(rev) AS rev, sum(gp) AS gp
  FROM s JOIN dim_product p USING (product_id) GROUP BY category)"""

# Margins in whole 1e-8, cut towards zero.
PRODUCTS = """,
p AS (SELECT product_id, product_name, category, sum(quantity) AS units, sum(rev) AS rev, sum(gp) AS gp
  FROM s JOIN dim_product USING (product_id) GROUP BY ALL),
scored AS (SELECT *, CAST(sign(gp) AS HUGEINT) * ((abs(gp)*100000000) // nullif(rev, 0)) AS margin FROM p),
stats AS (SELECT count(*) AS n, sum(units) AS units_all, count(margin) AS nm, sum(margin) AS margin_all FROM scored)"""

QUADRANT = f"""
SELECT product_id, product_name, category, CAST(units AS BIGINT) AS units, {money('rev')} AS revenue,
  {money('gp')} AS gross_profit, {pct2('gp', 'rev')} AS gross_margin_pct FROM scored, stats"""

LINE_MARGIN = """,
lm AS (SELECT *, CASE WHEN rev > 0 THEN CAST(sign(gp) AS BIGINT) * ((abs(gp)*100000000) // rev) END AS margin,
  CASE WHEN discount_amount*1000 <= -lst THEN NULL WHEN discount_amount*10000 <= lst THEN '0%'
    WHEN discount_amount*10 <= lst THEN '0-10%' WHEN discount_amount*10 <= lst*2 THEN '10-20%'
    WHEN discount_amount*10 <= lst*3 THEN '20-30%' WHEN discount_amount <= lst THEN '>30%' END AS discount_level
  FROM s WHERE lst > 0)"""

CHANNEL = """,
sales_c AS (SELECT channel_id, count(DISTINCT order_id) AS orders, sum(rev) AS rev, sum(gp) AS gp FROM s GROUP BY 1),
spend_c AS (SELECT channel_id, sum(marketing_spend) AS spend, CAST(sum(conversions) AS BIGINT) AS conversions
  FROM fact_marketing GROUP BY 1),
new_c AS (SELECT h.channel_id, count(*) AS new_customers FROM dim_customer c JOIN dim_channel h
  ON c.acquisition_channel=h.channel_name WHERE acquisition_date >= (SELECT min(date) FROM dim_date) GROUP BY 1),
ch AS (SELECT h.*, orders, rev, gp, spend, conversions, new_customers FROM dim_channel h
  LEFT JOIN sales_c USING (channel_id) LEFT JOIN spend_c USING (channel_id) LEFT JOIN new_c USING (channel_id))"""

RFM = """,
agg AS (SELECT customer_id, max(order_date) AS last_order_date, count(DISTINCT order_id) AS frequency,
  sum(rev - refund_amount) AS monetary FROM s GROUP BY 1),
rfm AS (SELECT *, CAST((SELECT max(order_date) FROM s) - last_order_date AS INTEGER) AS recency_days,
  count(*) OVER () AS n FROM agg)"""

_LADDER = """CASE WHEN m_score >= 4 AND f_score >= 4 AND r_score >= 3 THEN 'VIP'
    WHEN r_score <= 2 AND (f_score >= 3 OR m_score >= 4) THEN 'Clientes en riesgo'
    WHEN r_score <= 2 THEN 'Clientes inactivos' WHEN f_score <= 2 THEN 'Nuevos clientes'
    ELSE 'Clientes frecuentes' END"""

NTILE = RFM + f""",
q0 AS (SELECT *, CAST(ntile(5) OVER (ORDER BY last_order_date, customer_id) AS INTEGER) AS r_score,
  CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
  CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score FROM rfm),
q AS (SELECT *, {_LADDER} AS rfm_segment FROM q0)"""


def _quintile(order: str) -> str:
    return (f"CASE WHEN n = 1 THEN 1 ELSE greatest(1, (5*(row_number() OVER (ORDER BY {order}, customer_id) - 1)"
            f" + n - 2) // (n - 1)) END")


QUINTILE = RFM + f""",
q0 AS (SELECT *, CAST(6 - {_quintile('recency_days')} AS INTEGER) AS r_score,
  CAST({_quintile('frequency')} AS INTEGER) AS f_score, CAST({_quintile('monetary')} AS INTEGER) AS m_score FROM rfm),
q AS (SELECT *, {_LADDER} AS segment,
  CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_cell FROM q0),
everyone AS (
  SELECT c.customer_id, coalesce(segment, 'Clientes inactivos') AS segment,
    CAST(CASE WHEN q.customer_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS has_purchase,
    coalesce(recency_days, CAST((SELECT max(order_date) FROM s) - acquisition_date AS INTEGER)) AS recency_days,
    coalesce(frequency, 0) AS frequency, coalesce(monetary, 0) AS monetary, coalesce(r_score, 1) AS r_score,
    coalesce(f_score, 1) AS f_score, coalesce(m_score, 1) AS m_score,
    CAST(coalesce(r_score*100 + f_score*10 + m_score, 111) AS INTEGER) AS rfm_score,
    coalesce(rfm_cell, '111') AS rfm_cell, last_order_date,
    customer_segment, city, region, acquisition_date, acquisition_channel
  FROM dim_customer c LEFT JOIN q ON c.customer_id=q.customer_id)"""

# --- measures -------------------------------------------------------------------------------------

_GP = "(rev-pc-sc-pf-rf)"
MEASURES = {
    "revenue": money("rev"), "product_cost": money("pc"), "shipping_cost": money("sc"), "payment_fee": money("pf"),
    "refund_amount": money("rf"), "gross_profit": money(_GP), "gross_margin": quotient(_GP, "rev"),
    "orders": "orders", "units_sold": "CAST(units AS BIGINT)",
    "average_order_value": quotient("rev", "orders*100"),
    "marketing_spend": money("spend"), "new_customers": "new_customers", "cac": quotient("spend", "new_customers*100"),
    "roas": quotient("rev", "spend"), "net_marketing_contribution": money(f"({_GP}-coalesce(spend, 0))"),
    "returned_orders": "returned_orders", "return_rate": quotient("returned_orders", "orders"),
    "customers_with_orders": "buyers", "repeat_customers": "repeaters",
    "repeat_purchase_rate": quotient("repeaters", "buyers"), "revenue_per_customer": quotient("rev", "buyers*100"),
    "average_discount": quotient("disc", "lst"), "clv_approx": quotient(_GP, "buyers*100"),
    "conversions": "conversions", "cost_per_conversion": quotient("spend", "conversions*100"),
}


def measures(by: str | None = None, names: list[str] | None = None, line_key: str = "TRUE", lines: str = "s",
             spend_key: str | None = "TRUE", new_key: str | None = "TRUE") -> str:
    """Measures by one key. Each ``*_key`` is the key's expression over lines, marketing days and customers."""
    spend = (f"SELECT {spend_key} AS k, sum(marketing_spend) AS spend, CAST(sum(conversions) AS BIGINT) AS conversions "
             "FROM fact_marketing JOIN dim_channel USING (channel_id) GROUP BY 1" if spend_key else
             "SELECT NULL AS k, NULL::BIGINT AS spend, NULL::BIGINT AS conversions WHERE FALSE")
    new = (f"SELECT {new_key} AS k, count(DISTINCT customer_id) AS new_customers FROM dim_customer "
           "JOIN dim_date ON acquisition_date=date GROUP BY 1" if new_key else
           "SELECT NULL AS k, NULL::BIGINT AS new_customers WHERE FALSE")
    chosen = names or list(MEASURES)
    columns = ", ".join(f"{MEASURES[n]} AS {n}" for n in chosen)
    head = f"keys.k AS {by}, " if by else ""
    return f""",
a AS (SELECT {line_key} AS k, sum(rev) AS rev, sum(product_cost) AS pc, sum(shipping_cost) AS sc, sum(payment_fee) AS pf,
  sum(refund_amount) AS rf, sum(quantity) AS units, sum(discount_amount) AS disc, sum(lst) AS lst,
  count(DISTINCT order_id) AS orders,
  count(DISTINCT CASE WHEN returned_flag=1 THEN order_id END) AS returned_orders FROM {lines} GROUP BY 1),
b AS (SELECT k, count(*) AS buyers, count(*) FILTER (o >= 2) AS repeaters FROM (
  SELECT {line_key} AS k, customer_id, count(DISTINCT order_id) AS o FROM {lines} GROUP BY 1, 2) GROUP BY 1),
d AS ({spend}), e AS ({new}),
keys AS (SELECT k FROM a UNION SELECT k FROM b UNION SELECT k FROM d UNION SELECT k FROM e)
SELECT {head}{columns} FROM keys LEFT JOIN a ON a.k=keys.k LEFT JOIN b ON b.k=keys.k LEFT JOIN d ON d.k=keys.k
LEFT JOIN e ON e.k=keys.k"""


BY_MONTH = dict(by="year_month", line_key="ym", spend_key="strftime(date, '%Y-%m')",
                new_key="strftime(acquisition_date, '%Y-%m')")
PRODUCT_LINES = "(SELECT s.*, category FROM s JOIN dim_product USING (product_id)) z"
CHANNEL_LINES = "(SELECT s.*, channel_name FROM s JOIN dim_channel USING (channel_id)) z"

# --- quality --------------------------------------------------------------------------------------

DIM_DATE_KEYS = "(SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key FROM dim_date)"


def _rule(kind: str, table: str, column: str, severity: str, count: str, source: str, message: str,
          name: str | None = None) -> tuple[str, str]:
    label = name or (f"{kind}[{column}]" if column else kind)
    text = message.replace("'", "''")
    return kind, (f"SELECT '{label}' AS rule, '{table}' AS \"table\", '{severity}' AS severity, "
                  f"CAST(coalesce({count}, 0) AS BIGINT) AS n_errors, '{text}' AS msg FROM {source}")


def _rules(sales: str, customer: str, product: str) -> list[tuple[str, str]]:
    """The 31 rules as one SELECT each, over the named tables."""
    out = []
    for table, key, source in (("dim_date", "date_key", DIM_DATE_KEYS), ("dim_product", "product_id", product),
                               ("dim_customer", "customer_id", customer), ("dim_channel", "channel_id", "dim_channel")):
        out.append(_rule("duplicate_key", table, key, "critical", f"count(*) - count(DISTINCT {key})", source,
                         f" values of key '{key}' occur again."))
    for c in ("order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price"):
        out.append(_rule("nulls", "fact_sales", c, "critical", f"count(*) FILTER ({c} IS NULL)", sales,
                         f" values of '{c}' are missing."))
    for table, c, source in (("dim_customer", "city", customer), ("dim_customer", "region", customer),
                             ("dim_product", "brand", product), ("dim_product", "subcategory", product),
                             ("fact_sales", "discount_amount", sales), ("fact_sales", "shipping_cost", sales)):
        out.append(_rule("nulls", table, c, "warning", f"count(*) FILTER ({c} IS NULL)", source,
                         f" values of '{c}' are missing."))
    out.append(_rule("non_positive", "fact_sales", "quantity", "critical", "count(*) FILTER (quantity <= 0)", sales,
                     " values of 'quantity' are zero or less."))
    for c in ("unit_price", "discount_amount", "product_cost", "shipping_cost", "payment_fee", "refund_amount"):
        out.append(_rule("negative", "fact_sales", c, "critical", f"count(*) FILTER ({c} < 0)", sales,
                         f" values of '{c}' are below zero."))
    for table, c, source, parent in (("fact_sales", "customer_id", sales, customer),
                                     ("fact_sales", "product_id", sales, product),
                                     ("fact_sales", "channel_id", sales, "dim_channel"),
                                     ("fact_marketing", "channel_id", "fact_marketing", "dim_channel")):
        out.append(_rule("foreign_key", table, c, "critical", "count(*)",
                         f"{source} f WHERE f.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{c}=f.{c})",
                         f" values of '{table}.{c}' point to no '{c}'.", f"foreign_key[{c}->{c}]"))
    for table, c, source in (("fact_sales", "order_date", sales), ("fact_marketing", "date", "fact_marketing")):
        out.append(_rule("date_range", table, c, "critical",
                         f"count(*) FILTER ({c} IS NULL OR {c} < (SELECT min(date) FROM dim_date) "
                         f"OR {c} > (SELECT max(date) FROM dim_date))", source,
                         f" values of '{c}' are no date of the calendar."))
    out.append(_rule("duplicate_rows", "fact_sales", "", "warning",
                     f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {sales}))", sales,
                     " rows repeat another row in full."))
    revenue = "(quantity*unit_price - coalesce(discount_amount, 0) + shipping_revenue)"
    out.append(_rule("margin_sanity", "fact_sales", "", "warning",
                     f"count(*) FILTER ({revenue} > 0 AND {revenue} - product_cost - coalesce(shipping_cost, 0)"
                     f" - payment_fee - refund_amount > {revenue})", sales,
                     " rows earn more than their revenue."))
    return out


RAW_RULES = _rules("raw_sales", "raw_customer", "raw_product")
FILLED = """,
filled_customer AS (SELECT * REPLACE (coalesce(city, 'Unknown') AS city, coalesce(region, 'Unknown') AS region)
  FROM raw_customer),
filled_product AS (SELECT * REPLACE (coalesce(brand, 'Unknown') AS brand,
  coalesce(subcategory, 'Unknown') AS subcategory) FROM raw_product)"""
CLEAN_RULES = _rules("cleaned", "filled_customer", "filled_product")


def _results(rules: list[tuple[str, str]], name: str = "results") -> str:
    union = "\nUNION ALL ".join(sql for _, sql in rules)
    return f""",
{name} AS (SELECT rule, "table", severity, n_errors, CAST(n_errors AS VARCHAR) || msg AS message,
  n_errors = 0 AS passed, severity = 'critical' AND n_errors > 0 AS blocking FROM ({union}))"""


def _check(kind: str) -> str:
    return raw(_results([r for r in RAW_RULES if r[0] == kind]) + "\nSELECT * FROM results")


SUMMARY = """SELECT count(*) AS rules, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
  count(*) FILTER (blocking) AS critical_failures, count(*) FILTER (NOT passed AND severity='warning') AS warnings,
  CAST(sum(n_errors) AS BIGINT) AS total_errors FROM """


def _long_summary(table: str, label: str) -> str:
    return f"(UNPIVOT ({SUMMARY}{table}) ON COLUMNS(*) INTO NAME metric VALUE {label})"


def _orphans(with_marketing_date: bool) -> list[tuple[str, str]]:
    links = [("orphan_sales_customer", "fact_sales", "customer_id", "dim_customer", "customer_id"),
             ("orphan_sales_product", "fact_sales", "product_id", "dim_product", "product_id"),
             ("orphan_sales_channel", "fact_sales", "channel_id", "dim_channel", "channel_id"),
             ("orphan_sales_date", "fact_sales", "order_date", "dim_date", "date"),
             ("orphan_marketing_channel", "fact_marketing", "channel_id", "dim_channel", "channel_id")]
    if with_marketing_date:
        links.append(("orphan_marketing_date", "fact_marketing", "date", "dim_date", "date"))
    return [(n, f"(SELECT count(*) FROM {t} f LEFT JOIN {p} d ON f.{c}=d.{k} WHERE d.{k} IS NULL)")
            for n, t, c, p, k in links]


def _quality_checks() -> str:
    checks = [
        ("null_key_customer_id", "(SELECT count(*) FROM fact_sales WHERE customer_id IS NULL)"),
        ("null_key_product_id", "(SELECT count(*) FROM fact_sales WHERE product_id IS NULL)"),
        ("null_customer_city", "(SELECT count(*) FROM dim_customer WHERE city IS NULL)"),
        ("null_customer_region", "(SELECT count(*) FROM dim_customer WHERE region IS NULL)"),
        ("null_product_brand", "(SELECT count(*) FROM dim_product WHERE brand IS NULL)"),
        ("null_product_subcategory", "(SELECT count(*) FROM dim_product WHERE subcategory IS NULL)"),
        *_orphans(False),
        ("quantity_le_zero", "(SELECT count(*) FROM fact_sales WHERE quantity <= 0)"),
        ("negative_amounts", "(SELECT count(*) FROM fact_sales WHERE unit_price < 0 OR discount_amount < 0 OR "
                             "product_cost < 0 OR shipping_cost < 0 OR payment_fee < 0 OR refund_amount < 0)"),
        ("dates_out_of_period", "(SELECT count(*) FROM fact_sales WHERE order_date < (SELECT min(date) FROM dim_date) "
                                "OR order_date > (SELECT max(date) FROM dim_date))"),
        ("margin_gt_100pct", "(SELECT count(*) FROM s WHERE rev > 0 AND gp > rev)"),
    ]
    return whole("\n" + " UNION ALL ".join(f"SELECT '{n}' AS check_name, {q} AS issues" for n, q in checks))


def _load_verification() -> str:
    tables = ("dim_date", "dim_product", "dim_customer", "dim_channel", "fact_sales", "fact_marketing")
    checks = [(f"rowcount[{t}]", f"(SELECT count(*) FROM {t})", f"(SELECT count(*) FROM {t})") for t in tables]
    orphans = _orphans(True)
    checks += [(n, "0", q) for n, q in orphans]
    checks += [
        ("orders_without_customer", "0", "(SELECT count(*) FROM fact_sales WHERE customer_id IS NULL)"),
        ("lines_without_product", "0", "(SELECT count(*) FROM fact_sales WHERE product_id IS NULL)"),
        ("invalid_order_dates", "0", "(SELECT count(*) FROM fact_sales WHERE order_date IS NULL)"),
        ("total_revenue", *[f"(SELECT {money('sum(rev)')} FROM s)"] * 2),
        ("total_quantity", *["(SELECT sum(quantity) FROM s)"] * 2),
        ("distinct_orders", *["(SELECT count(DISTINCT order_id) FROM s)"] * 2),
        ("foreign_key_scan", "0", "(" + " + ".join(q for _, q in orphans) + ")"),
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, CAST({e} AS DOUBLE) AS expected, CAST({a} AS DOUBLE) AS actual"
        for n, e, a in checks)
    return whole(f"\nSELECT *, expected = actual AS passed FROM ({rows})")


def _constraints() -> str:
    tables = {
        "dim_date": ("""(SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date, year(date) AS year,
            quarter(date) AS quarter, month(date) AS month, monthname(date) AS month_name, week(date) AS week,
            dayname(date) AS day_of_week FROM dim_date) t""",
                     "date year quarter month month_name week day_of_week", "", "", ""),
        "dim_product": ("raw_product t", "product_name category unit_cost list_price active_flag",
                        "unit_cost list_price", "", "active_flag"),
        "dim_customer": ("raw_customer t", "customer_segment acquisition_date acquisition_channel", "", "", ""),
        "dim_channel": ("dim_channel t", "channel_name channel_type", "", "", ""),
        "fact_sales": ("raw_sales t", "order_id order_date customer_id product_id channel_id quantity unit_price "
                       "discount_amount shipping_revenue product_cost shipping_cost payment_fee returned_flag "
                       "refund_amount", "unit_price discount_amount shipping_revenue product_cost shipping_cost "
                       "payment_fee refund_amount", "quantity", "returned_flag"),
        "fact_marketing": ("fact_marketing t", "date channel_id campaign_name impressions clicks leads conversions "
                           "marketing_spend", "impressions clicks leads conversions marketing_spend", "", ""),
    }
    rows = []
    for table, (source, required, non_negative, positive, flags) in tables.items():
        tests = [(f"not_null[{c}]", f"{c} IS NULL") for c in required.split()]
        tests += [(f"check[{c} >= 0]", f"{c} < 0") for c in non_negative.split()]
        tests += [(f"check[{c} > 0]", f"{c} <= 0") for c in positive.split()]
        tests += [(f"check[{c} in (0, 1)]", f"{c} NOT IN (0, 1)") for c in flags.split()]
        rows += [f"SELECT '{table}' AS table_name, '{n}' AS constraint_name, count(*) FILTER ({t}) AS violations "
                 f"FROM {source}" for n, t in tests]
    for table, column in (("dim_date", "date_key"), ("dim_date", "date"), ("dim_product", "product_id"),
                          ("dim_customer", "customer_id"), ("dim_channel", "channel_id"), ("dim_channel", "channel_name")):
        rows.append(f"SELECT '{table}', 'unique[{column}]', count({column}) - count(DISTINCT {column}) "
                    f"FROM {tables[table][0]}")
    parents = {"dim_customer": "raw_customer", "dim_product": "raw_product"}
    for table, column, parent, key in (("fact_sales", "order_date", "dim_date", "date"),
                                       ("fact_marketing", "date", "dim_date", "date"),
                                       ("fact_marketing", "channel_id", "dim_channel", "channel_id"),
                                       ("fact_sales", "customer_id", "dim_customer", "customer_id"),
                                       ("fact_sales", "product_id", "dim_product", "product_id"),
                                       ("fact_sales", "channel_id", "dim_channel", "channel_id")):
        rows.append(f"SELECT '{table}', 'foreign_key[{column} -> {parent}.{key}]', count(*) FROM {tables[table][0]} "
                    f"WHERE t.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parents.get(parent, parent)} p "
                    f"WHERE p.{key}=t.{column})")
    return raw("\n" + " UNION ALL ".join(rows))


def _cleaning_log() -> str:
    counts = [("dim_date", "dim_date", "dim_date"), ("dim_product", "raw_product", "raw_product"),
              ("dim_customer", "raw_customer", "raw_customer"), ("dim_channel", "dim_channel", "dim_channel"),
              ("fact_sales", "raw_sales", "dedup"), ("fact_marketing", "fact_marketing", "fact_marketing")]
    rows = []
    for name, before, after in counts:
        a, b = f"(SELECT count(*) FROM {before})", f"(SELECT count(*) FROM {after})"
        rows += [f"SELECT 'rows_in' AS metric, '{name}' AS item, {a} AS value",
                 f"SELECT 'rows_out', '{name}', {b}", f"SELECT 'delta', '{name}', {b} - {a}"]
    fills = [("fact_sales", "dedup", ("discount_amount", "shipping_cost")), ("dim_customer", "raw_customer", ("city", "region")),
             ("dim_product", "raw_product", ("brand", "subcategory"))]
    filled = " UNION ALL ".join(
        f"SELECT 'nulls_filled' AS metric, '{t}.{c}' AS item, count(*) FILTER ({c} IS NULL) AS value FROM {source}"
        for t, source, columns in fills for c in columns)
    rows.append("SELECT * FROM filled WHERE value > 0")
    rows.append("SELECT 'duplicates_removed', 'fact_sales', (SELECT count(*) FROM raw_sales) - (SELECT count(*) FROM dedup)")
    rows.append("SELECT 'corrected', 'all', CAST((SELECT sum(value) FROM filled) AS BIGINT) + "
                "(SELECT count(*) FROM raw_sales) - (SELECT count(*) FROM dedup)")
    rows.append(f"SELECT 'text_normalized', column_name, normalized FROM ({_TEXT})")
    return raw(f",\nfilled AS ({filled})\n" + " UNION ALL ".join(rows))


_TEXT = " UNION ALL ".join(
    f"SELECT '{t}.{c}' AS column_name, count(*) FILTER (regexp_replace({c}, '^\\s+|\\s+$', '', 'g') <> {c}) AS normalized "
    f"FROM {source} HAVING normalized > 0"
    for t, source, columns in (
        ("dim_customer", "raw_customer", ("customer_segment", "city", "region", "acquisition_channel")),
        ("dim_product", "raw_product", ("product_name", "category", "subcategory", "brand", "supplier")),
        ("dim_channel", "dim_channel", ("channel_name", "channel_type")))
    for c in columns)

# --- findings -------------------------------------------------------------------------------------

F_TOTALS = (f"SELECT {money('sum(rev)')} AS total_revenue, {money('sum(gp)')} AS total_gross_profit, "
            f"{pct('sum(gp)', 'sum(rev)')} AS gross_margin_pct, count(DISTINCT order_id) AS orders FROM s")
F_LOSS = (f"SELECT role, category, {money('rev')} AS revenue, {money('gp')} AS gross_profit, "
          f"{pct('gp', 'rev')} AS gross_margin_pct FROM ("
          "SELECT 'loss' AS role, * FROM c WHERE gp < 0 UNION ALL "
          "SELECT 'top', * FROM (SELECT * FROM c ORDER BY gp DESC, category DESC LIMIT 1) UNION ALL "
          "SELECT 'named', * FROM c WHERE category='ECONOMY')")
F_PEAK = (f"SELECT a.ym AS peak_month, {money('a.rev')} AS peak_revenue, {pct('a.gp', 'a.rev')} AS peak_margin_pct, "
          f"b.ym AS drop_month, {pct('b.rev-b.prev', 'b.prev')} AS drop_mom_pct "
          "FROM (SELECT * FROM mm ORDER BY rev DESC, ym LIMIT 1) a, "
          f"(SELECT * FROM mm WHERE prev IS NOT NULL ORDER BY {pct('rev-prev', 'prev')}, ym LIMIT 1) b")
F_CONCENTRATION = (
    f"SELECT {pct('sum(gp)', 't')} AS top10_share_pct, max_by(product_name, i) AS top_product, {pct('max(gp)', 't')} AS top1_share_pct "
    "FROM (SELECT *, -row_number() OVER (ORDER BY gp DESC, product_id) AS i FROM p) , (SELECT sum(gp) AS t FROM p) "
    "WHERE i >= -10 GROUP BY t")
F_CHANNELS = (
    f"SELECT w.channel_name AS worst_paid_channel, {money('w.net')} AS worst_net_contribution, "
    f"CASE WHEN w.nc > 0 THEN {quotient('w.sp', 'w.nc*100')} END AS worst_cac, {quotient('w.rev', 'w.sp')} AS worst_roas, "
    f"{quotient('e.rev', 'e.sp')} AS email_roas, {money('e.net')} AS email_net_contribution, "
    f"(SELECT {money('coalesce(sum(gp), 0)')} FROM x WHERE sp = 0) AS zero_spend_gross_profit "
    "FROM (SELECT * FROM x WHERE channel_type='Paid' ORDER BY net, channel_id LIMIT 1) w, "
    "(SELECT * FROM x WHERE channel_name='Email') e")
X_CHANNEL = """,
x AS (SELECT *, coalesce(spend, 0) AS sp, coalesce(new_customers, 0) AS nc, gp - coalesce(spend, 0) AS net FROM ch)"""
F_RETURNS = (f"SELECT category, {pct('sum(returned_flag)', 'count(*)')} AS return_rate_pct, "
             f"{pct('sum(refund_amount)', 'sum(rev)')} AS refund_pct_of_revenue "
             "FROM s JOIN dim_product USING (product_id) GROUP BY category ORDER BY 2 DESC, 1 LIMIT 1")
_WITH = "CAST(sum(margin) FILTER (discount_amount > 0) AS DOUBLE)/(count(margin) FILTER (discount_amount > 0)*1000000)"
_WITHOUT = "CAST(sum(margin) FILTER (discount_amount = 0) AS DOUBLE)/(count(margin) FILTER (discount_amount = 0)*1000000)"
F_DISCOUNT = (f"SELECT *, without_discount_pct - with_discount_pct AS gap_points, "
              "CASE WHEN without_discount_pct > with_discount_pct THEN 'menor' ELSE 'mayor' END AS discounted_margin_is "
              f"FROM (SELECT {_WITH} AS with_discount_pct, {_WITHOUT} AS without_discount_pct FROM lm)")
F_SHIPPING = (f"SELECT {money('sum(shipping_revenue-shipping_cost)')} AS net_shipping, "
              "CASE WHEN sum(shipping_revenue-shipping_cost) < 0 THEN 'pérdida' ELSE 'ganancia' END AS outcome FROM s")
F_SEGMENTS = f"""SELECT v AS vip_customers, {pct('v', 'n')} AS vip_share_pct, {money('vm')} AS vip_monetary,
  nullif(ar, 0) AS at_risk_customers, {money('am')} AS at_risk_monetary FROM (
  SELECT count(*) AS n, count(*) FILTER (segment='VIP') AS v, sum(monetary) FILTER (segment='VIP') AS vm,
    count(*) FILTER (segment='Clientes en riesgo') AS ar,
    sum(monetary) FILTER (segment='Clientes en riesgo') AS am FROM everyone)"""


def _findings_report() -> str:
    def melt(name: str, table: str, numbers: list[str], texts: list[str], subject: str = "''") -> list[str]:
        rows = [f"SELECT '{name}' AS finding, {subject} AS subject, '{c}' AS metric, CAST({c} AS DOUBLE) AS value, "
                f"CAST(NULL AS VARCHAR) AS label FROM ({table})" for c in numbers]
        return rows + [f"SELECT '{name}', {subject}, '{c}', NULL, {c} FROM ({table})" for c in texts]

    rows = [
        *melt("totals", F_TOTALS, ["total_revenue", "total_gross_profit", "gross_margin_pct", "orders"], []),
        *melt("loss_categories", F_LOSS, ["revenue", "gross_profit", "gross_margin_pct"], [], "role || ':' || category"),
        *melt("peak_and_drop", F_PEAK, ["peak_revenue", "peak_margin_pct", "drop_mom_pct"], ["peak_month", "drop_month"]),
        *melt("concentration", F_CONCENTRATION, ["top10_share_pct", "top1_share_pct"], ["top_product"]),
        *melt("worst_return_category", F_RETURNS, ["return_rate_pct", "refund_pct_of_revenue"], [], "category"),
        *melt("discount_gap", F_DISCOUNT, ["with_discount_pct", "without_discount_pct", "gap_points"],
              ["discounted_margin_is"]),
        *melt("net_shipping", F_SHIPPING, ["net_shipping"], ["outcome"]),
        *melt("channels", "SELECT * FROM channel_finding",
              ["worst_net_contribution", "worst_cac", "worst_roas", "email_roas", "email_net_contribution",
               "zero_spend_gross_profit"], ["worst_paid_channel"]),
        *melt("segments", "SELECT * FROM segment_finding",
              ["vip_customers", "vip_share_pct", "vip_monetary", "at_risk_customers", "at_risk_monetary"], []),
    ]
    nested = (f"channel_finding AS (WITH {DIMENSIONS.strip()},{LINES},{ECONOMICS}{CHANNEL}{X_CHANNEL} {F_CHANNELS}),\n"
                 f"segment_finding AS (WITH {DIMENSIONS.strip()},{LINES},{ECONOMICS}{QUINTILE} {F_SEGMENTS})")
    return whole(f"{MONTHLY}{BY_CATEGORY}{PRODUCTS}{LINE_MARGIN},\n{nested}\n" + "\nUNION ALL ".join(rows))


# --- all queries ----------------------------------------------------------------------------------

def _orphan_rows() -> str:
    parts = []
    for name, key, parent, pkey in (("customer", "customer_id", "dim_customer", "customer_id"),
                                    ("product", "product_id", "dim_product", "product_id"),
                                    ("channel", "channel_id", "dim_channel", "channel_id"),
                                    ("date", "order_date", "dim_date", "date")):
        parts.append(f"SELECT '{name}' AS missing, order_id, product_id, CAST({key} AS VARCHAR) AS key_value FROM fact_sales "
                     f"WHERE {key} IS NULL OR {key} NOT IN (SELECT {pkey} FROM {parent})")
    return whole("\n" + " UNION ALL ".join(parts))


_RETURN_LINES = "FROM s JOIN dim_product USING (product_id) GROUP BY category"
_CAMPAIGN = "FROM fact_marketing JOIN dim_channel USING (channel_id) GROUP BY channel_name, campaign_name"
_FACT_MONEY = ("unit_price", "discount_amount", "shipping_revenue", "product_cost", "shipping_cost", "payment_fee",
               "refund_amount")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    cents = ", ".join(f"{money(c)} AS {c}" for c in _FACT_MONEY)
    q["sales_enriched"] = whole(f"""
SELECT order_id, order_date, customer_id, product_id, channel_id, quantity, {cents}, returned_flag, product_name, category,
  region, customer_segment, channel_name, channel_type, {money('rev')} AS revenue, {money('gp')} AS gross_profit,
  ym AS year_month, {money('lst')} AS list_amount
FROM s LEFT JOIN dim_product USING (product_id) LEFT JOIN dim_customer USING (customer_id)
LEFT JOIN dim_channel USING (channel_id)""")
    q["line_economics"] = whole(f"""
SELECT order_id, product_id, quantity, {money('rev')} AS revenue, {money('gp')} AS gross_profit FROM s""")
    q["line_discount_margin"] = whole(f"""{LINE_MARGIN}
SELECT order_id, product_id, discount_level, {quotient('discount_amount', 'lst')} AS discount_rate,
  CASE WHEN rev > 0 THEN {pct('gp', 'rev')} END AS margin_pct FROM lm""")
    q["orphan_sales_rows"] = _orphan_rows()
    q["monthly_revenue"] = whole(f"""{MONTHLY}
SELECT ym AS year_month, orders, {money('rev')} AS revenue, {money('gp')} AS gross_profit,
  {pct2('gp', 'rev')} AS gross_margin_pct, {exact('rev', 'orders', 1)} AS avg_order_value,
  {pct2('rev-prev', 'prev')} AS revenue_mom_pct, {pct2('gp-pgp', 'pgp')} AS gross_profit_mom_pct FROM mm""")
    q["monthly_margin_py"] = whole(f"""{MONTHLY}
SELECT ym AS year_month, orders, {money('rev')} AS revenue, {money('gp')} AS gross_profit,
  {pct('gp', 'rev')} AS gross_margin_pct, {pct('rev-prev', 'prev')} AS revenue_mom_pct FROM mm""")
    growth = f"""{MONTHLY},
g AS (SELECT a.ym, a.rev, a.gp, b.rev AS prev, b.gp AS pgp FROM m a LEFT JOIN m b
  ON strftime(CAST(a.ym || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m') = b.ym)"""
    q["mom_growth_calendar"] = whole(f"""{growth}
SELECT ym AS year_month, {money('rev')} AS revenue, {money('prev')} AS revenue_pm,
  {quotient('rev-prev', 'prev')} AS revenue_growth, {money('gp')} AS gross_profit, {money('pgp')} AS gross_profit_pm,
  {quotient('gp-pgp', 'pgp')} AS gross_profit_growth FROM g""")
    q["margin_by_category"] = whole(f"""{BY_CATEGORY}
SELECT category, orders, CAST(units AS BIGINT) AS units, {money('rev')} AS revenue, {money('gp')} AS gross_profit,
  {pct2('gp', 'rev')} AS gross_margin_pct, {exact('gp', 'units', 1)} AS profit_per_unit FROM c""")
    q["product_profitability"] = whole(f"""{PRODUCTS}
SELECT product_id, product_name, category, CAST(units AS BIGINT) AS units, {money('rev')} AS revenue,
  {money('gp')} AS gross_profit, {pct('gp', 'rev')} AS gross_margin_pct FROM p""")
    q["high_volume_low_margin"] = whole(f"{PRODUCTS}{QUADRANT} WHERE units*n >= units_all AND margin*nm <= margin_all")
    q["low_volume_high_margin"] = whole(f"{PRODUCTS}{QUADRANT} WHERE units*n <= units_all AND margin*nm >= margin_all")
    q["top10_margin_contribution"] = whole(f"""{PRODUCTS}
SELECT product_id, product_name, category, {money('gp')} AS gross_profit, {pct2('gp', 't')} AS pct_of_total_profit
FROM (SELECT *, sum(gp) OVER () AS t FROM p) ORDER BY gp DESC, product_id LIMIT 10""")
    q["returns_by_category"] = whole(f"""
SELECT category, count(*) AS lines, CAST(sum(returned_flag) AS BIGINT) AS returned_lines,
  {pct2('sum(returned_flag)', 'count(*)')} AS return_rate_line_pct,
  {pct2('count(DISTINCT CASE WHEN returned_flag=1 THEN order_id END)', 'count(DISTINCT order_id)')} AS return_rate_order_pct,
  {money('sum(refund_amount)')} AS total_refund, {pct2('sum(refund_amount)', 'sum(rev)')} AS refund_pct_of_revenue
{_RETURN_LINES}""")
    q["returns_by_category_line"] = whole(f"""
SELECT category, count(*) AS lines, CAST(sum(returned_flag) AS BIGINT) AS returned_lines,
  {money('sum(refund_amount)')} AS total_refund, {money('sum(rev)')} AS revenue,
  {pct('sum(returned_flag)', 'count(*)')} AS return_rate_pct,
  {pct('sum(refund_amount)', 'sum(rev)')} AS refund_pct_of_revenue {_RETURN_LINES}""")
    shipping = """,
r AS (SELECT region, count(shipping_cost) AS n, sum(shipping_cost) AS cost, sum(shipping_revenue) AS income
  FROM s LEFT JOIN dim_customer USING (customer_id) GROUP BY region)"""
    q["shipping_by_region"] = whole(f"""{shipping}
SELECT region, {quotient('cost', 'n*100')} AS avg_shipping_cost, {money('cost')} AS total_shipping_cost,
  {money('income')} AS total_shipping_revenue, {money('(income-cost)')} AS net_shipping FROM r""")
    q["page_ops_shipping"] = whole(f"""{shipping}
SELECT region, {quotient('cost', 'n*100')} AS avg_shipping_cost, {money('(income-cost)')} AS net_shipping FROM r""")
    q["margin_by_discount_bucket"] = whole(f"""{LINE_MARGIN}
SELECT discount_level, {quotient('sum(margin)', 'count(margin)*1000000')} AS margin_pct FROM lm
WHERE discount_level IS NOT NULL GROUP BY 1""")
    q["table_totals"] = whole(f"""
SELECT (SELECT count(*) FROM dim_date) AS dim_date_rows, (SELECT count(*) FROM dim_product) AS dim_product_rows,
  (SELECT count(*) FROM dim_customer) AS dim_customer_rows, (SELECT count(*) FROM dim_channel) AS dim_channel_rows,
  (SELECT count(*) FROM fact_sales) AS fact_sales_rows, (SELECT count(*) FROM fact_marketing) AS fact_marketing_rows,
  (SELECT count(DISTINCT order_id) FROM s) AS distinct_orders, (SELECT {money('sum(rev)')} FROM s) AS total_revenue,
  (SELECT {money('sum(gp)')} FROM s) AS total_gross_profit""")
    q["calendar_spine"] = whole("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(week(d) AS INTEGER) AS week, dayname(d) AS day_of_week
FROM (SELECT unnest(range(date_trunc('month', min(o_orderdate)),
  CAST(date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))""")
    q["seed_channels"] = whole(f""",
used AS (SELECT channel_id, regexp_replace(max(campaign_name), ' [0-9]+Q[0-9]$', '') AS channel_name,
  'In use' AS channel_type FROM fact_marketing GROUP BY 1)
SELECT * FROM used UNION ALL SELECT * FROM {CHANNELS} WHERE channel_id NOT IN (SELECT channel_id FROM used)""")
    q["load_star_counts"] = whole("\n" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("dim_date", "dim_product", "dim_customer", "dim_channel", "fact_sales", "fact_marketing")))
    q["load_verification"] = _load_verification()
    q["quality_checks"] = _quality_checks()

    # Channels and campaigns.
    q["channel_performance"] = whole(f"""{CHANNEL}
SELECT channel_id, channel_name, channel_type, coalesce(orders, 0) AS orders, {money('coalesce(rev, 0)')} AS revenue,
  {money('coalesce(gp, 0)')} AS gross_profit, {pct2('gp', 'rev')} AS gross_margin_pct,
  {money('coalesce(spend, 0)')} AS marketing_spend, coalesce(new_customers, 0) AS new_customers,
  coalesce(conversions, 0) AS conversions, {exact('spend', 'new_customers', 1)} AS cac,
  {exact('rev', 'spend', 100)} AS roas, {money('(coalesce(gp, 0)-coalesce(spend, 0))')} AS net_marketing_contribution,
  {pct2('(coalesce(gp, 0)-coalesce(spend, 0))', 'rev')} AS margin_after_mkt_pct FROM ch""")
    q["channel_performance_py"] = whole(f"""{CHANNEL}{X_CHANNEL}
SELECT channel_id, channel_name, channel_type, orders, {money('rev')} AS revenue, {money('gp')} AS gross_profit,
  {money('sp')} AS spend, coalesce(conversions, 0) AS conversions, nc AS new_customers,
  {pct('gp', 'rev')} AS gross_margin_pct, CASE WHEN nc > 0 THEN {quotient('sp', 'nc*100')} END AS cac,
  CASE WHEN sp > 0 THEN {quotient('rev', 'sp')} END AS roas, {money('net')} AS net_marketing_contribution FROM x""")
    funnel = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("impressions", "clicks", "conversions"))
    cost = exact("sum(marketing_spend)", "sum(conversions)", 1)
    q["campaign_performance"] = whole(f"""
SELECT channel_name, campaign_name, {money('sum(marketing_spend)')} AS spend, {funnel},
  {pct2('sum(clicks)', 'sum(impressions)')} AS ctr_pct, {pct2('sum(conversions)', 'sum(clicks)')} AS cvr_pct,
  {cost} AS cost_per_conversion {_CAMPAIGN}""")
    q["page_marketing_campaign"] = whole(f"""
SELECT channel_name, campaign_name, {money('sum(marketing_spend)')} AS spend, {funnel},
  {cost} AS cost_per_conversion {_CAMPAIGN}""")
    q["new_customers_by_channel"] = whole(f"""{CHANNEL}
SELECT channel_id, channel_name, new_customers FROM new_c JOIN dim_channel USING (channel_id)""")
    q["spend_by_channel"] = whole(f"{CHANNEL}\nSELECT channel_id, {money('spend')} AS spend, conversions FROM spend_c")

    # Customers.
    q["rfm_base"] = whole(f"""{RFM}
SELECT customer_id, last_order_date, frequency, {money('monetary')} AS monetary, recency_days FROM rfm""")
    q["rfm_quintile"] = whole(f"{QUINTILE}\nSELECT customer_id, r_score, f_score, m_score FROM q")
    q["rfm_ntile"] = whole(f"{NTILE}\nSELECT customer_id, r_score, f_score, m_score FROM q")
    q["rfm_scores_quintile"] = whole(f"""{QUINTILE}
SELECT customer_id, last_order_date, frequency, {money('monetary')} AS monetary, recency_days, r_score, f_score, m_score,
  CAST(r_score*100 + f_score*10 + m_score AS INTEGER) AS rfm_score, rfm_cell FROM q""")
    q["rfm_all_customers"] = q["rfm_export"] = whole(f"""{QUINTILE}
SELECT * REPLACE ({money('monetary')} AS monetary) FROM everyone""")
    q["rfm_scores_ntile"] = whole(f"""{NTILE}
SELECT customer_id, customer_segment, region, recency_days, frequency, {money('monetary')} AS monetary,
  r_score, f_score, m_score,
  CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_cell, rfm_segment
FROM q JOIN dim_customer USING (customer_id)""")
    q["customers_at_risk"] = whole(f"""{NTILE}
SELECT customer_id, customer_segment, region, recency_days, frequency, {money('monetary')} AS monetary,
  r_score, f_score, m_score FROM q JOIN dim_customer USING (customer_id)
WHERE r_score <= 2 AND (f_score >= 3 OR m_score >= 4)""")
    share = exact("count(*)", "sum(count(*)) OVER ()", 10000)
    q["rfm_segment_summary"] = whole(f"""{NTILE}
SELECT rfm_segment, count(*) AS customers, {exact('sum(recency_days)', 'count(*)', 10, 1)} AS avg_recency_days,
  {exact('sum(frequency)', 'count(*)', 100)} AS avg_frequency, {money('sum(monetary)')} AS total_monetary,
  {exact('sum(monetary)', 'count(*)', 1)} AS avg_monetary, {share} AS pct_of_customers FROM q GROUP BY rfm_segment""")
    q["segment_share"] = whole(f"""{NTILE}
SELECT rfm_segment, count(*) AS customers, {share} AS pct_of_customers FROM q GROUP BY rfm_segment""")
    q["rfm_segment_summary_all"] = whole(f"""{QUINTILE}
SELECT segment, count(*) AS customers, {money('sum(monetary)')} AS total_monetary,
  {quotient('sum(recency_days)', 'count(*)')} AS avg_recency FROM everyone GROUP BY segment""")
    q["rfm_distribution"] = whole(f"""{QUINTILE}
SELECT segment, count(*) AS customers, {quotient('sum(recency_days)', 'count(*)')} AS avg_recency,
  {quotient('sum(frequency)', 'count(*)')} AS avg_frequency, {money('sum(monetary)')} AS total_monetary,
  {quotient('sum(monetary)', 'count(*)*100')} AS avg_monetary, {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct_customers,
  {pct('sum(monetary)', 'sum(sum(monetary)) OVER ()')} AS pct_value FROM everyone GROUP BY segment""")
    bounds = [("recency_days", "r_score", "CAST(recency_days AS DOUBLE)"),
              ("frequency", "f_score", "CAST(frequency AS DOUBLE)"), ("monetary", "m_score", money("monetary"))]
    q["rfm_score_bounds"] = whole(f"{QUINTILE}\n" + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {sc} AS score, min({v}) AS min_value, max({v}) AS max_value FROM q GROUP BY {sc}"
        for m, sc, v in bounds))

    # Measures.
    q["measures_overall"] = whole(measures())
    q["measures_by_month"] = whole(measures(**BY_MONTH))
    q["measures_by_channel"] = whole(measures(
        by="channel_name", line_key="channel_name", lines=CHANNEL_LINES, spend_key="channel_name",
        new_key="acquisition_channel"))
    by_category = dict(by="category", line_key="category", lines=PRODUCT_LINES, spend_key=None, new_key=None)
    q["measures_by_category"] = whole(measures(**by_category))
    q["measures_sliced"] = whole(measures(
        by="brand", line_key="brand", spend_key=None, new_key=None,
        lines="(SELECT s.*, brand FROM s JOIN dim_product p USING (product_id) JOIN dim_customer c USING (customer_id) "
              "WHERE p.category IN ('PROMO','SMALL') AND c.region IN ('ASIA','EUROPE') AND p.active_flag=1) z",
        names=["revenue", "gross_profit", "gross_margin", "orders", "units_sold"]))
    q["repeat_purchase_rate"] = whole(f""",
o AS (SELECT acquisition_channel, customer_segment, customer_id, count(DISTINCT order_id) AS n FROM s
  JOIN dim_customer USING (customer_id) GROUP BY ALL)
SELECT acquisition_channel, customer_segment, count(*) AS customers_with_orders,
  count(*) FILTER (n >= 2) AS repeat_customers, {quotient('count(*) FILTER (n >= 2)', 'count(*)')} AS repeat_purchase_rate
FROM o GROUP BY 1, 2""")
    q["new_customers_by_month"] = whole("""
SELECT strftime(acquisition_date, '%Y-%m') AS year_month, count(DISTINCT customer_id) AS new_customers FROM dim_customer
JOIN dim_date ON acquisition_date=date GROUP BY 1""")

    # Pages.
    q["page_overview_kpis"] = whole(measures(names=[
        "revenue", "gross_profit", "gross_margin", "orders", "average_order_value", "marketing_spend", "roas"]))
    q["page_overview_monthly"] = whole(f"""{growth}
SELECT ym AS year_month, {money('rev')} AS revenue, {quotient(money('gp'), money('rev'))} AS gross_margin,
  {quotient('rev-prev', 'prev')} AS revenue_growth, {quotient('gp-pgp', 'pgp')} AS gross_profit_growth FROM g""")
    q["page_overview_category"] = whole(measures(**by_category, names=["gross_profit"]))
    days = "BETWEEN DATE '1996-07-01' AND DATE '1999-06-30'"
    q["measures_in_date_range"] = whole(
        measures(**BY_MONTH, lines=f"(SELECT * FROM s WHERE order_date {days}) z")
        .replace("FROM fact_marketing JOIN", f"FROM (SELECT * FROM fact_marketing WHERE date {days}) fm JOIN")
        .replace("FROM dim_customer JOIN", f"FROM (SELECT * FROM dim_customer WHERE acquisition_date {days}) dc JOIN"))
    q["measures_by_segment"] = whole(QUINTILE + measures(
        by="segment", line_key="segment", lines="(SELECT s.*, segment FROM s JOIN everyone USING (customer_id)) z",
        spend_key=None, new_key=None,
        names=["revenue", "gross_profit", "orders", "customers_with_orders", "repeat_purchase_rate"]))
    q["growth_by_category"] = whole(f""",
m AS (SELECT category, ym, sum(rev) AS rev, sum(gp) AS gp FROM s JOIN dim_product USING (product_id) GROUP BY ALL)
SELECT a.category, a.ym AS year_month, {money('a.rev')} AS revenue, {money('b.rev')} AS revenue_pm,
  {quotient('(a.rev-b.rev)', 'b.rev')} AS revenue_growth, {money('a.gp')} AS gross_profit,
  {money('b.gp')} AS gross_profit_pm, {quotient('(a.gp-b.gp)', 'b.gp')} AS gross_profit_growth
FROM m a LEFT JOIN m b ON a.category=b.category
  AND strftime(CAST(a.ym || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m') = b.ym""")
    some = PRODUCTS.replace("FROM s JOIN dim_product USING (product_id)", """FROM s JOIN dim_product USING (product_id)
  WHERE category IN ('PROMO', 'SMALL') AND order_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""")
    q["page_product_table_sliced"] = whole(f"""{some}
SELECT product_id, product_name, category, CAST(units AS BIGINT) AS units_sold, {money('rev')} AS revenue,
  {money('gp')} AS gross_profit, {pct('gp', 'rev')} AS gross_margin_pct,
  {quotient('units_all', 'n')} AS average_units, {quotient('margin_all', 'nm*1000000')} AS average_margin_pct
FROM scored, stats""")
    q["page_product_table"] = whole(f"""{PRODUCTS}
SELECT product_id, product_name, category, CAST(units AS BIGINT) AS units_sold, {money('rev')} AS revenue,
  {money('gp')} AS gross_profit, {pct('gp', 'rev')} AS gross_margin_pct,
  {quotient('units_all', 'n')} AS average_units, {quotient('margin_all', 'nm*1000000')} AS average_margin_pct
FROM scored, stats""")
    q["page_product_top10"] = whole(f"""{PRODUCTS}
SELECT product_name, category, {money('gp')} AS gross_profit FROM p ORDER BY gp DESC, product_id LIMIT 10""")
    q["page_marketing_kpis"] = whole(measures(names=[
        "marketing_spend", "revenue", "roas", "cac", "net_marketing_contribution", "conversions"]))
    q["page_marketing_channel"] = whole(measures(
        by="channel_name", line_key="channel_name", lines=CHANNEL_LINES, spend_key="channel_name",
        new_key="acquisition_channel",
        names=["net_marketing_contribution", "marketing_spend", "roas", "cac", "new_customers"]))
    q["page_customer_kpis"] = whole(measures(names=[
        "customers_with_orders", "repeat_purchase_rate", "revenue_per_customer", "clv_approx"]))
    vip = "sum(CASE WHEN segment='VIP' THEN {} END)"
    q["page_customer_segments"] = whole(f"""{QUINTILE},
t AS (SELECT count(*) FILTER (segment='VIP') AS v, coalesce({vip.format('monetary')}, 0) AS vm, sum(monetary) AS am
  FROM everyone)
SELECT segment, count(*) AS customers, {money('sum(monetary)')} AS monetary, v AS vip_customers,
  {pct2('vm', 'am')} AS vip_value_pct FROM everyone, t GROUP BY segment, v, vm, am""")
    q["page_customer_scatter"] = whole(f"""{QUINTILE}
SELECT customer_id, recency_days, frequency, {money('monetary')} AS monetary, segment FROM q""")
    q["page_customer_at_risk"] = whole(f"""{QUINTILE}
SELECT customer_id, customer_segment, region, recency_days, frequency, {money('monetary')} AS monetary FROM everyone
WHERE segment='Clientes en riesgo'""")
    q["page_ops_returns"] = whole(measures(**by_category, names=["return_rate", "refund_amount"]))
    q["page_ops_discount"] = whole(f"""{LINE_MARGIN}
SELECT discount_level, {quotient('sum(discount_amount)', 'sum(lst)')} AS average_discount,
  {quotient('sum(gp)', 'sum(rev)')} AS gross_margin FROM lm WHERE discount_level IS NOT NULL GROUP BY 1""")
    q["page_ops_alerts"] = whole(f""",
p AS (SELECT product_id, product_name, category, sum(rev) AS rev, sum(gp) AS gp, count(DISTINCT order_id) AS o,
  count(DISTINCT CASE WHEN returned_flag=1 THEN order_id END) AS ro FROM s JOIN dim_product USING (product_id) GROUP BY ALL),
f AS (SELECT *, CAST(gp < 0 AS INTEGER) AS negative_margin,
  CAST(ro * sum(o) OVER () >= o * sum(ro) OVER () AS INTEGER) AS high_return FROM p)
SELECT product_id, product_name, category, {quotient('gp', 'rev')} AS gross_margin, {quotient('ro', 'o')} AS return_rate,
  negative_margin, high_return FROM f WHERE negative_margin = 1 OR high_return = 1""")

    # Quality and cleaning.
    q["constraint_violations"] = _constraints()
    for key, kind in (("check_duplicate_keys", "duplicate_key"), ("check_nulls", "nulls"),
                      ("check_non_positive", "non_positive"), ("check_negative", "negative"),
                      ("check_foreign_key", "foreign_key"), ("check_date_range", "date_range"),
                      ("check_duplicate_rows", "duplicate_rows"), ("check_margin_sanity", "margin_sanity")):
        q[key] = _check(kind)
    q["validate_all"] = raw(_results(RAW_RULES) + "\nSELECT * FROM results")
    q["validation_summary"] = raw(_results(RAW_RULES) + f"\n{SUMMARY}results")
    q["blocking_gate"] = raw(_results(RAW_RULES) + """
SELECT count(*) FILTER (blocking) AS critical_failures, count(*) FILTER (blocking) > 0 AS blocked FROM results""")
    q["validation_before_after"] = raw(
        FILLED + _results(RAW_RULES, "r1") + _results(CLEAN_RULES, "r2")
        + f"\nSELECT metric, before, after FROM {_long_summary('r1', 'before')} JOIN {_long_summary('r2', 'after')} USING (metric)")
    q["source_null_report"] = raw(_results([r for r in RAW_RULES if r[0] == "nulls"]) + """
SELECT "table" || '.' || rule[7:-2] AS column_name, n_errors AS nulls, severity FROM results WHERE n_errors > 0""")
    q["clean_normalize_text"] = raw(f"\n{_TEXT}")
    q["clean_fill_unknown"] = raw("\n" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {k} AS id, '{c}' AS column_name, coalesce({c}, 'Unknown') AS value FROM {source}"
        for t, k, source, columns in (("dim_customer", "customer_id", "raw_customer", ("city", "region")),
                                      ("dim_product", "product_id", "raw_product", ("brand", "subcategory")))
        for c in columns))
    q["clean_dedup_sales"] = raw("\nSELECT * FROM dedup")
    q["clean_fill_discount"] = raw(
        "\nSELECT order_id, product_id, quantity, coalesce(discount_amount, 0) AS discount_amount FROM dedup")
    q["clean_fill_shipping_median"] = raw("\nSELECT order_id, product_id, quantity, shipping_cost FROM cleaned")
    q["clean_star"] = raw("""
SELECT order_id, product_id, customer_id, quantity, discount_amount, shipping_cost, coalesce(brand, 'Unknown') AS brand,
  coalesce(subcategory, 'Unknown') AS subcategory, coalesce(city, 'Unknown') AS city, coalesce(region, 'Unknown') AS region,
  regexp_replace(customer_segment, '^\\s+|\\s+$', '', 'g') AS customer_segment
FROM cleaned JOIN raw_product USING (product_id) JOIN raw_customer USING (customer_id)""")
    revenue = "sum(quantity*unit_price - coalesce(discount_amount, 0) + shipping_revenue)"
    q["reconcile_revenue"] = raw(f"""
SELECT {money('a')} AS raw_revenue, {money('b')} AS processed_revenue, {money('(a-b)')} AS difference
FROM (SELECT {revenue} AS a FROM raw_sales), (SELECT {revenue} AS b FROM cleaned)""")
    q["cleaning_log"] = _cleaning_log()

    # Findings.
    q["finding_totals"] = whole(f"\n{F_TOTALS}")
    q["finding_loss_categories"] = whole(f"{BY_CATEGORY}\n{F_LOSS}")
    q["finding_peak_and_drop"] = whole(f"{MONTHLY}\n{F_PEAK}")
    q["finding_concentration"] = whole(f"{PRODUCTS}\n{F_CONCENTRATION}")
    q["finding_channels"] = whole(f"{CHANNEL}{X_CHANNEL}\n{F_CHANNELS}")
    q["finding_worst_return_category"] = whole(f"\n{F_RETURNS}")
    q["finding_discount_gap"] = whole(f"{LINE_MARGIN}\n{F_DISCOUNT}")
    q["finding_net_shipping"] = whole(f"\n{F_SHIPPING}")
    q["finding_segments"] = whole(f"{QUINTILE}\n{F_SEGMENTS}")
    q["findings_report"] = _findings_report()
    return q
