"""Independent SQL (DuckDB dialect) for every registered query.

Written from the semantics, not generated from the Spark plans: the bronze
adapter, the window dedup and the cleaning rules are spelled out in SQL, so a
mismatch points at a real difference. Money follows the exact-cents recipe:
C = cents of the rounded sum, mean = (2C + N) // (2N) cents (half-up).
"""

from __future__ import annotations


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), lambda w: upper(w[1:1]) || w[2:]), ' ')"


BRONZE = """
bronze AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id,
    CASE WHEN c_custkey % 50 = 0 THEN '   ' ELSE concat('  ', lower(c_name), ' ') END AS customer_name,
    concat(' sku-', lpad(cast(p_partkey AS VARCHAR), 6, '0')) AS product_sku, p_name AS product_name,
    cast(l_quantity AS INTEGER) AS quantity, p_retailprice AS unit_price, cast(o_orderdate AS DATE) AS order_date,
    concat(lower(r_name), ' ') AS region,
    CASE WHEN l_partkey % 97 = 0 THEN ' ' WHEN l_returnflag = 'R' THEN 'cancelled'
         WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'delivered' WHEN l_returnflag = 'A' THEN 'shipped'
         WHEN l_linestatus = 'F' THEN 'confirmed' ELSE 'pending' END AS status,
    CASE WHEN l_linenumber <= 4 THEN 'csv' ELSE 'postgres' END AS source,
    l_linenumber AS src_line, l_partkey AS src_part, l_suppkey AS src_supp, l_extendedprice AS src_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey)"""


def dedup(src: str, name: str) -> str:
    return f"""
{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY
    CASE WHEN source = 'postgres' THEN 1 ELSE 2 END, src_line NULLS FIRST, src_part NULLS FIRST,
    src_supp NULLS FIRST, src_price NULLS FIRST) AS rn
  FROM {src}),
{name} AS (
  SELECT order_id, customer_id, nullif({initcap('customer_name')}, '') AS customer_name,
    upper(trim(product_sku)) AS product_sku, {initcap('product_name')} AS product_name,
    quantity, unit_price, order_date, upper(trim(region)) AS region,
    nullif(upper(trim(status)), '') AS status, source
  FROM {name}_ranked WHERE rn = 1)"""


SILVER_CTE = "WITH" + BRONZE + "," + dedup("bronze", "silver")

SILVER_COLS = "order_id, customer_id, customer_name, product_sku, product_name, quantity, unit_price, order_date, region, status, source"


def cents(expr: str = "round(unit_price * quantity, 2)") -> str:
    return f"cast(round(sum({expr}) * 100) AS HUGEINT)"


def money(c: str) -> str:
    return f"cast({c} AS DOUBLE) / 100.0"


def mean(c: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN cast((2 * {c} + {n}) // (2 * {n}) AS DOUBLE) / 100.0 END"


def rollup(key_expr: str, key: str, rev: str, n: str, extra: str = "", source: str = "silver") -> str:
    return f"""
SELECT {key}, {money('c')} AS {rev}, n AS {n}, {mean('c', 'n')} AS avg_order_value{extra}
FROM (SELECT {key_expr} AS {key}, {cents()} AS c, count(order_id) AS n FROM {source} GROUP BY 1)"""


SQL: dict[str, str] = {}

SQL["silver_orders"] = f"{SILVER_CTE}\nSELECT {SILVER_COLS} FROM silver"
SQL["silver_from_sources"] = SQL["silver_orders"]

SQL["revenue_by_region"] = SILVER_CTE + rollup("region", "region", "total_revenue", "total_orders")

SQL["order_status_breakdown"] = SILVER_CTE + rollup("status", "status", "total_revenue", "total_orders")

SQL["monthly_sales_trend"] = SILVER_CTE + rollup(
    "strftime(order_date, '%Y-%m')", "year_month", "monthly_revenue", "total_orders"
)

SQL["revenue_by_product"] = (
    SILVER_CTE
    + f"""
SELECT product_name, {money('c')} AS total_revenue, n AS total_orders, units AS total_units_sold,
  {mean('pc', 'pn')} AS avg_unit_price
FROM (SELECT product_name, {cents()} AS c, count(order_id) AS n, cast(sum(quantity) AS BIGINT) AS units,
        {cents('unit_price')} AS pc, count(unit_price) AS pn
      FROM silver GROUP BY 1)"""
)

SQL["revenue_at_risk"] = (
    SILVER_CTE
    + f"""
SELECT {money('c')} AS revenue_at_risk, n AS orders_at_risk
FROM (SELECT {cents()} AS c, count(order_id) AS n FROM silver WHERE status IN ('PENDING', 'CONFIRMED'))"""
)

MONTHLY_CTE = (
    SILVER_CTE
    + ", monthly AS ("
    + rollup("strftime(order_date, '%Y-%m')", "year_month", "monthly_revenue", "total_orders")
    + ")"
)

SQL["best_worst_month"] = (
    MONTHLY_CTE
    + """
SELECT b.year_month AS best_month, b.monthly_revenue AS best_revenue, b.total_orders AS best_orders,
  w.year_month AS worst_month, w.monthly_revenue AS worst_revenue, w.total_orders AS worst_orders
FROM (SELECT * FROM monthly ORDER BY monthly_revenue DESC NULLS LAST, year_month LIMIT 1) b,
     (SELECT * FROM monthly ORDER BY monthly_revenue ASC NULLS FIRST, year_month LIMIT 1) w"""
)

SQL["typed_orders"] = (
    SILVER_CTE
    + """
SELECT try_cast(order_id AS BIGINT) AS order_id, try_cast(customer_id AS BIGINT) AS customer_id,
  customer_name, product_sku, product_name, try_cast(quantity AS INTEGER) AS quantity,
  try_cast(unit_price AS DOUBLE) AS unit_price, try_cast(order_date AS DATE) AS order_date,
  region, status, source
FROM silver"""
)

# --- sources, set operations, audits ---------------------------------------------

SQL["source_overlap"] = (
    "WITH" + BRONZE + """
SELECT order_id FROM bronze WHERE source = 'csv'
INTERSECT
SELECT order_id FROM bronze WHERE source = 'postgres'"""
)

SQL["dedup_audit"] = (
    SILVER_CTE
    + """
SELECT b.n AS rows_before, s.n AS rows_after, b.n - s.n AS rows_removed, o.n AS overlapping_keys
FROM (SELECT count(*) AS n FROM bronze) b, (SELECT count(*) AS n FROM silver) s,
     (SELECT count(*) AS n FROM (SELECT order_id FROM bronze WHERE source = 'csv'
                                  INTERSECT SELECT order_id FROM bronze WHERE source = 'postgres')) o"""
)

SQL["bronze_audit"] = (
    "WITH" + BRONZE + """
SELECT source, count(*) AS row_count, min(order_date) AS earliest_order, max(order_date) AS latest_order,
  count(*) FILTER (WHERE order_id IS NULL) AS null_order_ids, count(DISTINCT region) AS unique_regions
FROM bronze GROUP BY source"""
)

SQL["source_summary"] = (
    "WITH" + BRONZE + """
SELECT 'sales_orders_' || CASE WHEN source = 'csv' THEN 'csv' ELSE 'postgres' END AS table_name,
  count(*) AS row_count, min(order_date) AS earliest_order, max(order_date) AS latest_order,
  count(DISTINCT region) AS unique_regions
FROM bronze GROUP BY source"""
)

SQL["null_profile"] = SILVER_CTE + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM silver"
    for c in ("order_id", "customer_name", "product_name", "region", "status", "unit_price")
)

SQL["distinct_status"] = SILVER_CTE + "\nSELECT DISTINCT status FROM silver"
SQL["distinct_region"] = SILVER_CTE + "\nSELECT DISTINCT region FROM silver"

_GOLD_COUNTS = {
    "revenue_by_region": "SELECT count(DISTINCT coalesce(region, '<null>')) FROM silver",
    "revenue_by_product": "SELECT count(DISTINCT coalesce(product_name, '<null>')) FROM silver",
    "order_status_breakdown": "SELECT count(DISTINCT coalesce(status, '<null>')) FROM silver",
    "monthly_sales_trend": "SELECT count(DISTINCT coalesce(strftime(order_date, '%Y-%m'), '<null>')) FROM silver",
}

SQL["layer_audit"] = (
    SILVER_CTE
    + """
SELECT 'BRONZE' AS layer, 'sales_orders_csv' AS table_name, count(*) AS row_count FROM bronze WHERE source = 'csv'
UNION ALL SELECT 'BRONZE', 'sales_orders_postgres', count(*) FROM bronze WHERE source = 'postgres'
UNION ALL SELECT 'SILVER', 'sales_orders', count(*) FROM silver
"""
    + "\n".join(f"UNION ALL SELECT 'GOLD', '{t}', ({q})" for t, q in _GOLD_COUNTS.items())
)

SQL["csv_round_trip"] = (
    "WITH" + BRONZE + """
SELECT order_id, customer_id, customer_name, product_sku, product_name, quantity, unit_price, order_date,
  region, status, source
FROM bronze"""
)

_FITS = "src_part % 89 <> 0 AND src_part % 97 <> 0 AND src_part % 83 <> 0 AND src_part % 79 <> 0"
SQL["csv_quarantine"] = (
    "WITH" + BRONZE + f"""
SELECT CASE WHEN {_FITS} THEN order_id END AS order_id, CASE WHEN {_FITS} THEN quantity END AS quantity,
  CASE WHEN {_FITS} THEN unit_price END AS unit_price, CASE WHEN {_FITS} THEN order_date END AS order_date,
  CASE WHEN NOT ({_FITS}) THEN CASE WHEN src_part % 89 = 0 THEN '?' ELSE '' END || order_id END AS rejected_key
FROM bronze"""
)

# --- table operations --------------------------------------------------------------

SQL["merge_upsert"] = (
    "WITH" + BRONZE + ","
    + " tgt_src AS (SELECT * FROM bronze WHERE source = 'csv'),"
    + " upd_src AS (SELECT * FROM bronze WHERE source = 'postgres'),"
    + dedup("tgt_src", "tgt") + "," + dedup("upd_src", "upd")
    + f"""
SELECT {SILVER_COLS} FROM upd
UNION ALL
SELECT {SILVER_COLS} FROM tgt
WHERE NOT EXISTS (SELECT 1 FROM upd WHERE upd.order_id IS NOT DISTINCT FROM tgt.order_id)"""
)

SQL["bucket_merge"] = SQL["merge_upsert"]

SQL["constraint_violations"] = (
    SILVER_CTE
    + """
SELECT order_id, rule FROM (
  SELECT order_id, 'customer_name_present' AS rule, customer_name IS NOT NULL AS ok FROM silver
  UNION ALL SELECT order_id, 'status_present', status IS NOT NULL FROM silver
  UNION ALL SELECT order_id, 'quantity_positive', quantity > 0 FROM silver
  UNION ALL SELECT order_id, 'price_positive', unit_price > 0 FROM silver)
WHERE ok IS NOT TRUE"""
)

# history of one layer run: every table written once at version 0; the forecast
# table holds the training months (all months but the partial last one and the
# 2 holdout months) plus the 6-month horizon.
def _gold_rows(name: str, rollup_sql: str, key: str, revenue: str, orders: str, units: str, average: str) -> str:
    return f"""
UNION ALL SELECT '{name}', cast({key} AS VARCHAR), {revenue}, {orders}, {units}, {average}, NULL FROM ({rollup_sql})"""


_STORED_SILVER = """
SELECT 'sales_orders' AS table_name, cast(order_id AS VARCHAR) AS key, unit_price AS revenue, customer_id AS orders,
  cast(quantity AS BIGINT) AS units, NULL::DOUBLE AS mean,
  concat_ws('|', customer_name, product_sku, product_name, region, status, source, cast(order_date AS VARCHAR)) AS text
FROM silver"""
_STORED = _STORED_SILVER + _gold_rows("revenue_by_region", rollup("region", "region", "total_revenue", "total_orders"),
                      "region", "total_revenue", "total_orders", "NULL::BIGINT", "avg_order_value")
_STORED += _gold_rows("order_status_breakdown", rollup("status", "status", "total_revenue", "total_orders"),
                      "status", "total_revenue", "total_orders", "NULL::BIGINT", "avg_order_value")
_STORED += _gold_rows("monthly_sales_trend", rollup("strftime(order_date, '%Y-%m')", "year_month", "monthly_revenue", "total_orders"),
                      "year_month", "monthly_revenue", "total_orders", "NULL::BIGINT", "avg_order_value")
_STORED += _gold_rows("revenue_by_product", SQL["revenue_by_product"][len(SILVER_CTE):],
                      "product_name", "total_revenue", "total_orders", "total_units_sold", "avg_unit_price")

SQL["table_history"] = (
    SILVER_CTE
    + """
SELECT 'bronze' AS layer, 'sales_orders_csv' AS table_name, 0::BIGINT AS version, 'OVERWRITE' AS operation,
  count(*) AS row_count FROM bronze WHERE source = 'csv'
UNION ALL SELECT 'bronze', 'sales_orders_postgres', 0, 'OVERWRITE', count(*) FROM bronze WHERE source = 'postgres'
UNION ALL SELECT 'silver', 'sales_orders', 0, 'CREATE', 0
UNION ALL SELECT 'silver', 'sales_orders', 1, 'MERGE', count(*) FROM silver
"""
    + "\n".join(f"UNION ALL SELECT 'gold', '{t}', 0, 'OVERWRITE', ({q})" for t, q in _GOLD_COUNTS.items())
    + """
UNION ALL SELECT 'gold', 'revenue_forecast', 0, 'OVERWRITE',
  (SELECT count(DISTINCT strftime(order_date, '%Y-%m')) - 1 - 2 + 6 FROM silver)
UNION ALL SELECT 'gold', 'forecast_runs', 0, 'APPEND', 1"""
)

# --- forecasting --------------------------------------------------------------------

_MONTHLY_REGION = f"""
monthly_r AS (
  SELECT region, year_month, {money('c')} AS monthly_revenue
  FROM (SELECT region, strftime(order_date, '%Y-%m') AS year_month, {cents()} AS c FROM silver GROUP BY 1, 2)),
series_r AS (
  SELECT region, month, y FROM (
    SELECT region, cast(year_month || '-01' AS DATE) AS month, monthly_revenue / cast(100000 AS DOUBLE) AS y
    FROM monthly_r WHERE year_month IS NOT NULL)
  QUALIFY month < max(month) OVER ()),
split_r AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY region ORDER BY month DESC) <= 2
                 THEN 'test' ELSE 'train' END AS split
  FROM series_r)"""

REGION_CTE = SILVER_CTE + "," + _MONTHLY_REGION

_SERIES_G = f"""
series_g AS (
  SELECT month, y FROM (
    SELECT cast(year_month || '-01' AS DATE) AS month, monthly_revenue / cast(10000000 AS DOUBLE) AS y
    FROM monthly WHERE year_month IS NOT NULL)
  WHERE month < (SELECT max(cast(year_month || '-01' AS DATE)) FROM monthly WHERE year_month IS NOT NULL))"""

SQL["forecast_series"] = MONTHLY_CTE + "," + _SERIES_G + "\nSELECT month, y FROM series_g"

SQL["holdout_split"] = (
    MONTHLY_CTE + "," + _SERIES_G
    + """
SELECT month, y, CASE WHEN row_number() OVER (ORDER BY month DESC) <= 2 THEN 'test' ELSE 'train' END AS split
FROM series_g"""
)

SQL["trend_fit"] = (
    REGION_CTE
    + """
SELECT region, round(regr_slope(y, x), 9) AS slope, round(regr_intercept(y, x), 6) AS intercept,
  count(*) AS train_months, min(month) AS first_month, max(month) AS last_month
FROM (SELECT *, year(month) * 12 + month(month) AS x FROM split_r WHERE split = 'train')
GROUP BY region"""
)

_PRED_R = """,
coef AS (
  SELECT region, month, y, split,
    CASE WHEN regr_count(ty, tx) OVER w >= 3 THEN regr_slope(ty, tx) OVER w END AS slope,
    CASE WHEN regr_count(ty, tx) OVER w >= 3 THEN regr_intercept(ty, tx) OVER w END AS intercept,
    regr_sxx(ty, tx) OVER w AS sxx, regr_sxy(ty, tx) OVER w AS sxy, regr_syy(ty, tx) OVER w AS syy,
    regr_count(ty, tx) OVER w AS n,
    max(CASE WHEN split = 'train' THEN month END) OVER w AS last_train, max(month) OVER w AS last_month
  FROM (SELECT *, CASE WHEN split = 'train' THEN year(month) * 12 + month(month) END AS tx,
               CASE WHEN split = 'train' THEN y END AS ty FROM split_r)
  WINDOW w AS (PARTITION BY region)),
coef2 AS (
  SELECT *, CASE WHEN n > 2 THEN sqrt(greatest(cast(0 AS DOUBLE), syy - sxy * sxy / sxx) / (n - 2)) END AS sigma
  FROM coef),
frame AS (
  SELECT region, month, y AS actual, split, slope, intercept, sigma, last_train FROM coef2
  UNION ALL
  SELECT region, m AS month, NULL::DOUBLE AS actual, 'future' AS split, slope, intercept, sigma, last_train
  FROM (SELECT *, cast(last_train + to_months(i) AS DATE) AS m
        FROM coef2, range(1, 7) t(i) WHERE month = last_train)
  WHERE m > last_month),
pred AS (
  SELECT region, month, actual, split, last_train,
    intercept + slope * (year(month) * 12 + month(month)) AS yhat, sigma
  FROM frame),
pred2 AS (
  SELECT region, month, actual, split, yhat,
    yhat - 1.2815515655446004 * sigma AS lower, yhat + 1.2815515655446004 * sigma AS upper,
    split = 'train' OR month <= cast(last_train + to_months(6) AS DATE) AS in_frame
  FROM pred)"""

SQL["trend_forecast"] = (
    REGION_CTE + _PRED_R
    + """
SELECT region, strftime(month, '%Y-%m') AS month, round(yhat, 2) AS forecast_revenue,
  round(lower, 2) AS forecast_lower, round(upper, 2) AS forecast_upper, actual AS actual_revenue,
  actual IS NULL AS is_forecast
FROM pred2 WHERE in_frame"""
)

_MERGED = (
    "WITH" + BRONZE + ","
    + " tgt_src AS (SELECT * FROM bronze WHERE source = 'csv'),"
    + " upd_src AS (SELECT * FROM bronze WHERE source = 'postgres'),"
    + dedup("tgt_src", "tgt") + "," + dedup("upd_src", "upd")
    + """,
silver AS (
  SELECT * FROM upd UNION ALL
  SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM upd WHERE upd.order_id IS NOT DISTINCT FROM tgt.order_id))"""
)
SQL["gold_kept_up"] = (
    _MERGED + "\nSELECT table_name, key, revenue, orders, units, mean FROM ("
    + "\nSELECT NULL AS table_name, NULL AS key, NULL::DOUBLE AS revenue, NULL::BIGINT AS orders, NULL::BIGINT AS units, NULL::DOUBLE AS mean, NULL AS text"
    + _STORED.removeprefix(_STORED_SILVER) + ") WHERE table_name IS NOT NULL"
)

SQL["stored_ranges"] = (
    "WITH" + BRONZE + """
SELECT 'sales_orders_' || source AS table_name, count(*) AS row_count, min(order_date) AS min_order_date, max(order_date) AS max_order_date,
  min(quantity) AS min_quantity, max(quantity) AS max_quantity
FROM bronze GROUP BY source"""
)

# the stored forecast is one line over all regions, in Crore
SQL["layer_tables"] = (
    MONTHLY_CTE + "," + _SERIES_G
    + """,
split_r AS (
  SELECT NULL::VARCHAR AS region, month, y, CASE WHEN row_number() OVER (ORDER BY month DESC) <= 2 THEN 'test' ELSE 'train' END AS split
  FROM series_g)"""
    + _PRED_R + _STORED
    + """
UNION ALL SELECT 'revenue_forecast', strftime(month, '%Y-%m'), round(yhat, 2), cast(actual IS NULL AS BIGINT), NULL, actual, NULL
FROM pred2 WHERE in_frame"""
)

SQL["forecast_accuracy"] = (
    REGION_CTE + _PRED_R
    + """
SELECT region,
  round(avg(CASE WHEN split = 'test' THEN abs(actual - yhat) END), 2) AS mae,
  round(avg(CASE WHEN split = 'test' THEN abs((actual - yhat) / (actual + 1e-9)) END) * 100, 2) AS mape_pct,
  count(*) FILTER (WHERE split = 'test') AS test_months,
  count(*) FILTER (WHERE split = 'train' AND actual IS NOT NULL) AS train_months
FROM pred2 GROUP BY region"""
)

SQL["trend_forecast_runs"] = (
    REGION_CTE + _PRED_R
    + """
SELECT *, CASE WHEN train_months < 3 THEN 'too_short' ELSE 'ok' END AS fit_status, 'trend' AS model,
  6 AS horizon_months, 2 AS holdout_months, 'additive' AS seasonality_mode,
  NULL::DOUBLE AS season_period_days, NULL::INTEGER AS fourier_order, 0.8::DOUBLE AS interval_width
FROM (
  SELECT region,
    round(avg(CASE WHEN split = 'test' THEN abs(actual - yhat) END), 2) AS mae,
    round(avg(CASE WHEN split = 'test' THEN abs((actual - yhat) / (actual + 1e-9)) END) * 100, 2) AS mape_pct,
    count(*) FILTER (WHERE split = 'test') AS test_months,
    count(*) FILTER (WHERE split = 'train' AND actual IS NOT NULL) AS train_months
  FROM pred2 GROUP BY region)"""
)

# Months, actuals and flags of the seasonal model; a fit is right where there are 3 training months or more.
_TRAINED_R = "(SELECT region AS r, count(*) FILTER (WHERE split = 'train' AND y IS NOT NULL) AS n FROM split_r GROUP BY 1)"

SQL["seasonal_forecast_by_region"] = (
    REGION_CTE + _PRED_R
    + f"""
SELECT region, strftime(month, '%Y-%m') AS month, actual AS actual_revenue, actual IS NULL AS is_forecast,
  CASE WHEN n >= 3 THEN TRUE END AS fits, n >= 3 AS banded
FROM pred2 JOIN {_TRAINED_R} ON region IS NOT DISTINCT FROM r WHERE in_frame"""
)

# One place for a bend: the hinge cleared of level and slope has a soft threshold
# (noise 0.002 over the prior scale 0.05) as its coefficient; level and slope follow by least squares.
SQL["changepoint_fit"] = (
    REGION_CTE
    + """,
used AS (
  SELECT region, month, datediff('day', min(month) OVER w, month) AS days, y / max(abs(y)) OVER w AS v, max(abs(y)) OVER w AS scale,
    row_number() OVER (PARTITION BY region ORDER BY month) AS place, count(*) OVER w AS n
  FROM split_r WHERE split = 'train' AND y IS NOT NULL WINDOW w AS (PARTITION BY region)),
timed AS (SELECT *, days / max(days) OVER w AS t, max(days) OVER w AS span FROM used WINDOW w AS (PARTITION BY region)),
placed AS (SELECT *, max(CASE WHEN place = cast(floor(n * 0.8) AS BIGINT) THEN t END) OVER (PARTITION BY region) AS c FROM timed WHERE n >= 3),
hinged AS (SELECT *, greatest(cast(0 AS DOUBLE), t - c) AS h FROM placed),
cleared AS (SELECT *, h - regr_intercept(h, t) OVER w - regr_slope(h, t) OVER w * t AS rest FROM hinged WINDOW w AS (PARTITION BY region)),
pulled AS (SELECT region, sum(rest * v) AS pull, sum(rest * rest) AS size FROM cleared GROUP BY region),
bent AS (SELECT region, sign(pull) * greatest(abs(pull) - 0.002::DOUBLE / 0.05::DOUBLE, cast(0 AS DOUBLE)) / size AS change FROM pulled),
fit AS (
  SELECT h.region, any_value(c) AS c, any_value(change) AS change, any_value(scale) AS scale, any_value(span) AS span,
    min(month) AS origin, max(month) AS last_train, regr_intercept(v - change * h, t) AS level, regr_slope(v - change * h, t) AS slope
  FROM hinged h JOIN bent b ON h.region IS NOT DISTINCT FROM b.region GROUP BY h.region),
ends AS (SELECT region, max(month) AS last_month FROM split_r GROUP BY region),
last AS (
  SELECT f.*, datediff('day', origin, greatest(last_month, cast(last_train + to_months(6) AS DATE))) / span AS t
  FROM fit f JOIN ends e ON f.region IS NOT DISTINCT FROM e.region)
SELECT region, round(c, 7) AS change_at, round(level, 7) AS level, round(slope, 7) AS slope, round(change, 7) AS change,
  round((level + slope * t + change * greatest(cast(0 AS DOUBLE), t - c)) * scale, 7) AS last_forecast
FROM last"""
)

SQL["forecast_runs"] = (
    REGION_CTE
    + """
SELECT region, train_months >= 3 AND test_months > 0 AS has_mae, train_months >= 3 AND test_months > 0 AS has_mape,
  test_months, train_months, CASE WHEN train_months < 3 THEN 'too_short' ELSE 'ok' END AS fit_status,
  'seasonal' AS model, 6 AS horizon_months, 2 AS holdout_months, 'additive' AS seasonality_mode,
  91.25::DOUBLE AS season_period_days, 3 AS fourier_order, 0.8::DOUBLE AS interval_width
FROM (
  SELECT region, count(*) FILTER (WHERE split = 'test') AS test_months,
    count(*) FILTER (WHERE split = 'train' AND y IS NOT NULL) AS train_months
  FROM split_r GROUP BY region)"""
)

_DATED = """
SELECT order_id, order_date,
  cast(1.0 AS DOUBLE) + cast(0.6 AS DOUBLE) * (datediff('day', s, order_date)
    / CASE WHEN datediff('day', s, e) = 0 THEN 1 ELSE datediff('day', s, e) END) AS growth_factor
FROM silver, (SELECT min(order_date) AS s, max(order_date) AS e FROM silver)"""

SQL["growth_factor"] = SILVER_CTE + _DATED

# The twelve month weights, January first.
SQL["seasonal_factor"] = (
    SILVER_CTE
    + """
SELECT order_id, order_date,
  cast([1.1, 0.9, 1.0, 0.85, 0.8, 0.9, 1.0, 1.05, 1.1, 1.2, 1.3, 1.25] AS DOUBLE[])[month(order_date)] AS seasonal_factor
FROM silver"""
)
