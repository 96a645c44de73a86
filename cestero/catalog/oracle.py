"""The registered queries in SQL, run by DuckDB on the same tables.

Every statement starts with the same common tables: receipts (``tx``), their
form with one row per product (``ex``), products and categories (``pc``,
``cat``), and the intermediate results that several statements use.
"""

from __future__ import annotations

COMMON = """
WITH basket AS (
  SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ' ' ORDER BY l_linenumber, l_partkey) AS products
  FROM lineitem GROUP BY 1),
tx AS (
  SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS transaction_date,
         c_nationkey AS store_id, o_custkey AS customer_id, products
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN basket ON o_orderkey = l_orderkey),
ex AS (
  SELECT transaction_date, store_id, customer_id, u AS token, TRY_CAST(u AS BIGINT) AS product_id
  FROM (SELECT transaction_date, store_id, customer_id, unnest(string_split(trim(products), ' ')) AS u FROM tx)),
pc AS (SELECT p_partkey AS product_id, CAST(substr(p_brand, 7) AS INTEGER) AS category_id
       FROM part WHERE p_partkey % 50 <> 0),
cat AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS category_id, p_brand AS category_name
        FROM part WHERE p_brand <> 'Brand#11'),
daily AS (SELECT transaction_date AS date, count(*) AS n FROM tx GROUP BY 1),
gaps AS (
  SELECT * FROM (
    SELECT customer_id, prev_date, date, CAST(date_diff('day', prev_date, date) AS INTEGER) AS days_between
    FROM (SELECT customer_id, transaction_date AS date,
                 lag(transaction_date) OVER (PARTITION BY customer_id ORDER BY transaction_date) AS prev_date
          FROM tx)) WHERE days_between IS NOT NULL),
cgap AS (
  SELECT customer_id, avg(days_between) AS promedio_dias_entre_compras, min(days_between) AS min_dias,
         max(days_between) AS max_dias, count(*) AS num_intervalos FROM gaps GROUP BY 1),
freq AS (
  SELECT customer_id, count(*) AS num_compras, min(transaction_date) AS primera_compra,
         max(transaction_date) AS ultima_compra FROM tx GROUP BY 1),
rfm0 AS (
  SELECT customer_id, num_compras AS frequency, CAST(date_diff('day', ultima_compra,
         (SELECT max(transaction_date) FROM tx) + 1) AS INTEGER) AS recency FROM freq),
rfm1 AS (
  SELECT *, CAST(5 - ntile(4) OVER (ORDER BY recency, customer_id) AS INTEGER) AS R_score,
         CAST(ntile(4) OVER (ORDER BY frequency DESC, customer_id) AS INTEGER) AS F_score FROM rfm0),
rfm AS (
  SELECT customer_id, frequency, recency, R_score, F_score,
    CASE WHEN R_score >= 4 AND F_score >= 4 THEN 'Champions'
         WHEN R_score >= 3 AND F_score >= 3 THEN 'Loyal Customers'
         WHEN R_score >= 4 AND F_score <= 2 THEN 'Promising'
         WHEN R_score <= 2 AND F_score >= 4 THEN 'At Risk'
         WHEN R_score <= 2 AND F_score <= 2 THEN 'Lost'
         WHEN R_score >= 3 AND F_score <= 2 THEN 'Potential Loyalists'
         ELSE 'Regular' END AS RFM_segment FROM rfm1),
bits AS (SELECT p_type AS t, 1 << (row_number() OVER (ORDER BY p_type) - 1) AS b FROM (SELECT DISTINCT p_type FROM part)),
bmask AS (SELECT l_orderkey, bit_or(b) AS m FROM lineitem JOIN part ON l_partkey = p_partkey JOIN bits ON t = p_type GROUP BY 1),
sets AS (
  SELECT i, count(*) AS freq FROM bmask, (SELECT unnest(range(1, 64)) AS i) s WHERE (m & i) = i
  GROUP BY 1 HAVING count(*) >= ceil(0.01 * (SELECT count(*) FROM bmask))),
names AS (SELECT i, string_agg(t, ',' ORDER BY t) AS items FROM sets JOIN bits ON (i & b) <> 0 GROUP BY 1),
rules AS (
  SELECT na.items AS antecedent, t AS consequent, w.freq / a.freq AS confidence,
         (w.freq / a.freq) / (c.freq / (SELECT count(*) FROM bmask)) AS lift,
         w.freq / (SELECT count(*) FROM bmask) AS support
  FROM sets w JOIN bits ON (w.i & b) <> 0 JOIN sets a ON a.i = w.i - b JOIN sets c ON c.i = b
  JOIN names na ON na.i = a.i WHERE w.freq / a.freq >= 0.3)
"""

_STORE_GAPS = """
  SELECT store_id, customer_id, date_diff('day', lag(transaction_date) OVER (
    PARTITION BY store_id, customer_id ORDER BY transaction_date), transaction_date) AS days_between
  FROM tx QUALIFY days_between IS NOT NULL"""

# Itemsets of each store, whose names are made again, as a store may have sets that all have not.
_STORE_SETS = """
store_mask AS (SELECT store_id, m FROM bmask JOIN tx ON l_orderkey = transaction_id),
store_size AS (SELECT store_id, count(*) AS n FROM store_mask GROUP BY 1),
store_sets AS (
  SELECT store_id, i, count(*) AS freq FROM store_mask, (SELECT unnest(range(1, 64)) AS i) s WHERE (m & i) = i
  GROUP BY 1, 2 HAVING count(*) >= ceil(0.01 * (SELECT n FROM store_size z WHERE z.store_id = store_mask.store_id))),
names AS (SELECT i, string_agg(t, ',' ORDER BY t) AS items
          FROM (SELECT unnest(range(1, 64)) AS i) JOIN bits ON (i & b) <> 0 GROUP BY 1)"""

STATEMENTS = {
    "available_stores": """
SELECT DISTINCT store_id FROM tx
""",
    "transactions_for_stores": """
SELECT transaction_id, store_id, customer_id, products FROM tx WHERE store_id IN (1, 3, 5)
""",
    "transactions": """
SELECT transaction_id, transaction_date, store_id, customer_id, products FROM tx
""",
    "explode_transactions": """
SELECT transaction_date, store_id, customer_id, product_id FROM ex
""",
    "basic_metrics": """
SELECT (SELECT count(*) FROM tx) AS total_transactions, (SELECT count(*) FROM ex) AS total_sales_units
""",
    "top_products": """
SELECT product_id, count(*) AS total_sold FROM ex GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
    "top_customers": """
SELECT customer_id, count(*) AS total_purchases FROM tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
    "peak_days": """
SELECT transaction_date AS date, count(*) AS num_transactions FROM tx GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""",
    "top_categories": """
SELECT category_id, category_name, count(*) AS total_volume FROM ex LEFT JOIN pc USING (product_id) LEFT JOIN cat USING (category_id) GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS FIRST LIMIT 10
""",
    "executive_summary": """
SELECT 'basic_metrics' AS section, 1 AS rank, 'total_transactions' AS key, (SELECT count(*) FROM tx) AS value
UNION ALL SELECT 'basic_metrics', 2, 'total_sales_units', (SELECT count(*) FROM ex)
UNION ALL SELECT * FROM (SELECT 'top_products', CAST(row_number() OVER (ORDER BY n DESC, k) AS INTEGER) AS r, CAST(k AS VARCHAR), n FROM (SELECT product_id AS k, count(*) AS n FROM ex GROUP BY 1)) WHERE r <= 10
UNION ALL SELECT * FROM (SELECT 'top_customers', CAST(row_number() OVER (ORDER BY n DESC, k) AS INTEGER) AS r, CAST(k AS VARCHAR), n FROM (SELECT customer_id AS k, count(*) AS n FROM tx GROUP BY 1)) WHERE r <= 10
UNION ALL SELECT * FROM (SELECT 'peak_days', CAST(row_number() OVER (ORDER BY n DESC, date) AS INTEGER) AS r, CAST(date AS VARCHAR), n FROM daily) WHERE r <= 10
UNION ALL SELECT * FROM (SELECT 'top_categories', CAST(row_number() OVER (ORDER BY n DESC, k NULLS FIRST) AS INTEGER) AS r, CAST(k AS VARCHAR), n FROM (SELECT category_id AS k, count(*) AS n FROM ex LEFT JOIN pc USING (product_id) GROUP BY 1)) WHERE r <= 10
""",
    "purchase_frequency": """
SELECT * FROM freq
""",
    "purchase_frequency_stats": """
SELECT avg(num_compras) AS promedio_compras, min(num_compras) AS min_compras, max(num_compras) AS max_compras FROM freq
""",
    "purchase_frequency_histogram": """
SELECT num_compras, count(*) AS num_clientes FROM freq GROUP BY 1
""",
    "purchase_gaps": """
SELECT * FROM gaps
""",
    "time_between_purchases": """
SELECT * FROM cgap
""",
    "time_between_stats": """
SELECT round(avg(promedio_dias_entre_compras), 6) AS promedio_general, min(promedio_dias_entre_compras) AS min_promedio, max(promedio_dias_entre_compras) AS max_promedio FROM cgap
""",
    "frequency_tiers": """
SELECT CASE WHEN promedio_dias_entre_compras <= 7 THEN 'Muy Frecuente (≤7 días)' WHEN promedio_dias_entre_compras <= 15 THEN 'Frecuente (8-15 días)' WHEN promedio_dias_entre_compras <= 30 THEN 'Regular (16-30 días)' WHEN promedio_dias_entre_compras <= 60 THEN 'Ocasional (31-60 días)' ELSE 'Esporádico (>60 días)' END AS categoria_frecuencia, count(*) AS num_clientes FROM cgap GROUP BY 1
""",
    "rfm_segmentation": """
SELECT * FROM rfm
""",
    "rfm_segment_profile": """
SELECT RFM_segment, count(*) AS num_clientes, round(avg(recency), 6) AS avg_recency, round(avg(frequency), 6) AS avg_frequency FROM rfm GROUP BY 1
""",
    "daily_sales": """
SELECT transaction_date AS date, count(*) AS num_transacciones, count(DISTINCT customer_id) AS clientes_unicos FROM tx GROUP BY 1
""",
    "daily_sales_stats": """
SELECT avg(n) AS promedio_diario, min(n) AS min_diario, max(n) AS max_diario FROM daily
""",
    "weekly_sales": """
SELECT CAST(year(transaction_date) AS INTEGER) AS year, CAST(weekofyear(transaction_date) AS INTEGER) AS week, count(*) AS num_transacciones, min(transaction_date) AS inicio_semana, max(transaction_date) AS fin_semana FROM tx GROUP BY 1, 2
""",
    "weekly_sales_stats": """
SELECT avg(n) AS promedio_semanal, min(n) AS min_semanal, max(n) AS max_semanal FROM (SELECT count(*) AS n FROM tx GROUP BY year(transaction_date), weekofyear(transaction_date))
""",
    "monthly_sales": """
SELECT CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month, monthname(transaction_date) AS month_name, count(*) AS num_transacciones FROM tx GROUP BY 1, 2, 3
""",
    "monthly_sales_stats": """
SELECT avg(n) AS promedio_mensual, min(n) AS min_mensual, max(n) AS max_mensual FROM (SELECT count(*) AS n FROM tx GROUP BY year(transaction_date), month(transaction_date))
""",
    "day_of_week_sales": """
SELECT CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS day_of_week, dayname(transaction_date) AS day_name, count(*) AS num_transacciones FROM tx GROUP BY 1, 2
""",
    "day_of_week_extremes": """
SELECT arg_max(day_name, (n, -d)) AS max_day, max(n) AS max_transacciones, arg_min(day_name, (n, d)) AS min_day, min(n) AS min_transacciones FROM (SELECT dayofweek(transaction_date) AS d, dayname(transaction_date) AS day_name, count(*) AS n FROM tx GROUP BY 1, 2)
""",
    "sales_trend": """
SELECT date, n AS num_transacciones, avg(n) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7d FROM daily
""",
    "trend_change": """
SELECT f AS first_week_avg, l AS last_week_avg, round((l - f) / f * 100, 6) AS trend_change, CASE WHEN (l - f) / f * 100 > 5 THEN 'CRECIENTE' WHEN (l - f) / f * 100 < -5 THEN 'DECRECIENTE' ELSE 'ESTABLE' END AS trend FROM (SELECT (SELECT avg(n) FROM (SELECT n FROM daily ORDER BY date LIMIT 7)) AS f, (SELECT avg(n) FROM (SELECT n FROM daily ORDER BY date DESC LIMIT 7)) AS l)
""",
    "product_sales": """
SELECT product_id, count(*) AS num_ventas FROM ex GROUP BY 1
""",
    "product_sales_stats": """
SELECT avg(n) AS promedio_ventas, min(n) AS min_ventas, max(n) AS max_ventas FROM (SELECT count(*) AS n FROM ex GROUP BY product_id)
""",
    "top_products_per_store": """
SELECT * FROM (SELECT store_id, product_id, num_ventas, CAST(row_number() OVER (PARTITION BY store_id ORDER BY num_ventas DESC, product_id) AS INTEGER) AS rank FROM (SELECT store_id, product_id, count(*) AS num_ventas FROM ex GROUP BY 1, 2)) WHERE rank <= 10
""",
    "baskets": """
SELECT customer_id, transaction_date, store_id, array_to_string(string_split(trim(products), ' '), ',') AS items FROM tx
""",
    "basket_stats": """
SELECT count(*) AS num_transacciones, avg(s) AS avg_basket_size, min(s) AS min_basket_size, max(s) AS max_basket_size FROM (SELECT CAST(len(string_split(trim(products), ' ')) AS INTEGER) AS s FROM tx)
""",
    "product_combinations": """
SELECT array_to_string(string_split(trim(products), ' '), ',') AS items, count(*) AS frequency FROM tx WHERE len(string_split(trim(products), ' ')) >= 2 GROUP BY 1
""",
    "multi_item_count": """
SELECT count(*) AS num_multi_item FROM tx WHERE len(string_split(trim(products), ' ')) >= 2
""",
    "frequent_itemsets": """
SELECT items, freq FROM sets JOIN names USING (i)
""",
    "top_itemsets": """
SELECT items, freq FROM sets JOIN names USING (i) ORDER BY freq DESC, items LIMIT 20
""",
    "association_rules": """
SELECT antecedent, consequent, round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(support, 6) AS support FROM rules
""",
    "top_rules": """
SELECT antecedent, consequent, round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(support, 6) AS support FROM rules ORDER BY round(lift, 6) DESC, round(confidence, 6) DESC, antecedent, consequent LIMIT 20
""",
    "strong_rules": """
SELECT antecedent, consequent, round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(support, 6) AS support FROM rules WHERE lift > 1.02 AND confidence > 0.5
""",
    "mining_counts": """
SELECT (SELECT count(*) FROM sets) AS num_itemsets, (SELECT count(*) FROM rules) AS num_rules, (SELECT count(*) FROM rules WHERE lift > 1.02 AND confidence > 0.5) AS num_strong_rules
""",
    "weekly_sales_iso": """
SELECT CAST(isoyear(transaction_date) AS INTEGER) AS year, CAST(weekofyear(transaction_date) AS INTEGER) AS week,
       count(*) AS num_transacciones, min(transaction_date) AS inicio_semana, max(transaction_date) AS fin_semana
FROM tx GROUP BY 1, 2
""",
    "reference_csv_roundtrip": """
SELECT category_id, product_id, category_name FROM pc LEFT JOIN cat USING (category_id)
""",
    "rfm_segmentation_inverted": """
SELECT customer_id, frequency, recency, R_score, F_score,
  CASE WHEN R_score >= 4 AND F_score >= 4 THEN 'Champions'
       WHEN R_score >= 3 AND F_score >= 3 THEN 'Loyal Customers'
       WHEN R_score >= 4 AND F_score <= 2 THEN 'Promising'
       WHEN R_score <= 2 AND F_score >= 4 THEN 'At Risk'
       WHEN R_score <= 2 AND F_score <= 2 THEN 'Lost'
       WHEN R_score >= 3 AND F_score <= 2 THEN 'Potential Loyalists'
       ELSE 'Regular' END AS RFM_segment
FROM (SELECT customer_id, frequency, R_score, 5 - F_score AS F_score,
             CAST(date_diff('day', ultima_compra, DATE '2002-01-01') AS INTEGER) AS recency
      FROM rfm1 JOIN (SELECT customer_id, ultima_compra FROM freq) USING (customer_id))
""",
    "product_combinations_normalised": """
SELECT array_to_string(items, ',') AS items, count(*) AS frequency
FROM (SELECT list_sort(list_distinct(string_split(trim(products), ' '))) AS items FROM tx WHERE products IS NOT NULL)
WHERE len(items) >= 2 GROUP BY 1
""",
    "frequent_items": """
SELECT t AS item, count(*) AS freq FROM bmask JOIN bits ON (m & b) <> 0
GROUP BY 1 HAVING count(*) >= ceil(0.01 * (SELECT count(*) FROM bmask))
UNION ALL SELECT NULL, count(*) FROM bmask
""",
    "report_top_items": """
SELECT 'categories' AS type, 10 AS top_n, CAST(row_number() OVER (ORDER BY n DESC, category_id NULLS FIRST) AS INTEGER) AS position,
       category_id, category_name, n AS total_volume
FROM (SELECT category_id, category_name, count(*) AS n FROM ex LEFT JOIN pc USING (product_id) LEFT JOIN cat USING (category_id) GROUP BY 1, 2)
ORDER BY position LIMIT 10
""",
    "report_time_series": """
SELECT transaction_date AS date, count(*) AS num_transacciones, count(DISTINCT customer_id) AS clientes_unicos,
       'daily_sales' AS series_name, 'num_transacciones' AS value_column FROM tx GROUP BY 1
""",
    "report_matrix": """
SELECT CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS row, CAST(month(transaction_date) AS INTEGER) AS col,
       count(*) AS value FROM tx GROUP BY 1, 2
""",
    "report_clusters": """
SELECT customer_id, num_compras AS cluster, num_clientes,
       CAST((SELECT count(DISTINCT num_compras) FROM freq) AS INTEGER) AS n_clusters, (SELECT count(*) FROM freq) AS total_customers
FROM freq JOIN (SELECT num_compras, count(*) AS num_clientes FROM freq GROUP BY 1) USING (num_compras)
""",
    "report_run_metadata": """
SELECT 'daily' AS dag_id, 'summary' AS task_id, 'success' AS status,
       (SELECT count(*) FROM tx) AS total_transactions, (SELECT count(*) FROM ex) AS total_sales_units
""",
    "category_report": """
SELECT category_id, category_name, count(DISTINCT product_id) AS num_products
FROM cat LEFT JOIN pc USING (category_id) GROUP BY 1, 2
""",
    "unknown_categories": """
SELECT category_id, count(DISTINCT product_id) AS num_products FROM pc
WHERE category_id NOT IN (SELECT category_id FROM cat) GROUP BY 1
""",
    "uncategorised_products": """
SELECT product_id, count(*) AS num_ventas FROM ex
WHERE product_id NOT IN (SELECT product_id FROM pc) GROUP BY 1
""",
    "transaction_quality": """
SELECT count(*) AS total_transactions, count(*) FILTER (transaction_date IS NULL) AS null_transaction_date,
       count(*) FILTER (store_id IS NULL) AS null_store_id, count(*) FILTER (customer_id IS NULL) AS null_customer_id,
       count(*) FILTER (products IS NULL) AS null_products, count(*) FILTER (trim(products) = '') AS empty_products,
       count(*) FILTER (trim(products) LIKE '%  %') AS double_space_products,
       (SELECT count(*) FROM ex WHERE product_id IS NULL AND token <> '') AS bad_tokens,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT transaction_date, store_id, customer_id, products FROM tx)) AS duplicate_transactions
FROM tx
""",
    "store_summary": """
SELECT store_id, count(*) AS num_transacciones,
       CAST(coalesce(sum(len(string_split(trim(products), ' '))), 0) AS BIGINT) AS total_unidades,
       count(DISTINCT customer_id) AS clientes_unicos, round(avg(len(string_split(trim(products), ' '))), 6) AS avg_basket_size
FROM tx GROUP BY 1
""",
    "daily_sales_per_store": """
SELECT store_id, transaction_date AS date, count(*) AS num_transacciones FROM tx GROUP BY 1, 2
""",
    "sample_summary": """
SELECT transaction_date AS date, count(*) AS num_transacciones, count(DISTINCT customer_id) AS clientes_unicos
FROM (SELECT * FROM tx ORDER BY transaction_id LIMIT 5000) GROUP BY 1
""",
    "rfm_preview": """
SELECT * FROM rfm ORDER BY R_score DESC, F_score DESC, customer_id LIMIT 20
""",
    "weekly_sales_per_store": """
SELECT store_id, CAST(year(transaction_date) AS INTEGER) AS year, CAST(weekofyear(transaction_date) AS INTEGER) AS week,
       count(*) AS num_transacciones, min(transaction_date) AS inicio_semana, max(transaction_date) AS fin_semana FROM tx GROUP BY 1, 2, 3
""",
    "monthly_sales_per_store": """
SELECT store_id, CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
       monthname(transaction_date) AS month_name, count(*) AS num_transacciones FROM tx GROUP BY 1, 2, 3, 4
""",
    "day_of_week_sales_per_store": """
SELECT store_id, CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS day_of_week, dayname(transaction_date) AS day_name,
       count(*) AS num_transacciones FROM tx GROUP BY 1, 2, 3
""",
    "purchase_frequency_per_store": """
SELECT store_id, customer_id, count(*) AS num_compras, min(transaction_date) AS primera_compra, max(transaction_date) AS ultima_compra
FROM tx GROUP BY 1, 2
""",
    "basket_stats_per_store": """
SELECT store_id, count(*) AS num_transacciones, round(avg(s), 6) AS avg_basket_size, min(s) AS min_basket_size, max(s) AS max_basket_size
FROM (SELECT store_id, CAST(len(string_split(trim(products), ' ')) AS INTEGER) AS s FROM tx) GROUP BY 1
""",
    "product_combinations_per_store": """
SELECT store_id, array_to_string(string_split(trim(products), ' '), ',') AS items, count(*) AS frequency
FROM tx WHERE len(string_split(trim(products), ' ')) >= 2 GROUP BY 1, 2
""",
    "csv_roundtrip": """
SELECT transaction_date, store_id, customer_id, products FROM tx
""",
    "purchase_gaps_per_store": """
SELECT * FROM (
  SELECT store_id, customer_id, prev_date, date, CAST(date_diff('day', prev_date, date) AS INTEGER) AS days_between
  FROM (SELECT store_id, customer_id, transaction_date AS date,
    lag(transaction_date) OVER (PARTITION BY store_id, customer_id ORDER BY transaction_date) AS prev_date FROM tx)
) WHERE days_between IS NOT NULL
""",
    "time_between_purchases_per_store": f"""
SELECT store_id, customer_id, avg(days_between) AS promedio_dias_entre_compras, min(days_between) AS min_dias,
  max(days_between) AS max_dias, count(*) AS num_intervalos FROM ({_STORE_GAPS}) GROUP BY 1, 2
""",
    "frequency_tiers_per_store": f"""
SELECT store_id, CASE WHEN d <= 7 THEN 'Muy Frecuente (≤7 días)' WHEN d <= 15 THEN 'Frecuente (8-15 días)'
  WHEN d <= 30 THEN 'Regular (16-30 días)' WHEN d <= 60 THEN 'Ocasional (31-60 días)'
  ELSE 'Esporádico (>60 días)' END AS categoria_frecuencia, count(*) AS num_clientes
FROM (SELECT store_id, customer_id, avg(days_between) AS d FROM ({_STORE_GAPS}) GROUP BY 1, 2) GROUP BY 1, 2
""",
    "rfm_segmentation_per_store": """
SELECT store_id, customer_id, frequency, recency, R_score, F_score,
  CASE WHEN R_score >= 4 AND F_score >= 4 THEN 'Champions'
       WHEN R_score >= 3 AND F_score >= 3 THEN 'Loyal Customers'
       WHEN R_score >= 4 AND F_score <= 2 THEN 'Promising'
       WHEN R_score <= 2 AND F_score >= 4 THEN 'At Risk'
       WHEN R_score <= 2 AND F_score <= 2 THEN 'Lost'
       WHEN R_score >= 3 AND F_score <= 2 THEN 'Potential Loyalists'
       ELSE 'Regular' END AS RFM_segment
FROM (
  SELECT *, CAST(5 - ntile(4) OVER (PARTITION BY store_id ORDER BY recency, customer_id) AS INTEGER) AS R_score,
    CAST(ntile(4) OVER (PARTITION BY store_id ORDER BY frequency DESC, customer_id) AS INTEGER) AS F_score
  FROM (
    SELECT store_id, customer_id, count(*) AS frequency, CAST(date_diff('day', max(transaction_date),
      (max(max(transaction_date)) OVER (PARTITION BY store_id)) + 1) AS INTEGER) AS recency
    FROM tx GROUP BY 1, 2))
""",
    "sales_trend_per_store": """
SELECT store_id, date, n AS num_transacciones,
  avg(n) OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7d
FROM (SELECT store_id, transaction_date AS date, count(*) AS n FROM tx GROUP BY 1, 2)
""",
    "sales_trend_per_product": """
SELECT store_id, product_id, date, n AS num_transacciones, avg(n) OVER (
    PARTITION BY store_id, product_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7d
FROM (SELECT store_id, product_id, transaction_date AS date, count(*) AS n FROM ex GROUP BY 1, 2, 3)
""",
    "trend_change_per_store": """
SELECT store_id, f AS first_week_avg, l AS last_week_avg, round((l - f) / f * 100, 6) AS trend_change,
  CASE WHEN (l - f) / f * 100 > 5 THEN 'CRECIENTE' WHEN (l - f) / f * 100 < -5 THEN 'DECRECIENTE'
       ELSE 'ESTABLE' END AS trend
FROM (
  SELECT store_id, avg(n) FILTER (a <= 7) AS f, avg(n) FILTER (z <= 7) AS l
  FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY date) AS a,
               row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS z
        FROM (SELECT store_id, transaction_date AS date, count(*) AS n FROM tx GROUP BY 1, 2))
  GROUP BY 1)
""",
    "order_value_deciles": """
SELECT o_orderkey, o_totalprice, CAST(ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS decile
FROM orders
""",
    "frequent_itemsets_per_store": f"""
SELECT * FROM (WITH {_STORE_SETS}
SELECT store_id, items, freq, n AS n_baskets FROM store_sets JOIN store_size USING (store_id) JOIN names USING (i))
""",
    "association_rules_per_store": f"""
SELECT * FROM (WITH {_STORE_SETS}
SELECT w.store_id, na.items AS antecedent, t AS consequent, round(w.freq / a.freq, 6) AS confidence,
  round((w.freq / a.freq) / (c.freq / n), 6) AS lift, round(w.freq / n, 6) AS support
FROM store_sets w JOIN store_size s ON s.store_id = w.store_id JOIN bits ON (w.i & b) <> 0
JOIN store_sets a ON a.i = w.i - b AND a.store_id = w.store_id
JOIN store_sets c ON c.i = b AND c.store_id = w.store_id
JOIN names na ON na.i = a.i WHERE w.freq / a.freq >= 0.3)
""",
    "daily_visitors": """
SELECT transaction_date AS date, count(*) AS num_transacciones, count(DISTINCT customer_id) AS clientes_unicos
FROM tx GROUP BY 1
""",
    "weekly_visitors": """
SELECT CAST(year(transaction_date) AS INTEGER) AS year, CAST(weekofyear(transaction_date) AS INTEGER) AS week,
  count(*) AS num_transacciones, count(DISTINCT customer_id) AS clientes_unicos
FROM tx GROUP BY 1, 2
""",
    "monthly_visitors": """
SELECT CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
  count(*) AS num_transacciones, count(DISTINCT customer_id) AS clientes_unicos
FROM tx GROUP BY 1, 2
""",
    "monthly_visitors_per_store": """
SELECT store_id, CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
  count(*) AS num_transacciones, count(DISTINCT customer_id) AS clientes_unicos
FROM tx GROUP BY 1, 2, 3
""",
    "visitors_per_store": """
SELECT store_id, count(*) AS num_transacciones, count(DISTINCT customer_id) AS clientes_unicos FROM tx GROUP BY 1
""",
    "rejected_rows": """
SELECT 'transactions' AS input, CASE (transaction_id // 10) % 5
    WHEN 0 THEN 'store_id' WHEN 1 THEN 'customer_id' WHEN 2 THEN 'transaction_date' ELSE 'columns' END AS reason,
  'damaged' AS folder, count(*) AS n, count(*) AS lines
FROM tx WHERE transaction_id % 10 = 0 GROUP BY ALL
""",
    "incremental_load": """
SELECT transaction_date, store_id, customer_id, products, 0 AS reloaded FROM tx
""",
}

# Written out and read back, these give the rows of another query.
SAME_ROWS = {
    "ingest_roundtrip": "csv_roundtrip",
    "accepted_rows": "csv_roundtrip",
    "purchase_gaps_bucketed": "purchase_gaps",
    "time_between_purchases_bucketed": "time_between_purchases",
    "purchase_frequency_bucketed": "purchase_frequency",
    "rfm_segmentation_bucketed": "rfm_segmentation",
    "executive_summary_job": "executive_summary",
    "executive_summary_one_scan": "executive_summary",
    "rules_roundtrip": "association_rules",
    "rules_csv_roundtrip": "association_rules",
    "report_recommendations": "association_rules",
    "itemsets_csv_roundtrip": "frequent_itemsets",
    "frequent_itemsets_by_bitmaps": "frequent_itemsets",
    "association_rules_by_bitmaps": "association_rules",
    "json_records_roundtrip": "daily_sales",
    "report_summary_metrics": "basic_metrics",
    "report_distribution": "purchase_frequency_histogram",
}

# Sections of the summaries: the statement of each frame, and its columns in
# order; a name that ends in ~ is a double.
SECTIONS = {
    "temporal_summary": {
        "daily": ("daily_sales", "date num_transacciones clientes_unicos"),
        "weekly": ("weekly_sales", "year week num_transacciones inicio_semana fin_semana"),
        "monthly": ("monthly_sales", "year month month_name num_transacciones"),
        "day_of_week": ("day_of_week_sales", "day_of_week day_name num_transacciones"),
        "trends": ("sales_trend", "date num_transacciones moving_avg_7d~"),
    },
    "customer_summary": {
        "frequency": ("purchase_frequency", "customer_id num_compras primera_compra ultima_compra"),
        "time_between": (
            "time_between_purchases",
            "customer_id promedio_dias_entre_compras~ min_dias max_dias num_intervalos",
        ),
        "rfm": ("rfm_segmentation", "customer_id frequency recency R_score F_score RFM_segment"),
    },
    "product_summary": {
        "top_products": ("product_sales", "product_id num_ventas"),
        "store_products": ("top_products_per_store", "store_id product_id num_ventas rank"),
        "combinations": ("product_combinations", "items frequency"),
        "frequent_itemsets": ("frequent_itemsets", "items freq"),
        "association_rules": (
            "association_rules",
            "antecedent consequent confidence~ lift~ support~",
        ),
    },
}
STORE_SECTIONS = {
    "store_summary": (
        "store_summary",
        "store_id num_transacciones total_unidades clientes_unicos avg_basket_size~",
    ),
    "daily_per_store": ("daily_sales_per_store", "store_id date num_transacciones"),
    "weekly_per_store": (
        "weekly_sales_per_store",
        "store_id year week num_transacciones inicio_semana fin_semana",
    ),
    "monthly_per_store": (
        "monthly_sales_per_store",
        "store_id year month month_name num_transacciones",
    ),
    "day_of_week_per_store": (
        "day_of_week_sales_per_store",
        "store_id day_of_week day_name num_transacciones",
    ),
    "frequency_per_store": (
        "purchase_frequency_per_store",
        "store_id customer_id num_compras primera_compra ultima_compra",
    ),
    "trends_per_store": ("sales_trend_per_store", "store_id date num_transacciones moving_avg_7d~"),
    "time_between_per_store": (
        "time_between_purchases_per_store",
        "store_id customer_id promedio_dias_entre_compras~ min_dias max_dias num_intervalos",
    ),
    "rfm_per_store": (
        "rfm_segmentation_per_store",
        "store_id customer_id frequency recency R_score F_score RFM_segment",
    ),
    "basket_stats_per_store": (
        "basket_stats_per_store",
        "store_id num_transacciones avg_basket_size~ min_basket_size max_basket_size",
    ),
    "combinations_per_store": ("product_combinations_per_store", "store_id items frequency"),
    "products_per_store": ("top_products_per_store", "store_id product_id num_ventas rank"),
}
SECTIONS["analytics_job"] = (
    SECTIONS["temporal_summary"]
    | SECTIONS["customer_summary"]
    | SECTIONS["product_summary"]
    | STORE_SECTIONS
)


def contents(sections: dict[str, tuple[str, str]]) -> str:
    """Every row of each section, with all columns in one text."""

    def text(column: str) -> str:
        if column.endswith("~"):
            return f"CAST(CAST(round({column[:-1]}, 6) AS DECIMAL(20, 6)) AS VARCHAR)"
        return f"CAST({column} AS VARCHAR)"

    return "\nUNION ALL ".join(
        f"SELECT '{section}' AS section, concat_ws('|', {', '.join(map(text, columns.split()))}) AS row "
        f"FROM ({STATEMENTS[name]})"
        for section, (name, columns) in sections.items()
    )


def statements() -> dict[str, str]:
    found = STATEMENTS | {name: contents(sections) for name, sections in SECTIONS.items()}
    found |= {name: STATEMENTS[twin] for name, twin in SAME_ROWS.items()}
    return {name: COMMON + body for name, body in found.items()}
