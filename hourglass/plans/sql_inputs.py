"""The canonical derived inputs written as plain SQL for the DuckDB oracle.

These are deliberately the *naive* formulations (global windows, one scan
per question) so they check the distributed plans independently.
"""

HOURLY = """
feeds AS (
  SELECT date_trunc('hour', ts) AS ts,
         avg(value) AS rt,
         avg(value) FILTER (WHERE event_type = 'view') AS dam,
         100.0::DOUBLE * avg(value) FILTER (WHERE event_type = 'click') AS prc,
         sum(value) AS load_total,
         sum(value) FILTER (WHERE event_type = 'purchase') AS hub_load,
         sum(value) FILTER (WHERE event_type = 'error') AS wind,
         sum(value) FILTER (WHERE event_type = 'view') AS zone_view,
         sum(value) FILTER (WHERE event_type = 'click') AS zone_click,
         sum(value) FILTER (WHERE event_type = 'signup') AS zone_signup,
         sum(value) FILTER (WHERE event_type = 'error') AS zone_error,
         count(*) AS n_events
  FROM events GROUP BY 1),
spine AS (
  SELECT unnest(generate_series((SELECT min(ts) FROM feeds), (SELECT max(ts) FROM feeds),
                                INTERVAL 1 HOUR)) AS ts),
hourly AS (
  SELECT spine.ts, rt, dam, prc, load_total, hub_load, wind, zone_view, zone_click, zone_signup,
         zone_error, n_events
  FROM spine LEFT JOIN feeds ON spine.ts = feeds.ts),
hourly_pos AS (
  SELECT *, row_number() OVER (ORDER BY ts) - 1 AS pos FROM hourly)
"""

INTERVALS = """
iv0 AS (
  SELECT user_id, ts, event_id, event_type, value AS rt,
         CAST(120.0::DOUBLE * TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS prc
  FROM events),
iv AS (
  SELECT user_id, ts, event_id, event_type, rt, prc,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         avg(rt) OVER (PARTITION BY user_id ORDER BY ts, event_id
                       ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS dam,
         lag(prc) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pred_prc,
         lag(rt) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pred_price
  FROM iv0),
ivr AS (
  SELECT *,
    CASE WHEN prc > 0 AND prc <= 3000 THEN 'Scarcity' WHEN prc > 3000 AND prc <= 5000 THEN 'Tight'
         WHEN prc > 5000 AND prc <= 10000 THEN 'Normal' WHEN prc > 10000 THEN 'Surplus' END AS regime,
    CASE WHEN pred_prc > 0 AND pred_prc <= 3000 THEN 'Scarcity'
         WHEN pred_prc > 3000 AND pred_prc <= 5000 THEN 'Tight'
         WHEN pred_prc > 5000 AND pred_prc <= 10000 THEN 'Normal'
         WHEN pred_prc > 10000 THEN 'Surplus' END AS pred_regime,
    CASE WHEN pred_prc IS NULL THEN NULL
         ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - pred_prc / 6000.0::DOUBLE)) END
      AS p_scarcity
  FROM iv)
"""

DAILY = """
daily0 AS (
  SELECT CAST(o_orderdate AS TIMESTAMP) AS ts, sum(o_totalprice) AS load_total,
         count(*) AS n_orders, avg(o_totalprice) AS avg_price
  FROM orders GROUP BY 1),
daily1 AS (
  SELECT *, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
         CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
         row_number() OVER (ORDER BY ts) - 1 AS pos,
         max(load_total) OVER (PARTITION BY year(ts), month(ts) ORDER BY ts
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cm
  FROM daily0),
daily AS (
  SELECT *, lag(cm) OVER (ORDER BY ts) AS monthly_load_max FROM daily1),
peaks AS (
  SELECT ts AS peak_ts FROM (
    SELECT ts, row_number() OVER (PARTITION BY year, month ORDER BY load_total DESC, ts) AS rk
    FROM daily WHERE month IN (6, 7, 8, 9)) WHERE rk = 1),
dailyp AS (
  SELECT d.*,
         CASE WHEN d.month IN (6, 7, 8, 9) THEN 1 ELSE 0 END AS is_4cp_season,
         CASE WHEN p.peak_ts IS NULL THEN 0 ELSE 1 END AS is_peak,
         CASE WHEN d.monthly_load_max = 0 THEN NULL ELSE d.load_total / d.monthly_load_max END
           AS load_vs_monthly_max
  FROM daily d LEFT JOIN peaks p ON d.ts = p.peak_ts),
dailys AS (
  SELECT *, CASE WHEN is_4cp_season = 1 AND load_vs_monthly_max IS NOT NULL
                 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, load_vs_monthly_max - 0.5::DOUBLE))
                 ELSE 0.0::DOUBLE END AS p_peak
  FROM dailyp)
"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body
