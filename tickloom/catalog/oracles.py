"""The same queries in SQL for an independent engine, over the same tables.

Written against the definition of each result, not against the Spark plans: plain
windows and joins where the library uses distributed variants. Doubles are published
with the same small shift off the rounding tie as in ``queries.publish``.
"""

from __future__ import annotations

BASE = """
WITH b AS (
  SELECT event_id, user_id, ts, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         date_trunc('hour', ts) AS timestamp
  FROM events),
raw_ticks AS (
  SELECT event_id, user_id,
    CASE WHEN event_id % 211 = 7 THEN NULL WHEN event_id % 223 = 7 THEN ''
         ELSE concat('U', lpad(CAST(user_id AS VARCHAR), 6, '0'), '.JK') END AS ticker,
    CASE user_id % 11 WHEN 0 THEN 'Energy' WHEN 1 THEN 'Basic Materials'
      WHEN 2 THEN 'Industrials' WHEN 3 THEN 'Consumer Non-Cyclicals'
      WHEN 4 THEN 'Consumer Cyclicals' WHEN 5 THEN 'Healthcare' WHEN 6 THEN 'Financials'
      WHEN 7 THEN 'Properties & Real Estate' WHEN 8 THEN 'Technology'
      WHEN 9 THEN 'Infrastructures' ELSE 'Transportation & Logistic' END AS sector,
    timestamp, ts AS fetch_ts,
    CASE WHEN event_id % 101 = 7 THEN CAST('NaN' AS DOUBLE) ELSE value END AS open,
    value * CAST(1.02 AS DOUBLE) AS high, value * CAST(0.98 AS DOUBLE) AS low,
    CASE WHEN event_id % 131 = 7 THEN NULL
         WHEN event_id % 97 = 7 THEN value * CAST(1.05 AS DOUBLE)
         ELSE value * (CAST(1 AS DOUBLE)
              + CAST((event_id % 21) - 10 AS DOUBLE) / CAST(1000 AS DOUBLE)) END AS close,
    CASE WHEN event_id % 127 = 7 THEN NULL
         WHEN event_id % 113 = 7 THEN -k - 1 ELSE k END AS volume
  FROM b),
clean AS (
  SELECT event_id, user_id, ticker, sector, timestamp, fetch_ts,
    CASE WHEN isnan(open) THEN NULL ELSE open END AS open, high, low, close, volume
  FROM raw_ticks WHERE ticker IS NOT NULL AND ticker <> ''),
ticks AS (
  SELECT ticker, sector, timestamp, fetch_ts, open, high, low, close, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker, timestamp
                                 ORDER BY fetch_ts, event_id) AS rn FROM clean) x
  WHERE rn = 1),
stg AS (
  SELECT *, CAST(timestamp AS DATE) AS date_id, date_trunc('hour', timestamp) AS hour_bucket
  FROM ticks WHERE timestamp >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 90 DAY),
universe AS (
  SELECT concat('U', lpad(CAST(i AS VARCHAR), 6, '0'), '.JK') AS ticker,
    CASE i % 11 WHEN 0 THEN 'Energy' WHEN 1 THEN 'Basic Materials'
      WHEN 2 THEN 'Industrials' WHEN 3 THEN 'Consumer Non-Cyclicals'
      WHEN 4 THEN 'Consumer Cyclicals' WHEN 5 THEN 'Healthcare' WHEN 6 THEN 'Financials'
      WHEN 7 THEN 'Properties & Real Estate' WHEN 8 THEN 'Technology'
      WHEN 9 THEN 'Infrastructures' ELSE 'Transportation & Logistic' END AS sector
  FROM range(55) r(i)),
seed(sector_name, category) AS (VALUES
  ('Energy', 'Commodities'), ('Basic Materials', 'Commodities'),
  ('Consumer Cyclicals', 'Consumer & Services'),
  ('Consumer Non-Cyclicals', 'Consumer & Services'),
  ('Healthcare', 'Consumer & Services'), ('Properties & Real Estate', 'Financial'),
  ('Technology', 'Infrastructure & Tech'), ('Infrastructures', 'Infrastructure & Tech'),
  ('Transportation & Logistic', 'Infrastructure & Tech'), ('Financials', 'Financial'),
  ('Industrial', 'Infrastructure & Tech')),
good AS (
  SELECT * FROM raw_ticks WHERE event_id % 89 <> 7 AND event_id % 179 <> 7),
daily AS (
  SELECT ticker, sector, date_id,
    min(timestamp) AS first_tick_ts, max(timestamp) AS last_tick_ts,
    arg_min_null(open, timestamp) AS open_price, arg_max_null(close, timestamp) AS close_price,
    max(high) AS high_price, min(low) AS low_price,
    CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS tick_count,
    sum(close * volume) / NULLIF(CAST(sum(volume) AS DOUBLE), 0) AS vwap,
    (arg_max_null(close, timestamp) - arg_min_null(open, timestamp))
      / NULLIF(arg_min_null(open, timestamp), 0) AS price_change_pct
  FROM stg GROUP BY ticker, sector, date_id),
totals AS (
  SELECT sector, date_id, count(DISTINCT ticker) AS ticker_count,
    CAST(sum(total_volume) AS BIGINT) AS sector_total_volume,
    avg(price_change_pct) AS avg_price_change_pct,
    CAST(count(*) FILTER (WHERE price_change_pct > 0) AS BIGINT) AS tickers_up,
    CAST(count(*) FILTER (WHERE price_change_pct < 0) AS BIGINT) AS tickers_down,
    CAST(count(*) FILTER (WHERE abs(price_change_pct) < 0.001) AS BIGINT) AS tickers_flat
  FROM daily GROUP BY sector, date_id),
summary AS (
  SELECT *,
    row_number() OVER (PARTITION BY date_id
      ORDER BY avg_price_change_pct DESC NULLS LAST, sector) AS sector_performance_rank,
    row_number() OVER (PARTITION BY date_id
      ORDER BY sector_total_volume DESC NULLS LAST, sector) AS sector_volume_rank
  FROM totals),
rankings AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY sector, date_id
      ORDER BY total_volume DESC NULLS LAST, ticker) AS volume_rank
    FROM daily) x WHERE volume_rank <= 5),
breadth AS (
  SELECT date_id, count(DISTINCT ticker) AS total_tickers,
    count(*) FILTER (WHERE price_change_pct > 0) AS gainers,
    count(*) FILTER (WHERE price_change_pct < 0) AS losers,
    count(*) FILTER (WHERE abs(price_change_pct) < 0.001) AS flat,
    avg(price_change_pct) AS avg_change_pct, CAST(sum(total_volume) AS BIGINT) AS total_volume
  FROM daily GROUP BY date_id),
dimt AS (
  SELECT row_number() OVER (ORDER BY ticker, sector) AS ticker_sk, ticker AS ticker_code,
    replace(ticker, '.JK', '') AS ticker_name, sector,
    CAST(min(timestamp) AS DATE) AS first_seen_date, CAST(max(timestamp) AS DATE) AS last_seen_date,
    CAST(max(timestamp) AS DATE) >= DATE '2024-01-23' AS is_active
  FROM ticks GROUP BY ticker, sector),
dims AS (
  SELECT row_number() OVER (ORDER BY sector) AS sector_sk, sector AS sector_name,
    CASE WHEN sector IN ('Financials', 'Properties & Real Estate') THEN 'Financial'
         WHEN sector IN ('Technology', 'Infrastructures', 'Transportation & Logistic')
           THEN 'Infrastructure & Tech'
         WHEN sector IN ('Energy', 'Basic Materials') THEN 'Commodities'
         ELSE 'Consumer & Services' END AS sector_category
  FROM (SELECT DISTINCT sector FROM ticks) d),
fact AS (
  SELECT d.ticker_sk, s.sector_sk, t.timestamp, t.open, t.high, t.low, t.close, t.volume, t.fetch_ts
  FROM ticks t LEFT JOIN dimt d ON t.ticker = d.ticker_code
  LEFT JOIN dims s ON t.sector = s.sector_name),
week_stats AS (
  SELECT ticker, avg(total_volume) AS avg_volume_7d, stddev_samp(total_volume) AS stddev_volume_7d
  FROM daily WHERE date_id >= DATE '2024-01-23' GROUP BY ticker),
anomalies AS (
  SELECT r.ticker, r.sector, r.date_id, r.total_volume, s.avg_volume_7d, s.stddev_volume_7d,
    (r.total_volume - s.avg_volume_7d) / NULLIF(s.stddev_volume_7d, 0) AS volume_z_score
  FROM daily r JOIN week_stats s ON r.ticker = s.ticker
  WHERE r.date_id = DATE '2024-01-29' AND s.stddev_volume_7d > 0
    AND (r.total_volume - s.avg_volume_7d) / s.stddev_volume_7d > 2.0),
aggd AS (
  SELECT *, row_number() OVER (PARTITION BY sector_sk, date_id
      ORDER BY total_volume DESC NULLS LAST, ticker_sk) AS volume_rank_in_sector
  FROM (
    SELECT ticker_sk, sector_sk, CAST(timestamp AS DATE) AS date_id,
      arg_min_null(open, timestamp) AS open_price, arg_max_null(close, timestamp) AS close_price,
      max(high) AS high_price, min(low) AS low_price, CAST(sum(volume) AS BIGINT) AS total_volume,
      sum(close * volume) / NULLIF(CAST(sum(volume) AS DOUBLE), 0) AS vwap,
      (arg_max_null(close, timestamp) - arg_min_null(open, timestamp))
        / NULLIF(arg_min_null(open, timestamp), 0) AS price_change_pct
    FROM fact WHERE timestamp >= TIMESTAMP '2024-01-23 12:00:00'
    GROUP BY ticker_sk, sector_sk, CAST(timestamp AS DATE)) g)
"""

# Day checks are ratios over today's ticks.
_TODAY_CHECK = """
SELECT '{check_id}' AS check_id, count(*) FILTER (WHERE {failed}) AS failed_rows,
  round(1.00000000001 * (CAST(count(*) FILTER (WHERE {failed}) AS DOUBLE) / NULLIF(count(*), 0)), 6) AS failure_rate
FROM ticks WHERE CAST(timestamp AS DATE) = DATE '2024-01-30'
"""
_PRICE_LOGIC = "close < low * 0.999::DOUBLE OR close > high * 1.001::DOUBLE"
_STALE = "timestamp < TIMESTAMP '2024-01-30 11:00:00'"
_IS_TODAY = "CAST(timestamp AS DATE) = DATE '2024-01-30'"

# (check id, name, severity, scope, failed) of the quality log.
_LOG_CHECKS = [
    ("ohlcv_logic", "Close between low and high", "critical", _IS_TODAY, _PRICE_LOGIC),
    ("negative_volume", "Volume not negative", "critical", _IS_TODAY, "volume < 0"),
    ("null_critical_fields", "Ticker and time present", "critical", _IS_TODAY,
     "ticker IS NULL OR timestamp IS NULL"),
    ("stale_data", "Not older than an hour", "warning", _IS_TODAY, _STALE),
    ("null_critical_fields_all", "Ticker and time present (all rows)", "critical", "true",
     "ticker IS NULL OR timestamp IS NULL"),
    ("close_positive", "Close above zero", "critical", "true", "NOT close > 0"),
    ("volume_nonneg", "Volume at least zero", "critical", "true", "NOT volume >= 0"),
    ("accepted_sector", "Known sector", "warning", "true",
     "sector NOT IN (SELECT sector_name FROM seed)"),
    *[(f"not_null_{c}", f"{c} present", "critical", "true", f"{c} IS NULL")
      for c in ("ticker", "sector", "timestamp", "close", "volume")],
]


def _log_rows() -> str:
    """Counts of every logged check, as one relation ``log``."""
    rows = [
        f"SELECT '{check_id}' AS check_id, '{name}' AS check_name, '{severity}' AS severity, "
        f"count(*) FILTER (WHERE {scope}) AS total_rows, "
        f"count(*) FILTER (WHERE ({scope}) AND ({failed})) AS failed_rows FROM {{source}}"
        for check_id, name, severity, scope, failed in _LOG_CHECKS
    ]
    return " UNION ALL ".join(rows)


def _with_log(body: str, source: str = "raw_ticks") -> str:
    return BASE + ", log AS (" + _log_rows().replace("{source}", source) + ") " + body


def _rounded(relation: str, columns: str, doubles: str, tail: str = "") -> str:
    """Select plain and rounded columns of a relation."""
    rounded = ", ".join(f"round(1.00000000001 * {c}, 6) AS {c}" for c in doubles.split())
    plain = ", ".join(columns.split())
    return f"SELECT {', '.join(x for x in (plain, rounded) if x)} FROM {relation} {tail}"


_TICK_DOUBLES = "open high low close"
_DAILY_DOUBLES = "open_price close_price high_price low_price vwap price_change_pct"
_SECTOR_COUNTS = "sector date_id ticker_count sector_total_volume tickers_up tickers_down tickers_flat"

_EXPECTED = """
  SELECT CAST(d.day AS DATE) AS date_id, u.ticker, u.sector
  FROM universe u JOIN generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-02-07', INTERVAL 1 DAY) d(day)
    ON CAST(d.day AS DATE) >= DATE '2024-01-01' + CAST(substr(u.ticker, 2, 6) AS INTEGER) % 20
  WHERE isodow(d.day) <= 5"""

_BODIES: dict[str, str] = {
    # scans and sources
    "raw_scan": _rounded("ticks", "ticker sector timestamp fetch_ts volume", _TICK_DOUBLES),
    "table_row_count": "SELECT count(*) AS row_count FROM raw_ticks",
    "seed_sector_mapping": """
        SELECT c.sector, s.category, count(*) AS tick_count
        FROM clean c LEFT JOIN seed s ON c.sector = s.sector_name GROUP BY c.sector, s.category""",
    "universe_explode": """
        SELECT u.sector, u.ticker, count(t.ticker) AS tick_count
        FROM universe u LEFT JOIN ticks t ON t.ticker = u.ticker GROUP BY u.sector, u.ticker""",
    "candles_with_sector": """
        SELECT t.ticker, u.sector, t.timestamp, round(1.00000000001 * open, 6) AS open, round(1.00000000001 * high, 6) AS high,
          round(1.00000000001 * low, 6) AS low, round(1.00000000001 * close, 6) AS close, volume
        FROM ticks t JOIN universe u ON t.ticker = u.ticker""",
    # ingest
    "parse_valid": """
        SELECT event_id AS message_offset, ticker, sector,
          strftime(timestamp + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS timestamp,
          strftime(fetch_ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS fetch_ts,
          isnan(open) AS open_is_nan, round(1.00000000001 * high, 6) AS high, round(1.00000000001 * low, 6) AS low,
          round(1.00000000001 * close, 6) AS close, volume, false AS partially_corrupt
        FROM good""",
    "dlq_records": """
        SELECT CASE WHEN event_id % 89 = 7 THEN substr('{'
                 || CASE WHEN ticker IS NULL THEN '' ELSE '"ticker":"' || ticker || '",' END
                 || '"sector":"' || sector || '","timestamp":"', 1, 20) ELSE '' END AS json_str,
          'ticks' AS topic, CAST(user_id % 4 AS INTEGER) AS source_partition,
          event_id AS source_offset
        FROM raw_ticks WHERE event_id % 89 = 7 OR event_id % 179 = 7""",
    "clean_ticks": """
        SELECT ticker, sector, timestamp, date_trunc('second', fetch_ts) AS fetch_ts,
          round(1.00000000001 * (CASE WHEN isnan(open) THEN NULL ELSE open END), 6) AS open, round(1.00000000001 * high, 6) AS high,
          round(1.00000000001 * low, 6) AS low, round(1.00000000001 * close, 6) AS close, volume
        FROM good WHERE ticker IS NOT NULL AND ticker <> ''""",
    "dedup_ticks": """
        SELECT ticker, timestamp, fetch_ts, round(1.00000000001 * close, 6) AS close, volume FROM (
          SELECT ticker, timestamp, date_trunc('second', fetch_ts) AS fetch_ts, close, volume,
            row_number() OVER (PARTITION BY ticker, timestamp
              ORDER BY date_trunc('second', fetch_ts), event_id) AS rn
          FROM good WHERE ticker IS NOT NULL AND ticker <> '') x WHERE rn = 1""",
    "high_water_mark_dedup": """
        SELECT event_id, ticker, timestamp, round(1.00000000001 * close, 6) AS close, volume FROM (
          SELECT *, max(timestamp) OVER (PARTITION BY ticker
            ORDER BY event_id - event_id % 1024 + (event_id % 1024 * 389) % 1024
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM clean) x
        WHERE mark IS NULL OR timestamp > mark""",
    "incremental_new_ticks": """
        SELECT t.ticker, t.sector, t.timestamp, round(1.00000000001 * t.close, 6) AS close, t.volume
        FROM ticks t LEFT JOIN (
          SELECT ticker, max(timestamp) AS mark FROM clean
          WHERE fetch_ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY ticker) m ON t.ticker = m.ticker
        WHERE m.mark IS NULL OR t.timestamp > m.mark""",
    "to_message_json": """
        SELECT ticker, sector,
          strftime(timestamp + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS event_time,
          strftime(fetch_ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') || '+07:00' AS fetch_time,
          round(1.00000000001 * open, 6) AS open, round(1.00000000001 * high, 6) AS high, round(1.00000000001 * low, 6) AS low,
          round(1.00000000001 * close, 6) AS close, volume, CAST(9 AS INTEGER) AS field_count,
          'stock_tick' AS schema_name, '1' AS schema_version
        FROM ticks""",
    "market_hours_flag": """
        SELECT ticker, timestamp,
          isodow(timestamp + INTERVAL 7 HOUR) <= 5
          AND hour(timestamp + INTERVAL 7 HOUR) * 60 + minute(timestamp + INTERVAL 7 HOUR) >= 540
          AND hour(timestamp + INTERVAL 7 HOUR) * 60 + minute(timestamp + INTERVAL 7 HOUR) < 900
            AS is_market_open
        FROM ticks""",
    "schema_drift_profile": """
        SELECT field, drift, count(*) AS records FROM (
          SELECT unnest(list_concat(
            CASE WHEN ticker IS NULL THEN ['ticker'] ELSE [] END,
            CASE WHEN close IS NULL THEN ['close'] ELSE [] END,
            CASE WHEN volume IS NULL THEN ['volume'] ELSE [] END)) AS field, 'missing' AS drift
          FROM good
          UNION ALL SELECT 'bid', 'unknown' FROM good WHERE event_id % 83 = 7) x
        GROUP BY field, drift""",
    # staging, dimensions, fact
    "stg_ticks": _rounded("stg", "ticker sector timestamp fetch_ts volume date_id hour_bucket", _TICK_DOUBLES),
    "stg_ticks_14d": _rounded(
        "stg", "ticker sector timestamp fetch_ts volume date_id hour_bucket", _TICK_DOUBLES,
        "WHERE timestamp >= TIMESTAMP '2024-01-16 12:00:00'"),
    "dim_ticker": "SELECT * FROM dimt",
    "dim_sector": "SELECT * FROM dims",
    "dim_sector_seeded": """
        SELECT d.sector_sk, d.sector_name, s.category AS sector_category
        FROM dims d LEFT JOIN seed s ON d.sector_name = s.sector_name""",
    "active_tickers": "SELECT * FROM dimt WHERE is_active",
    "fct_intraday_ticks": _rounded("fact", "ticker_sk sector_sk timestamp fetch_ts volume", _TICK_DOUBLES),
    "star_today": """
        SELECT t.ticker_name, s.sector_name, round(1.00000000001 * f.close, 6) AS close, f.volume
        FROM fact f JOIN dimt t ON f.ticker_sk = t.ticker_sk JOIN dims s ON f.sector_sk = s.sector_sk
        WHERE CAST(f.timestamp AS DATE) = DATE '2024-01-30'""",
    # intermediate
    "int_daily_stock_stats": _rounded(
        "daily", "ticker sector date_id first_tick_ts last_tick_ts total_volume tick_count", _DAILY_DOUBLES),
    "int_sector_daily_summary": _rounded(
        "summary", _SECTOR_COUNTS + " sector_performance_rank sector_volume_rank", "avg_price_change_pct"),
    "int_ticker_rankings": _rounded(
        "rankings", "ticker sector date_id first_tick_ts last_tick_ts total_volume tick_count volume_rank",
        _DAILY_DOUBLES),
    "volume_stats_7d": _rounded("week_stats", "ticker", "avg_volume_7d stddev_volume_7d"),
    "sector_rank_over_agg": """
        SELECT sector, date_id, count(DISTINCT ticker) AS ticker_count,
          CAST(sum(total_volume) AS BIGINT) AS sector_total_volume,
          round(1.00000000001 * (avg(price_change_pct)), 6) AS avg_price_change_pct,
          count(*) FILTER (WHERE price_change_pct > 0) AS tickers_up,
          count(*) FILTER (WHERE price_change_pct < 0) AS tickers_down,
          count(*) FILTER (WHERE abs(price_change_pct) < 0.001) AS tickers_flat,
          row_number() OVER (PARTITION BY date_id
            ORDER BY avg(price_change_pct) DESC NULLS LAST, sector) AS sector_performance_rank
        FROM daily GROUP BY sector, date_id""",
    # marts
    "mrt_top5_sector_daily": _rounded("rankings", "sector date_id ticker total_volume volume_rank", _DAILY_DOUBLES),
    "mrt_sector_performance": """
        SELECT sector, date_id, round(1.00000000001 * avg_price_change_pct, 6) AS avg_price_change_pct,
          sector_total_volume, ticker_count, tickers_up, tickers_down, tickers_flat,
          round(1.00000000001 * (CAST(tickers_up AS DOUBLE) / NULLIF(tickers_down, 0)), 6) AS advance_decline_ratio,
          sector_performance_rank, sector_volume_rank
        FROM summary""",
    "mrt_sector_performance_sk": """
        SELECT d.sector_sk, s.sector, s.date_id, round(1.00000000001 * avg_price_change_pct, 6) AS avg_price_change_pct,
          sector_total_volume, ticker_count, tickers_up, tickers_down, tickers_flat,
          round(1.00000000001 * (CAST(tickers_up AS DOUBLE) / NULLIF(tickers_down, 0)), 6) AS advance_decline_ratio,
          sector_performance_rank
        FROM summary s LEFT JOIN dims d ON s.sector = d.sector_name""",
    "mrt_market_breadth": """
        SELECT date_id, total_tickers, gainers, losers, flat, round(1.00000000001 * avg_change_pct, 6) AS avg_change_pct,
          total_volume, round(1.00000000001 * (CAST(gainers AS DOUBLE) / NULLIF(losers, 0)), 6) AS advance_decline_ratio
        FROM breadth""",
    "mrt_volume_anomalies": _rounded(
        "anomalies", "ticker sector date_id total_volume", "avg_volume_7d stddev_volume_7d volume_z_score"),
    "anomaly_severity": """
        SELECT ticker, sector, date_id, round(1.00000000001 * volume_z_score, 6) AS volume_z_score,
          CASE WHEN volume_z_score > 5 THEN 'investigate' WHEN volume_z_score > 3 THEN 'critical'
               WHEN volume_z_score > 2 THEN 'warning' END AS severity
        FROM anomalies""",
    # user queries
    "adhoc_top5_today": """
        SELECT sector, date_id, ticker, volume_rank, round(close_price, 0) AS close_price,
          round(price_change_pct * 100, 2) AS change_pct, total_volume
        FROM rankings WHERE date_id = DATE '2024-01-30'""",
    "top_gainers_today": """
        SELECT ticker, sector, round(1.00000000001 * price_change_pct, 6) AS price_change_pct, total_volume
        FROM daily WHERE date_id = DATE '2024-01-30'
        ORDER BY daily.price_change_pct DESC NULLS LAST, ticker, sector LIMIT 10""",
    "ticker_day_latest5": """
        SELECT ticker, date_id, timestamp, round(1.00000000001 * close, 6) AS close, volume, recency_rank FROM (
          SELECT *, CAST(timestamp AS DATE) AS date_id, row_number() OVER (
            PARTITION BY ticker, CAST(timestamp AS DATE) ORDER BY timestamp DESC) AS recency_rank
          FROM ticks) x WHERE recency_rank <= 5""",
    "sector_leaderboard_today": """
        SELECT sector, round(1.00000000001 * avg_price_change_pct, 6) AS avg_price_change_pct, tickers_up, tickers_down
        FROM summary WHERE date_id = DATE '2024-01-30'""",
    "market_breadth_today": """
        SELECT date_id, total_tickers, gainers, losers, flat, round(1.00000000001 * avg_change_pct, 6) AS avg_change_pct,
          total_volume, round(1.00000000001 * (CAST(gainers AS DOUBLE) / NULLIF(losers, 0)), 6) AS advance_decline_ratio
        FROM breadth WHERE date_id = DATE '2024-01-30'""",
    "ticks_per_ticker": "SELECT ticker, count(*) AS tick_count FROM ticks GROUP BY ticker",
    "ticks_per_minute": """
        SELECT date_trunc('minute', fetch_ts) AS minute_start, count(*) AS tick_count,
          round(1.00000000001 * (count(*) / 60.0::DOUBLE), 6) AS rate_per_second
        FROM clean GROUP BY date_trunc('minute', fetch_ts)""",
    "recent_hour_health": """
        SELECT count(*) AS row_count, max(timestamp) AS latest_ts
        FROM ticks WHERE timestamp > TIMESTAMP '2024-01-30 11:00:00'""",
    # quality
    "dq_ohlcv_logic": _TODAY_CHECK.format(check_id="ohlcv_logic", failed=_PRICE_LOGIC),
    "dq_negative_volume": _TODAY_CHECK.format(check_id="negative_volume", failed="volume < 0"),
    "dq_stale": _TODAY_CHECK.format(check_id="stale_data", failed=_STALE),
    "dq_unique_ticker_ts": """
        SELECT ticker, timestamp, count(*) AS copies FROM clean
        GROUP BY ticker, timestamp HAVING count(*) > 1""",
    "dq_accepted_values_sector": """
        SELECT sector, count(*) AS row_count FROM ticks
        WHERE sector NOT IN (SELECT sector_name FROM seed) GROUP BY sector""",
    "dq_expr_close_positive": """
        SELECT 'close_positive' AS check_id, count(*) AS total_rows,
          count(*) FILTER (WHERE NOT close > 0) AS failed_rows,
          round(1.00000000001 * (CAST(count(*) FILTER (WHERE NOT close > 0) AS DOUBLE) / count(*)), 6) AS failure_rate
        FROM stg""",
    "dq_expr_volume_nonneg": """
        SELECT 'volume_nonneg' AS check_id, count(*) AS total_rows,
          count(*) FILTER (WHERE NOT volume >= 0) AS failed_rows,
          round(1.00000000001 * (CAST(count(*) FILTER (WHERE NOT volume >= 0) AS DOUBLE) / count(*)), 6) AS failure_rate
        FROM stg""",
    "dq_sector_coverage": """
        SELECT u.sector, count(*) AS expected_tickers, count(o.ticker) AS observed_tickers,
          count(*) - count(o.ticker) AS missing_tickers
        FROM universe u LEFT JOIN (SELECT DISTINCT sector, ticker FROM ticks) o
          ON u.sector = o.sector AND u.ticker = o.ticker GROUP BY u.sector""",
    "dq_missing_tickers": f"""
        SELECT date_id, ticker, sector FROM ({_EXPECTED}) e WHERE NOT EXISTS (
          SELECT 1 FROM ticks t WHERE t.ticker = e.ticker AND CAST(t.timestamp AS DATE) = e.date_id)""",
    "ticker_coverage_calendar": f"""
        SELECT e.date_id, count(*) AS tickers_expected, count(o.ticker) AS tickers_succeeded,
          count(*) - count(o.ticker) AS tickers_failed
        FROM ({_EXPECTED}) e LEFT JOIN (SELECT DISTINCT ticker, CAST(timestamp AS DATE) AS date_id FROM ticks) o
          ON o.ticker = e.ticker AND o.date_id = e.date_id GROUP BY e.date_id""",
    "route_versions": """
        SELECT schema_version, outcome, count(*) AS messages,
          count(*) FILTER (WHERE outcome = 'accepted' AND schema_version = '2' AND event_id % 83 = 7) AS bids,
          count(*) FILTER (WHERE outcome = 'accepted' AND ticker IS NOT NULL) AS tickers
        FROM (SELECT event_id, ticker, schema_version,
            CASE WHEN schema_version = '9' OR (event_id % 13 = 5 AND event_id % 7 <> 0) THEN 'unknown_version'
                 WHEN event_id % 89 = 7 OR event_id % 179 = 7 THEN 'malformed' ELSE 'accepted' END AS outcome
          FROM (SELECT event_id, ticker,
              CASE WHEN event_id % 7 < 3 THEN '1' WHEN event_id % 7 < 5 THEN '2' ELSE '9' END AS schema_version
            FROM raw_ticks) v) r
        GROUP BY schema_version, outcome""",
    "silent_feeds": """
        SELECT 'ticks-' || i AS feed, last_seen,
          date_diff('second', date_trunc('second', last_seen), TIMESTAMP '2024-01-30 12:00:00') AS silent_seconds,
          coalesce(date_diff('second', date_trunc('second', last_seen), TIMESTAMP '2024-01-30 12:00:00') > 600, true) AS is_silent
        FROM range(5) r(i) LEFT JOIN (
          SELECT user_id % 4 AS p, max(fetch_ts) AS last_seen FROM raw_ticks
          WHERE fetch_ts <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY user_id % 4) m ON m.p = r.i""",
    "layer_fingerprints": """
        SELECT layer, date_id, count(*) AS row_count, CAST(sum(h) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor
        FROM (SELECT layer, CAST(timestamp AS DATE) AS date_id,
            CAST('0x' || substr(md5(concat(ticker, '|', CAST(epoch(timestamp) AS BIGINT), '|', volume)), 1, 15) AS BIGINT) AS h
          FROM (SELECT 'ticks' AS layer, ticker, timestamp, volume FROM ticks
                UNION ALL SELECT 'staged', ticker, timestamp, volume FROM stg) u) x
        GROUP BY layer, date_id""",
    "dq_key_integrity": """
        SELECT CAST(count(*) FILTER (WHERE a >= TIMESTAMP '2024-01-16 12:00:00') AS BIGINT) AS rows_without_key,
          CAST(count(*) FILTER (WHERE a < TIMESTAMP '2024-01-16 12:00:00' AND a >= TIMESTAMP '2024-01-16') AS BIGINT) AS rows_with_unknown_key,
          count(DISTINCT t.ticker) FILTER (WHERE a < TIMESTAMP '2024-01-16 12:00:00' AND a >= TIMESTAMP '2024-01-16') AS unknown_keys,
          CAST(0 AS BIGINT) AS unused_dimension_rows
        FROM ticks t JOIN (SELECT ticker, min(timestamp) AS a FROM clean GROUP BY ticker) f ON t.ticker = f.ticker""",
    "freshness": """
        SELECT latest_ts, date_diff('second', latest_ts, TIMESTAMP '2024-01-30 12:00:00') AS age_seconds,
          coalesce(date_diff('second', latest_today, TIMESTAMP '2024-01-30 12:00:00') < 600, false) AS gate_open,
          coalesce(date_diff('second', latest_ts, TIMESTAMP '2024-01-30 12:00:00') > 900, false) AS too_old
        FROM (SELECT max(timestamp) AS latest_ts,
                max(timestamp) FILTER (WHERE CAST(timestamp AS DATE) = DATE '2024-01-30') AS latest_today
              FROM clean WHERE timestamp <= TIMESTAMP '2024-01-30 12:00:00') x""",
    "ticker_coverage": """
        SELECT CAST(t.timestamp AS DATE) AS date_id, count(DISTINCT u.ticker) AS tickers_succeeded,
          55 - count(DISTINCT u.ticker) AS tickers_failed
        FROM ticks t LEFT JOIN universe u ON t.ticker = u.ticker GROUP BY CAST(t.timestamp AS DATE)""",
    # extensions
    "agg_daily_ticker": _rounded(
        "aggd", "ticker_sk sector_sk date_id total_volume volume_rank_in_sector", _DAILY_DOUBLES),
    "agg_sector_hourly": """
        SELECT sector, hour_bucket, round(1.00000000001 * (avg(change)), 6) AS avg_price_change_pct,
          CAST(sum(volume) AS BIGINT) AS total_volume,
          count(*) FILTER (WHERE change > 0) AS tickers_up,
          count(*) FILTER (WHERE change < 0) AS tickers_down,
          count(*) FILTER (WHERE abs(change) < 0.001) AS tickers_flat
        FROM (SELECT ticker, sector, hour_bucket, sum(volume) AS volume,
                (arg_max_null(close, timestamp) - arg_min_null(open, timestamp))
                  / NULLIF(arg_min_null(open, timestamp), 0) AS change
              FROM stg GROUP BY ticker, sector, hour_bucket) h
        GROUP BY sector, hour_bucket""",
    "view_top5_sector_by_volume": """
        SELECT s.sector_name, t.ticker_code, a.total_volume, a.volume_rank_in_sector
        FROM aggd a JOIN dimt t ON a.ticker_sk = t.ticker_sk JOIN dims s ON a.sector_sk = s.sector_sk
        WHERE a.volume_rank_in_sector <= 5 AND a.date_id = DATE '2024-01-30'""",
    "view_market_summary": """
        SELECT count(DISTINCT ticker_sk) AS total_tickers, round(1.00000000001 * (avg(price_change_pct)), 6) AS avg_market_change,
          count(*) FILTER (WHERE price_change_pct > 0) AS gainers,
          count(*) FILTER (WHERE price_change_pct < 0) AS losers,
          CAST(sum(total_volume) AS BIGINT) AS total_market_volume
        FROM aggd WHERE date_id = DATE '2024-01-30'""",
    "sector_top_gainer_loser": """
        SELECT sector, date_id, max(ticker) FILTER (WHERE up = 1 AND price_change_pct IS NOT NULL) AS top_gainer_ticker,
          max(ticker) FILTER (WHERE down = 1 AND price_change_pct IS NOT NULL) AS top_loser_ticker
        FROM (SELECT *,
            row_number() OVER (PARTITION BY sector, date_id
              ORDER BY price_change_pct DESC NULLS LAST, ticker) AS up,
            row_number() OVER (PARTITION BY sector, date_id
              ORDER BY price_change_pct ASC NULLS LAST, ticker) AS down
          FROM daily) x GROUP BY sector, date_id""",
    "daily_stats_extra": """
        SELECT ticker, sector, date_id,
          round(1.00000000001 * (CAST(total_volume AS DOUBLE) / tick_count), 6) AS avg_volume_per_minute,
          round(1.00000000001 * (close_price - open_price), 6) AS price_change
        FROM daily""",
    "sector_performance_delta": """
        SELECT a.sector, a.date_id, round(1.00000000001 * a.avg_price_change_pct, 6) AS avg_price_change_pct,
          round(1.00000000001 * (a.avg_price_change_pct - a.previous), 6) AS change_vs_previous_day,
          round(1.00000000001 * (a.avg_price_change_pct - w.avg_price_change_pct), 6) AS change_vs_week_ago,
          round(1.00000000001 * (a.avg_price_change_pct - m.avg_price_change_pct), 6) AS change_vs_four_weeks_ago
        FROM (SELECT *, lag(avg_price_change_pct) OVER (PARTITION BY sector ORDER BY date_id) AS previous
              FROM summary) a
        LEFT JOIN summary w ON w.sector = a.sector AND w.date_id = a.date_id - 7
        LEFT JOIN summary m ON m.sector = a.sector AND m.date_id = a.date_id - 28""",
    "ticker_scd2": """
        SELECT ticker, sector, date_id AS valid_from,
          CAST(lead(date_id) OVER (PARTITION BY ticker ORDER BY date_id) - 1 AS DATE) AS valid_to,
          lead(date_id) OVER (PARTITION BY ticker ORDER BY date_id) IS NULL AS is_current
        FROM (SELECT *, lag(sector) OVER (PARTITION BY ticker ORDER BY date_id) AS before FROM (
            SELECT ticker, CAST(timestamp AS DATE) AS date_id, max(
              CASE WHEN CAST(substr(ticker, 2, 6) AS INTEGER) % 7 = 3
                    AND CAST(timestamp AS DATE) >= DATE '2024-01-16' THEN 'Technology' ELSE sector END) AS sector
            FROM ticks GROUP BY ticker, CAST(timestamp AS DATE)) d) c
        WHERE before IS NULL OR before <> sector""",
    "null_profile": """
        SELECT date_id, column_name, total_rows, null_rows FROM (
          SELECT CAST(timestamp AS DATE) AS date_id, count(*) AS total_rows,
            count(*) - count(ticker) AS ticker, count(*) - count(sector) AS sector,
            count(*) - count(timestamp) AS timestamp, count(*) - count(fetch_ts) AS fetch_ts,
            count(*) - count(open) AS open, count(*) - count(high) AS high, count(*) - count(low) AS low,
            count(*) - count(close) AS close, count(*) - count(volume) AS volume
          FROM raw_ticks GROUP BY CAST(raw_ticks.timestamp AS DATE)) p
        UNPIVOT (null_rows FOR column_name IN
          (ticker, sector, timestamp, fetch_ts, open, high, low, close, volume))""",
    "moving_average_close": """
        SELECT ticker, sector, date_id, round(1.00000000001 * close_price, 6) AS close_price,
          round(1.00000000001 * (avg(close_price) OVER (PARTITION BY ticker, sector ORDER BY date_id
            ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)), 6) AS close_moving_average
        FROM daily""",
    "dlq_rate": """
        SELECT 'ticks' AS topic, date_trunc('hour', fetch_ts) AS window_start, count(*) AS messages,
          count(*) FILTER (WHERE event_id % 89 = 7 OR event_id % 179 = 7) AS rejected,
          round(1.00000000001 * (CAST(count(*) FILTER (WHERE event_id % 89 = 7 OR event_id % 179 = 7) AS DOUBLE) / count(*)), 6)
            AS dead_letter_rate,
          CAST(count(*) FILTER (WHERE event_id % 89 = 7 OR event_id % 179 = 7) AS DOUBLE) / count(*) > 0.05
            AS is_high
        FROM raw_ticks GROUP BY date_trunc('hour', fetch_ts)""",
    "no_data_gaps": """
        SELECT 'ticks' AS topic, last_minute, next_minute,
          date_diff('minute', last_minute, next_minute) AS gap_minutes
        FROM (SELECT next_minute, lag(next_minute) OVER (ORDER BY next_minute) AS last_minute
              FROM (SELECT DISTINCT date_trunc('minute', fetch_ts) AS next_minute FROM raw_ticks) d) g
        WHERE date_diff('minute', last_minute, next_minute) > 10""",
    "dq_referential": """
        SELECT 'staged_rows' AS measure, count(*) AS row_count FROM stg
        UNION ALL SELECT 'daily_stats_ticks', CAST(sum(tick_count) AS BIGINT) FROM daily
        UNION ALL SELECT 'unlisted_ticker_rows', count(*) FROM ticks
          WHERE ticker NOT IN (SELECT ticker FROM universe)""",
    "volume_z_rolling": """
        SELECT ticker, sector, date_id, total_volume, round(1.00000000001 * m, 6) AS mean_volume, round(1.00000000001 * s, 6) AS stddev_volume,
          round(1.00000000001 * (CASE WHEN s > 0 THEN (total_volume - m) / s END), 6) AS volume_z_score
        FROM (SELECT *, avg(total_volume) OVER w AS m, stddev_samp(total_volume) OVER w AS s FROM daily
              WINDOW w AS (PARTITION BY ticker ORDER BY date_id
                RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)) x""",
}

# Keys of two loads: known ones first, new ones above them.
_LOADED = """
, loaded_t AS (
  SELECT ticker, sector, min(timestamp) AS a, max(timestamp) AS b,
    row_number() OVER (ORDER BY min(timestamp) >= TIMESTAMP '2024-01-16 12:00:00', ticker, sector) AS ticker_sk
  FROM ticks GROUP BY ticker, sector),
loaded_s AS (
  SELECT sector, row_number() OVER (ORDER BY min(timestamp) >= TIMESTAMP '2024-01-16 12:00:00', sector) AS sector_sk
  FROM ticks GROUP BY sector)
"""
_LOADED_BODIES = {
    "fct_incremental": f"""
        SELECT d.ticker_sk, s.sector_sk, t.timestamp, t.fetch_ts, t.volume, CAST(t.timestamp AS DATE) AS date_id,
          {", ".join(f"round(1.00000000001 * t.{c}, 6) AS {c}" for c in _TICK_DOUBLES.split())}
        FROM ticks t LEFT JOIN loaded_t d ON t.ticker = d.ticker LEFT JOIN loaded_s s ON t.sector = s.sector""",
    "dim_ticker_merged": """
        SELECT ticker_sk, ticker AS ticker_code, replace(ticker, '.JK', '') AS ticker_name, sector,
          CAST(a AS DATE) AS first_seen_date, CAST(b AS DATE) AS last_seen_date,
          CAST(b AS DATE) >= DATE '2024-01-23' AS is_active
        FROM loaded_t""",
}

_RATE = "round(1.00000000001 * (CAST(failed_rows AS DOUBLE) / NULLIF(total_rows, 0)), 6) AS failure_rate"

_LOG_BODIES = {
    "dq_null_critical": f"""
        SELECT check_id, total_rows, failed_rows, {_RATE} FROM log
        WHERE check_id IN ('null_critical_fields', 'null_critical_fields_all')""",
    "dq_all_checks": f"""
        SELECT check_id, check_name, 'post_load' AS stage, 'batch-1' AS batch_id,
          TIMESTAMP '2024-01-30 12:00:00' AS execution_ts, total_rows, failed_rows, {_RATE},
          '{{"failed_rows":' || failed_rows || ',"total_rows":' || total_rows || '}}' AS details, severity
        FROM log""",
    "dq_report_top10": f"""
        SELECT check_name, failed_rows, {_RATE} FROM log
        ORDER BY CAST(failed_rows AS DOUBLE) / NULLIF(total_rows, 0) DESC NULLS LAST, check_name LIMIT 10""",
}

_NOT_NULL = " UNION ALL ".join(
    f"SELECT 'not_null_{c}' AS check_id, count(*) AS total_rows, count(*) - count({c}) AS failed_rows "
    "FROM (SELECT *, CAST(timestamp AS DATE) AS date_id FROM raw_ticks) t"
    for c in ("ticker", "sector", "timestamp", "close", "volume", "date_id")
)

_TREND = """
, by_day AS (
  SELECT CAST(timestamp AS DATE) AS date_id, * FROM raw_ticks),
rates AS (
  {rates}),
trended AS (
  SELECT *, CAST(failed_rows AS DOUBLE) / n AS rate FROM rates),
lagged AS (
  SELECT *, lag(rate) OVER (PARTITION BY check_id ORDER BY date_id) AS previous FROM trended)
SELECT date_id, check_id, failed_rows, round(1.00000000001 * rate, 6) AS failure_rate, round(1.00000000001 * previous, 6) AS previous_rate,
  CASE WHEN rate > previous THEN 'up' WHEN rate < previous THEN 'down' WHEN rate = previous THEN 'same' END AS trend,
  failure_rank
FROM (SELECT *, row_number() OVER (PARTITION BY date_id ORDER BY rate DESC NULLS LAST, check_id) AS failure_rank
      FROM lagged) r WHERE failure_rank <= 3
"""
_TREND_CHECKS = [
    ("ohlcv_logic", _PRICE_LOGIC),
    ("negative_volume", "volume < 0"),
    ("null_critical_fields", "ticker IS NULL OR timestamp IS NULL"),
    ("stale_data", _STALE),
    ("not_null_close", "close IS NULL"),
    ("not_null_volume", "volume IS NULL"),
]


def oracle_sql() -> dict[str, str]:
    """SQL text per query name."""
    texts = {name: BASE + body for name, body in _BODIES.items()}
    texts.update({name: _with_log(body) for name, body in _LOG_BODIES.items()})
    texts.update({name: BASE + _LOADED + body for name, body in _LOADED_BODIES.items()})
    texts["agg_sector_hourly_merged"] = texts["agg_sector_hourly"].replace(
        "SELECT sector, hour_bucket, round", "SELECT sector, hour_bucket, CAST(hour_bucket AS DATE) AS date_id, round"
    )
    texts["dq_not_null"] = BASE + _NOT_NULL
    rates = " UNION ALL ".join(
        f"SELECT date_id, '{check_id}' AS check_id, count(*) AS n, "
        f"count(*) FILTER (WHERE {failed}) AS failed_rows FROM by_day GROUP BY date_id"
        for check_id, failed in _TREND_CHECKS
    )
    texts["dq_summary_trend"] = BASE + _TREND.replace("{rates}", rates)
    return texts
