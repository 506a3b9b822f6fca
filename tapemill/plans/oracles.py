"""The registered queries as SQL over the same tables, written from their definition for another engine."""

from tapemill.plans.event_feed import (
    CLOCK,
    COMPRESSION,
    FAULT_CYCLE,
    FAULT_FLAGS,
    FAULT_TIMES,
    FAULTS,
    LATE_CYCLE,
    LATE_SLOT,
    ORIGIN_MS,
    VENUES,
)
from tapemill.plans.registry import SYMBOL

NOW = f"TIMESTAMP '{CLOCK:%Y-%m-%d %H:%M:%S}'"


def _units(number: str) -> str:
    """A decimal number in units of its last place."""
    return f"CAST(replace(CAST({number} AS VARCHAR), '.', '') AS HUGEINT)"


def _mean(units: str, places: int) -> str:
    """Mean of whole numbers of units of 10^-places, rounded half up to eight places; AVG would be a double."""
    scale = 10 ** (places - 8)
    rounded = f"(2 * SUM({units}) + COUNT(*) * {scale}::HUGEINT) // (2 * COUNT(*) * {scale}::HUGEINT)"
    return f"CAST(CAST({rounded} AS DECIMAL(28,0)) * CAST('0.00000001' AS DECIMAL(9,8)) AS DECIMAL(18,8))"


# A double counts as the decimal number that it is written as.
_PRICE = "CAST(CAST(price AS VARCHAR) AS DECIMAL(28,18))"
_MEASURES = f"""
    COUNT(*) AS trade_cnt,
    CAST(SUM(CAST(CAST(qty AS VARCHAR) AS DECIMAL(38,10))) AS DECIMAL(38,10)) AS volume_sum,
    {_mean(_units(_PRICE), 18)} AS price_avg,
    CAST(MIN({_PRICE}) AS DECIMAL(18,8)) AS price_min,
    CAST(MAX({_PRICE}) AS DECIMAL(18,8)) AS price_max"""

_TRADE = f"""trade AS (
  SELECT event_id,
         {ORIGIN_MS} + (epoch_us(ts) // 1000 - {ORIGIN_MS}) // {COMPRESSION} AS ts,
         event_type AS symbol, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS qty,
         CASE WHEN event_id % 2 = 0 THEN 'sell' ELSE 'buy' END AS side
  FROM events)"""

_MINUTE = f"""{_TRADE}, bar AS (
  SELECT symbol, date_trunc('minute', make_timestamp(ts * 1000)) AS window_start_ts, {_MEASURES}
  FROM trade GROUP BY ALL)"""

_HOUR = f"""
  SELECT symbol, date_trunc('hour', window_start_ts) AS window_start_ts,
         SUM(trade_cnt) AS trade_cnt, SUM(volume_sum) AS volume_sum,
         {_mean(_units("price_avg"), 8)} AS price_avg,
         MIN(price_min) AS price_min, MAX(price_max) AS price_max
  FROM bar {{where}} GROUP BY ALL"""

# What leaves an engine: plain integers, and decimals as text.
_BAR_OUT = """symbol, window_start_ts, CAST(trade_cnt AS BIGINT) AS trade_cnt,
  CAST(CAST(volume_sum AS DECIMAL(38,10)) AS VARCHAR) AS volume_sum, CAST(price_avg AS VARCHAR) AS price_avg,
  CAST(price_min AS VARCHAR) AS price_min, CAST(price_max AS VARCHAR) AS price_max"""

# The minutes of many thin feeds, up to the clock.
_THIN = f"""{_TRADE}, thin AS (
  SELECT DISTINCT symbol || '-' || (event_id % {VENUES}) AS symbol,
    date_trunc('minute', make_timestamp(ts * 1000)) AS start
  FROM trade WHERE date_trunc('minute', make_timestamp(ts * 1000)) <= {NOW})"""

_PANEL = f"""{_MINUTE}, panel AS (
  SELECT * FROM bar WHERE window_start_ts >= {NOW} - INTERVAL '1 hour')"""

_RECENT = f"""{_MINUTE}, recent AS (
  SELECT * FROM bar WHERE window_start_ts >= {NOW} - INTERVAL '10 minutes'
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start_ts DESC) <= 10)"""

_FIGURES = f"""{_PANEL}, figure AS (
  SELECT symbol, AVG(CAST(price_avg AS DOUBLE)) AS avg_price,
         MAX(price_max) AS max_price, MIN(price_min) AS min_price,
         CAST(SUM(trade_cnt) AS BIGINT) AS trade_count,
         stddev_samp(CAST(price_avg AS DOUBLE)) AS std_dev,
         CAST(MAX(price_max) - MIN(price_min) AS DOUBLE) / AVG(CAST(price_avg AS DOUBLE)) * 100 AS vol_rate
  FROM panel GROUP BY symbol)"""


def _slot(*faults: str) -> str:
    return f"event_id % {FAULT_CYCLE} IN ({', '.join(str(FAULTS[fault]) for fault in faults)})"


_REJECTED = f"""CASE
  WHEN {_slot('not json', 'two messages', 'forged wrapper')} THEN 'unreadable message'
  WHEN {_slot('no time at all')} THEN 'no event time'
  WHEN {_slot(*FAULT_TIMES)} THEN 'bad event time'
  WHEN {_slot('price not a number')} THEN 'bad price'
  WHEN {_slot('no quantity')} THEN 'bad quantity'
  WHEN {_slot('no symbol')} THEN 'no symbol' END"""

def _by_slot(values: dict[str, str], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {_slot(name)} THEN '{value}'" for name, value in values.items()) + (
        f" ELSE {otherwise} END"
    )


_TIME = _by_slot(FAULT_TIMES, "CAST(ts AS VARCHAR)")
_FLAG = _by_slot(FAULT_FLAGS, "CASE WHEN side = 'sell' THEN 'true' ELSE 'false' END")
_WHOLE = f"""'{{' || concat_ws(',',
  CASE WHEN NOT {_slot('no time at all')} THEN '"E":' || {_TIME} END,
  CASE WHEN {_slot('zero trade time')} THEN '"T":0'
       WHEN NOT {_slot('no trade time', 'no time at all')} THEN '"T":' || {_TIME} END,
  CASE WHEN NOT {_slot('no symbol')} THEN '"s":"' || symbol || '"' END,
  '"p":"' || CASE WHEN {_slot('price not a number')} THEN 'n/a' ELSE CAST(price AS VARCHAR) END || '"',
  CASE WHEN NOT {_slot('no quantity')} THEN '"q":"' || CAST(qty AS VARCHAR) || '"' END,
  CASE WHEN NOT {_slot('no maker flag')} THEN '"m":' || {_FLAG} END) || '}}'"""
_MESSAGE = f"""CASE WHEN {_slot('not json')} THEN 'trade ' || event_id
  WHEN {_slot('two messages')} THEN {_WHOLE} || ',' || {_WHOLE}
  WHEN {_slot('forged wrapper')} THEN {_WHOLE} || ',"message":' || {_WHOLE}
  ELSE {_WHOLE} END"""
_SIDE = f"""CASE WHEN {_slot('no maker flag', 'maker flag 0', 'maker flag empty text')} THEN 'buy'
  WHEN {_slot('maker flag 1', 'maker flag text')} THEN 'sell' ELSE side END"""

# Trades with fractional quantities of all magnitudes and prices that are ties at the ninth decimal.
_FINE = f"""{_TRADE}, fine AS (
  SELECT symbol, ts,
    CAST(printf('%d.%03de%d', event_id % 9 + 1, event_id % 997, event_id % 29 - 10) AS DOUBLE) AS qty,
    CAST(printf('%d.%08d5', event_id % 100, event_id * 7919 % 100000000) AS DOUBLE) AS price
  FROM trade), bar AS (
  SELECT symbol, date_trunc('minute', make_timestamp(ts * 1000)) AS window_start_ts, {_MEASURES}
  FROM fine GROUP BY ALL)"""

_RECORD = f"""'{{"ts":' || {_TIME} || ',"symbol":"' || symbol || '"'
  || CASE WHEN {_slot('price not a number')} THEN '' ELSE ',"price":' || CAST(price AS VARCHAR) END
  || ',"qty":' || CAST(qty AS VARCHAR) || ',"side":"' || side || '"}}'"""

# Late trades come last; they count if their minute ends after the watermark, two minutes behind the newest.
_ROUTED = f"""{_TRADE}, phased AS (
  SELECT *, event_id % {LATE_CYCLE} = {LATE_SLOT} AS late FROM trade), routed AS (
  SELECT *, NOT late
    OR (ts // 60000 + 1) * 60000 > (SELECT MAX(ts) FROM phased WHERE NOT late) - 120000 AS kept FROM phased)"""
_LATE = f"""{_ROUTED}, bar AS (
  SELECT symbol, date_trunc('minute', make_timestamp(ts * 1000)) AS window_start_ts, {_MEASURES}
  FROM routed WHERE kept GROUP BY ALL)"""

# A batch with every seventh bar twice, and a copy without its symbol of every eleventh.
_BATCH = """batch AS (
  SELECT symbol, window_start_ts FROM bar
  UNION ALL SELECT symbol, window_start_ts FROM bar WHERE minute(window_start_ts) % 7 = 0
  UNION ALL SELECT NULL, window_start_ts FROM bar WHERE minute(window_start_ts) % 11 = 0)"""

_ROLLING = """
SELECT symbol, window_start_ts,
       round(CASE WHEN COUNT(*) OVER five >= 5
             THEN stddev_samp(CAST(price_avg AS DOUBLE)) OVER five END, 6) AS rolling_std
FROM {source}
WINDOW five AS (PARTITION BY symbol ORDER BY window_start_ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""


def _series(measure: str) -> str:
    return f"""WITH {_PANEL}
SELECT symbol, window_start_ts + INTERVAL '9 hours' AS window_start_ts,
       CAST({measure} AS VARCHAR) AS {measure} FROM panel"""


def oracle_queries() -> dict[str, str]:
    hour_range = (
        "WHERE window_start_ts >= date_trunc('hour', {now}) - INTERVAL '1 hour' "
        "AND window_start_ts < date_trunc('hour', {now}) + INTERVAL '1 hour'"
    )
    last_run = hour_range.format(now=NOW)
    both_runs = f"WHERE window_start_ts >= date_trunc('hour', {NOW}) - INTERVAL '2 hours'" + (
        f" AND window_start_ts < date_trunc('hour', {NOW}) + INTERVAL '1 hour'"
    )
    minutes = f"WITH {_MINUTE} SELECT {_BAR_OUT} FROM bar"
    return {
        "normalize_trades": f"""WITH {_TRADE}
SELECT ts, symbol, price, qty, {_SIDE} AS side
FROM trade WHERE ({_REJECTED}) IS NULL""",
        "rejected_trades": f"""WITH {_TRADE}
SELECT {_MESSAGE} AS value, {_REJECTED} AS reason FROM trade WHERE ({_REJECTED}) IS NOT NULL""",
        "encode_trades": f"""WITH {_TRADE}
SELECT symbol AS key, '{{"ts":' || ts || ',"symbol":"' || symbol || '","price":' || CAST(price AS VARCHAR)
  || ',"qty":' || CAST(qty AS VARCHAR) || ',"side":"' || side || '"}}' AS value FROM trade""",
        "parse_trade_json": f"""WITH {_TRADE}
SELECT ts, symbol, price, qty, side, make_timestamp(ts * 1000) AS event_time FROM trade""",
        "event_time": f"WITH {_TRADE} SELECT event_id, ts, make_timestamp(ts * 1000) AS event_time FROM trade",
        "unparsed_trades": f"""WITH {_TRADE}
SELECT CASE WHEN {_slot('not json')} THEN substr({_RECORD}, 1, 5) ELSE {_RECORD} END AS value,
  CASE WHEN {_slot('not json')} THEN 'unreadable message'
    WHEN {_slot(*FAULT_TIMES)} THEN 'bad event time' ELSE 'bad price' END AS reason
FROM trade WHERE {_slot('not json', 'price not a number', *FAULT_TIMES)}""",
        "agg_1m": minutes,
        "agg_1m_fine": f"WITH {_FINE} SELECT {_BAR_OUT} FROM bar",
        "late_data": f"WITH {_LATE} SELECT {_BAR_OUT} FROM bar",
        "late_trades": f"""WITH {_ROUTED}
SELECT symbol, date_trunc('minute', make_timestamp(ts * 1000)) AS window_start_ts,
  CAST(COUNT(*) FILTER (kept) AS BIGINT) AS trade_cnt, CAST(COUNT(*) FILTER (NOT kept) AS BIGINT) AS late_cnt
FROM routed GROUP BY ALL""",
        "contract_violations": f"""WITH {_MINUTE}, {_BATCH}
SELECT symbol, window_start_ts, CAST(COUNT(*) AS BIGINT) AS row_cnt,
  CAST(COUNT(*) FILTER (symbol IS NULL) AS BIGINT) AS null_row_cnt
FROM batch GROUP BY ALL HAVING COUNT(*) > 1 OR COUNT(*) FILTER (symbol IS NULL) > 0""",
        "run_hourly": f"WITH {_MINUTE} SELECT {_BAR_OUT} FROM ({_HOUR.format(where=both_runs)})",
        "agg_1m_stream": minutes,
        "agg_1m_once": minutes,
        "conform_agg": f"WITH {_MINUTE} SELECT {_BAR_OUT}, {NOW} AS updated_at FROM bar",
        "upsert_1m": f"""WITH {_MINUTE}, sell AS (
  SELECT symbol, date_trunc('minute', make_timestamp(ts * 1000)) AS window_start_ts, {_MEASURES}
  FROM trade WHERE side = 'sell' GROUP BY ALL)
SELECT {_BAR_OUT} FROM (
  SELECT * FROM sell UNION ALL
  SELECT * FROM bar WHERE NOT EXISTS (
    SELECT 1 FROM sell WHERE sell.symbol = bar.symbol AND sell.window_start_ts = bar.window_start_ts))""",
        "rollup_1h": f"WITH {_MINUTE} SELECT {_BAR_OUT} FROM ({_HOUR.format(where=last_run)})",
        "rollup_1h_history": f"WITH {_MINUTE} SELECT {_BAR_OUT} FROM ({_HOUR.format(where='')})",
        "rollup_1h_stream": f"WITH {_MINUTE} SELECT {_BAR_OUT} FROM ({_HOUR.format(where='')})",
        "upsert_1h": f"WITH {_MINUTE} SELECT {_BAR_OUT} FROM ({_HOUR.format(where=both_runs)})",
        "snapshot_manifest": f"""WITH {_MINUTE}, hour AS ({_HOUR.format(where='')})
SELECT 'trade_agg_1m' AS table_name, COUNT(*) AS row_cnt,
       MIN(window_start_ts) AS first_window, MAX(window_start_ts) AS last_window FROM bar
UNION ALL
SELECT 'trade_agg_1h', COUNT(*), MIN(window_start_ts), MAX(window_start_ts) FROM hour""",
        "dq_recent_30m": f"""WITH {_MINUTE}
SELECT COUNT(*) AS cnt, COUNT(*) > 0 AS fresh FROM bar
WHERE window_start_ts >= {NOW} - INTERVAL '30 minutes'""",
        "outages": f"""WITH {_THIN}, step AS (
  SELECT symbol, start, lead(start) OVER (PARTITION BY symbol ORDER BY start) AS following FROM thin)
SELECT symbol, start + INTERVAL '1 minute' AS silent_from, following AS silent_until, following IS NULL AS ongoing,
  date_diff('minute', start + INTERVAL '1 minute', coalesce(following, {NOW})) AS silent_minutes
FROM step WHERE coalesce(following, {NOW}) > start + INTERVAL '30 minutes'""",
        "symbol_freshness": f"""WITH {_THIN}
SELECT symbol, MAX(start) AS last_window, MAX(start) >= {NOW} - INTERVAL '30 minutes' AS fresh
FROM thin GROUP BY symbol""",
        "ingest_status": f"""WITH {_RECENT}
SELECT CASE WHEN COUNT(*) > 0 THEN 'ok' ELSE 'no data' END AS status,
       CAST(COALESCE(SUM(trade_cnt), 0) AS BIGINT) AS recent_rows FROM recent""",
        "panel_1h": f"WITH {_PANEL} SELECT {_BAR_OUT} FROM panel ORDER BY window_start_ts, symbol",
        "panel_1h_symbol": f"""WITH {_PANEL}
SELECT {_BAR_OUT} FROM panel WHERE symbol = '{SYMBOL}' ORDER BY window_start_ts""",
        "panel_recent": f"WITH {_RECENT} SELECT {_BAR_OUT} FROM recent",
        "panel_recent_symbol": f"""WITH {_MINUTE}
SELECT {_BAR_OUT} FROM bar
WHERE symbol = '{SYMBOL}' AND window_start_ts >= {NOW} - INTERVAL '10 minutes'
ORDER BY window_start_ts DESC LIMIT 10""",
        "recent_total": f"""WITH {_RECENT}
SELECT symbol, CAST(SUM(trade_cnt) AS BIGINT) AS recent_rows FROM recent GROUP BY symbol""",
        "kpis_1h": f"""WITH {_FIGURES}
SELECT symbol, round(avg_price, 6) AS avg_price, CAST(max_price AS VARCHAR) AS max_price,
  CAST(min_price AS VARCHAR) AS min_price, trade_count FROM figure""",
        "volatility_1h": f"""WITH {_FIGURES}
SELECT symbol, round(std_dev, 6) AS std_dev, round(vol_rate, 6) AS vol_rate FROM figure""",
        "volatility_history": f"""WITH {_MINUTE}
SELECT symbol, COUNT(*) AS minutes, round(stddev_samp(CAST(price_avg AS DOUBLE)), 6) AS std_dev,
       round(CAST(MAX(price_max) - MIN(price_min) AS DOUBLE) / AVG(CAST(price_avg AS DOUBLE)) * 100, 6) AS vol_rate
FROM bar GROUP BY symbol""",
        "hour_moments": f"""WITH {_MINUTE}
SELECT symbol, date_trunc('hour', window_start_ts) AS hour, COUNT(*) AS minutes,
       round(AVG(CAST(price_avg AS DOUBLE)), 7) AS mean,
       round(stddev_pop(CAST(price_avg AS DOUBLE)), 6) AS deviation,
       CAST(MIN(price_min) AS VARCHAR) AS price_min, CAST(MAX(price_max) AS VARCHAR) AS price_max
FROM bar GROUP BY ALL""",
        "axis_range_1h": f"""WITH {_PANEL}
SELECT symbol, round(MIN(CAST(price_avg AS DOUBLE)) * CAST(0.999 AS DOUBLE), 6) AS y_min,
       round(MAX(CAST(price_avg AS DOUBLE)) * CAST(1.001 AS DOUBLE), 6) AS y_max
FROM panel GROUP BY symbol""",
        "rolling_std": f"WITH {_PANEL} {_ROLLING.format(source='panel')}",
        "rolling_std_stream": f"WITH {_MINUTE} {_ROLLING.format(source='bar')}",
        "rolling_std_history": f"WITH {_MINUTE} {_ROLLING.format(source='bar')}",
        "minute_bars": f"""WITH {_RECENT}
SELECT symbol, strftime(window_start_ts, '%H:%M') AS minute, trade_cnt FROM recent""",
        "price_series": _series("price_avg"),
        "volume_series": _series("volume_sum"),
        "display_time": f"""WITH {_MINUTE}
SELECT symbol, window_start_ts, window_start_ts + INTERVAL '9 hours' AS shown_ts FROM bar""",
        "kpi_text": f"""WITH {_FIGURES}
SELECT symbol, format('{{:,.2f}}', avg_price) AS avg_price, format('{{:,.2f}}', CAST(max_price AS DOUBLE)) AS max_price,
       format('{{:,.2f}}', CAST(min_price AS DOUBLE)) AS min_price, format('{{:,}}', trade_count) AS trade_count,
       format('{{:,.2f}}', std_dev) AS std_dev, format('{{:.2f}}%', vol_rate) AS vol_rate FROM figure""",
    }
