"""DuckDB SQL with the same results as the registered queries, over the same tables."""

from tidemark.schemas import FEATURE_STORE_TYPES, STORED_FEATURES

TICKS = """ticks AS (
  SELECT ts AS t, event_type AS symbol, value AS price, event_id AS id,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size
  FROM events)"""


def _bars(name, source, bucket, frame):
    return f"""{name} AS (
  SELECT {bucket} AS time, symbol, '{frame}' AS timeframe,
         arg_min(price, row(t, id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(t, id)) AS close, sum(size) AS volume,
         sum(price * size) AS quote_volume, CAST(count(*) AS BIGINT) AS trades_count
  FROM {source} GROUP BY {bucket}, symbol)"""


CANDLES = TICKS + ", " + _bars("candles", "ticks", "date_trunc('hour', t)", "1h")

HUGE_CANDLES = CANDLES.replace("candles AS (", "base_candles AS (") + """, candles AS (
  SELECT * REPLACE (CASE WHEN symbol = 'click' AND hour(time) = 9 THEN 1e9 ELSE close END AS close,
    greatest(high, CASE WHEN symbol = 'click' AND hour(time) = 9 THEN 1e9 ELSE close END) AS high) FROM base_candles)"""

HOLED_CANDLES = CANDLES.replace("candles AS (", "base_candles AS (") + """, candles AS (
  SELECT * REPLACE (last_value(CASE WHEN (hour(time) = 3 AND day(time) % 5 = 3) OR (hour(time) = 7 AND day(time) % 5 = 4)
    THEN NULL ELSE close END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY time ROWS UNBOUNDED PRECEDING) AS close) FROM base_candles)"""

ORDER_CANDLES = f"""order_ticks AS (
  SELECT o_orderdate AS t, o_orderpriority AS symbol, o_totalprice AS price, 1.0::DOUBLE AS size,
         o_orderkey AS id FROM orders), {_bars('candles', 'order_ticks', "date_trunc('day', t)", '1d')}"""


def _resample(name, source, bucket, frame):
    return f"""{name} AS (
  SELECT {bucket} AS time, symbol, '{frame}' AS timeframe, arg_min(open, time) AS open,
         max(high) AS high, min(low) AS low, arg_max(close, time) AS close, sum(volume) AS volume,
         sum(quote_volume) AS quote_volume, CAST(sum(trades_count) AS BIGINT) AS trades_count
  FROM {source} GROUP BY {bucket}, symbol)"""


BOTH = f"""{CANDLES}, {_resample('days', 'candles', "date_trunc('day', time)", '1d')},
both_frames AS (SELECT * FROM candles UNION ALL BY NAME SELECT * FROM days)"""

METADATA = """metadata AS (
  SELECT DISTINCT event_type AS symbol, event_type AS base_currency, 'USDT' AS quote_currency,
         'binance' AS exchange, true AS is_active FROM events WHERE event_type <> 'error')"""

DIRTY = f"""{CANDLES}, broken AS (
  SELECT time, symbol, timeframe, open, CASE WHEN hour(time) = 3 THEN low - 1 ELSE high END AS high,
         low, close, CASE WHEN hour(time) = 5 THEN -volume ELSE volume END AS volume FROM candles),
dirty AS (SELECT * FROM broken UNION ALL SELECT * FROM broken
          WHERE time >= TIMESTAMP '2024-01-10' AND time < TIMESTAMP '2024-01-11')"""

STORED = f"""{CANDLES}, stored AS (SELECT * FROM candles WHERE time < TIMESTAMP '2024-01-20'),
arriving AS (SELECT * REPLACE (close * 1.01 AS close) FROM candles WHERE time >= TIMESTAMP '2024-01-15')"""

PREDICTED = f"""{CANDLES}, predictions AS (
  SELECT 'last_close' AS model_name, symbol, timeframe, time AS prediction_time,
         time + INTERVAL 1 HOUR AS target_time, close AS predicted FROM candles
  UNION ALL
  SELECT 'midrange', symbol, timeframe, time, time + INTERVAL 1 HOUR, (high + low) / 2 FROM candles),
scored AS (
  SELECT p.*, c.close AS actual FROM predictions p
  LEFT JOIN candles c ON c.symbol = p.symbol AND c.timeframe = p.timeframe AND c.time = p.target_time)"""

W = "PARTITION BY symbol, timeframe ORDER BY time"


def r(expr, name=None):
    out = f"round(({expr}) + 3.3e-9, 6) + 0.0::DOUBLE"
    return f"{out} AS {name}" if name else out


def half_up(expr, places):
    return f"CAST(round(CAST({expr} AS DECIMAL(38,8)), {places}) AS DOUBLE) + 0.0::DOUBLE"


def strict(fn, column, n):
    frame = f"({W} ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({column}) OVER {frame} >= {n} THEN {fn}({column}) OVER {frame} END"


def partial(fn, column, n):
    return f"{fn}({column}) OVER ({W} ROWS {n - 1} PRECEDING)"


def prev(column, k=1):
    return f"lag({column}, {k}) OVER ({W})"


# --- moving and exponential averages, step by step ---------------------------

SPANS = (7, 25, 99, 12, 26)


def _scan(spans, extra=False):
    """Recursive CTE with one exponential average per span (and gain, loss, true range)."""
    first = [f"close AS e{s}" for s in spans]
    nxt = [f"{2 / (s + 1)!r} * b.close + {1 - 2 / (s + 1)!r} * e.e{s}" for s in spans]
    if extra:
        a, q = repr(2 / 15), repr(1 - 2 / 15)
        first += [f"{x} AS e_{x}" for x in ("gain", "loss", "tr")]
        nxt += [f"{a} * b.{x} + {q} * e.e_{x}" for x in ("gain", "loss", "tr")]
    return f"""numbered AS (
  SELECT symbol, timeframe, time, close, row_number() OVER ({W}) AS rn,
         greatest(coalesce(close - {prev('close')}, 0.0), 0.0) AS gain,
         greatest(coalesce({prev('close')} - close, 0.0), 0.0) AS loss,
         greatest(high - low, coalesce(abs(high - {prev('close')}), high - low),
                  coalesce(abs(low - {prev('close')}), high - low)) AS tr
  FROM candles),
ema AS (
  SELECT symbol, timeframe, time, rn, {', '.join(first)} FROM numbered WHERE rn = 1
  UNION ALL
  SELECT b.symbol, b.timeframe, b.time, b.rn, {', '.join(nxt)}
  FROM ema e JOIN numbered b ON b.symbol = e.symbol AND b.timeframe = e.timeframe AND b.rn = e.rn + 1)"""


SIGNAL = f"""signal AS (
  SELECT symbol, timeframe, rn, e12 - e26 AS s FROM ema WHERE rn = 1
  UNION ALL
  SELECT b.symbol, b.timeframe, b.rn, {2 / 10!r} * (b.e12 - b.e26) + {1 - 2 / 10!r} * g.s
  FROM signal g JOIN ema b ON b.symbol = g.symbol AND b.timeframe = g.timeframe AND b.rn = g.rn + 1)"""

RSI = """CASE WHEN e_loss = 0 AND e_gain > 0 THEN 100.0 WHEN e_loss = 0 THEN NULL
  ELSE 100 - 100 / (1 + e_gain / e_loss) END"""

CALENDAR = """CAST(hour(time) AS INTEGER) AS hour, CAST(isodow(time) - 1 AS INTEGER) AS day_of_week,
  CAST(day(time) AS INTEGER) AS day_of_month, CAST(month(time) AS INTEGER) AS month,
  CAST(quarter(time) AS INTEGER) AS quarter, CAST(year(time) AS INTEGER) AS year,
  round(sin(2 * pi() * hour(time) / 24) + 3.3e-9, 6) + 0.0::DOUBLE AS hour_sin,
  round(cos(2 * pi() * hour(time) / 24) + 3.3e-9, 6) + 0.0::DOUBLE AS hour_cos,
  round(sin(2 * pi() * (isodow(time) - 1) / 7) + 3.3e-9, 6) + 0.0::DOUBLE AS day_sin,
  round(cos(2 * pi() * (isodow(time) - 1) / 7) + 3.3e-9, 6) + 0.0::DOUBLE AS day_cos,
  round(sin(2 * pi() * month(time) / 12) + 3.3e-9, 6) + 0.0::DOUBLE AS month_sin,
  round(cos(2 * pi() * month(time) / 12) + 3.3e-9, 6) + 0.0::DOUBLE AS month_cos,
  CAST(CASE WHEN isodow(time) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend"""

WINDOWED = f"""windowed AS (
  SELECT *, {prev('close')} AS prev_close, first_value(close) OVER ({W}) AS first_close,
    row_number() OVER ({W}) AS rn,
    {strict('avg', 'close', 7)} AS sma_7, {strict('avg', 'close', 25)} AS sma_25,
    {strict('avg', 'close', 99)} AS sma_99,
    {strict('avg', 'close', 20)} AS bb_middle, {strict('stddev_samp', 'close', 20)} AS bb_dev,
    {strict('min', 'low', 14)} AS low_14, {strict('max', 'high', 14)} AS high_14,
    {strict('avg', 'volume', 7)} AS volume_sma_7, {strict('avg', 'volume', 25)} AS volume_sma_25,
    sum(volume * (high + low + close) / 3) OVER ({W} ROWS UNBOUNDED PRECEDING) AS traded,
    sum(volume) OVER ({W} ROWS UNBOUNDED PRECEDING) AS volume_so_far,
    {strict('stddev_samp', 'close', 7)} AS price_volatility_7,
    {strict('stddev_samp', 'close', 14)} AS price_volatility_14,
    {strict('stddev_samp', 'close', 30)} AS price_volatility_30,
    {', '.join(f"{prev('close', k)} AS close_lag_{k}" for k in (1, 3, 6, 12, 24))}
  FROM candles),
derived AS (
  SELECT *, close / nullif(prev_close, 0) - 1 AS returns,
    CASE WHEN close / nullif(prev_close, 0) > 0 THEN ln(close / nullif(prev_close, 0)) END AS log_returns,
    CASE WHEN rn > 1 THEN close / nullif(first_close, 0) - 1 END AS cumulative_returns,
    close - open AS price_change, (close - open) / nullif(open, 0) * 100 AS price_change_pct,
    high - low AS daily_range, (high - low) / nullif(low, 0) * 100 AS daily_range_pct,
    bb_middle + 2.0 * bb_dev AS bb_upper, bb_middle - 2.0 * bb_dev AS bb_lower,
    4.0 * bb_dev AS bb_width,
    100 * (close - low_14) / nullif(high_14 - low_14, 0) AS stoch_k,
    volume / nullif(volume_sma_25, 0) AS volume_ratio,
    traded / nullif(volume_so_far, 0) AS vwap
  FROM windowed),
twice AS (
  SELECT *, {strict('avg', 'stoch_k', 3)} AS stoch_d,
    {strict('stddev_samp', 'returns', 7)} AS volatility_7,
    {strict('stddev_samp', 'returns', 14)} AS volatility_14,
    {strict('stddev_samp', 'returns', 30)} AS volatility_30
  FROM derived)"""

FEATURES = f"""{CANDLES}, {_scan(SPANS, True)}, {SIGNAL}, {WINDOWED},
features AS (
  SELECT t.*, e.e7 AS ema_7, e.e25 AS ema_25, e.e99 AS ema_99, {RSI} AS rsi_14,
    e.e12 - e.e26 AS macd, g.s AS macd_signal, e.e12 - e.e26 - g.s AS macd_histogram,
    e.e_tr AS atr_14, t.volatility_7 AS volatility_24h
  FROM twice t
  JOIN ema e ON e.symbol = t.symbol AND e.timeframe = t.timeframe AND e.rn = t.rn
  JOIN signal g ON g.symbol = t.symbol AND g.timeframe = t.timeframe AND g.rn = t.rn)"""

# The feature columns other than the calendar ones.
FEATURE_NAMES = [
    "returns", "log_returns", "cumulative_returns", "price_change", "price_change_pct", "daily_range",
    "daily_range_pct", "sma_7", "sma_25", "sma_99", "ema_7", "ema_25", "ema_99", "rsi_14", "macd",
    "macd_signal", "macd_histogram", "bb_upper", "bb_middle", "bb_lower", "bb_width", "atr_14",
    "stoch_k", "stoch_d", "volume_sma_7", "volume_sma_25", "volume_ratio", "vwap", "volatility_7",
    "volatility_14", "volatility_30", "price_volatility_7", "price_volatility_14",
    "price_volatility_30", "close_lag_1", "close_lag_3", "close_lag_6", "close_lag_12", "close_lag_24",
]

_few_nulls = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in STORED_FEATURES)
KEPT = f"{FEATURES}, kept AS (SELECT * FROM features WHERE {_few_nulls} < {len(STORED_FEATURES) / 2})"


def _stored_type(t):
    return f"DECIMAL({t.precision},{t.scale})"


SAVED = f"""{KEPT}, saved AS (
  SELECT time, symbol, timeframe, {', '.join(f"CAST({n} AS {_stored_type(t)}) AS {n}" for n, t in FEATURE_STORE_TYPES.items())}
  FROM kept)"""
_saved_doubles = ", ".join(r(f"CAST(s.{n} AS DOUBLE)", n) for n in STORED_FEATURES)

_no_nulls = " AND ".join(f"{c} IS NOT NULL" for c in (*STORED_FEATURES, "close", "target"))
TRAINING = f"""{SAVED}, joined AS (
  SELECT s.*, c.close, lead(c.close) OVER (PARTITION BY s.symbol, s.timeframe ORDER BY s.time) AS target
  FROM saved s JOIN candles c USING (time, symbol, timeframe)),
training AS (SELECT * FROM joined WHERE {_no_nulls})"""


def _split(source):
    part = "PARTITION BY symbol, timeframe"
    return f"""placed AS (
  SELECT *, row_number() OVER ({part} ORDER BY time) - 1 AS place, count(*) OVER ({part})::DOUBLE AS n
  FROM {source}),
divided AS (
  SELECT * EXCLUDE (place, n), CASE WHEN place < floor(n * {1 - 0.2 - 0.1!r}::DOUBLE) THEN 'train'
    WHEN place < floor(n * {1 - 0.2!r}::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM placed)"""


_moments = ", ".join(f"avg({c}::DOUBLE) AS {c}_m, var_pop({c}::DOUBLE) AS {c}_v" for c in STORED_FEATURES)
MOMENTS = f"""moments AS (SELECT symbol, timeframe, count(*)::DOUBLE AS n, {_moments} FROM divided
            WHERE split = 'train' GROUP BY symbol, timeframe)"""


def _standardized(c):
    eps = "2.220446049250313e-16"
    noise = f"(n * {eps} * {c}_v + pow(n * {c}_m * {eps}, 2))"
    return f"({c}::DOUBLE - {c}_m) / CASE WHEN {c}_v <= {noise} THEN 1.0 ELSE sqrt({c}_v) END"


def _scaled():
    columns = ", ".join(r(_standardized(c), c) for c in STORED_FEATURES)
    return f"""WITH RECURSIVE {TRAINING}, {_split('training')},
{MOMENTS}
SELECT time, symbol, timeframe, {columns}, {r('target', 'target')}, split
FROM divided JOIN moments USING (symbol, timeframe)"""


METRICS = """metrics AS (
  SELECT model_name, symbol, count(*) AS samples, sqrt(avg(pow(actual - predicted, 2))) AS rmse,
    avg(abs(actual - predicted)) AS mae, avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape,
    1 - sum(pow(actual - predicted, 2)) / nullif(var_pop(actual) * count(*), 0) AS r2
  FROM scored WHERE actual IS NOT NULL GROUP BY model_name, symbol)"""

MOVES = """moves AS (
  SELECT model_name, symbol, timeframe,
    sign(actual - lag(actual) OVER w) = sign(predicted - lag(predicted) OVER w) AS hit
  FROM scored WHERE actual IS NOT NULL
  WINDOW w AS (PARTITION BY model_name, symbol, timeframe ORDER BY target_time)),
directions AS (
  SELECT model_name, symbol, timeframe,
    coalesce(avg(CASE WHEN hit IS NOT NULL THEN hit::INT END) * 100, 0.0) AS directional_accuracy
  FROM moves GROUP BY ALL)"""

METRIC_COLUMNS = "model_name, symbol, samples, " + ", ".join(
    r(c, c) for c in ("rmse", "mae", "mape", "r2")
)
BAR_COLUMNS = "time, symbol, timeframe, " + ", ".join(
    r(c, c) for c in ("open", "high", "low", "close", "volume", "quote_volume")
) + ", trades_count"
RETURNS = f"""changes AS (
  SELECT time, symbol, timeframe, close, {prev('close')} AS prev_close,
    (close - {prev('close')}) / nullif({prev('close')}, 0) * 100 AS returns_pct FROM candles)"""
DAY_COLUMNS = """arg_min(open, time) AS day_open, max(high) AS day_high, min(low) AS day_low,
  arg_max(close, time) AS day_close, sum(volume) AS day_volume"""
NEWEST = """newest AS (SELECT symbol, arg_max(close, row(time, timeframe)) AS close FROM both_frames GROUP BY symbol),
ago AS (SELECT symbol, max(time) AS time, arg_max(close, row(time, timeframe)) AS price_ago FROM both_frames
        WHERE time <= (SELECT max(time) FROM both_frames) - INTERVAL 24 HOUR GROUP BY symbol)"""
TICKERS = """tickers AS (
  SELECT symbol, arg_max(close, time) AS last_price, sum(quote_volume) AS volume_24h,
    (arg_max(close, time) - arg_min(open, time)) / nullif(arg_min(open, time), 0) * 100 AS change_24h_pct,
    max(high) AS high_24h, min(low) AS low_24h, max(time) AS "timestamp"
  FROM candles WHERE time > (SELECT max(time) FROM candles) - INTERVAL 24 HOUR GROUP BY symbol)"""


def _features(names):
    return f"WITH RECURSIVE {FEATURES} SELECT time, symbol, timeframe, {', '.join(r(n, n) for n in names)} FROM features"


def _windowed(*names):
    return f"WITH {CANDLES}, {WINDOWED} SELECT time, symbol, timeframe, {', '.join(r(n, n) for n in names)} FROM twice"


def _describe():
    parts = " UNION ALL ".join(
        f"SELECT symbol, '{c}' AS k, {c} AS v FROM candles"
        for c in ("open", "high", "low", "close", "volume")
    )
    quart = ", ".join(r(f"quantile_cont(v, {p})", n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    return f"""WITH {CANDLES}, long AS ({parts})
SELECT symbol, k AS "column", count(v) AS count, {r('avg(v)', 'mean')}, {r('stddev_samp(v)', 'std')},
  {r('min(v)', 'min')}, {r('max(v)', 'max')}, {quart} FROM long GROUP BY symbol, k"""


ORACLES = {
    "daily_stats": f"""WITH {CANDLES} SELECT date_trunc('day', time)::TIMESTAMP AS day, symbol, timeframe,
{DAY_COLUMNS}, count(*) AS candles_count FROM candles GROUP BY 1, 2, 3""",
    "daily_latest50": f"""WITH {BOTH} SELECT date_trunc('day', time)::TIMESTAMP AS day, symbol,
{DAY_COLUMNS} FROM both_frames GROUP BY 1, 2 ORDER BY day DESC, symbol LIMIT 50""",
    "resample_4h": f"""WITH {CANDLES}, {_resample('coarse', 'candles', "time_bucket(INTERVAL 4 HOUR, time)", '4h')}
SELECT {BAR_COLUMNS} FROM coarse""",
    "resample_1w": f"""WITH {ORDER_CANDLES}, {_resample('coarse', 'candles', "date_trunc('week', time)::TIMESTAMP", '1w')}
SELECT {BAR_COLUMNS} FROM coarse""",
    "resample_1month": f"""WITH {ORDER_CANDLES}, {_resample('coarse', 'candles', "date_trunc('month', time)::TIMESTAMP", '1M')}
SELECT {BAR_COLUMNS} FROM coarse""",
    "ticks_to_candles": f"WITH {CANDLES} SELECT {BAR_COLUMNS} FROM candles",
    "table_stats": f"""WITH {CANDLES} SELECT count(DISTINCT symbol) AS nb_symbols, count(*) AS total_candles,
min(time) AS first_date, max(time) AS last_date,
CAST(floor((epoch(max(time)) - epoch(min(time))) / 86400) AS BIGINT) AS days FROM candles""",
    "count_per_symbol": f"WITH {CANDLES} SELECT symbol, count(*) AS count FROM candles GROUP BY symbol",
    "distinct_symbols": f"WITH {CANDLES} SELECT DISTINCT symbol FROM candles",
    "symbol_stats": f"""WITH {CANDLES} SELECT symbol, count(*) AS nb_candles, min(time) AS first_date,
max(time) AS last_date, {half_up('avg(close)', 2)} AS avg_price, {half_up('min(low)', 2)} AS min_price,
{half_up('max(high)', 2)} AS max_price, {half_up('sum(volume)', 2)} AS total_volume
FROM candles GROUP BY symbol""",
    "summary": f"""WITH {CANDLES}, ends AS (
  SELECT symbol, count(*) AS nb_candles, arg_min(close, time) AS f, arg_max(close, time) AS l,
    min(low) AS lo, max(high) AS hi, avg(volume) AS av, sum(volume) AS sv FROM candles GROUP BY symbol)
SELECT symbol, nb_candles, {half_up('f', 2)} AS first_price, {half_up('l', 2)} AS last_price,
  {half_up('(l - f) / nullif(f, 0) * 100', 2)} AS total_change_pct, {half_up('lo', 2)} AS min_price,
  {half_up('hi', 2)} AS max_price, {half_up('av', 2)} AS avg_volume, {half_up('sv', 2)} AS total_volume
FROM ends""",
    "collection_summary": f"""WITH {CANDLES} SELECT symbol, count(*) AS candles, min(time) AS first_time,
max(time) AS last_time, min(low) AS min_price, max(high) AS max_price, sum(volume) AS total_volume
FROM candles GROUP BY ROLLUP (symbol)""",
    "collection_report": f"""WITH {CANDLES} SELECT count(DISTINCT symbol) AS total_symbols,
string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols, count(*) AS total_candles FROM candles""",
    "returns_stats": f"""WITH {CANDLES}, {RETURNS} SELECT symbol, {half_up('avg(returns_pct)', 4)} AS mean,
{half_up('quantile_cont(returns_pct, 0.5)', 4)} AS median, {half_up('stddev_samp(returns_pct)', 4)} AS std,
{half_up('min(returns_pct)', 4)} AS min, {half_up('max(returns_pct)', 4)} AS max
FROM changes WHERE returns_pct IS NOT NULL GROUP BY symbol""",
    "describe": _describe(),
    "returns_hist": f"""WITH {CANDLES}, {RETURNS}, edges AS (
  SELECT symbol, min(returns_pct) AS lo, max(returns_pct) AS hi FROM changes GROUP BY symbol)
SELECT symbol, CAST(least(floor((returns_pct - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS count
FROM changes JOIN edges USING (symbol) WHERE returns_pct IS NOT NULL GROUP BY 1, 2""",
    "returns_corr": f"""WITH {CANDLES}, times AS (SELECT DISTINCT time FROM candles),
symbols AS (SELECT DISTINCT symbol FROM candles),
grid AS (
  SELECT t.time, s.symbol,
    last_value(c.close IGNORE NULLS) OVER (PARTITION BY s.symbol ORDER BY t.time ROWS UNBOUNDED PRECEDING) AS close
  FROM times t CROSS JOIN symbols s LEFT JOIN candles c ON c.time = t.time AND c.symbol = s.symbol),
steps AS (SELECT time, symbol, close / lag(close) OVER (PARTITION BY symbol ORDER BY time) - 1 AS ret FROM grid),
complete AS (SELECT time FROM steps GROUP BY time HAVING count(ret) = count(*))
SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, {r('corr(a.ret, b.ret)', 'corr')}
FROM steps a JOIN steps b ON a.time = b.time JOIN complete k ON k.time = a.time GROUP BY 1, 2""",
    "pivot_close": f"""WITH {CANDLES} SELECT time, {', '.join(
        f"max(close) FILTER (symbol = '{s}') AS {s}" for s in ('click', 'error', 'purchase', 'signup', 'view'))}
FROM candles GROUP BY time""",
    "gaps": f"""WITH {CANDLES}, ends AS (SELECT symbol, timeframe, min(time) AS a, max(time) AS b FROM candles GROUP BY 1, 2),
grid AS (SELECT symbol, timeframe, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS time FROM ends)
SELECT g.symbol, g.timeframe, g.time FROM grid g ANTI JOIN candles c USING (symbol, timeframe, time)
UNION ALL
SELECT g.symbol, '1M', g.time FROM (
  SELECT symbol, unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS time FROM (
    SELECT o_orderpriority AS symbol, date_trunc('month', o_orderdate)::TIMESTAMP AS m FROM orders) WHERE month(m) % 4 <> 2 GROUP BY symbol) g
ANTI JOIN (SELECT o_orderpriority AS symbol, date_trunc('month', o_orderdate)::TIMESTAMP AS time FROM orders
           WHERE month(o_orderdate) % 4 <> 2) USING (symbol, time)""",
    "outliers": f"""WITH {CANDLES}, steps AS (
  SELECT time, symbol, timeframe, close, close / nullif({prev('close')}, 0) - 1 AS returns FROM candles),
moments AS (SELECT symbol, timeframe, avg(returns) AS m, stddev_samp(returns) AS s FROM steps GROUP BY 1, 2)
SELECT time, symbol, timeframe, close, {r('returns', 'returns')} FROM steps JOIN moments USING (symbol, timeframe)
WHERE abs(returns - m) > 3 * s""",
    "scan_ohlcv": f"""WITH {BOTH} SELECT time, symbol, open, high, low, close, volume, timeframe
FROM both_frames WHERE timeframe = '1h'""",
    "scan_limit": f"""WITH {BOTH} SELECT {BAR_COLUMNS} FROM both_frames WHERE symbol = 'click'
ORDER BY both_frames.time, symbol, timeframe LIMIT 25""",
    "latest_prices": f"""WITH {BOTH} SELECT symbol, timeframe, max(time) AS time, arg_max(close, time) AS price,
arg_max(volume, time) AS volume FROM both_frames GROUP BY symbol, timeframe""",
    "asof_price": f"WITH {BOTH}, {NEWEST} SELECT symbol, time, price_ago FROM ago",
    "performance_24h": f"""WITH {BOTH}, {NEWEST} SELECT symbol, {half_up('close', 2)} AS current_price,
{half_up('price_ago', 2)} AS price_24h_ago,
{half_up('(close - price_ago) / nullif(price_ago, 0) * 100', 2)} AS change_24h_pct
FROM newest JOIN ago USING (symbol)""",
    "market_summary": f"""WITH {CANDLES}, {TICKERS} SELECT symbol, last_price, {r('volume_24h', 'volume_24h')},
{r('change_24h_pct', 'change_24h_pct')}, high_24h, low_24h, CAST(NULL AS DOUBLE) AS bid,
CAST(NULL AS DOUBLE) AS ask, "timestamp" FROM tickers""",
    "available_symbols": f"""WITH {CANDLES}, {TICKERS} SELECT symbol, {r('volume_24h', 'volume_24h')}
FROM tickers WHERE contains(symbol, 'i') AND volume_24h >= 1000 AND volume_24h <> 0""",
    "top_symbols": f"""WITH {CANDLES}, {TICKERS} SELECT symbol, {r('volume_24h', 'volume_24h')}
FROM tickers t WHERE t.volume_24h >= 1 ORDER BY t.volume_24h DESC, symbol LIMIT 3""",
    "sma": _windowed("sma_7", "sma_25", "sma_99"),
    "sma_partial": f"""WITH {CANDLES} SELECT time, symbol, timeframe,
{', '.join(r(partial('avg', 'close', n), f'sma_{n}') for n in (7, 25, 99))} FROM candles""",
    "volume_sma24": f"""WITH {CANDLES} SELECT time, symbol, timeframe, {r('volume', 'volume')},
{r(partial('avg', 'volume', 24), 'volume_sma_24')} FROM candles""",
    "ema": f"""WITH RECURSIVE {CANDLES}, {_scan((7, 25, 99))} SELECT time, symbol, timeframe,
{', '.join(r(f'e{s}', f'ema_{s}') for s in (7, 25, 99))} FROM ema""",
    "ema_missing": f"""WITH RECURSIVE {HOLED_CANDLES}, {_scan((7, 25, 99))} SELECT time, symbol, timeframe,
{', '.join(r(f'e{s}', f'ema_{s}') for s in (7, 25, 99))} FROM ema""",
    "ema_orders": f"""WITH RECURSIVE {ORDER_CANDLES}, {_scan((7, 25, 99))} SELECT time, symbol, timeframe,
{', '.join(f'round(e{s} + 3.3e-9, 4) AS ema_{s}' for s in (7, 25, 99))} FROM ema""",
    "rsi": _features(["rsi_14"]),
    "macd": _features(["macd", "macd_signal", "macd_histogram"]),
    "bollinger": _windowed("bb_upper", "bb_middle", "bb_lower", "bb_width"),
    "atr": _features(["atr_14"]),
    "stochastic": _windowed("stoch_k", "stoch_d"),
    "returns": _windowed("returns", "log_returns"),
    "cumulative_returns": _windowed("cumulative_returns"),
    "price_features": _windowed("price_change", "price_change_pct", "daily_range", "daily_range_pct"),
    "volume_features": _windowed("volume_sma_7", "volume_sma_25", "volume_ratio"),
    "vwap": _windowed("vwap"),
    "volatility": _windowed(*[f"{p}volatility_{w}" for p in ("", "price_") for w in (7, 14, 30)]),
    "lags": _windowed(*[f"close_lag_{k}" for k in (1, 3, 6, 12, 24)]),
    "target": f"""WITH {CANDLES} SELECT time, symbol, timeframe, close, lead(close) OVER ({W}) AS target_1
FROM candles""",
    "multi_target": f"""WITH {CANDLES} SELECT time, symbol, timeframe,
{', '.join(f'lead(close, {h}) OVER ({W}) AS target_{h}' for h in (1, 6, 24, 168))} FROM candles""",
    "returns_pct": f"""WITH {CANDLES}, {RETURNS} SELECT time, symbol, timeframe, close, prev_close,
{r('returns_pct', 'returns_pct')} FROM changes""",
    "temporal": f"WITH {CANDLES} SELECT time, symbol, timeframe, {CALENDAR} FROM candles",
    "all_features": f"""WITH RECURSIVE {FEATURES} SELECT time, symbol, timeframe,
{', '.join(r(n, n) for n in FEATURE_NAMES)}, {CALENDAR} FROM features""",
    "features_store": f"WITH RECURSIVE {SAVED} SELECT time, symbol, timeframe, {_saved_doubles} FROM saved s",
    "null_threshold": f"""WITH RECURSIVE {KEPT} SELECT time, symbol, timeframe, {r('sma_7', 'sma_7')},
{r('rsi_14', 'rsi_14')} FROM kept""",
    "dropna_any": f"""WITH {CANDLES}, {RETURNS} SELECT time, symbol, timeframe, prev_close,
{r('returns_pct', 'returns_pct')} FROM changes WHERE returns_pct IS NOT NULL""",
    "feature_coverage": f"""WITH RECURSIVE {SAVED} SELECT symbol, count(*) AS nb_rows, count(sma_7) AS sma_count,
count(rsi_14) AS rsi_count, count(macd) AS macd_count FROM saved GROUP BY symbol""",
    "feature_run_stats": f"""WITH RECURSIVE {SAVED}, a AS (SELECT symbol, timeframe, count(*) AS rows FROM candles GROUP BY 1, 2),
b AS (SELECT symbol, timeframe, count(*) AS features_stored FROM saved GROUP BY 1, 2)
SELECT symbol, timeframe, rows, coalesce(features_stored, 0) AS features_stored FROM a LEFT JOIN b USING (symbol, timeframe)""",
    "feature_overflow": f"""WITH RECURSIVE {KEPT.replace(CANDLES, HUGE_CANDLES)}, judged AS (SELECT symbol, timeframe,
  {' OR '.join(f"({n} IS NOT NULL AND TRY_CAST({n} AS {_stored_type(t)}) IS NULL)" for n, t in FEATURE_STORE_TYPES.items())} AS bad FROM kept),
a AS (SELECT symbol, timeframe, count(*) AS rows FROM candles GROUP BY 1, 2),
b AS (SELECT symbol, timeframe, count(*) FILTER (NOT bad) AS good, count(*) FILTER (bad) AS over FROM judged GROUP BY 1, 2)
SELECT symbol, timeframe, rows, coalesce(good, 0) AS features_stored, coalesce(over, 0) AS features_overflowing
FROM a LEFT JOIN b USING (symbol, timeframe)""",
    "features_join": f"""WITH RECURSIVE {SAVED} SELECT s.time, s.symbol, s.timeframe, c.close, {_saved_doubles}
FROM saved s JOIN candles c ON c.time = s.time AND c.symbol = s.symbol AND c.timeframe = s.timeframe""",
    "check_prices": f"""WITH {DIRTY} SELECT time, symbol, timeframe, open, {r('high', 'high')}, low, close FROM dirty
WHERE NOT (high >= low AND high >= open AND high >= close AND low <= open AND low <= close)""",
    "check_volume": f"WITH {DIRTY} SELECT time, symbol, timeframe, volume FROM dirty WHERE NOT (volume >= 0)",
    "check_not_null": f"""WITH {CANDLES} SELECT time, symbol, timeframe, open, CAST(NULL AS DOUBLE) AS close
FROM candles WHERE hour(time) = 7""",
    "check_unique": f"""WITH {DIRTY} SELECT time, symbol, timeframe, count(*) AS count FROM dirty
GROUP BY time, symbol, timeframe HAVING count(*) > 1""",
    "check_reasons": f"""WITH {DIRTY}, marked AS (
  SELECT time, symbol, timeframe,
    NOT (high >= low AND high >= open AND high >= close AND low <= open AND low <= close) AS p,
    NOT (volume >= 0) AS v FROM dirty)
SELECT time, symbol, timeframe,
  CASE WHEN p AND v THEN 'check_prices,check_volume' WHEN p THEN 'check_prices' ELSE 'check_volume' END AS reasons
FROM marked WHERE p OR v""",
    "check_fk": f"""WITH {CANDLES}, {METADATA} SELECT time, symbol, timeframe, close FROM candles
SEMI JOIN metadata USING (symbol)""",
    "fk_orphans": f"""WITH {CANDLES}, {METADATA} SELECT time, symbol, timeframe, close FROM candles
ANTI JOIN metadata USING (symbol)""",
    "check_enum": f"""WITH {CANDLES}, signals AS (
  SELECT time, symbol, CASE hour(time) % 4 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' WHEN 2 THEN 'HOLD' ELSE 'BAD' END
    AS signal_type, close AS price, 'active' AS status FROM candles)
SELECT * FROM signals WHERE signal_type IN ('BUY', 'SELL', 'HOLD')""",
    "typed_candles": f"""WITH {CANDLES} SELECT time, symbol, open, high, low, close, volume,
CASE WHEN hour(time) = 2 THEN 0.0::DOUBLE ELSE {r('quote_volume')} END AS quote_volume,
CAST(CASE WHEN hour(time) = 4 THEN 0 ELSE trades_count END AS INTEGER) AS trades_count, timeframe FROM candles""",
    "normalize_candles": f"""WITH {CANDLES} SELECT time AS "timestamp", symbol, timeframe, open, high, low, close,
volume FROM candles""",
    "upsert_ignore": f"""WITH {STORED} SELECT time, symbol, timeframe, open, close FROM stored
UNION ALL SELECT time, symbol, timeframe, open, {r('close')} FROM arriving ANTI JOIN stored USING (time, symbol, timeframe)""",
    "upsert_update": f"""WITH {STORED} SELECT time, symbol, timeframe, {r('coalesce(a.open + 1, s.open)', 'open')},
{r('coalesce(a.close, s.close)', 'close')},
CASE WHEN s.close IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS created_at
FROM stored s FULL JOIN arriving a USING (time, symbol, timeframe)""",
    "upsert_touch": f"""WITH {METADATA} SELECT symbol, base_currency, quote_currency, exchange, is_active,
TIMESTAMP '2024-01-01' AS updated_at FROM metadata WHERE symbol <> 'click'
UNION ALL SELECT DISTINCT event_type, upper(event_type), 'EUR', 'binance', false,
CASE WHEN event_type = 'click' THEN TIMESTAMP '2024-03-01' ELSE TIMESTAMP '2024-01-05' END
FROM events WHERE event_type IN ('click', 'error')""",
    "ensure_symbols": """SELECT DISTINCT event_type AS symbol, event_type AS base_currency, 'USDT' AS quote_currency,
'binance' AS exchange, true AS is_active FROM events""",
    "retention": f"""WITH {CANDLES} SELECT time, symbol, timeframe, close FROM candles
WHERE time >= TIMESTAMP '2025-01-15' - INTERVAL 12 MONTH""",
    "cascade_delete": f"WITH {CANDLES} SELECT time, symbol, timeframe, close FROM candles WHERE symbol <> 'view'",
    "training_frame": f"""WITH RECURSIVE {TRAINING} SELECT time, symbol, timeframe, close, {_saved_doubles}, target
FROM training s""",
    "ml_frame": f"""WITH RECURSIVE {FEATURES}, ahead AS (
  SELECT *, lead(close) OVER ({W}) AS target_1 FROM features)
SELECT time, symbol, timeframe, {', '.join(r(n, n) for n in FEATURE_NAMES)}, {CALENDAR}, target_1 FROM ahead
WHERE {' AND '.join(f'{n} IS NOT NULL' for n in FEATURE_NAMES)} AND target_1 IS NOT NULL""",
    "chrono_split": f"WITH {CANDLES}, {_split('candles')} SELECT time, symbol, timeframe, split FROM divided",
    "scale_features": _scaled(),
    "score_predictions": f"""WITH {PREDICTED} SELECT model_name, symbol, prediction_time, target_time,
{r('predicted', 'predicted_price')}, actual AS actual_price, {r('abs(actual - predicted)', 'absolute_error')},
{r('abs(actual - predicted) / nullif(actual, 0) * 100', 'percentage_error')} FROM scored""",
    "eval_metrics": f"WITH {PREDICTED}, {METRICS} SELECT {METRIC_COLUMNS} FROM metrics",
    "directional_accuracy": f"""WITH {PREDICTED}, {MOVES} SELECT model_name, symbol, timeframe,
{r('directional_accuracy', 'directional_accuracy')} FROM directions""",
    "model_ranking": f"""WITH {PREDICTED}, {METRICS} SELECT {METRIC_COLUMNS},
row_number() OVER (PARTITION BY symbol ORDER BY m.rmse, model_name) = 1 AS is_best FROM metrics m""",
    "model_performance": f"""WITH {PREDICTED}, {METRICS}, {MOVES} SELECT model_name, symbol, timeframe,
DATE '2024-02-01' AS evaluation_date, {r('CAST(CAST(rmse AS DECIMAL(20,8)) AS DOUBLE)', 'rmse')},
{r('CAST(CAST(mae AS DECIMAL(20,8)) AS DOUBLE)', 'mae')}, {r('CAST(CAST(mape AS DECIMAL(10,4)) AS DOUBLE)', 'mape')},
{r('CAST(CAST(r2 AS DECIMAL(10,6)) AS DOUBLE)', 'r2_score')},
{r('CAST(CAST(directional_accuracy AS DECIMAL(10,4)) AS DOUBLE)', 'directional_accuracy')},
CAST(samples AS INTEGER) AS test_samples, '1.0' AS model_version, 0::INTEGER AS train_samples
FROM metrics JOIN directions USING (model_name, symbol)""",
    "mape_alerts": f"WITH {PREDICTED}, {METRICS} SELECT {METRIC_COLUMNS} FROM metrics m WHERE m.mape > 200",
    "confidence_band": f"""WITH {PREDICTED}, {METRICS}, banded AS (
  SELECT s.*, CASE WHEN s.model_name = 'last_close' THEN m.rmse * 1.96 ELSE predicted * 0.05 END AS margin
  FROM scored s LEFT JOIN metrics m USING (model_name, symbol))
SELECT model_name, symbol, prediction_time, {r('predicted', 'predicted')},
{r('predicted - margin', 'confidence_lower')}, {r('predicted + margin', 'confidence_upper')} FROM banded""",
    "src_csv_candles": f"""WITH {CANDLES} SELECT time, symbol, open, high, low, close, volume,
{r('quote_volume', 'quote_volume')}, CAST(trades_count AS INTEGER) AS trades_count, timeframe FROM candles""",
    "src_csv_dir": f"""WITH {CANDLES} SELECT time, symbol, open, high, low, close, volume,
CASE WHEN day(time) BETWEEN 11 AND 20 THEN 0.0::DOUBLE ELSE {r('quote_volume')} END AS quote_volume,
CAST(CASE WHEN day(time) BETWEEN 11 AND 20 THEN 0 ELSE trades_count END AS INTEGER) AS trades_count, timeframe
FROM candles""",
    "csv_quarantine": f"""WITH {CANDLES} SELECT 'bad line' AS reason, count(*) AS lines FROM candles WHERE day(time) = 2
UNION ALL SELECT 'missing columns high, low, close, volume', 1::BIGINT""",
    "sink_csv": f"""WITH {CANDLES} SELECT * REPLACE ({r('volume')} AS volume, {r('quote_volume')} AS quote_volume),
replace(symbol, '/', '_') AS symbol_safe, timeframe AS frame FROM candles""",
    "sink_by_day": f"""WITH {CANDLES} SELECT time, symbol, timeframe, close, {r('volume', 'volume')}, CAST(time AS DATE) AS day
FROM candles""",
    "sink_by_week": f"""WITH {PREDICTED} SELECT model_name, symbol, prediction_time, {r('predicted', 'predicted_price')},
CAST(prediction_time AS DATE) - CAST((CAST(prediction_time AS DATE) - DATE '1970-01-01') % 7 AS INTEGER) AS day
FROM predictions""",
    "stream_ingest": f"WITH {DIRTY} SELECT DISTINCT time, symbol, timeframe, close FROM dirty",
    "stream_fk": f"""WITH {CANDLES}, {METADATA} SELECT time, symbol, timeframe, close FROM candles
SEMI JOIN metadata USING (symbol)""",
}

# Same content through a file or a stream: the SQL of the batch twin.
ORACLES["sink_report"] = ORACLES["collection_report"]
ORACLES["sink_summary"] = ORACLES["summary"]
ORACLES["stream_latest"] = ORACLES["latest_prices"]
ORACLES["stream_ema"] = f"""WITH RECURSIVE {FEATURES} SELECT time, symbol, timeframe, close,
{', '.join(r(n, n) for n in ('ema_7', 'ema_25', 'ema_99', 'rsi_14', 'macd', 'macd_signal', 'macd_histogram'))}
FROM features"""
ORACLES["stream_ema_batches"] = ORACLES["stream_ema"]
ORACLES["stream_daily"] = f"""WITH {CANDLES} SELECT date_trunc('day', time)::TIMESTAMP AS day, symbol, timeframe,
{DAY_COLUMNS}, count(*) AS candles_count FROM candles GROUP BY 1, 2, 3"""
ORACLES["stream_upsert"] = f"""WITH {STORED} SELECT time, symbol, timeframe, coalesce(a.open, s.open) AS open,
{r('coalesce(a.close, s.close)', 'close')} FROM stored s FULL JOIN arriving a USING (time, symbol, timeframe)"""

_FITTED = f"""WITH RECURSIVE {TRAINING}, {_split('training')}"""


def _model(name, *facts):
    return f"""{_FITTED} SELECT '{name}' AS model_name, symbol, timeframe, time, split, {r('target', 'actual')}, true AS finite,
{', '.join(f'true AS {f}' for f in facts)} FROM divided"""


for _query, _name in (("lr_predict", "linear"), ("ridge_predict", "linear_ridge"), ("lasso_predict", "linear_lasso")):
    ORACLES[_query] = _model(_name, "residuals_sum_to_zero", "optimal")
ORACLES["rf_predict"] = _model("random_forest", "better_than_mean", "within_range")
ORACLES["gbt_predict"] = _model("xgboost", "better_than_mean")
ORACLES["feature_importance"] = f"""SELECT unnest([{', '.join(f"'{n}'" for n in STORED_FEATURES)}]) AS feature,
true AS sums_to_one, true AS descending, true AS top_is_prefix"""
ORACLES["model_comparison"] = f"""{_FITTED} SELECT unnest(['linear', 'linear_ridge', 'linear_lasso', 'random_forest', 'xgboost', 'lightgbm']) AS model_name,
'val' AS split, n AS samples, true AS best_is_first FROM (SELECT count(*) AS n FROM divided WHERE split = 'val')"""
ORACLES["model_roundtrip"] = f"""{_FITTED} SELECT 'linear' AS model_name, time, symbol, timeframe, split, {r('target', 'actual')}, true AS same
FROM divided"""

ORACLES["upsert_stored"] = ORACLES["upsert_update"]
ORACLES["retention_stored"] = ORACLES["retention"]
ORACLES["cascade_stored"] = ORACLES["cascade_delete"]
ORACLES["daily_refresh"] = ORACLES["daily_stats"]
ORACLES["asof_many"] = f"""WITH {CANDLES}, asked AS (
  SELECT symbol, '1h' AS timeframe, unnest([t, t - INTERVAL 90 MINUTE]) AS at, id AS request FROM ticks)
SELECT a.symbol, a.timeframe, a.at, request, {r('c.close', 'close_then')}, c.time AS close_time
FROM asked a ASOF LEFT JOIN candles c ON a.symbol = c.symbol AND a.at >= c.time"""
ORACLES["stream_daily_late"] = f"""WITH {CANDLES}, days AS (SELECT date_trunc('day', time)::TIMESTAMP AS day, symbol, timeframe,
{DAY_COLUMNS}, count(*) AS candles_count FROM candles GROUP BY 1, 2, 3)
SELECT * REPLACE ({", ".join(f"CASE WHEN day >= TIMESTAMP '2024-01-08' THEN {c} END AS {c}" for c in ("day_open", "day_high", "day_low", "day_close", "day_volume", "candles_count"))}),
CASE WHEN day < TIMESTAMP '2024-01-08' THEN candles_count END AS late_count FROM days"""


def _ridge_predictions(alpha=1.0):
    """The closed form: Gram matrix of the centred training rows, Gauss-Jordan elimination one column a step."""
    k = len(STORED_FEATURES)
    centred = [f"(x[{i}] - mx[{i}])" for i in range(1, k + 1)] + ["(y - my)"]
    gram = ", ".join(
        "[" + ", ".join(f"sum({centred[i]} * {centred[j]})" + (f" + {alpha}" if i == j else "") for j in range(k + 1)) + "]" for i in range(k))
    return f"""{_FITTED},
{MOMENTS},
vectors AS (SELECT symbol, timeframe, time, split, target::DOUBLE AS y, [{", ".join(map(_standardized, STORED_FEATURES))}] AS x FROM divided JOIN moments USING (symbol, timeframe)),
center AS (SELECT [{", ".join(f"avg(x[{i}])" for i in range(1, k + 1))}] AS mx, avg(y) AS my FROM vectors WHERE split = 'train'),
solving AS (
  SELECT 0 AS step, (SELECT [{gram}] FROM vectors, center WHERE split = 'train')::DOUBLE[][] AS m
  UNION ALL
  SELECT step + 1, list_transform(range(1, {k + 1}), lambda i: CASE WHEN i = step + 1 THEN lead_row
    ELSE list_transform(range(1, {k + 2}), lambda j: m[i][j] - m[i][step + 1] * lead_row[j]) END)
  FROM (SELECT step, m, list_transform(m[step + 1], lambda v: v / m[step + 1][step + 1]) AS lead_row FROM solving WHERE step < {k})),
solved AS (SELECT list_transform(m, lambda row: row[{k + 1}]) AS b FROM solving WHERE step = {k})
SELECT 'linear_ridge' AS model_name, symbol, timeframe, time, split, {r('y', 'actual')},
{r(f"my + list_sum(list_transform(range(1, {k + 1}), lambda j: (x[j] - mx[j]) * b[j]))", 'predicted')} FROM vectors, center, solved"""


ORACLES["ridge_predictions"] = _ridge_predictions()
