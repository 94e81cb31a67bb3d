"""Technical indicators and price, volume and lag columns for every series at once.

Each ``*_step`` describes the columns and the reach of one indicator; the plain
functions run one step on a frame of candles. Several steps share one layout
(:func:`tidemark.operators.series.run`).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeframes import calendar_columns, calendar_sql
from tidemark.operators.series import (
    RUNNING,
    Step,
    ema,
    ema_reach,
    over_block,
    rolling,
    run,
    trailing,
    twice_averaged,
)


def _previous(column: str, rows: int = 1) -> str:
    return f"lag({column}, {rows}) {over_block()}"


def _change(value: str, before: str) -> str:
    """Relative change, NULL without a previous value or after a zero."""
    return f"try_divide({value}, {before}) - 1"


def sma_step(column="close", periods=(7, 25, 99)) -> Step:
    means = {f"sma_{p}": p for p in periods}
    return Step(tuple(means), rolling(column, means), behind=max(periods) - 1)


def known(column: str) -> str:
    """The column with missing values (NULL or NaN) replaced by the last known one of the series."""
    return f"_known_{column}"


def ema_step(column="close", periods=(7, 25, 99)) -> Step:
    """A missing value counts as the last known one; NULL before the first."""
    layers = ema({f"ema_{p}": (known(column), p) for p in periods}, started=known(column))
    return Step(
        tuple(layers[-1]), ({}, *layers), behind=max(ema_reach(p) for p in periods), carries={known(column): column}
    )


def relative_strength(gain: str, loss: str) -> str:
    return (
        f"CASE WHEN {loss} = 0 AND {gain} > 0 THEN 100D WHEN {loss} = 0 THEN NULL "
        f"ELSE 100 - 100 / (1 + try_divide({gain}, {loss})) END"
    )


def moves(delta: str, gain: str, loss: str) -> dict:
    """Gains and losses of a change, both 0 where there is none."""
    return {
        gain: f"CASE WHEN {delta} > 0 THEN {delta} ELSE 0D END",
        loss: f"CASE WHEN {delta} < 0 THEN -{delta} ELSE 0D END",
    }


# Rows of a flat stretch for which ``rsi_step`` holds its last value unless told to hold it without end.
RSI_HOLD = 4000


def held_rsi(now: str, delta: str, hold: int) -> str:
    """The last ratio, for at most ``hold`` rows after the last move; NULL then, until the next move."""
    since = f"_pos - last(CASE WHEN {delta} <> 0 THEN _pos END, true) {over_block(RUNNING)}"
    return f"CASE WHEN {since} <= {hold} THEN last({now}, true) {over_block(RUNNING)} END"


def moved_rsi(up: str, down: str, delta: str) -> str:
    """The ratio in rows that move, NULL in others."""
    return f"CASE WHEN {delta} <> 0 THEN {relative_strength(up, down)} END"


def rsi_step(column="close", period=14, hold: int | None = RSI_HOLD) -> Step:
    """100 - 100/(1 + gain/loss) with exponential averages of gains and losses.

    NULL until the first move, 100 without any loss. A flat stretch shrinks both
    averages alike and leaves their ratio as it was; it is held for ``hold`` rows, with None until the next move.
    """
    name = f"rsi_{period}"
    delta, gain, loss, up, down, now = (
        f"_{n}_{name}" for n in ("delta", "gain", "loss", "up", "down", "now")
    )
    averages = ema({up: (gain, period), down: (loss, period)})
    layers = (
        {delta: f"{known(column)} - {_previous(known(column))}"},
        {**moves(delta, gain, loss), **averages[0]},
        *averages[1:],
    )
    if hold is None:
        # Copied rows must reach back from a move only; the value of the last move is carried over blocks.
        return Step(
            (name,),
            (*layers, {now: moved_rsi(up, down, delta)}),
            behind=ema_reach(period) + 1,
            carries={known(column): column},
            holds={name: (now, None)},
        )
    return Step(
        (name,),
        (*layers, {now: relative_strength(up, down)}, {name: held_rsi(now, delta, hold)}),
        behind=hold + ema_reach(period) + 1,
        carries={known(column): column},
    )


def macd_step(column="close", fast=12, slow=26, signal=9) -> Step:
    """Fast minus slow average, its own average (the signal) and their difference.

    The signal follows from averages of the input, so it needs no second scan.
    """
    spans = sorted({fast, slow, signal})
    averages = ema({f"_macd_ema_{s}": (known(column), s) for s in spans}, started=known(column))
    line = {"macd": f"_macd_ema_{fast} - _macd_ema_{slow}"}

    def averaged(span):
        return twice_averaged(f"_macd_ema_{span}", f"_macd_ema_{signal}", span, signal)

    if signal in (fast, slow):
        layers = (*averages, line, *ema({"macd_signal": ("macd", signal)}))
    else:
        layers = (*averages, {**line, "macd_signal": f"{averaged(fast)} - {averaged(slow)}"})
    return Step(
        ("macd", "macd_signal", "macd_histogram"),
        ({}, *layers, {"macd_histogram": "macd - macd_signal"}),
        behind=2 * max(ema_reach(s) for s in spans),
        carries={known(column): column},
    )


def bollinger_step(column="close", period=20, std=2.0) -> Step:
    windows = rolling(column, {"bb_middle": period}, {"_bb_dev": period})
    return Step(
        ("bb_upper", "bb_middle", "bb_lower", "bb_width"),
        (
            *windows,
            {
                "bb_upper": f"bb_middle + _bb_dev * {float(std)!r}D",
                "bb_lower": f"bb_middle - _bb_dev * {float(std)!r}D",
            },
            {"bb_width": "bb_upper - bb_lower"},
        ),
        behind=period - 1,
    )


def atr_step(period=14) -> Step:
    averages = ema({f"atr_{period}": ("_true_range", period)}, started=known("close"))
    true_range = f"greatest({known('high')} - {known('low')}, abs({known('high')} - _atr_before), abs({known('low')} - _atr_before))"
    return Step(
        (f"atr_{period}",),
        (
            {"_atr_before": _previous(known("close"))},
            {"_true_range": true_range, **averages[0]},
            *averages[1:],
        ),
        behind=ema_reach(period) + 1,
        carries={known(c): c for c in ("high", "low", "close")},
    )


def stochastic_step(period=14, smooth=3) -> Step:
    lows = rolling("low", extremes={"_stoch_low": ("min", period)})
    highs = rolling("high", extremes={"_stoch_high": ("max", period)})
    return Step(
        ("stoch_k", "stoch_d"),
        (
            *[{**a, **b} for a, b in zip(lows, highs)],
            {"stoch_k": "100 * try_divide(close - _stoch_low, _stoch_high - _stoch_low)"},
            *rolling("stoch_k", {"stoch_d": smooth}),
        ),
        behind=period + smooth - 2,
    )


def returns_step() -> Step:
    return Step(
        ("returns", "log_returns"),
        (
            {"_return_ratio": f"try_divide(close, {_previous('close')})"},
            {
                "returns": "_return_ratio - 1",
                "log_returns": "CASE WHEN _return_ratio > 0 THEN ln(_return_ratio) END",
            },
        ),
        behind=1,
    )


def cumulative_returns_step() -> Step:
    """Product of (1 + return) since the first row, minus 1: the close over the first close, minus 1."""
    value = f"CASE WHEN _pos > 0 THEN {_change('close', '_first_close')} END"
    return Step(
        ("cumulative_returns",),
        ({"cumulative_returns": value},),
        firsts={"_first_close": F.col("close")},
    )


# Row expressions on one candle.
SHAPE = {
    "price_change": "close - open",
    "price_change_pct": "try_divide(close - open, open) * 100",
    "daily_range": "high - low",
    "daily_range_pct": "try_divide(high - low, low) * 100",
}


def candle_shape_step() -> Step:
    return Step(tuple(SHAPE), (SHAPE,))


def volume_step(short=7, long=25) -> Step:
    names = (f"volume_sma_{short}", f"volume_sma_{long}", "volume_ratio", "vwap")
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    parts, merged, means = rolling("volume", {names[0]: short, names[1]: long})
    return Step(
        names,
        (
            parts,
            merged,
            {**means, "vwap": "try_divide(_traded, _volume)"},
            {"volume_ratio": f"try_divide(volume, {names[1]})"},
        ),
        behind=max(short, long) - 1,
        totals={
            "_traded": F.col("volume") * typical,
            "_volume": F.col("volume").cast("double"),
        },
    )


def volatility_step(windows=(7, 14, 30)) -> Step:
    """Sample deviation of returns and of closes over trailing windows."""
    of_returns = {f"volatility_{w}": w for w in windows}
    of_prices = {f"price_volatility_{w}": w for w in windows}
    prices = rolling("close", deviations=of_prices)
    returns = rolling("_vol_return", deviations=of_returns)
    return Step(
        (*of_returns, *of_prices),
        (
            {"_vol_before": _previous("close"), **prices[0]},
            {"_vol_return": _change("close", "_vol_before"), **prices[1]},
            {**prices[2], **returns[0]},
            *returns[1:],
        ),
        behind=max(windows),
    )


def calendar_step(time="time") -> Step:
    parts = calendar_sql(time)
    return Step(tuple(parts), (parts,))


def lag_step(column="close", lags=(1, 3, 6, 12, 24)) -> Step:
    layer = {f"{column}_lag_{k}": _previous(column, k) for k in lags}
    return Step(tuple(layer), (layer,), behind=max(lags))


def target_step(column="close", horizons=(1,)) -> Step:
    """The value ``h`` rows later, as ``target_h``."""
    layer = {f"target_{h}": f"lead({column}, {h}) {over_block()}" for h in horizons}
    return Step(tuple(layer), (layer,), ahead=max(horizons))


def partial_mean_step(column, windows: dict) -> Step:
    """Trailing means that start with fewer rows at the head, as ``{name: rows}``."""
    layer = {n: f"avg({column}) {over_block(trailing(w))}" for n, w in windows.items()}
    return Step(tuple(layer), (layer,), behind=max(windows.values()) - 1)


def returns_pct_step() -> Step:
    return Step(
        ("prev_close", "returns_pct"),
        (
            {"prev_close": _previous("close")},
            {"returns_pct": "try_divide(close - prev_close, prev_close) * 100"},
        ),
        behind=1,
    )


def sma(df: DataFrame, column="close", periods=(7, 25, 99), **layout) -> DataFrame:
    return run(df, [sma_step(column, periods)], **layout)


def exponential_average(df: DataFrame, column="close", periods=(7, 25, 99), **layout) -> DataFrame:
    return run(df, [ema_step(column, periods)], **layout)


def rsi(df: DataFrame, column="close", period=14, hold=None, **layout) -> DataFrame:
    return run(df, [rsi_step(column, period, hold)], **layout)


def macd(df: DataFrame, column="close", fast=12, slow=26, signal=9, **layout) -> DataFrame:
    return run(df, [macd_step(column, fast, slow, signal)], **layout)


def bollinger(df: DataFrame, column="close", period=20, std=2.0, **layout) -> DataFrame:
    return run(df, [bollinger_step(column, period, std)], **layout)


def atr(df: DataFrame, period=14, **layout) -> DataFrame:
    return run(df, [atr_step(period)], **layout)


def stochastic(df: DataFrame, period=14, smooth=3, **layout) -> DataFrame:
    return run(df, [stochastic_step(period, smooth)], **layout)


def price_features(df: DataFrame, **layout) -> DataFrame:
    return run(df, [returns_step(), cumulative_returns_step(), candle_shape_step()], **layout)


def volume_features(df: DataFrame, **layout) -> DataFrame:
    return run(df, [volume_step()], **layout)


def volatility_features(df: DataFrame, windows=(7, 14, 30), **layout) -> DataFrame:
    return run(df, [volatility_step(windows)], **layout)


def temporal_features(df: DataFrame, time="time") -> DataFrame:
    return df.withColumns(calendar_columns(time))


def candle_shape(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.expr(e) for n, e in SHAPE.items()})


def lag_features(df: DataFrame, column="close", lags=(1, 3, 6, 12, 24), **layout) -> DataFrame:
    return run(df, [lag_step(column, lags)], **layout)


def target(df: DataFrame, column="close", horizons=(1,), **layout) -> DataFrame:
    return run(df, [target_step(column, horizons)], **layout)


def returns_pct(df: DataFrame, **layout) -> DataFrame:
    return run(df, [returns_pct_step()], **layout)


def partial_means(df: DataFrame, column, windows: dict, **layout) -> DataFrame:
    return run(df, [partial_mean_step(column, windows)], **layout)

