"""Table schemas, store types and fixed column lists."""

from pyspark.sql import types as T

SERIES = ("symbol", "timeframe")
CANDLE_KEY = ("time", "symbol", "timeframe")

PRICE = T.DecimalType(20, 8)
VOLUME = T.DecimalType(30, 8)


def _table(*fields):
    return T.StructType([T.StructField(*f) for f in fields])


METADATA = _table(
    ("symbol", T.StringType(), False),
    ("name", T.StringType(), True),
    ("base_currency", T.StringType(), False),
    ("quote_currency", T.StringType(), False),
    ("exchange", T.StringType(), True),
    ("is_active", T.BooleanType(), True),
    ("created_at", T.TimestampNTZType(), True),
    ("updated_at", T.TimestampNTZType(), True),
)

CANDLES = _table(
    ("time", T.TimestampType(), False),
    ("symbol", T.StringType(), False),
    ("timeframe", T.StringType(), False),
    ("open", PRICE, False),
    ("high", PRICE, False),
    ("low", PRICE, False),
    ("close", PRICE, False),
    ("volume", VOLUME, False),
    ("quote_volume", VOLUME, True),
    ("trades_count", T.IntegerType(), True),
    ("created_at", T.TimestampType(), True),
)

# The columns of a candle CSV.
CANDLE_FILE = _table(
    ("timestamp", T.TimestampType(), True),
    ("open", T.DoubleType(), True),
    ("high", T.DoubleType(), True),
    ("low", T.DoubleType(), True),
    ("close", T.DoubleType(), True),
    ("volume", T.DoubleType(), True),
    ("symbol", T.StringType(), True),
    ("quote_volume", T.DoubleType(), True),
    ("trades_count", T.IntegerType(), True),
)
REQUIRED_FILE_COLUMNS = ("timestamp", "open", "high", "low", "close", "volume", "symbol")

# Store type of each column of the features table, in table order.
FEATURE_STORE_TYPES = {
    **{f"{kind}_{n}": PRICE for kind in ("sma", "ema") for n in (7, 25, 99)},
    "rsi_14": T.DecimalType(10, 4),
    "macd": PRICE,
    "macd_signal": PRICE,
    "macd_histogram": PRICE,
    "bb_upper": PRICE,
    "bb_middle": PRICE,
    "bb_lower": PRICE,
    "bb_width": PRICE,
    "returns": T.DecimalType(15, 8),
    "log_returns": T.DecimalType(15, 8),
    "volatility_24h": T.DecimalType(15, 8),
    "volume_sma_7": VOLUME,
    "volume_ratio": T.DecimalType(10, 4),
}
STORED_FEATURES = tuple(FEATURE_STORE_TYPES)

FEATURES = T.StructType(
    [
        T.StructField("time", T.TimestampType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("timeframe", T.StringType(), False),
    ]
    + [T.StructField(n, t, True) for n, t in FEATURE_STORE_TYPES.items()]
    + [T.StructField("created_at", T.TimestampType(), True)]
)

# model_name belongs to the key: two models may predict the same instant.
PREDICTION_KEY = ("symbol", "timeframe", "target_time", "prediction_time", "model_name")
PREDICTIONS = _table(
    ("prediction_time", T.TimestampType(), False),
    ("target_time", T.TimestampType(), False),
    ("symbol", T.StringType(), False),
    ("timeframe", T.StringType(), False),
    ("predicted_price", PRICE, False),
    ("actual_price", PRICE, True),
    ("model_name", T.StringType(), False),
    ("model_version", T.StringType(), True),
    ("horizon_hours", T.IntegerType(), False),
    ("confidence_lower", PRICE, True),
    ("confidence_upper", PRICE, True),
    ("absolute_error", PRICE, True),
    ("percentage_error", T.DecimalType(10, 4), True),
    ("created_at", T.TimestampType(), True),
)

MODEL_PERFORMANCE = _table(
    ("model_name", T.StringType(), False),
    ("model_version", T.StringType(), True),
    ("symbol", T.StringType(), True),
    ("timeframe", T.StringType(), True),
    ("evaluation_date", T.DateType(), False),
    ("rmse", PRICE, True),
    ("mae", PRICE, True),
    ("mape", T.DecimalType(10, 4), True),
    ("r2_score", T.DecimalType(10, 6), True),
    ("directional_accuracy", T.DecimalType(10, 4), True),
    ("train_samples", T.IntegerType(), True),
    ("test_samples", T.IntegerType(), True),
)

SIGNALS = _table(
    ("time", T.TimestampType(), False),
    ("symbol", T.StringType(), False),
    ("signal_type", T.StringType(), False),
    ("price", PRICE, False),
    ("confidence", T.DecimalType(5, 4), True),
    ("model_name", T.StringType(), True),
    ("stop_loss", PRICE, True),
    ("take_profit", PRICE, True),
    ("status", T.StringType(), True),
    ("created_at", T.TimestampType(), True),
    ("updated_at", T.TimestampType(), True),
)

# Allowed enumeration entries and the symbols a new metadata table starts with.
SIGNAL_TYPES = ("BUY", "SELL", "HOLD")
SIGNAL_STATUSES = ("active", "executed", "cancelled", "expired")
SEED_SYMBOLS = (
    ("BTC/USDT", "Bitcoin"),
    ("ETH/USDT", "Ethereum"),
    ("BNB/USDT", "Binance Coin"),
    ("SOL/USDT", "Solana"),
    ("ADA/USDT", "Cardano"),
    ("XRP/USDT", "Ripple"),
    ("DOT/USDT", "Polkadot"),
    ("AVAX/USDT", "Avalanche"),
    ("MATIC/USDT", "Polygon"),
    ("LINK/USDT", "Chainlink"),
)
