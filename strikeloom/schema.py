"""Column layouts of the three table layers and of daily bars."""

from pyspark.sql import types as T

# Column names, order and types of a one-minute quote file.
QUOTE_SCHEMA = T.StructType(
    [
        T.StructField("ts_recv", T.TimestampType()),
        T.StructField("ts_event", T.TimestampType()),
        T.StructField("rtype", T.IntegerType()),
        T.StructField("publisher_id", T.IntegerType()),
        T.StructField("instrument_id", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("flags", T.IntegerType()),
        T.StructField("bid_px_00", T.DoubleType()),
        T.StructField("ask_px_00", T.DoubleType()),
        T.StructField("bid_sz_00", T.IntegerType()),
        T.StructField("ask_sz_00", T.IntegerType()),
        T.StructField("bid_pb_00", T.IntegerType()),
        T.StructField("ask_pb_00", T.IntegerType()),
        T.StructField("symbol", T.StringType()),
    ]
)

# Column that carries the text of a line that does not fit the layout while files are loaded.
REJECTED = "rejected_text"

# The reply shape of the daily-bars service and the layout bars are kept in.
BAR_REPLY_SCHEMA = "ticker string, results array<struct<t: bigint, c: double, v: double>>"
BAR_COLUMNS = ("timestamp", "symbol", "close", "volume")

# Silver puts these first, then the untouched quote columns, then SILVER_TAIL.
SILVER_HEAD = ("symbol", "underlying", "trade_date", "expiry_date", "option_type", "strike_price")
SILVER_TAIL = ("mid_price", "file_name")

# The chain a contract belongs to, and the gold layouts of the two strategies.
CHAIN_KEY = ("underlying", "trade_date", "expiry_date")
THRESHOLD_COLUMNS = (
    "symbol",
    "trade_date",
    "expiry_date",
    "strike_price",
    "mid_price",
    "option_type",
    "signal",
    "strategy_name",
    "underlying",
)
CONDOR_COLUMNS = (
    "underlying",
    "trade_date",
    "expiration",
    "strike_short_call",
    "price_short_call",
    "strike_long_call",
    "price_long_call",
    "strike_short_put",
    "price_short_put",
    "strike_long_put",
    "price_long_put",
    "net_credit",
    "strategy_name",
)

# Columns strategies receive as double whatever their stored type is.
DOUBLE_COLUMNS = (
    "strike_price",
    "mid_price",
    "price",
    "bid_px_00",
    "ask_px_00",
    "bid_pb_00",
    "ask_pb_00",
)

# Option root to the fund it is traded against.
UNDERLYINGS = {
    "SPX": "SPY",
    "SPXW": "SPY",
    "NDX": "QQQ",
    "NDXP": "QQQ",
    "RUT": "IWM",
    "RUTW": "IWM",
    "DJX": "DIA",
    "VIX": "VXX",
}

# Columns that tell where stored rows belong: the file a row came from, and the part of a date in
# silver that holds it. A part is one file's rows, or rows of several files once they are merged.
SOURCE = "source"
PART = "part"
MERGED = "merged"

# Table names of the two loaded layers. The rejects are lines kept out of both.
BRONZE = "bronze_options_chain"
REJECTS = "bronze_rejects"
SILVER = "enriched_options_silver"
JOURNAL = "load_journal"
STATISTICS = "layer_statistics"
