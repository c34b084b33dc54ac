"""Small hand-made inputs."""

from datetime import date

from pyspark.sql import types as T

from strikeloom.schema import QUOTE_SCHEMA

HEADER = ",".join(QUOTE_SCHEMA.fieldNames())


def bronze(spark, rows):
    """Rows of (symbol, bid, ask, file name) with all other quote columns empty."""
    names = QUOTE_SCHEMA.fieldNames()
    full = [
        tuple({"symbol": s, "bid_px_00": b, "ask_px_00": a}.get(name) for name in names) + (f,)
        for s, b, a, f in rows
    ]
    schema = T.StructType([*QUOTE_SCHEMA, T.StructField("file_name", T.StringType())])
    return spark.createDataFrame(full, schema)


def silver(spark, rows):
    """Rows of (underlying, trade date, expiry, type, strike, mid)."""
    return spark.createDataFrame(
        rows,
        "underlying string, trade_date date, expiry_date date, option_type string, "
        "strike_price decimal(15,7), mid_price decimal(15,6)",
    )


def csv_line(symbol, bid="1.0", ask="1.2", instant="2025-01-28T14:31:00.000000000Z"):
    return f"{instant},,193,30,1258322251,N,,0,200,{bid},{ask},10,10,0,0,{symbol}"


def write_csv(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def day(text):
    return date.fromisoformat(text)
