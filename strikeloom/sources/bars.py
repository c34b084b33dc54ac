"""Daily bars from landed service replies, one JSON object per line."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom.schema import BAR_REPLY_SCHEMA


def read_bar_replies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BAR_REPLY_SCHEMA).json(path)


def normalise_bars(replies: DataFrame) -> DataFrame:
    """One row per bar; replies without results contribute none."""
    return replies.select("ticker", F.inline("results")).select(
        F.col("t").cast("string").alias("timestamp"),
        F.col("ticker").alias("symbol"),
        F.col("c").cast("double").alias("close"),
        F.col("v").cast("double").alias("volume"),
    )


def bars_between(bars: DataFrame, symbol: str, start: str, end: str) -> DataFrame:
    """Bars of one symbol from ``start`` to ``end``, both ISO dates and both included (UTC days)."""
    millis = F.col("timestamp").cast("bigint")

    def midnight(day: str):
        return F.unix_date(F.lit(day).cast("date")).cast("bigint") * 86_400_000

    return bars.where(
        (F.col("symbol") == symbol)
        & (millis >= midnight(start))
        & (millis < midnight(end) + 86_400_000)
    )


def bars_for_requests(
    bars: DataFrame, requests: DataFrame, bucket_days: int = 64, request: str = "request_id"
) -> DataFrame:
    """Bars of many requests at once: rows (``request``, all bar columns).

    ``requests`` has ``request``, symbol, start_date and end_date (UTC days, both included); a NULL
    date leaves that side open. A bar lies in one bucket of ``bucket_days`` days and a request in
    all that it meets, so both join on (symbol, bucket) and what the border buckets hold too much
    is left out after that. A symbol with many bars or requests is spread over its buckets.
    Requests are first cut to the days that bars exist for, so each becomes a bounded number of rows.

    Overlapping and repeated requests each get their bars. A NULL symbol, a start after its end
    and requests without bars give no rows; so do bars whose time is no number.
    """
    day = F.floor(F.expr("try_cast(timestamp AS bigint)") / 86_400_000).cast("int")
    dated = bars.withColumn("_day", day).where("_day IS NOT NULL")
    span = dated.agg(F.min("_day").alias("first"), F.max("_day").alias("last"))
    first, last = (span.select(name).scalar() for name in ("first", "last"))

    wanted = requests.select(
        F.col(request),
        F.col("symbol").alias("_symbol"),
        F.greatest(F.unix_date(F.col("start_date").cast("date")), first).alias("_from"),
        F.least(F.unix_date(F.col("end_date").cast("date")), last).alias("_to"),
    ).where("_from <= _to")

    def bucket(number: Column) -> Column:
        return F.floor(number / bucket_days).cast("int")

    met = F.explode(F.sequence(bucket(F.col("_from")), bucket(F.col("_to"))))
    spread = wanted.withColumn("_bucket", met)
    joined = dated.withColumn("_of", bucket(F.col("_day"))).join(
        spread, (F.col("symbol") == F.col("_symbol")) & (F.col("_of") == F.col("_bucket"))
    )
    return joined.where("_day BETWEEN _from AND _to").select(request, *bars.columns)
