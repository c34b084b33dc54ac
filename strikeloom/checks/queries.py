"""The registered queries: each runs one operator or job on quotes derived from ``lineitem``.

Decimals are given as double and instants as epoch seconds, so that engines can be compared.
"""

from collections.abc import Callable
from contextlib import suppress
from functools import partial, wraps

import pandas as pd
from pyspark.errors import SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strikeloom import jobs
from strikeloom.checks.landing import land_quotes
from strikeloom.checks.lineitem_quotes import bar_replies_from_lineitem, quotes_from_lineitem
from strikeloom.checks.scratch import scratch_database, scratch_folder
from strikeloom.functions import osi
from strikeloom.operators import chains, lookback, policies, reports
from strikeloom.operators.enrich import enrich, underlying_of, with_underlying_from
from strikeloom.operators import profiles as sketches
from strikeloom.plans import condor, custom, tables, threshold
from strikeloom.plans.registry import STRATEGIES, Strategy
from strikeloom.schema import (
    CHAIN_KEY,
    CONDOR_COLUMNS,
    MERGED,
    PART,
    QUOTE_SCHEMA,
    REJECTED,
    UNDERLYINGS,
)
from strikeloom.sinks import bars as stored_daily
from strikeloom.sinks import clustering, journal, maintenance, profiles, statistics
from strikeloom.sinks.layers import (
    SILVER_ORDER,
    bronze_table,
    gold_table,
    read_silver,
    rejects_table,
    replace_gold,
    rules_of,
    silver_table,
)
from strikeloom.sinks.shared import stored
from strikeloom.sources import bars, files
from strikeloom.streaming.intake import absorb, run_intake

# Quote columns compared as they are.
PASSED = tuple(
    name for name in QUOTE_SCHEMA.fieldNames() if name not in ("ts_recv", "ts_event", "symbol")
)


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_from_lineitem(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return enrich(quotes(spark, sf_dir), policies=policies.named(names))


# --- shared scratch data ---------------------------------------------------------------------


def once(build: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    """Keep where ``build`` stored its data, per application and input folder."""
    made: dict[tuple[str, str], str] = {}

    @wraps(build)
    def stored(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in made:
            made[key] = build(spark, sf_dir)
        return made[key]

    return stored


@once
def landed(spark: SparkSession, sf_dir: str) -> str:
    """Folder of quote CSV files."""
    return land_quotes(quotes(spark, sf_dir), scratch_folder(spark))


@once
def loaded(spark: SparkSession, sf_dir: str) -> str:
    """Database bootstrapped from those files."""
    database = scratch_database(spark)
    jobs.load(spark, landed(spark, sf_dir), database, bootstrap=True)
    return database


@once
def grown(spark: SparkSession, sf_dir: str) -> str:
    """Database with half the files bootstrapped and the other half added after that."""
    database = scratch_database(spark)
    paths = landed_files(spark, sf_dir)
    half = len(paths) // 2
    jobs.load(spark, paths[:half], database, bootstrap=True)
    jobs.load(spark, paths[half:], database)
    return database


def landed_files(spark: SparkSession, sf_dir: str) -> list[str]:
    return sorted(files.read_quote_csv(spark, landed(spark, sf_dir)).inputFiles())


# --- comparable outputs ----------------------------------------------------------------------


def untouched() -> list[Column]:
    """The quote columns that silver passes through, and what names the file."""
    return [
        F.unix_seconds("ts_recv").alias("ts_recv_epoch"),
        F.unix_seconds("ts_event").alias("ts_event_epoch"),
        *map(F.col, PASSED),
        F.substring_index("file_name", ".", 1).alias("file_stem"),
    ]


def quote_rows(frame: DataFrame) -> DataFrame:
    """Every quote, all columns, without the part of the file name a split date may vary in."""
    return frame.select(
        *untouched(), "symbol", osi.trade_date(F.col("file_name")).alias("trade_date")
    )


def silver_rows(frame: DataFrame) -> DataFrame:
    return frame.select(
        "symbol",
        "underlying",
        "trade_date",
        "expiry_date",
        "option_type",
        F.col("strike_price").cast("double").alias("strike_price"),
        *untouched(),
        F.col("mid_price").cast("double").alias("mid_price"),
    )


def contract_rows(frame: DataFrame) -> DataFrame:
    """What policies and windows are compared on."""
    return frame.select(
        "symbol",
        "underlying",
        "trade_date",
        "expiry_date",
        "bid_px_00",
        "ask_px_00",
        F.col("mid_price").cast("double").alias("mid_price"),
    )


# --- scans, sources, sinks -------------------------------------------------------------------


def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_rows(files.read_quote_csv(spark, landed(spark, sf_dir)))


def src_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes landed with an unreadable bid where seven lots are bid: stored rows and rejects."""
    database = scratch_database(spark)
    bid = F.when(F.col("bid_sz_00") == 7, "oops").otherwise(F.col("bid_px_00").cast("string"))
    broken = quotes(spark, sf_dir).withColumn("bid_px_00", bid)
    jobs.load(spark, land_quotes(broken, scratch_folder(spark)), database, bootstrap=True)
    stored = quote_rows(spark.table(bronze_table(database))).withColumn("rejected", F.lit(False))
    fields = F.split(REJECTED, ",")
    lines = spark.table(rejects_table(database)).select(
        F.get(fields, F.lit(QUOTE_SCHEMA.names.index("instrument_id"))).alias("instrument_id"),
        F.get(fields, F.lit(QUOTE_SCHEMA.names.index("symbol"))).alias("symbol"),
        osi.trade_date(F.col("file_name")).alias("trade_date"),
        F.lit(True).alias("rejected"),
    )
    return stored.unionByName(lines, allowMissingColumns=True)


def src_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = files.read_quote_csv(spark, landed(spark, sf_dir))
    named = read.select(F.substring_index("file_name", ".", 1).alias("file_stem"), "symbol")
    return named.groupBy("file_stem").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("symbol").alias("first_symbol")
    )


def src_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    quotes(spark, sf_dir).write.parquet(folder)
    return quote_rows(files.read_quote_parquet(spark, folder))


def stored_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    bar_replies_from_lineitem(spark, sf_dir).write.json(folder)
    return bars.normalise_bars(bars.read_bar_replies(spark, folder))


def bars_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.bars_between(stored_bars(spark, sf_dir), "O:S3", "1995-01-01", "1996-12-31")


def bars_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars loaded as a job: half of the symbols with prices that later replies correct, then all, twice."""
    database, early, late = scratch_database(spark), scratch_folder(spark), scratch_folder(spark)
    replies = bar_replies_from_lineitem(spark, sf_dir)
    wrong = F.transform("results", lambda bar: bar.withField("c", F.lit(0.5)))
    replies.where("ticker < 'O:S5'").withColumn("results", wrong).write.json(early)
    replies.write.json(late)
    for folder in (early, late, late):
        jobs.load_bars(spark, folder, database)
    return stored_daily.stored_bars(spark, database)


def bars_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two requests of every supplier, one of them for a symbol that all ask for; some are open or reversed."""
    number = F.col("s_suppkey").cast("int")
    start = F.date_add(F.lit("1992-01-01").cast("date"), number * 37 % 2000)
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    own = suppliers.select(
        F.concat(F.lit("own"), number).alias("request_id"),
        F.concat(F.lit("O:S"), number).alias("symbol"),
        F.when(number % 7 != 0, start).alias("start_date"),
        F.when(number % 5 != 0, F.date_add(start, number * 53 % 400 - 20)).alias("end_date"),
    )
    hot = suppliers.select(
        F.concat(F.lit("hot"), number).alias("request_id"),
        F.lit("O:S3").alias("symbol"),
        start.alias("start_date"),
        F.date_add(start, 365).alias("end_date"),
    )
    return bars.bars_for_requests(stored_bars(spark, sf_dir), own.unionByName(hot))


def bronze_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_rows(spark.table(bronze_table(loaded(spark, sf_dir))))


def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_rows(spark.table(bronze_table(grown(spark, sf_dir))))


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_rows(read_silver(spark, silver_table(grown(spark, sf_dir))))


def reprocess_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a database, load all of its files again, and read all rows back."""
    database = scratch_database(spark)
    jobs.load(spark, landed(spark, sf_dir), database, bootstrap=True)
    jobs.load(spark, landed(spark, sf_dir), database)
    return silver_rows(read_silver(spark, silver_table(database)))


def calls_and_others(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two parts that together are all quotes."""
    call = F.coalesce(osi.option_type(F.col("symbol")) == "CALL", F.lit(False))
    return frame.where(call), frame.where(~call)


def same_name_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each date landed as two files of one name in two folders; both loaded, then one again."""
    database = scratch_database(spark)
    parts = calls_and_others(quotes(spark, sf_dir))
    folders = [land_quotes(part, scratch_folder(spark)) for part in parts]
    jobs.load(spark, folders, database, bootstrap=True)
    jobs.load(spark, folders[1], database)
    return silver_rows(read_silver(spark, silver_table(database)))


def parquet_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the quotes loaded from CSV, the others from Parquet with its columns reversed."""
    database, folder = scratch_database(spark), scratch_folder(spark)
    calls, others = calls_and_others(quotes(spark, sf_dir))
    jobs.load(spark, land_quotes(calls, scratch_folder(spark)), database, bootstrap=True)
    others.select(*reversed(others.columns)).write.parquet(folder)
    jobs.load(spark, folder, database, raw_format="parquet", regroup=True)
    return silver_rows(read_silver(spark, silver_table(database)))


def bootstrap_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database of half the quotes bootstrapped again with all of them, grouped by date."""
    database = scratch_database(spark)
    calls, _ = calls_and_others(quotes(spark, sf_dir))
    jobs.load(spark, land_quotes(calls, scratch_folder(spark)), database, bootstrap=True)
    jobs.load(spark, landed(spark, sf_dir), database, bootstrap=True, regroup=True)
    return silver_rows(read_silver(spark, silver_table(database)))


def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = scratch_database(spark)
    run_intake(spark, landed(spark, sf_dir), database, scratch_folder(spark))
    return silver_rows(read_silver(spark, silver_table(database)))


@once
def many_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of quote CSV files, eight or more for each trade date."""
    minute = F.hour("ts_recv") * 60 + F.minute("ts_recv")
    split = F.regexp_replace("file_name", ".csv$", "")
    name = F.concat(split, F.lit(".part"), (minute % 8).cast("string"), F.lit(".csv"))
    return land_quotes(quotes(spark, sf_dir).withColumn("file_name", name), scratch_folder(spark))


def stream_many_files_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many files of each date dealt over the stream's batches; each batch adds its own files' rows."""
    database = scratch_database(spark)
    run_intake(spark, many_files(spark, sf_dir), database, scratch_folder(spark), files_per_batch=64)
    return silver_rows(read_silver(spark, silver_table(database)))


def _policy_that_fails(frame: DataFrame) -> DataFrame:
    return frame.where(F.assert_true(F.col("symbol").isNull()).isNull())


def load_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that broke off between the layers, completed by loading another file."""
    database = scratch_database(spark)
    paths = landed_files(spark, sf_dir)
    jobs.load(spark, paths[:-2], database, bootstrap=True)
    breaking = partial(enrich, policies=[_policy_that_fails])
    with suppress(SparkRuntimeException):
        absorb(files.scan_quote_csv(spark, paths[-2]), database, breaking, rules_of((), UNDERLYINGS))
    if not journal.broken_off(spark, database)[0]:
        raise RuntimeError("the load was to break off")
    jobs.load(spark, paths[-1], database)
    return silver_rows(read_silver(spark, silver_table(database)))


@once
def counted(spark: SparkSession, sf_dir: str) -> str:
    """Database whose statistics are kept through a late file, a reprocess and a merging load."""
    database = scratch_database(spark)
    paths = landed_files(spark, sf_dir)
    jobs.load(spark, paths[:-2], database, bootstrap=True)
    statistics.keep(spark, database)
    jobs.load(spark, paths[-1], database)
    jobs.load(spark, paths[:2], database)
    jobs.load(spark, paths[-2], database, regroup=True)
    return database


def coverage_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.coverage(spark, counted(spark, sf_dir))


def layer_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept digests of both layers, after a look that they are those of the stored rows."""
    database = counted(spark, sf_dir)
    for found in (statistics.changed_since(spark, database), statistics.unreconciled(spark, database)):
        if not found.isEmpty():
            raise RuntimeError(f"layers that are not what was loaded: {found.take(5)}")
    kept = statistics.layer_digests(spark, database)
    return kept.withColumns({name: F.col(name).cast("string") for name in ("hash_sum", "other_sum")})


def strategies_shared_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All strategies and a failing one on one scan of silver: outcome and stored rows of each."""
    database = loaded(spark, sf_dir)
    registry = {**STRATEGIES, "FailingStrategy": Strategy(threshold.INPUT, _failing)}
    outcome = jobs.run_strategies(spark, database, list(registry), registry, shared_scan=True)
    succeeded = [name for name, ok in outcome.items() if ok]
    outcomes = spark.createDataFrame(list(outcome.items()), "layer string, succeeded boolean")
    return outcomes.join(jobs.gold_counts(spark, database, succeeded), "layer", "left")


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = loaded(spark, sf_dir)
    table = gold_table(database, "roundtrip")
    replace_gold(condor.iron_condors(spark.table(silver_table(database))), table)
    return spark.table(table).select(*CONDOR_COLUMNS)


def materialized_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = loaded(spark, sf_dir)
    target = f"{database}.cheap_spy_calls"
    criteria = "underlying = 'SPY' AND option_type = 'CALL' AND mid_price < 5"
    maintenance.materialize_slice(spark, silver_table(database), target, criteria)
    return contract_rows(spark.table(target))


def clustered_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice stored along the curve in many small files, and what one strike range of it holds."""
    database = loaded(spark, sf_dir)
    target = f"{database}.wide_clustered"
    clustering.clustered_slice(
        spark, silver_table(database), target, "mid_price >= 5", target_bytes=64 * 1024
    )
    return contract_rows(spark.table(target).where("strike_price BETWEEN 110 AND 125"))


def compact_preserves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store silver in several files a date, merge them, and read all rows back."""
    table = f"{scratch_database(spark)}.fragmented"
    for part in calls_and_others(silver(spark, sf_dir)):
        part.write.mode("append").partitionBy("trade_date").saveAsTable(table)
    maintenance.compact(spark, table, "trade_date", SILVER_ORDER)
    return silver_rows(spark.table(table))


def compact_stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many files a date merged in stored silver, one of them loaded again after that."""
    database, folder = scratch_database(spark), many_files(spark, sf_dir)
    jobs.load(spark, folder, database, bootstrap=True)
    silver_of = silver_table(database)
    merged = maintenance.compact(spark, silver_of, "trade_date", SILVER_ORDER, same={PART: MERGED})
    if not merged or maintenance.compact(spark, silver_of, "trade_date", SILVER_ORDER, same={PART: MERGED}):
        raise RuntimeError("every date was to be merged once")
    again = sorted(files.read_quote_csv(spark, folder).inputFiles())[:3]
    jobs.load(spark, again, database)
    return silver_rows(read_silver(spark, silver_of))


def ddl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a table, insert the quotes per date, check that it is listed, and drop another."""
    database = scratch_database(spark)
    ddl = "(trade_date DATE, row_count BIGINT) USING parquet"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.coverage {ddl}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.unwanted {ddl}")
    coverage = reports.date_coverage(silver(spark, sf_dir))
    spark.sql(f"INSERT INTO {database}.coverage SELECT * FROM {{rows}}", rows=coverage)
    spark.sql(f"DROP TABLE IF EXISTS {database}.unwanted")
    # Any database's list also has the session's temporary views, such as those of strategies.
    if [table.name for table in spark.catalog.listTables(database) if not table.isTemporary] != ["coverage"]:
        raise RuntimeError("the catalog does not list exactly the table that was kept")
    return spark.table(f"{database}.coverage")


# --- projections and filters -----------------------------------------------------------------


def silver_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_rows(silver(spark, sf_dir))


def osi_decompose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes(spark, sf_dir).select(
        "symbol",
        osi.root(F.col("symbol")).alias("root"),
        osi.expiry_date(F.col("symbol")).alias("expiry_date"),
        osi.option_type(F.col("symbol")).alias("option_type"),
        osi.strike_price(F.col("symbol")).cast("double").alias("strike_price"),
    )


def trade_date_from_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    trade_date = osi.trade_date(F.col("file_name")).alias("trade_date")
    dated = quotes(spark, sf_dir).select("file_name", trade_date)
    return dated.groupBy("file_name", "trade_date").agg(F.count(F.lit(1)).alias("row_count"))


def mid_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    mid = osi.mid_price(F.col("bid_px_00"), F.col("ask_px_00")).cast("double")
    return quotes(spark, sf_dir).select("bid_px_00", "ask_px_00", mid.alias("mid_price"))


def underlying_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes(spark, sf_dir).select(
        "symbol", underlying_of(osi.root(F.col("symbol"))).alias("underlying")
    )


def underlying_map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = spark.createDataFrame(list(UNDERLYINGS.items()), "root string, underlying string")
    joined = with_underlying_from(quotes(spark, sf_dir).select("symbol"), dimension)
    return joined.select("symbol", "underlying")


def strategy_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.as_doubles(silver(spark, sf_dir).select(*condor.INPUT))


def filter_zero_dte(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_rows(silver(spark, sf_dir, "zero_dte"))


def filter_liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_rows(silver(spark, sf_dir, "liquidity"))


def filter_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_rows(silver(spark, sf_dir, "zero_dte", "liquidity"))


def lookback_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_rows(lookback.lookback(silver(spark, sf_dir), 3))


def lookback_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_rows(lookback.lookback(silver(spark, sf_dir), 30))


# --- strategies ------------------------------------------------------------------------------


def threshold_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold.threshold_signals(lookback.lookback(silver(spark, sf_dir), 3))


def threshold_signals_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = lookback.lookback(silver(spark, sf_dir), 3)
    return threshold.threshold_signals(window, "QQQ", only_underlying=True)


def condor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.as_doubles(chains.strike_prices(silver(spark, sf_dir)))


def condor_strike_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = chains.rank_strikes(chains.strike_prices(silver(spark, sf_dir)))
    return chains.as_doubles(ranked)


def condor_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return condor.condor_legs(silver(spark, sf_dir))


def condor_valid_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.valid_chains(silver(spark, sf_dir))


def condor_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    strikes = chains.strike_prices(silver(spark, sf_dir))
    return chains.as_doubles(chains.rows_of_valid_chains(strikes))


def iron_condor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return condor.iron_condors(lookback.lookback(silver(spark, sf_dir), 30))


def iron_condor_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return condor.iron_condors(silver(spark, sf_dir))


def iron_condor_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return condor.iron_condors_by_joins(silver(spark, sf_dir))


def _strike_span(chain: pd.DataFrame) -> pd.DataFrame:
    """A user's strategy in pandas: how wide a chain is and how many strikes it lists."""
    span = chain[list(CHAIN_KEY)].head(1)
    return span.assign(
        strikes=len(chain), width=chain["strike_price"].max() - chain["strike_price"].min()
    )


SPAN_SCHEMA = (
    "underlying string, trade_date date, expiry_date date, strikes bigint, width double"
)


def custom_strategy_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return custom.per_chain(_strike_span, SPAN_SCHEMA)(silver(spark, sf_dir))


def _quoted_range(chain: pd.DataFrame) -> pd.DataFrame:
    """A user's strategy on columns of its own: what was bid and asked over a chain's strikes."""
    return chain[list(CHAIN_KEY)].head(1).assign(
        lowest_bid=chain["low_bid"].min(),
        highest_ask=chain["high_ask"].max(),
        closing_bids=chain["last_bid"].sum(),
        asked=int(chain["asked"].sum()),
    )


RANGE_SCHEMA = (
    "underlying string, trade_date date, expiry_date date, lowest_bid double, "
    "highest_ask double, closing_bids double, asked bigint"
)
RANGE_COLUMNS = {
    "low_bid": ("bid_px_00", "min"),
    "high_ask": ("ask_px_00", "max"),
    "last_bid": ("bid_px_00", "last"),
    "asked": ("ask_sz_00", "sum"),
}


def custom_strategy_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered and run like the other strategies, then read from its gold table."""
    database = loaded(spark, sf_dir)
    strategy = Strategy(
        columns=(*condor.INPUT, "ts_recv", "bid_px_00", "ask_px_00", "ask_sz_00"),
        signals=custom.per_chain(_quoted_range, RANGE_SCHEMA, RANGE_COLUMNS),
        lookback_days=30,
    )
    jobs.run_strategies(spark, database, ["QuotedRange"], {"QuotedRange": strategy})
    return spark.table(gold_table(database, "QuotedRange"))


def _spread(batch: pd.DataFrame) -> pd.DataFrame:
    wide = batch["ask_px_00"] - batch["bid_px_00"] > 1
    return batch[["symbol", "trade_date"]].assign(wide=wide)


def custom_strategy_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = silver(spark, sf_dir).select("symbol", "trade_date", "bid_px_00", "ask_px_00")
    return custom.per_batch(_spread, "symbol string, trade_date date, wide boolean")(frame)


def _failing(_: DataFrame) -> DataFrame:
    raise RuntimeError("a strategy that fails on purpose")


def strategies_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All strategies and a failing one side by side: outcome and stored rows of each."""
    database = loaded(spark, sf_dir)
    registry = {**STRATEGIES, "FailingStrategy": Strategy(threshold.INPUT, _failing)}
    outcome = jobs.run_strategies(spark, database, list(registry), registry)
    succeeded = [name for name, ok in outcome.items() if ok]
    outcomes = spark.createDataFrame(list(outcome.items()), "layer string, succeeded boolean")
    return outcomes.join(jobs.gold_counts(spark, database, succeeded), "layer", "left")


def strategy_from_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Condors asked for in SQL, by view and by table function with the dates dealt between them."""
    tables.register_strategies(spark, spark.table(silver_table(loaded(spark, sf_dir))))
    return spark.sql(
        """
        SELECT * FROM IronCondorStrategy WHERE trade_date < DATE'2025-01-20'
        UNION ALL
        SELECT * FROM IronCondorStrategy_between(DATE'2025-01-20', DATE'2025-12-31')
        """
    )


def strategy_chain_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pandas function of one chain as a SQL table function, partitioned by chain."""
    tables.register_strategies(spark, spark.table(silver_table(loaded(spark, sf_dir))))
    tables.register_chain_function(spark, "strike_span", _strike_span, SPAN_SCHEMA)
    return spark.sql(tables.by_chain("strike_span"))


# --- reports ---------------------------------------------------------------------------------


def max_trade_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookback.max_trade_date(silver(spark, sf_dir))


def newest_stored_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anchor as the strategy job finds it, with the rows the stored table has on that date."""
    table = silver_table(loaded(spark, sf_dir))
    newest = lookback.newest_stored_date(spark, table)
    stored = spark.table(table).where(F.col("trade_date") == newest)
    return reports.date_coverage(stored)


def option_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.option_type_counts(silver(spark, sf_dir))


def distinct_underlying(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distinct_underlyings(silver(spark, sf_dir))


def signal_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.signal_distribution(threshold_signals(spark, sf_dir))


def date_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.date_coverage(silver(spark, sf_dir))


def latest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_dates(silver(spark, sf_dir))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each stored layer, the liquid rows of silver among them."""
    database = loaded(spark, sf_dir)
    stored = spark.table(silver_table(database))
    return reports.layer_counts(
        {
            "bronze": spark.table(bronze_table(database)),
            "silver": stored,
            "silver_liquid": policies.liquidity(stored),
        }
    )


def range_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = quotes(spark, sf_dir).withColumn("ts_recv_epoch", F.unix_seconds("ts_recv"))
    return reports.range_profile(stored, ["ts_recv_epoch", "bid_px_00", "ask_px_00", "price"])


def range_profile_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile kept by date, some dates anew, merged over a month: exact where it is, within its error elsewhere."""
    database, first, last = loaded(spark, sf_dir), "2025-01-05", "2025-02-03"
    profiles.keep_profile(spark, database)
    profiles.keep_profile(spark, database, ["2025-01-06", "2025-01-07"])
    one = stored(profiles.profile(spark, database, first, last))
    rows = spark.table(silver_table(database)).where(F.col("trade_date").between(first, last))

    columns = ["row_count", "bid_px_00_count", "price_count", "bid_px_00_min", "ask_px_00_max"]
    found = [one.select(name).scalar().alias(name) for name in columns]
    total = F.count(F.lit(1))
    for name in ("bid_px_00", "ask_px_00", "mid_price"):
        value = F.col(name).cast("double")
        for share in (0.25, 0.5, 0.95):
            at = one.select(sketches.quantile(name, share)).scalar()
            # The wanted rank lies within 2 % of the ranks that the estimated value takes.
            below, upto = F.count_if(value < at) / total, F.count_if(value <= at) / total
            found.append(((below <= share + 0.02) & (upto >= share - 0.02)).alias(f"{name}_q{int(share * 100)}_near"))
    symbols = one.select(sketches.distinct_count("symbol")).scalar()
    exact = F.count_distinct("symbol")
    found.append((F.abs(symbols - exact) <= exact * 0.08).alias("symbols_near"))
    most = one.select(F.get(sketches.most_frequent("option_type", 1), F.lit(0))).scalar()
    found += [most["item"].alias("top_type"), most["count"].alias("top_type_count")]
    found.append(one.select(sketches.quantile("price", 0.5)).scalar().isNull().alias("price_unknown"))
    return rows.agg(*found)


def gold_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = condor.iron_condors(silver(spark, sf_dir))
    return reports.head(gold, ["trade_date", "underlying", "expiration"])


QUERIES = {
    query.__name__: query
    for query in (
        iron_condor,
        iron_condor_all,
        iron_condor_joins,
        silver_enriched,
        osi_decompose,
        trade_date_from_file,
        mid_price,
        underlying_map,
        underlying_map_join,
        strategy_projection,
        filter_zero_dte,
        filter_liquidity,
        filter_chain,
        lookback_3d,
        lookback_30d,
        max_trade_date,
        newest_stored_date,
        threshold_signals,
        threshold_signals_own,
        condor_dedup,
        condor_strike_rank,
        condor_legs,
        condor_valid_groups,
        condor_valid_rows,
        custom_strategy_pandas,
        custom_strategy_batches,
        custom_strategy_columns,
        strategies_run,
        strategy_from_sql,
        strategy_chain_function,
        option_type_counts,
        distinct_underlying,
        signal_distribution,
        date_coverage,
        latest_dates,
        layer_counts,
        range_profile,
        range_profile_sketched,
        gold_head,
        src_csv,
        src_csv_rejects,
        src_file_name,
        src_parquet,
        bars_range,
        bars_loaded,
        bars_requests,
        bronze_bootstrap,
        bronze_incremental,
        silver_incremental,
        reprocess_idempotent,
        same_name_files,
        parquet_reordered,
        bootstrap_twice,
        stream_intake,
        stream_many_files_per_date,
        load_resumed,
        coverage_maintained,
        layer_digests,
        strategies_shared_scan,
        gold_roundtrip,
        materialized_slice,
        clustered_slice,
        compact_preserves_rows,
        compact_stored_silver,
        ddl_roundtrip,
    )
} | {"bars_normalised": stored_bars}
