"""The bronze, silver and gold tables of one database."""

import json
from collections.abc import Callable, Iterable, Mapping
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strikeloom.functions import origin, osi
from strikeloom.schema import BRONZE, MERGED, PART, REJECTED, REJECTS, SILVER, SILVER_HEAD, SILVER_TAIL, SOURCE
from strikeloom.sinks.catalog import (
    drop_partitions,
    partition_keys,
    set_table_properties,
    table_properties,
)
from strikeloom.sinks.dealing import dealt
from strikeloom.sinks.journal import FileKey
from strikeloom.sinks.partitioned import replace_partitions, replace_table

Enrichment = Callable[[DataFrame], DataFrame]

# Bronze has a partition per landed file, silver one per part of a date: a file's rows, or those of
# several files once they are merged. Silver keeps each row's source as a column of its own.
BRONZE_KEY = ("trade_date", SOURCE)
SILVER_KEY = ("trade_date", PART)
BY_DATE = ("trade_date",)
# Rows of one contract lie together in the data files.
BRONZE_ORDER = ("symbol", "ts_recv")
SILVER_ORDER = ("underlying", "expiry_date", "option_type", "strike_price", "ts_recv")
# So many files are named in a table that every task gets: a few megabytes.
FILES_TO_BROADCAST = 20_000


def bronze_table(database: str) -> str:
    return f"{database}.{BRONZE}"


def rejects_table(database: str) -> str:
    return f"{database}.{REJECTS}"


def silver_table(database: str) -> str:
    return f"{database}.{SILVER}"


def gold_table(database: str, strategy: str) -> str:
    return f"{database}.gold_{strategy.lower()}"


def read_silver(spark: SparkSession, table: str) -> DataFrame:
    """Stored silver rows in their documented column order."""
    stored = spark.table(table)
    apart = (*SILVER_HEAD, *SILVER_TAIL, SOURCE, PART)
    return stored.select(*SILVER_HEAD, *[name for name in stored.columns if name not in apart], *SILVER_TAIL)


def _with_origin(quotes: DataFrame, uris: list[str], file_named: bool) -> DataFrame:
    """Add ``trade_date`` and ``source``, the partition of bronze that rows belong to.

    Both are the same for all rows of a file. Where rows are named after the files they are read
    from (``file_named``) they come from a table of the files instead of being made for every row. A
    long list of files, or none as in a stream's batch, and names that came with the rows are dealt
    with per row.
    """
    uri = F.input_file_name()
    if not file_named or not 0 < len(uris) <= FILES_TO_BROADCAST:
        named = F.col("file_name")
        return quotes.withColumns({"trade_date": osi.trade_date(named), SOURCE: origin.source(named, uri)})
    days, sources = zip(*map(file_key, uris))
    if len(uris) == 1:
        return quotes.withColumns({"trade_date": F.lit(days[0]).cast("date"), SOURCE: F.lit(sources[0])})
    listed = pa.table({"_uri": uris, "_day": pa.array(days, pa.string()), SOURCE: sources})
    files = quotes.sparkSession.createDataFrame(listed)
    files = files.select("_uri", F.col("_day").cast("date").alias("trade_date"), SOURCE)
    return quotes.withColumn("_uri", uri).join(F.broadcast(files), "_uri").drop("_uri")


def file_key(uri: str) -> FileKey:
    """The partition of bronze that a file named after itself goes to."""
    return osi.trade_date_of(origin.file_name_of(uri)), origin.source_of(uri)


def _number_rejected(quotes: DataFrame) -> Column:
    """Metric that a write learns on its way: how many lines could not be read."""
    return (F.count(REJECTED) if REJECTED in quotes.columns else F.count(F.lit(None))).alias("rejected")


def _rejected(quotes: DataFrame, uris: list[str]) -> DataFrame:
    """File and text of the lines that could not be read.

    The metric keeps all columns in the scan: a line is judged by those that are asked for.
    """
    lines = quotes.where(F.col(REJECTED).isNotNull())
    judged = lines.observe(Observation(), F.max(F.hash(*quotes.columns)).alias("judged"))
    return _with_origin(judged, uris, True).select("file_name", REJECTED, *BRONZE_KEY)


def _stored_rows(quotes: DataFrame, uris: list[str], seen: Observation) -> DataFrame:
    """The rows to store. Scans that keep unreadable lines apart name their rows after the files.

    A task of such a scan has as many rows as fit its share of the text. Others read Parquet, which
    may hold any number of rows in as many bytes, so these are dealt to tasks by their number.
    """
    scanned = REJECTED in quotes.columns
    rows = quotes.observe(seen, _number_rejected(quotes))
    if scanned:
        return _with_origin(rows.where(F.col(REJECTED).isNull()).drop(REJECTED), uris, scanned)
    rows = _with_origin(rows, uris, scanned)
    by_file = dealt(rows, _with_origin(quotes, uris, scanned), *BRONZE_KEY)
    return rows if by_file is None else by_file


def replace_bronze(quotes: DataFrame, table: str, rejects: str) -> int:
    """All landed files at once. Each split of text belongs to one file, so no text is shuffled.

    Lines that cannot be read go to ``rejects``, by a second scan only if there are any; returns
    how many there are.
    """
    spark, seen, uris = quotes.sparkSession, Observation(), quotes.inputFiles()
    replace_table(_stored_rows(quotes, uris, seen), table, BRONZE_KEY, BRONZE_ORDER)
    if seen.get["rejected"]:
        replace_table(_rejected(quotes, uris), rejects, BRONZE_KEY)
        return spark.table(rejects).count()
    if spark.catalog.tableExists(rejects):
        drop_partitions(spark, rejects, BRONZE_KEY, partition_keys(spark, rejects))
    return 0


def _replace_rejects(
    quotes: DataFrame, uris: list[str], rejects: str, any_rejected: bool, replaced: set[FileKey]
) -> int:
    """Store the rejected lines of loaded files and drop those of earlier versions; their number."""
    spark = quotes.sparkSession
    written, number = set(), 0
    if any_rejected:
        seen = Observation()
        lines = _rejected(quotes, uris).observe(seen, F.count(F.lit(1)).alias("lines"))
        written = replace_partitions(lines, rejects, BRONZE_KEY)
        number = seen.get["lines"]
    if spark.catalog.tableExists(rejects):
        drop_partitions(spark, rejects, BRONZE_KEY, replaced - written)
    return number


def versions_of(spark: SparkSession, table: str, files: set[FileKey]) -> set[FileKey]:
    """Stored files that have the name of one of ``files``, whatever folder they came from."""
    if not spark.catalog.tableExists(table):
        return set()
    names = {origin.file_name_in(source) for _, source in files}
    stored = partition_keys(spark, table, "trade_date", {day for day, _ in files})
    return {key for key in stored if origin.file_name_in(key[1]) in names}


def replace_bronze_files(
    quotes: DataFrame, table: str, rejects: str, new_versions: bool = False
) -> tuple[set[FileKey], int]:
    """Add files or replace those loaded before from the same place.

    Returns the files whose rows changed and the number of lines that could not be read and went
    to ``rejects``.

    A file is known by its name and folder: one of the same name from another folder is kept beside
    it, unless ``new_versions`` says that it replaces every other one of that name. A file that has
    no rows any more also loses the rows of its earlier version.
    """
    spark, seen, uris = quotes.sparkSession, Observation(), quotes.inputFiles()
    rows = _stored_rows(quotes, uris, seen)
    written = replace_partitions(rows, table, BRONZE_KEY, BRONZE_ORDER)
    landed = set(map(file_key, uris))
    if not written <= landed:
        landed = written  # names come with the rows, so those of the data files mean nothing
    changed = landed | versions_of(spark, table, landed) if new_versions else landed
    drop_partitions(spark, table, BRONZE_KEY, changed - written)
    return changed, _replace_rejects(quotes, uris, rejects, seen.get["rejected"] > 0, changed)


def rebuild_silver(
    spark: SparkSession, bronze: str, silver: str, enrichment: Enrichment, regroup: bool = False
) -> None:
    """Silver from all of bronze.

    Bronze partitions hold one file, hence one trade date each, so a task meets few dates and
    writes few files; rows are shuffled only where they are too many for a task. ``regroup`` gathers
    the rows of a date into one part first: worth its shuffle where files landed small and many. A
    large date is still split over several tasks.
    """
    stored = spark.table(bronze)
    replace_table(_in_parts(enrichment(stored), stored, regroup), silver, SILVER_KEY, SILVER_ORDER)


def _in_parts(rows: DataFrame, stored: DataFrame, regroup: bool) -> DataFrame:
    """Silver rows with their part, dealt to tasks; ``stored`` has the bronze rows they come from."""
    if regroup:
        rows, by = rows.withColumn(PART, F.lit(MERGED)), BY_DATE
    else:
        rows, by = rows.withColumn(PART, F.col(SOURCE)), BRONZE_KEY
    by_part = dealt(rows, stored, *by)
    if by_part is None:
        return rows.hint("rebalance", "trade_date") if regroup else rows
    return by_part


def on_partition(column: str, values: set[str | None]) -> Column:
    """A condition on a partition column alone, so that the catalog prunes by it."""
    known = [value for value in values if value is not None]
    typed = [F.lit(value).cast("date") for value in known] if column == "trade_date" else known
    condition = F.col(column).isin(typed)
    return condition | F.col(column).isNull() if len(known) < len(set(values)) else condition


def files_of(rows: DataFrame, files: set[FileKey]) -> DataFrame:
    """Rows of ``files``: plain conditions on the columns that bronze is partitioned by."""
    return rows.where(on_partition("trade_date", {day for day, _ in files}) & on_partition(SOURCE, {s for _, s in files}))


def refresh_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    enrichment: Enrichment,
    files: set[FileKey],
    regroup: bool = False,
) -> None:
    """Make silver hold what bronze holds of ``files``, other files' rows left as they are.

    Only these files are read, and each replaces its own part of its date. Where a date has merged
    parts, the files' rows are first taken out of them. ``regroup`` merges the dates' files instead
    and so reads all of them. What is left without rows is dropped.
    """
    dates = {day for day, _ in files}
    if not files:
        return
    stored = set(partition_keys(spark, silver, "trade_date", dates)) if spark.catalog.tableExists(silver) else set()
    if regroup:
        kept = spark.table(bronze).where(on_partition("trade_date", dates))
        written = replace_partitions(_in_parts(enrichment(kept), kept, True), silver, SILVER_KEY, SILVER_ORDER)
        drop_partitions(spark, silver, SILVER_KEY, stored - written)
        return
    _take_out(spark, silver, {day for day, part in stored if part == MERGED}, files)
    kept = files_of(spark.table(bronze), files)
    written = replace_partitions(_in_parts(enrichment(kept), kept, False), silver, SILVER_KEY, SILVER_ORDER)
    drop_partitions(spark, silver, SILVER_KEY, (stored & files) - written)


def _take_out(spark: SparkSession, silver: str, dates: set[str | None], files: set[FileKey]) -> None:
    """Rewrite the merged parts that hold rows of ``files`` without them."""
    if not dates:
        return
    sources = [source for _, source in files]
    merged = spark.table(silver).where((F.col(PART) == MERGED) & on_partition("trade_date", dates))
    holding = merged.where(F.col(SOURCE).isin(sources)).select(F.col("trade_date").cast("string"))
    touched = {day for (day,) in holding.distinct().collect()}
    if touched:
        rest = merged.where(on_partition("trade_date", touched) & ~F.col(SOURCE).isin(sources))
        written = replace_partitions(rest, silver, SILVER_KEY, SILVER_ORDER)
        drop_partitions(spark, silver, SILVER_KEY, {(day, MERGED) for day in touched} - written)


def rules_of(policies: Iterable[str], underlyings: Mapping[str, str]) -> dict[str, str]:
    """How silver rows are made, as table properties."""
    mapping = json.dumps(sorted(underlyings.items()))
    return {
        "strikeloom.policies": ",".join(sorted(set(policies))),
        "strikeloom.underlyings": sha256(mapping.encode()).hexdigest(),
    }


def require_same_rules(spark: SparkSession, silver: str, rules: Mapping[str, str]) -> None:
    """Refuse to add rows made by other rules than the stored ones; a bootstrap may change them."""
    if not spark.catalog.tableExists(silver):
        return
    stored = table_properties(spark, silver)
    differing = [key for key, value in rules.items() if stored.get(key, value) != value]
    if differing:
        raise ValueError(
            f"{silver} was made with other {' and '.join(differing)}; bootstrap it to change them"
        )


def keep_rules(spark: SparkSession, silver: str, rules: Mapping[str, str]) -> None:
    if rules.items() - table_properties(spark, silver).items():
        set_table_properties(spark, silver, rules)


def replace_gold(signals: DataFrame, table: str) -> None:
    replace_table(signals, table, BY_DATE)
