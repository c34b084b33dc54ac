"""Lay quotes out as vendor-style CSV files, for checks of the file sources."""

from pyspark.sql import DataFrame

from strikeloom.schema import QUOTE_SCHEMA
from strikeloom.sinks.dealing import dealt


def land_quotes(quotes: DataFrame, folder: str) -> str:
    """Write one CSV file per ``file_name`` and return the folder.

    Spark writes the data, splitting a date with too many rows for one task over several files; the
    driver only renames the results, since Spark chooses its own file names. Every name keeps its date.
    """
    spark = quotes.sparkSession
    parts, landing = f"{folder}/parts", f"{folder}/landing"
    rows = quotes.select(*QUOTE_SCHEMA.fieldNames(), "file_name")
    by_file = dealt(rows, rows, "file_name")
    if by_file is None:
        by_file = rows.hint("rebalance", "file_name")
    (
        by_file.write.partitionBy("file_name")
        .option("header", True)
        .option("timeZone", "UTC")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSSS'Z'")
        .csv(parts)
    )
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(landing))
    for number, status in enumerate(files.globStatus(path(f"{parts}/file_name=*/part-*.csv"))):
        source = status.getPath()
        name = source.getParent().getName().split("=", 1)[1]
        target = path(f"{landing}/{name}")
        if files.exists(target):
            target = path(f"{landing}/{name.removesuffix('.csv')}.{number}.csv")
        if not files.rename(source, target):
            raise OSError(f"could not rename {source} to {target}")
    return landing
