"""Bronze quotes to silver rows: symbol parts, trade date, underlying and mid price."""

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikeloom.functions import osi
from strikeloom.schema import SILVER_HEAD, SILVER_TAIL, UNDERLYINGS

Policy = Callable[[DataFrame], DataFrame]


def underlying_of(root: Column, underlyings: Mapping[str, str] = UNDERLYINGS) -> Column:
    """Mapped underlying, or the root itself where it is not mapped."""
    if not underlyings:
        return root
    lookup = F.create_map(*[F.lit(text) for text in chain(*underlyings.items())])
    return F.coalesce(lookup[root], root)


def with_underlying_from(quotes: DataFrame, dimension: DataFrame) -> DataFrame:
    """Add ``underlying`` by joining a table of ``root, underlying``, for long mappings.

    Every quote is kept exactly once: the dimension is made unique per root first. No broadcast is
    forced; Spark broadcasts the dimension when its measured size allows and otherwise shuffles,
    where adaptive execution splits the partitions of frequent roots.
    """
    unique = dimension.groupBy(F.col("root").alias("_root")).agg(
        F.min("underlying").alias("_mapped")
    )
    keyed = quotes.withColumn("_root", osi.root(F.col("symbol")))
    return (
        keyed.join(unique, "_root", "left")
        .withColumn("underlying", F.coalesce("_mapped", "_root"))
        .drop("_root", "_mapped")
    )


def enrich(
    bronze: DataFrame,
    underlyings: Mapping[str, str] = UNDERLYINGS,
    policies: Iterable[Policy] = (),
) -> DataFrame:
    """Silver rows of ``bronze``; further bronze columns pass through unchanged.

    A single projection, so it pipelines with the scan; ``policies`` filter the result. Quotes that
    are stored by ``trade_date`` keep it; others get it from their file's name.
    """
    symbol, file_name = F.col("symbol"), F.col("file_name")
    derived = {
        "underlying": underlying_of(osi.root(symbol), underlyings),
        "trade_date": F.col("trade_date") if "trade_date" in bronze.columns else osi.trade_date(file_name),
        "expiry_date": osi.expiry_date(symbol),
        "option_type": osi.option_type(symbol),
        "strike_price": osi.strike_price(symbol),
        "mid_price": osi.mid_price(F.col("bid_px_00"), F.col("ask_px_00")),
    }
    passed = [name for name in bronze.columns if name not in ("symbol", "trade_date", "file_name")]
    layout = (*SILVER_HEAD, *passed, *SILVER_TAIL)
    silver = bronze.select(
        *[derived[name].alias(name) if name in derived else F.col(name) for name in layout]
    )
    return reduce(DataFrame.transform, policies, silver)
