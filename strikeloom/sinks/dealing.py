"""Rows dealt to tasks by their number.

How many rows a scan or a shuffle gives a task follows from compressed bytes, and a few bytes may
hold millions of rows. A task that sorts what it writes holds them in memory or spills all of them.
"""

from functools import reduce
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that one task sorts: a quarter of a gigabyte of quotes.
ROWS_PER_TASK = 500_000
# Fixed value: up to so many tasks, a shuffle streams rows to its files instead of buffering them.
# More rows than that go to larger tasks, not to more of them.
STREAMED_TASKS = 200


def dealt(rows: DataFrame, sized: DataFrame, *by: str, most: int | None = None) -> DataFrame | None:
    """``rows`` shuffled so that no task has more than about ``most``; None where all are fewer.

    Rows with the same values in the columns ``by`` stay together unless they are too many for a
    task. ``sized`` has the same values and at least as many rows of each, but is cheaper to count.
    The plan of tasks has a row per combination of values, as the catalog lists a partition for each.
    """
    most = most or ROWS_PER_TASK
    counts = sorted((tuple(each) for each in sized.groupBy(*by).count().collect()), key=str)
    total = sum(each[-1] for each in counts)
    if total <= most:
        return None
    most = max(most, ceil(total / STREAMED_TASKS))
    plan, task, held = [], 0, 0
    for *key, number in counts:
        if held and held + number > most:
            task, held = task + 1, 0
        parts = ceil(number / most)
        plan.append((*key, task, parts))
        task, held = (task, held + number) if parts == 1 else (task + parts, 0)
    keys = [f"_key{number}" for number in range(len(by))]
    listed = pa.table(dict(zip([*keys, "_task", "_parts"], map(pa.array, zip(*plan)))))
    tasks = F.broadcast(
        rows.sparkSession.createDataFrame(listed).select(
            *[F.col(key).cast(sized.schema[name].dataType).alias(key) for key, name in zip(keys, by)],
            F.col("_task").cast("int").alias("_task"),
            "_parts",
        )
    )
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(key)) for name, key in zip(by, keys)])
    placed = rows.withColumn("_row", F.monotonically_increasing_id()).join(tasks, same, "left")
    # Rows that came after the count go to any task.
    part = F.pmod(F.xxhash64("_row"), F.coalesce("_parts", F.lit(1))).cast("int")
    return placed.repartitionById(task + 1, F.coalesce("_task", F.lit(0)) + part).select(*rows.columns)
