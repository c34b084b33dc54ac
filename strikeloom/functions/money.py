from pyspark.sql import Column
from pyspark.sql import functions as F


def round_cents_half_even(amount: Column) -> Column:
    """Half-to-even on the scaled double; mids move in half cents, so ties are common."""
    return F.rint(amount * 100) / 100
