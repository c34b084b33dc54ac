"""Column expressions over the 21-character option symbol and the quote file name.

Layout: root padded to 6, expiry as yymmdd, C or P, strike times 1000 in 8 digits. Malformed text
gives NULL parts rather than a failed job, also in ANSI mode.
"""

import re
from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _iso_date(digits: Column, month_at: int) -> Column:
    """Date of year, two-digit month and two-digit day run together, the month at ``month_at``.

    Setting dashes and casting is far cheaper per row than parsing by pattern.
    """
    dashed = F.overlay(digits, F.lit("-"), F.lit(month_at + 2), F.lit(0))
    return F.overlay(dashed, F.lit("-"), F.lit(month_at), F.lit(0)).try_cast("date")


def root(symbol: Column) -> Column:
    return F.trim(F.substring(symbol, 1, 6))


def expiry_date(symbol: Column) -> Column:
    """Two-digit years all lie in 2000-2099.

    The cast would also take a day that is cut short or padded, hence the look at its last digit.
    """
    digits = F.concat(F.lit("20"), F.substring(symbol, 7, 6))
    return F.when(F.substring(symbol, 12, 1).between("0", "9"), _iso_date(digits, 5))


def option_type(symbol: Column) -> Column:
    """Anything that is not marked C counts as a put, a missing or malformed symbol included."""
    return F.when(F.substring(symbol, 13, 1) == "C", "CALL").otherwise("PUT")


def strike_price(symbol: Column) -> Column:
    """Exact: multiplying decimals costs half of dividing them."""
    thousands = F.substring(symbol, 14, 8).try_cast("decimal(10,2)")
    return (thousands * F.lit(Decimal("0.001"))).cast("decimal(15,7)")


def mid_price(bid: Column, ask: Column) -> Column:
    """Each side is rounded half up to cents before averaging; NULL if either side is NULL."""
    both = bid.try_cast("decimal(10,2)") + ask.try_cast("decimal(10,2)")
    return (both * F.lit(Decimal("0.5"))).cast("decimal(15,6)")


def trade_date(file_name: Column) -> Column:
    """Date in the first run of eight digits of the file name."""
    return _iso_date(F.regexp_extract(file_name, r"(\d{8})", 1), 5)


def trade_date_of(file_name: str) -> str | None:
    """The same for one name on the driver, as ISO text."""
    digits = re.search(r"[0-9]{8}", file_name)
    try:
        return date(int(digits[0][:4]), int(digits[0][4:6]), int(digits[0][6:])).isoformat() if digits else None
    except ValueError:
        return None
