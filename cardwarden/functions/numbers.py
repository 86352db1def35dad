"""Brazilian money text and the numeric clean-ups of the anomaly features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
PLAIN_NUMBER = r"^ *[+-]?[0-9]*(\.[0-9]*)? *$"


def brazilian_amount(text: Column) -> Column:
    """``1.250,50`` as 1250.50; points are always thousands marks, bad text is NULL."""
    short = F.left(text.cast("string"), F.lit(50))
    plain = F.replace(F.replace(short, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(plain.rlike(PLAIN_NUMBER), plain.try_cast(MONEY))


def clean_double(value: Column) -> Column:
    """Value as double with anything unusable as 0.0."""
    return F.coalesce(F.nanvl(value.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def round4_even(value: Column) -> Column:
    """Four decimals, ties to even, as array libraries round."""
    return F.rint(value * 10000) / 10000
