"""Transaction dates in their two text styles, and integer date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwarden.fixed_values import UNKNOWN_DATE, UNKNOWN_DATE_KEY

DAY_FIRST = r"^ *(\d{1,2})/(\d{1,2})/(\d{4}) *$"
YEAR_FIRST = r"^ *\d{4}-\d{2}-\d{2}( .*)?$"


def day_first_date(text: Column) -> Column:
    """``d/m/yyyy`` as a date, NULL when it is not one.

    The text is turned round to ISO order for the plain date cast: cheaper than a
    formatter, which would throw and catch for every row that does not parse.
    """
    iso = F.regexp_replace(text, DAY_FIRST, "$3-$2-$1")
    return F.when(text.rlike(DAY_FIRST), iso.try_cast("date"))


def year_first_date(text: Column) -> Column:
    """``yyyy-mm-dd`` with an optional time as a date, NULL when it is not one."""
    return F.when(text.rlike(YEAR_FIRST), F.trim(text).try_cast("date"))


def transaction_date(date_text: Column, period: Column) -> Column:
    """Date by the first rule that fits: blank text is the unknown date, day first,
    year first, first day of an ``M/YYYY`` statement month, unknown date."""
    text = F.left(date_text.cast("string"), F.lit(20))
    month = F.concat(F.lit("01/"), F.left(period.cast("string"), F.lit(20)))
    unknown = F.lit(UNKNOWN_DATE).cast("date")
    return F.coalesce(
        F.when(F.trim(text) == "", unknown),
        day_first_date(text),
        year_first_date(text),
        day_first_date(month),
        unknown,
    )


def date_key(date: Column) -> Column:
    """Date as the integer ``YYYYMMDD``; no date is the unknown member."""
    key = F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
    return F.coalesce(key, F.lit(UNKNOWN_DATE_KEY))
