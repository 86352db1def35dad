"""Statement periods: free text to ``MM/YYYY``, to ``YYYY-MM`` and to month numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwarden.fixed_values import DEFAULT_YEAR, MONTHS_BACK
from cardwarden.functions.text import strip


def normalize_period(
    period: Column, default_month: int = 1, default_year: int = DEFAULT_YEAR
) -> Column:
    """``m/yyyy``, ``yyyymm`` or ``yyyy`` text as ``MM/YYYY``; anything else is the default.

    A text with one slash whose month is not a whole number raises.
    """
    text = strip(F.coalesce(period.cast("string"), F.lit("")))
    shaped = text
    for pattern, form in [
        (r"^(\d{4})(\d{2})$", "$2/$1"),
        (r"^(\d{4})$", f"{default_month:02d}/$1"),
        (r"^0*(\d)\s*/", "0$1/"),
        (r"^0*([1-9]\d+)\s*/", "$1/"),
    ]:
        shaped = F.regexp_replace(shaped, pattern, form)
    not_a_month = F.raise_error(F.concat(F.lit("month is not a number: "), text)).cast("string")
    return (
        F.when(shaped.rlike(r"^\d{2,}/[^/]*$"), shaped)
        .when(text.rlike(r"^[^/]*/[^/]*$"), not_a_month)
        .otherwise(F.lit(f"{default_month:02d}/{default_year}"))
    )


def month_number(period: Column) -> Column:
    """Months since year 0 of an ``MM/YYYY`` period; raises on a month outside 1..12."""
    month = F.substring_index(period, "/", 1).cast("int")
    year = F.substring_index(period, "/", -1).cast("int")
    wrong = F.raise_error(F.concat(F.lit("no such month: "), period)).cast("int")
    return F.when(month.between(1, 12), year * 12 + month - 1).otherwise(wrong)


def month_text(number: Column) -> Column:
    """Month number as ``YYYY-MM``."""
    year = F.floor(number / 12).cast("string")
    return F.concat(year, F.lit("-"), F.lpad((number % 12 + 1).cast("string"), 2, "0"))


def rolling_window(as_of: Column, months_back: int = MONTHS_BACK) -> tuple[Column, Column]:
    """First and last ``MM/YYYY`` of the window that ends in the month of ``as_of``."""
    last = F.trunc(as_of, "MM")
    return (
        F.date_format(F.add_months(last, -months_back), "MM/yyyy"),
        F.date_format(last, "MM/yyyy"),
    )


def chosen_window(
    first: Column, last: Column, as_of: Column, months_back: int = MONTHS_BACK
) -> tuple[Column, Column]:
    """The explicit window if both of its ends are set, else the rolling one."""
    first, last = strip(first), strip(last)
    explicit = (F.length(first) > 0) & (F.length(last) > 0)
    rolling_first, rolling_last = rolling_window(as_of, months_back)
    return (
        F.when(explicit, first).otherwise(rolling_first),
        F.when(explicit, last).otherwise(rolling_last),
    )


def statement_month(period: Column) -> Column:
    """Statement month text (``M/YYYY`` or ``YYYYMM``) as ``YYYY-MM``; other text is kept."""
    text = F.left(period.cast("string"), F.lit(20))
    slash = F.instr(text, "/")
    year = F.substr(text, slash + 1, F.lit(4))
    month = F.right(F.concat(F.lit("00"), F.substring_index(text, "/", 1)), F.lit(2))
    return (
        F.when(slash > 0, F.concat(year, F.lit("-"), month))
        .when(
            F.length(F.rtrim(text)) == 6,
            F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2)),
        )
        .otherwise(text)
    )
