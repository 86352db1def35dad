"""Text defaults and the removal of personal documents from names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwarden.fixed_values import BLANKS, NAME_PATTERNS, NOT_INFORMED


def present(text: Column) -> Column:
    """NULL for a text that is missing or empty."""
    return F.nullif(text, F.lit(""))


def first_present(*texts: Column, default: str | None = None) -> Column:
    """First text that is neither NULL nor empty, else ``default``."""
    picks = [present(t) for t in texts]
    return F.coalesce(*picks, F.lit(default)) if default is not None else F.coalesce(*picks)


def strip(text: Column) -> Column:
    """Cut blanks of any Unicode kind at both ends (``trim`` alone only knows the space)."""
    return F.btrim(text, F.lit(BLANKS))


def may_hold_document(text: Column) -> Column:
    """Whether any name pattern can match: all of them need a digit at the start, or a digit
    or mark of a document number at the end."""
    return F.left(text, F.lit(1)).rlike(r"(?U)\d") | F.right(text, F.lit(1)).rlike(r"(?U)[\d.*/-]")


def sanitize_name(name: Column) -> Column:
    """Upper-case name without leaked tax ids; nothing left means not informed.

    Most names hold no document, and two looks at their ends spare them the patterns.
    """
    stripped = strip(name)
    cleaned = stripped
    for pattern in NAME_PATTERNS:
        cleaned = F.regexp_replace(cleaned, pattern, "")
    cleaned = F.when(may_hold_document(stripped), strip(cleaned)).otherwise(stripped)
    return first_present(F.upper(cleaned), default=NOT_INFORMED)


def blank_trimmed(text: Column, default: str) -> Column:
    """Default for NULL, then spaces cut; an empty text stays empty."""
    return F.trim(F.coalesce(text.cast("string"), F.lit(default)))


def snake_case(name: str) -> str:
    """camelCase field name as a snake_case column name."""
    return "".join("_" + c.lower() if c.isupper() else c for c in name)
