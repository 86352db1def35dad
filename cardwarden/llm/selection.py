"""Where a budget ends in an order of any number of rows, without sorting them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Slices of the first key field that are summed in one pass.
SLICES = 4096
#: Rows are looked through in order once so many or fewer are left.
LAST_ROWS = 100_000


def prefix_end(rows: DataFrame, budget: int):
    """Key of the last row, in ascending order of key, up to which the sum of ``size`` is in budget.

    ``rows`` has ``key``, a struct whose first field is a number that is not NULL, and ``size``,
    at least 0. None if not even the first row fits. The range of the first field is cut into
    slices and summed; the slice that the budget ends in is cut again until few rows are left
    in it, and only those are put in order. The driver sees at most SLICES rows a pass.
    """
    first = rows.schema["key"].dataType.names[0]
    at, best, room = F.col(f"key.{first}").cast("double"), None, budget
    low, high = rows.agg(F.min(at), F.max(at)).first()
    if low is None:
        return None
    while True:
        inside = rows.where((at >= low) & (at <= high))
        width = (high - low) / SLICES
        number = F.least(F.floor((at - low) / width), F.lit(SLICES - 1)) if width > 0 else F.lit(0)
        parts = inside.groupBy(number.alias("n")).agg(
            F.sum("size").alias("s"), F.count("*").alias("c"),
            F.min(at).alias("first"), F.max("key").alias("last"),
        )
        for part in sorted(parts.collect(), key=lambda r: r.n):
            if part.s > room:
                break
            room, best = room - part.s, part.last
        else:
            return best
        # the next bounds are values of rows, so that no row is lost to rounding
        stop = float(part.last[0])
        done = part.c <= LAST_ROWS or (part.first, stop) == (low, high)
        low, high = part.first, stop
        if done:
            break
    last = rows.where((at >= low) & (at <= high))
    upto = W.orderBy("key").rowsBetween(W.unboundedPreceding, 0)
    found = last.withColumn("_sum", F.sum("size").over(upto)).where(F.col("_sum") <= room)
    return found.agg(F.max("key").alias("k")).first().k or best


def literal(key, kind):
    """A key that :func:`prefix_end` found, as a column to compare with."""
    return F.struct(*[F.lit(key[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])
