"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwarden.llm.common import unpacked_rows, whole_row
from cardwarden.llm.selection import literal, prefix_end
from cardwarden.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
BUDGET_SHARE = 1.5
REPEATS = 2
#: About so many documents are put in order by one task.
RUN_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)).cast("bigint")


def running_total(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` of the row and those before it in its group.

    ``_run`` numbers consecutive pieces of a group's order, so that a group of any size is
    summed by many tasks: totals of pieces first, then rows within their piece.
    """
    keys = [*group, "_run"]
    pieces = rows.groupBy(*keys).agg(F.sum(value).alias("_piece"))
    before = W.partitionBy(*group).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    pieces = materialize(
        pieces.withColumn("_before", F.coalesce(F.sum("_piece").over(before), F.lit(0))).drop("_piece"), "pieces"
    )
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    within = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    joined = rows.alias("r").join(pieces.alias("p"), same).select("r.*", "p._before")
    return joined.withColumn(out, F.sum(value).over(within) + F.col("_before")).drop("_before")


def source_targets(
    sizes: DataFrame, source: str, size: str,
    weights: Sequence[float] = WEIGHTS, budget_share: float = BUDGET_SHARE, repeats: int = REPEATS,
) -> DataFrame:
    """(source, source_size, n_docs, target), one row per source.

    Sources in code-point order, NULL last, take the weights in turn. The budget is shared by
    weight; a source stops at ``repeats`` times its size and its excess goes to the others. In the
    order of cap per weight, the share per weight of a source and those behind it rises as long
    as sources stop at their caps and falls after, so its maximum is the level of the rest.
    """
    per = sizes.groupBy(source).agg(F.sum(size).alias("source_size"), F.count("*").alias("n_docs"))
    turn = W.orderBy(F.col(source).asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("_w", F.element_at(listed, (F.row_number().over(turn) - 1) % len(weights) + 1))
    per = per.withColumn("_cap", F.col("source_size") * F.lit(float(repeats)))
    everything = W.partitionBy(F.lit(1))
    fill = W.orderBy(F.col("_cap") / F.col("_w"), F.col(source).asc_nulls_last())
    per = per.withColumns({
        "_left": F.sum("source_size").over(everything) * F.lit(float(budget_share))
        - F.coalesce(F.sum("_cap").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "_weights": F.sum("_w").over(fill.rowsBetween(W.currentRow, W.unboundedFollowing)),
    })
    level = F.max(F.col("_left") / F.col("_weights")).over(everything)
    target = F.least(F.col("_cap"), level * F.col("_w"))
    return per.select(source, "source_size", "n_docs", target.alias("target"))


def queue(
    docs: DataFrame, id_col: str, text_col: str, source_col: str,
    weights: Sequence[float], budget_share: float, repeats: int, seed: int,
) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_cum``, their place in their source's queue in words; and the sources."""
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
        word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("_text"),
    )
    key = F.concat_ws(":", F.coalesce(F.col("_id").cast("string"), F.lit("null")), F.lit(str(seed)))
    rows = materialize(rows.withColumn("_order", F.md5(key)), "sizes")
    sources = materialize(source_targets(rows, "_source", "size", weights, budget_share, repeats), "targets")
    runs = F.ceil(F.col("n_docs") / F.lit(RUN_ROWS))
    place = F.conv(F.substring("_order", 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    same = F.col("r._source").eqNullSafe(F.col("s._source"))
    placed = rows.alias("r").join(sources.alias("s"), same).select(
        "r.*", "source_size", "target", F.floor(place * runs).cast("int").alias("_run")
    )
    summed = running_total(placed, ["_source"], ["_order", "_id", "_text"], "size", "_cum")
    return materialize(summed.drop("_run"), "queue"), sources


def finish_key(copy: Column) -> Column:
    """Order of all copies: virtual finish time, then what settles ties (NULL first)."""
    finish = (F.col("_cum") + copy * F.col("source_size")) / F.when(F.col("target") > 0, F.col("target"))
    return F.struct(
        finish.alias("finish"), F.col("_source").alias("source"), copy.alias("copy"),
        F.col("_order").alias("order"), F.col("_id").alias("id"), F.col("_text").alias("text"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, budget_share: float = BUDGET_SHARE, repeats: int = REPEATS,
    seed: int = 7,
) -> DataFrame:
    """Rows (id, size, source_size, target, taken, copies, source, text_hash), one for each of ``docs``.

    Each source's documents stand in the order of md5(id, seed), once for each repeat. A copy's
    virtual finish time is its source's cumulative size up to it, divided by the source's target.
    All copies in the order of finish time (ties: source, repeat, md5, id, text hash) are taken
    as long as the total stays within the budget, ``budget_share`` of all sizes; ``taken`` is the
    size of a document times its taken ``copies``. So each source comes as near its target as
    whole documents allow, and the same input gives the same mix on any cluster.

    NULL and empty texts have size 0 and take nothing; a NULL source is a source of its own; a
    NULL id is ordered as the text "null"; rows equal in id, source and text are interchangeable.
    An empty table gives no rows. Other columns are ignored.
    """
    queued, sources = queue(docs, id_col, text_col, source_col, weights, budget_share, repeats, seed)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    items = queued.where("size > 0 and target > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    ).select("size", finish_key(F.col("_copy")).alias("key"))
    end = prefix_end(items, int(min(budget_share, repeats) * total)) if total else None
    copies = F.lit(0)
    if end is not None:
        last = literal(end, items.schema["key"].dataType)
        for copy in range(repeats):
            taken = (F.col("size") > 0) & (F.col("target") > 0) & (finish_key(F.lit(copy)) <= last)
            copies = copies + F.when(taken, 1).otherwise(0)
    return queued.withColumn("copies", copies).select(
        F.col("_id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies",
        F.col("_source").alias("source"), F.col("_text").alias("text_hash"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents the mix takes, with their own columns, a document taken twice as two rows.

    Of rows equal in id, source and text, the first ones carry what the mix takes of them all.
    """
    keys = ["id", "source", "text_hash"]
    chosen = mix(docs, id_col, text_col, source_col, **options).withColumnRenamed(id_col, "id")
    chosen = chosen.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
    keyed = docs.select(
        whole_row(docs), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
    ).alias("d")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    joined = keyed.join(chosen.where("copies > 0").alias("c"), same).select("d.*", "copies", "n")
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(F.lit(1)))
    more = F.when(F.col("nth") <= F.col("copies") % F.col("n"), 1).otherwise(0)
    times = (F.floor(F.col("copies") / F.col("n")) + more).cast("int")
    spread = joined.withColumn("nth", nth).withColumn("times", times).where("times > 0")
    return unpacked_rows(spread.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))), docs)
