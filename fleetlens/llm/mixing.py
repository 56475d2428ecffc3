"""Mixing sources to target weights by repeating documents.

Words are summed per source (partial sums before the shuffle, so a hot source
costs one row a task).  Targets are filled like water: every source gets its
weight's share of the budget, but no more than ``cap`` times what it holds, and
the excess goes to the others by weight.  A document is then taken
``floor(rate)`` times and once more with the rate's fraction as probability.

These last draws are hash-seeded and depend on each other: the documents of a
source stand in order of their sizes, and one number from 0 to 1, hashed from
the source's name, moves a comb over them whose teeth are ``1 / fraction``
apart.  Every document is hit with probability ``fraction``, as if drawn by
itself, but as every tooth stands for its neighbours, which are as long, the
words taken miss the source's target by less than its longest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, written
from .prefix import prefix_sums
from .textstats import WORD

#: Sources by code point take these weights in turn.
WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes.
BUDGET = 1.5
#: No source, and no document, is taken more often than this.
CAP = 2
#: A table of sources up to this many rows is broadcast; a longer one is joined by shuffling.
MAX_BROADCAST_SOURCES = 100_000


def _digest(key: Column) -> Column:
    return F.md5(F.concat(F.lit("mix:"), key).cast("binary"))


def _start(source: Column) -> Column:
    """A number from 0 to 1 that depends on the source's name alone."""
    return F.conv(F.substring(_digest(F.coalesce(source, F.lit(""))), 1, 12), 16, 10).cast("double") / float(16**12)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """``source``, ``source_size``, ``target`` and ``first`` from rows of ``source``, ``size`` and ``nth``; null is a source, last.

    However many sources there are, they are numbered and filled by prefix
    sums over partitions.
    """
    own, _ = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("nth").alias("first")), "sources")
    named = prefix_sums(own, [F.col("source").asc_nulls_last()], [], "named")
    filled = (
        named.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("most", F.col("source_size") * cap)
        .withColumn("full_at", F.col("most").cast("double") / F.col("weight"))
        .withColumnRenamed("nth", "number")
    )
    line = prefix_sums(filled, [F.col("full_at"), F.col("number")], ["most", "weight"], "filled")
    total, total_weight = (x or 0 for x in filled.agg(F.sum("source_size"), F.sum("weight")).first())
    # water level if the sources before this one are full and this one and those after it are not
    level = (F.lit(float(total)) * budget - F.col("before_most")) / (F.lit(total_weight) - F.col("before_weight"))
    water = line.select("full_at", "number", level.alias("level")).where("level <= full_at").agg(F.min(F.struct("full_at", "number", "level"))["level"]).first()[0]
    most = F.col("most").cast("double")
    return line.select("source", "source_size", "first", (most if water is None else F.least(most, F.lit(water) * F.col("weight"))).alias("target"))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: bool = False, **rates) -> DataFrame:
    """One row a document: id, size, source_size, target and copies; with ``carry`` its own columns as the struct ``row``.

    Null text has no words; it and other texts without words are drawn like the
    rest but take none.  Very long texts are counted whole.  Documents of one
    size stand by the digests of their ids, then of their texts, so reruns
    agree; rows equal in both are interchangeable.  An empty table gives an
    empty plan.  Other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        _digest(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("id_digest"),
        F.md5(text.cast("binary")).alias("text_digest"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    if not carry:  # texts are read once
        rows, _ = written(rows, "sized")
    line = prefix_sums(rows, [F.col(c) for c in ("source", "size", "id_digest", "text_digest")], [], "lined")
    targets, _ = written(source_targets(line.select("source", "size", "nth"), **rates), "targets")
    side = targets.withColumnRenamed("source", "of")
    side = F.broadcast(side) if small(targets, MAX_BROADCAST_SOURCES) else side
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    place, part = F.col("nth") - F.col("first"), F.col("rate") - F.floor("rate")
    tooth = F.floor(F.col("start") + (place + 1) * part) - F.floor(F.col("start") + place * part)
    return (
        line.join(side, F.col("source").eqNullSafe(F.col("of")))
        .withColumns({"rate": rate, "start": _start(F.col("source"))})
        .select(F.col("id").alias(id_col), "size", "source_size", "target", (F.floor("rate") + tooth).cast("int").alias("copies"), *(["row"] if carry else []))
    )


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixture itself: every document as often as the plan takes it, with the columns of ``docs``."""
    plan = plan_mix(docs, carry=True, **kw).where("copies > 0")
    return plan.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
