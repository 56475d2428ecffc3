"""Contiguous shards of near equal bytes from global prefix sums.

Rows are put in one global order (digest of the text, then id), range
partitioned so that even a text that a third of all rows share spreads over
tasks.  Each partition sums its own bytes; the prefix sums of these totals, one
row a partition, turn local offsets into global ones, and shards are cut at
equal byte targets.  A row goes to the shard that holds its middle byte.  Equal
texts are neighbours: a group of them no heavier than a shard's target stays
whole, in the shard of its first row; a heavier one is cut where shards end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .common import written

#: Bytes that each document weighs beside its text.
ROW_BYTES = 8


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's place and byte offset, and its group's offset, within the sorted partition."""
    pid, pos, at, last, start = TaskContext.get().partitionId(), 0, 0, None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size, keys = batch.column("__size").to_numpy(), batch.column("__key")
        off = at + np.concatenate(([0], np.cumsum(size)[:-1]))
        new = np.concatenate(([keys[0].as_py() != last], pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)))
        group = np.maximum.accumulate(np.where(new, off, start))  # offsets grow, so the last start counts
        last, start, at = keys[n - 1].as_py(), int(group[-1]), int(off[-1] + size[-1])
        made = [pa.array(np.full(n, pid), pa.int32()), pa.array(np.arange(pos, pos + n)), pa.array(off), pa.array(group)]
        pos += n
        yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "__pid", "__pos", "__off", "__goff"])


def assign_shards(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row a row of ``docs``: id, size, text_crc32, shard and slot; with ``carry``, its own columns too, as the struct ``row``.

    Null text weighs as the empty text (``ROW_BYTES``); a null id sorts first.
    Very long texts are rows like others: a shard may exceed its target by half
    a row or group.  Rows equal in text and id are interchangeable.  An empty
    table gives an empty result.  Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("__id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("__size"),
        F.crc32(text.cast("binary")).alias("__crc"),
        F.md5(text.cast("binary")).alias("__key"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")] if carry else []),
    )
    if not carry:  # texts are read once; the sort's sampling and the sort itself read a few bytes a row
        rows, _ = written(rows, "sized")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "__key", "__id").sortWithinPartitions("__key", "__id")
    schema = T.StructType([*rows.schema.fields, T.StructField("__pid", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("__pos", "__off", "__goff"))])
    placed, _ = written(ordered.mapInArrow(_offsets, schema), "sharded")

    # One row a partition from here: no more rows than partitions.
    by_pid, before = Window.orderBy("__pid"), Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    stats, _ = written(
        placed.groupBy("__pid").agg(
            F.sum("__size").alias("__bytes"),
            F.count(F.lit(1)).alias("__rows"),
            F.min("__key").alias("__first"),
            F.max("__key").alias("__last"),
            F.max("__goff").alias("__last_goff"),
            F.min(F.when(F.col("__goff") > 0, F.col("__goff"))).alias("__first_bytes"),
        ),
        "stats",
    )
    total = stats.agg(F.coalesce(F.sum("__bytes"), F.lit(0)).cast("long")).first()[0]
    parts_df = (
        stats.withColumn("__base", F.coalesce(F.sum("__bytes").over(before), F.lit(0)))
        .withColumn("__nth", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .withColumn("__goes_on", F.col("__first").eqNullSafe(F.lag("__last").over(by_pid)))
        .withColumn("__opens", F.when(~(F.col("__goes_on") & (F.col("__first") == F.col("__last"))), F.col("__base") + F.col("__last_goff")))
        .withColumn("__open_at", F.last("__opens", ignorenulls=True).over(before))
        .select("__pid", "__base", "__nth", "__open_at", F.when(F.col("__goes_on"), F.col("__first")).alias("__open_key"))
    )
    heavy = _heavy(placed, stats, total, n_shards)
    off, group = F.col("__base") + F.col("__off"), F.when(F.col("__key") == F.col("__open_key"), F.col("__open_at")).otherwise(F.col("__base") + F.col("__goff"))
    anchor = F.when(F.col("__key").isin(heavy), off).otherwise(group) if heavy else group
    # Whole numbers in longs: an int's double overflows from a total of 2^30 bytes, and a decimal quotient is rounded up just below a cut.
    shard = F.least(F.lit(n_shards - 1), F.call_function("div", (anchor * 2 + F.col("__size")) * n_shards, F.lit(2 * max(total, 1)).cast("long"))).cast("int")
    sharded = placed.join(F.broadcast(parts_df), "__pid").withColumn("shard", shard).withColumn("__nth_row", F.col("__nth") + F.col("__pos"))
    firsts = sharded.groupBy("shard").agg(F.min("__nth_row").alias("__first_row"))  # n_shards rows at most
    return sharded.join(F.broadcast(firsts), "shard").select(
        F.col("__id").alias(id_col),
        F.col("__size").alias("size"),
        F.col("__crc").alias("text_crc32"),
        "shard",
        (F.col("__nth_row") - F.col("__first_row")).alias("slot"),
        *([F.col("__row").alias("row")] if carry else []),
    )


def _heavy(placed: DataFrame, stats: DataFrame, total: int, n_shards: int) -> list[str]:
    """Keys of groups heavier than a shard's target; there are fewer than ``n_shards``.

    Such a group is seen inside one partition, or as the first or last group
    of several.
    """
    within = placed.where((F.col("__off") - F.col("__goff") + F.col("__size")) * n_shards > total).select("__key").distinct()
    first = F.struct(F.col("__first").alias("key"), F.coalesce("__first_bytes", "__bytes").alias("bytes"))
    last = F.when(F.col("__first") != F.col("__last"), F.struct(F.col("__last").alias("key"), (F.col("__bytes") - F.col("__last_goff")).alias("bytes")))
    across = stats.select(F.explode(F.array_compact(F.array(first, last))).alias("end")).groupBy("end.key").agg(F.sum("end.bytes").alias("bytes")).where(F.col("bytes") * n_shards > total)
    return sorted(r[0] for r in within.union(across.select("key")).distinct().collect())
