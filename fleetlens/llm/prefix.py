"""Positions and prefix sums in a global order, without one task that sees all rows.

Rows are range partitioned and sorted; each partition counts and sums its own,
and the totals, one row a partition, turn local figures into global ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .common import written


def prefix_sums(rows: DataFrame, order: list[Column], sums: list[str], what: str) -> DataFrame:
    """``rows``, written in the given order, with ``nth`` from 0 and for each long column of ``sums`` its sum over the rows before as ``before_`` and its name.

    Rows equal in the order are placed in any way.  Ties of the leading keys
    spread over partitions where later keys differ.  No column may be null in ``sums``.
    """
    spark = rows.sparkSession
    ship(spark)

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, n, totals = TaskContext.get().partitionId(), 0, [0] * len(sums)
        for batch in batches:
            k = batch.num_rows
            if not k:
                continue
            made = [pa.array(np.full(k, pid), pa.int32()), pa.array(np.arange(n, n + k))]
            n += k
            for j, c in enumerate(sums):
                upto = np.cumsum(batch.column(c).to_numpy())
                made.append(pa.array(totals[j] + np.concatenate(([0], upto[:-1]))))
                totals[j] += int(upto[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "pid", "nth", *(f"before_{c}" for c in sums)])

    schema = T.StructType([*rows.schema.fields, T.StructField("pid", T.IntegerType()), T.StructField("nth", T.LongType()), *(T.StructField(f"before_{c}", T.LongType()) for c in sums)])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local, _ = written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(located, schema), what)
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = local.groupBy("pid").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in sums])  # one row a partition
    bases = bases.select(
        F.col("pid").alias("base_pid"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_nth"), *[F.coalesce(F.sum(f"sum_{c}").over(before), F.lit(0)).alias(f"base_{c}") for c in sums]
    )
    joined = local.join(F.broadcast(bases), F.col("pid") == F.col("base_pid"))
    return joined.select(*rows.columns, (F.col("nth") + F.col("base_nth")).alias("nth"), *[(F.col(f"before_{c}") + F.col(f"base_{c}")).alias(f"before_{c}") for c in sums])
