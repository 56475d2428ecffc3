"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

#: Rows, and bytes of their strings, that a Python pass handles at a time; one longer row stands alone.
#: Spark itself bounds what it hands over by ``spark.sql.execution.arrow.maxBytesPerBatch``.
SLICE_ROWS, SLICE_BYTES = 512, 8 << 20


class Memo(dict):
    """What a task remembers of words.  It is emptied when the task ends, as workers go on to other work."""

    def __init__(self):
        super().__init__()
        _memos.add(self)

    __hash__ = object.__hash__

    def __eq__(self, other) -> bool:
        return self is other


_memos: weakref.WeakSet = weakref.WeakSet()


def forget() -> None:
    """At a task's end: empties what was remembered and gives freed memory back, as idle workers keep theirs else."""
    for m in list(_memos):
        m.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    On a local master that names none, as in tests, a temporary folder is set.
    Elsewhere that would lose rows, so it is an error.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fleetlens-"))
        found = sc.getCheckpointDir()
    return found


def fresh_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/fleetlens-{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


#: Paths made inside each open ``noted``.
_open: list[list[str]] = []


@contextlib.contextmanager
def noted() -> Iterator[list[str]]:
    """Lists the tables that are written inside and left."""
    made: list[str] = []
    _open.append(made)
    try:
        yield made
    finally:
        _open.pop()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are removed at the end; what is to stay must have been written outside by then.

    Tables that a returned plan still reads stay until ``clear`` or until the
    folder of the application is removed.
    """
    made: list[str] = []
    try:
        with noted() as made:
            yield
    finally:
        for path in made:
            drop(spark, path)


def clear(spark: SparkSession) -> None:
    """Removes all tables that this application has left; no result may be read after it."""
    drop(spark, f"{shared_dir(spark)}/fleetlens-{spark.sparkContext.applicationId}")


def written(df: DataFrame, what: str, path: str | None = None) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, and the table's path: lineage ends here."""
    spark, path = df.sparkSession, path or fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def free(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop(spark: SparkSession, path: str) -> None:
    """Removes a written table that no later plan reads."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> bool:
    """Whether ``df`` (a written or cheap table) is within a bound fit for a broadcast.

    Counts rows and the bytes of its string and binary columns; 16 bytes stand
    for each other column.
    """
    size = F.lit(0)
    for f in df.schema.fields:
        wide = isinstance(f.dataType, (T.StringType, T.BinaryType))
        size = size + (F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if wide else F.lit(16))
    n, b = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and b <= max_bytes


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of at most SLICE_ROWS rows and, unless one row is longer, SLICE_BYTES bytes of strings."""
    size = np.zeros(batch.num_rows, np.int64)
    for c in batch.columns:
        for leaf in c.flatten() if pa.types.is_struct(c.type) else [c]:
            if pa.types.is_string(leaf.type) or pa.types.is_binary(leaf.type):
                size += pc.fill_null(pc.binary_length(leaf), 0).to_numpy(zero_copy_only=False)
    end, at = np.cumsum(size), 0
    while at < batch.num_rows:
        fits = int(np.searchsorted(end, (end[at - 1] if at else 0) + SLICE_BYTES, "right"))
        upto = min(max(fits, at + 1), at + SLICE_ROWS)
        yield batch.slice(at, upto - at)
        at = upto


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType) -> DataFrame:
    """``fn`` over ``slices``, so that memory stays bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = fn(part)
                if out is not None:
                    yield out
        forget()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def first_by_hash(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The ``n`` rows that come first in ``order``, whose first column is a 64-bit hash.

    Rows with hashes that cannot be among them go before the sort, so that
    tasks together send about twice ``n`` rows, however many tasks there are.
    """
    total = df.count()
    if total > 2 * n:  # twice the share that is expected to hold n rows, from the lowest hash on
        few = df.where(order[0] < -(1 << 63) + int((1 << 64) * (2 * n / total)))
        df = few if few.count() >= n else df
    return df.orderBy(*order).limit(n)


def field(df: DataFrame, name: str, to: str | None = None) -> T.StructField:
    return T.StructField(to or name, df.schema[name].dataType, True)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's strings; null reads as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]
