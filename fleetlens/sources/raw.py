"""Raw metadata: JSON tables, their manifest, and the state of sensor files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..schemas import RAW, raw_schema


class SourceError(Exception):
    """A table, a column or a key that must be there is not."""


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One raw table with its required columns typed; other columns are kept as read.

    A missing file or column is an error, and so is a file that is no JSON.
    """
    path = f"{folder}/{name}.json"
    try:
        found = spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        raise SourceError(f"raw table {name} not found at {path}") from e
    schema = raw_schema(name)
    if missing := set(schema.names) - set(found.columns):
        raise SourceError(f"raw table {name} lacks {sorted(missing)}")
    typed = T.StructType([*schema.fields, *[f for f in found.schema.fields if f.name not in schema.names]])
    return spark.read.schema(typed).option("multiLine", True).option("mode", "FAILFAST").json(path)


def check_key(df: DataFrame, name: str, key: str = "token") -> None:
    again = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if again:
        raise SourceError(f"{name}: {key} {again[0][key]!r} repeats")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Table, rows and SHA-256 of each raw file; nothing in it depends on when it is made."""
    names = F.regexp_extract("path", r"([^/]+)\.json$", 1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).select(names.alias("table"), F.sha2("content", 256).alias("sha256"))
    rows = None
    for name in RAW:
        n = read_table(spark, folder, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        rows = n if rows is None else rows.unionByName(n)
    return rows.join(files, "table")


def read_parquet(spark: SparkSession, path: str, made_by: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        raise SourceError(f"{path} is missing: run {made_by} first") from e


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """filename (below ``root``) and size of every sensor file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{root}/samples", f"{root}/sweeps"])
    return files.select(relative(F.col("path")).alias("filename"), F.col("length").alias("file_size_bytes"))


def relative(path):
    return F.regexp_extract(path, r"((?:samples|sweeps)/.*)$", 1)
