"""Tables of the layers as SQL views."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession

#: Views by the folder below the output folder that they read.
LAYERS = {f"{layer}_{name}": f"{layer}/{name}" for layer, names in {"silver": ("frames", "annotations", "sync", "frame_features", "frames_qc", "annotations_qc"), "gold": ("samples", "labels_2d"), "reports": ("issues", "coverage")}.items() for name in names}


def register(spark: SparkSession, tables: Mapping[str, str]) -> None:
    """A temporary view for each name and Parquet path; a view of that name is replaced."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def register_layers(spark: SparkSession, out_dir: str) -> None:
    """Views of all tables that a run has written below ``out_dir``: silver_frames, gold_samples and so on."""
    register(spark, {name: f"{out_dir}/{path}" for name, path in LAYERS.items()})


@contextlib.contextmanager
def registered(spark: SparkSession, tables: Mapping[str, str]) -> Iterator[None]:
    """Views for the time of a block; plans made in it stay valid."""
    register(spark, tables)
    try:
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
