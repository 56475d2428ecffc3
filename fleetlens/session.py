"""Spark session with the settings that the engine's results depend on."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "fleetlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; a given master and settings win over the environment's."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master or os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or os.environ["SPARK_MASTER"])
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable where Python workers run.

    Nothing is done where they find it anyway: on PYTHONPATH, or in the working
    folder of a local master.  Elsewhere a zip of it is sent with Spark's own
    file server, once per application.
    """
    sc = spark.sparkContext
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p] + [os.getcwd()] * local
    if here in known or sc.applicationId in _shipped:
        return
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="fleetlens-"), "fleetlens"), "zip", here, "fleetlens")
    sc.addPyFile(made)
    _shipped.add(sc.applicationId)
