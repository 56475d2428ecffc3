"""Where results come from: the code's commit and the data's fingerprint."""

from __future__ import annotations

import subprocess

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def git_commit(folder: str = ".") -> str:
    """The short commit of a work tree, ``-dirty`` if files differ; ``unknown`` outside of one."""
    try:
        run = lambda *a: subprocess.run(["git", "-C", folder, *a], capture_output=True, text=True, check=True, timeout=30).stdout.strip()
        return run("rev-parse", "--short", "HEAD") + ("-dirty" if run("status", "--porcelain") else "")
    except (OSError, subprocess.SubprocessError):
        return "unknown"


def fingerprint(spark: SparkSession, path: str, digits: int = 12) -> str:
    """The first digits of a file's SHA-256."""
    return spark.read.format("binaryFile").load(path).select(F.substring(F.sha2("content", 256), 1, digits)).first()[0]
