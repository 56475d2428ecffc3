"""A corpus from raw documents to shards: classify, thin out copies, decontaminate, mix, shard.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents it keeps, which are written as Parquet and read again by
the next.  All but the last return the columns of ``documents``; the last adds
``shard`` and ``slot``, or ``shard_`` and so on where ``documents`` has such
columns itself.

In every stage, rows with nulls in any column, empty or very long texts, ties
and repeated rows are handled as its operator says, an empty table gives an
empty one, and further columns are carried along, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import decontam, mixing, ngram_join, quality, sharding
from fleetlens.llm.common import drop, free, noted, table, written

N_SHARDS = 24
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Tables that the stage called last in an application has left, as its result reads them.
_left: dict[str, list[str]] = {}


def stage(first: bool = False) -> Callable[[Stage], Stage]:
    """A stage that, unless it is the first, removes the tables which its predecessor has left.

    Its documents are the predecessor's written result, so nothing reads them
    any more.  One pipeline runs at a time in an application.
    """

    def of(function: Stage) -> Stage:
        @functools.wraps(function)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            app = spark.sparkContext.applicationId
            for path in [] if first else _left.pop(app, []):
                drop(spark, path)
            with noted() as _left[app]:
                return function(spark, docs, sf_dir)

        return run_stage

    return of


@stage(first=True)
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return quality.keep_good(docs)


@stage()
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links of similarity 0.8 or more connect, the one of least id stays."""
    return ngram_join.keep_one(docs)


@stage()
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@stage()
def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources come near their target weights."""
    return mixing.mix(docs)


@stage()
def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place there."""
    placed = sharding.assign_shards(docs, N_SHARDS, carry=True)
    return placed.select("row.*", *[F.col(c).alias(free(docs, c)) for c in ("shard", "slot")])


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("sharding", shard_documents),
]

#: The classifier and the join's posterior pruning are no SQL; the tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of all stages; a stage's result goes when the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, function in STAGES[:-1]:
        docs, path = written(function(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
