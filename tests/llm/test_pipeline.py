"""The pipeline against plain Python, stage by stage, on a small corpus."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from fleetlens.llm import queries, quality

from .test_text_operators import copies_by_hand, join_by_hand, near_copies, plan_by_hand, prose, shards_by_hand


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    items = [(i, prose(700 + i, 25)) for i in range(4)]
    docs = near_copies() + [(5000 + i, prose(300 + i, rng.randint(40, 200))) for i in range(80)]
    docs += [(6000 + i, prose(400 + i, 60) + " " + items[i][1] + " " + prose(500 + i, 60)) for i in range(4)]
    docs += [(7000 + i, " ".join(w + "$$$" for w in prose(i).split())) for i in range(15)] + [(8000 + i, "Same line again.\n" * 40 + str(i)) for i in range(15)]
    rows = [(i, t, "en", f"src{i % 4}", len(t)) for i, t in docs]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def by_hand(rows, items):
    patterns, feats = [], []
    for r in rows:
        stats, at, share = quality.describe(r[1])
        patterns.append(quality.vote_pattern(stats))
        feats.append(quality.features(stats, at, share))
    bad, _, _ = quality.fit_labellers(dict(Counter(patterns)))
    order = sorted(range(len(rows)), key=lambda k: (patterns[k], feats[k][0].tobytes(), feats[k][1].tobytes()))
    w, b = quality.fit_scorer([feats[k] for k in order], np.array([1 - bad[patterns[k]] for k in order]))
    good = [r for r, (i, v) in zip(rows, feats, strict=True) if 1 / (1 + np.exp(-(w[i] @ v + b))) >= 0.5]
    first = {i for i, c, *_ in join_by_hand([r[:2] for r in good]) if i == c}
    kept = [r for r in good if r[0] in first and not any(t in r[1] for _, t in items)]
    plain = [(r[0], r[1], r[3]) for r in kept]
    copies = copies_by_hand(plain, *plan_by_hand(plain))
    mixed = [r for r in kept for _ in range(copies[r[0]])]
    return [(i, shard, slot) for i, _, _, shard, slot in shards_by_hand([r[:2] for r in mixed])]


def test_pipeline_equals_plain_python(spark, corpus):
    path, rows, items = corpus
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    got = sorted((r.doc_id, r.shard, r.slot) for r in out.collect())
    assert got == sorted(by_hand(rows, items))
    assert not {i for i, *_ in got} & ({6000 + i for i in range(4)} | {7000 + i for i in range(15)} | {8000 + i for i in range(15)})
    assert len({i for i, *_ in got if i >= 5000}) > 40


def test_stages_keep_the_columns_of_documents(spark, corpus):
    path, *_ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(40), path).columns == docs.columns, name
        assert stage(spark, docs.limit(0), path).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), path).count() == 0


def test_every_query_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_on_awkward_rows_and_clashing_names(spark, tmp_path):
    from .test_text_operators import SCHEMA, awkward_rows

    schema = SCHEMA + ", slot string, votes string, own_key string, gone_id int, text_key string, c0 int, pid int, nth long"
    docs = spark.createDataFrame([(*r, "x", "v", "k", 1, "t", 2, 3, 4) for r in awkward_rows()], schema).repartition(3)
    spark.createDataFrame([(1, "an item of the benchmark that no document of this table holds at all")], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() <= 2 * docs.count(), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.columns == [*docs.columns, "shard_", "slot_"] and last.count() == docs.count()
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == last.columns


def test_contract_columns_of_queries_without_sql(spark):
    import zlib

    path = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{path}/documents.parquet").count()
    tokens = queries.op4_token_counts(spark, path).collect()
    assert len(tokens) == n and all(r.over_limit == (r.n_tokens > 512) for r in tokens)
    toxic = queries.op6_toxicity(spark, path).collect()
    assert len(toxic) == n and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) for r in toxic)
    assert sum(bool(r.evidence) for r in toxic) >= 0.95 * n
    assert all(r.contaminated for r in queries.op7_decontamination(spark, path).collect())
    rules = queries.op8_quality_rules(spark, path).collect()
    assert len(rules) == n and not any(r.kept and r.base_failed for r in rules)
    assert queries.op1_quality_classifier(spark, path).count() == n
