"""Which documents the join keeps, and how often it drops a pair."""

from math import comb

import numpy as np

from fleetlens.llm import ngram_join

from .test_text_operators import prose


def test_one_text_of_a_class_stays_without_ids_or_with_a_shared_one(spark):
    near = [[prose(k, 120) + end for end in ("", " one more", " and another end")] for k in range(3)]
    rows = [(None, t) for t in near[0]] + [(5, near[1][0]), (5, near[1][1]), (9, near[1][2])] + [(None, near[2][0]), (8, near[2][1]), (7, near[2][2])]
    rows += [(None, near[0][0]), (5, near[1][0]), (None, prose(9)), (4, prose(10)), (4, prose(11))]
    got = [tuple(r) for r in ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sum(t in near[0] for _, t in got) == 1
    assert [i for i, t in got if t in near[1]] == [5]
    assert [(i, t) for i, t in got if t in near[2]] == [(7, near[2][2])]
    assert {t for _, t in got} >= {prose(9), prose(10), prose(11)} and len(got) == 6


def test_decisions_drop_no_more_true_links_than_stated():
    for s, most in ((0.8, 1e-5), (0.81, 4e-6)):
        p = s + (1 - s) / 256
        step = np.array([comb(ngram_join.STEP, k) * p**k * (1 - p) ** (ngram_join.STEP - k) for k in range(ngram_join.STEP + 1)])
        alive, dropped = np.ones(1), 0.0
        for least in ngram_join.FEWEST:
            alive = np.convolve(alive, step)
            dropped += alive[:least].sum()
            alive[:least] = 0
        assert dropped <= most
