"""Each operator against a brute-force version, and on awkward rows."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import compression, decontam, licenses, mixing, ngram_join, quality, queries, sharding, textstats, tokencount, toxicity, warc
from fleetlens.llm.components import components

#: doc_id, text, lang, source, n_chars and columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, size long, score double, tid string, root string, n long, id long, row string, kept boolean"


def prose(seed: int, n: int = 120) -> str:
    """Sentences of invented words."""
    rng = random.Random(seed)
    parts = ["ta", "ri", "mo", "len", "sha", "ver", "ko", "ni", "pel", "dra", "sun", "bo"]
    words, out = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n)], []
    for i in range(0, n, 9):
        out.append(" ".join(words[i : i + 9]).capitalize() + ".")
    return " ".join(out)


def awkward_rows() -> list[tuple]:
    long = " ".join(prose(900 + i, 400) for i in range(60))
    texts = [None, "", " ", "\n\t", "one", "two words here", "x" * 50_000, long, long, "é€😀   \x1c a", prose(1), prose(1), prose(2), "<|endoftext|> in <|endoftext|>text", "Orre " * 300]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(10, prose(1)), (None, prose(3)), (None, prose(3)), (None, None)]
    return [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", 1, 7, 8, 0.5, "t", "r", 2, 3, "row", True) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def shingle_set(t):
    w = words(t)
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


# statistics of one text


@given(st.text(alphabet="ab \n\t#|é\x1c ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_text_statistics_match_plain_definitions(t):
    w = words(t)
    ids, distinct = textstats.word_ids(textstats.words_of(t))
    assert len(ids) == len(w) and distinct == len(set(w))
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    assert textstats.repeated_words(ids, distinct) == len(covered)
    assert textstats.word_char_count(t) == sum(map(len, w))
    lines = [x for x in t.split("\n") if words(x)]
    assert textstats.duplicate_lines(t) == (len(lines) - len(set(lines)), len(lines))
    assert textstats.symbol_count(t) == len(re.findall(r"[#*$%&|<>]", t))


# 1 quality classifier


def test_quality_learns_without_labels(spark):
    good = [(i, prose(i)) for i in range(120)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(i, 20).split()) * 4) for i in range(12)] + [(2000 + i, ("Same line again.\n") * 40) for i in range(12)]
    bad += [(3000 + i, " ".join(w + "$$$" for w in prose(i).split())) for i in range(12)]
    got = {r.doc_id: r for r in quality.score_quality(spark.createDataFrame(good + bad, "doc_id long, text string")).collect()}
    assert all(got[i].kept for i, _ in good) and not any(got[i].kept for i, _ in bad)
    again = {r.doc_id: r.score for r in quality.score_quality(spark.createDataFrame(good + bad, "doc_id long, text string").repartition(7)).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in again)


def test_expectation_maximisation_finds_accuracies():
    rng = random.Random(5)
    right, counts = [0.95, 0.9, 0.85, 0.7], Counter()
    for _ in range(4000):
        bad = rng.random() < 0.3
        votes = "".join("-" if rng.random() < 0.2 else "bg"[bad != (rng.random() < a)] for a in right)
        counts[votes + "-" * (len(quality.LABELLERS) - 4)] += 1
    bad, found, share = quality.fit_labellers(dict(counts))
    assert abs(share - 0.3) < 0.05 and all(abs(a - b) < 0.05 for a, b in zip(found, right, strict=False))
    assert bad["bbbb" + "-" * (len(quality.LABELLERS) - 4)] > 0.99


def test_quality_of_awkward_rows(awkward, empty):
    got = quality.score_quality(awkward).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 and r.kept is not None for r in got)
    assert len({r.score for r in got if r.doc_id == 10}) == 1
    assert quality.score_quality(empty).count() == 0
    kept = quality.keep_good(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r.kept for r in got)


# 2 mixing


def plan_by_hand(rows):
    size = [len(words(t)) for _, t, _ in rows]
    by = defaultdict(int)
    for (_, _, s), n in zip(rows, size, strict=True):
        by[s] += n
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None] * (None in by)
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(names)}
    target, full = {}, set()
    while True:  # refill until none is above its most
        rest = sum(by.values()) * 1.5 - sum(2 * by[s] for s in full)
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        target = {s: 2.0 * by[s] if s in full else rest * weight[s] / total for s in names}
        over = {s for s in open_ if target[s] > 2 * by[s]}
        if not over:
            return size, by, target
        full |= over


def copies_by_hand(rows, size, by, target):
    """Documents of a source in order of size, hit by a comb that a hash of the source moves."""
    digest, out = lambda x: hashlib.md5(x.encode()).hexdigest(), {}
    for s in by:
        own = sorted((n, digest(f"mix:{i}"), digest(t or ""), i) for (i, t, of), n in zip(rows, size, strict=True) if of == s)
        rate = target[s] / by[s] if by[s] else 0.0
        start, part = int(digest(f"mix:{s or ''}")[:12], 16) / 16**12, rate - math.floor(rate)
        for k, (*_, i) in enumerate(own):
            out[i] = math.floor(rate) + math.floor(start + (k + 1) * part) - math.floor(start + k * part)
    return out


def test_mixing_draws_each_document_with_its_fraction():
    """Over many starts of the comb every document is hit as often as the fraction says."""
    part, starts = 0.37, [(k + 0.5) / 1000 for k in range(1000)]
    for place in (0, 1, 7, 40):
        assert abs(sum(math.floor(u + (place + 1) * part) - math.floor(u + place * part) for u in starts) / 1000 - part) < 2e-3


def test_mixing_of_many_sources(spark):
    rows = [(i, prose(i, 5 + i % 40), f"https://{i % 700}.example/") for i in range(1400)]
    size, by, target = plan_by_hand(rows)
    got = {r.doc_id: r for r in mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    copies = copies_by_hand(rows, size, by, target)
    assert all(got[i].target == pytest.approx(target[s]) and got[i].copies == copies[i] for i, _, s in rows)


def test_mixing_matches_refilling(spark):
    rng = random.Random(3)
    rows = [(i, prose(i, rng.randint(1, 200)), rng.choice(["a", "b", "é", "z", None])) for i in range(300)]
    size, by, target = plan_by_hand(rows)
    plan = {r.doc_id: r for r in mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    copies, taken, longest = copies_by_hand(rows, size, by, target), Counter(), Counter()
    for (i, _, s), n in zip(rows, size, strict=True):
        r = plan[i]
        assert (r.size, r.source_size) == (n, by[s]) and r.target == pytest.approx(target[s])
        assert r.copies == copies[i] <= 2
        taken[s] += r.copies * n
        longest[s] = max(longest[s], n)
    assert all(abs(taken[s] - target[s]) < longest[s] for s in by)  # a source misses its target by less than a document
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert Counter(r.doc_id for r in mixed.collect()) == {i: r.copies for i, r in plan.items() if r.copies}


def test_mixing_awkward_rows(awkward, empty):
    plan = mixing.plan_mix(awkward)
    assert plan.count() == awkward.count() and all(r.copies == 0 or r.size <= 2 * r.source_size for r in plan.collect())
    assert mixing.mix(awkward).columns == awkward.columns
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixing_joins_without_broadcast_alike(spark, monkeypatch):
    rows = [(i, prose(i, 20), f"s{i % 5}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted(mixing.plan_mix(df).collect())
    monkeypatch.setattr(mixing, "MAX_BROADCAST_SOURCES", 0)
    assert sorted(mixing.plan_mix(df).collect()) == want


# 3 license scans


def test_license_scan_matches_containment(spark, awkward, empty):
    rng, rows = random.Random(8), []
    names = list(licenses.TEMPLATES)
    for i in range(200):
        w = prose(i, rng.randint(0, 100)).split()
        for k in range(rng.randint(0, 3)):
            t = licenses.TEMPLATES[rng.choice(names)].split()
            if rng.random() < 0.5 and len(t) > 12:
                t[rng.randrange(len(t))] = "changed"
            w += t + prose(1000 * k + i, rng.randint(0, 80)).split()  # one after another: a template cut by another is no stretch of text
        rows.append((i, " ".join(w)))

    def grams(t):
        x = [y for y in re.split(r"[^\w]|_", t.lower()) if y]
        return {" ".join(x[i : i + 5]) for i in range(len(x) - 4)}

    templates = {k: grams(v) for k, v in licenses.TEMPLATES.items()}
    # A template is found where a stretch of the text holds it; scattered shingles do not occur here.
    want = {(i, k) for i, t in rows for k, g in templates.items() if len(g & grams(t)) >= 0.8 * len(g)}
    got = {(r.doc_id, r.template) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and len(want) > 100
    assert licenses.scan_licenses(awkward).count() == 0 and licenses.scan_licenses(empty).count() == 0


def test_license_scan_reports_rows_without_ids_and_with_shared_ones_by_themselves(spark):
    mit, cc = licenses.TEMPLATES["MIT grant"], licenses.TEMPLATES["CC-BY-SA-4.0 notice"]
    rows = [(None, f"{prose(1)} {mit}"), (None, f"{prose(2)} {mit}"), (7, mit), (7, f"{cc} {prose(3)}"), (7, mit), (8, prose(4, 9000) + " " + cc + " " + prose(5))]
    df = spark.createDataFrame([(i, t, 1, "r", "t") for i, t in rows], "doc_id long, text string, row int, template string, held string")
    got = Counter((r.doc_id, r.template) for r in licenses.scan_licenses(df).collect())
    assert got == {(None, "MIT grant"): 2, (7, "MIT grant"): 2, (7, "CC-BY-SA-4.0 notice"): 1, (8, "CC-BY-SA-4.0 notice"): 1}
    assert [r.first_word for r in licenses.scan_licenses(df.where("doc_id = 8")).collect()] == [9000]


# 4 token counts


def test_token_counts_match_the_library(spark, awkward, empty):
    from tokenizers import Tokenizer

    path = queries.vocabulary()
    tok, rng = Tokenizer.from_file(path), random.Random(1)
    alphabet = ["a", "The", " ", "  ", "\n", "\t", " ", "　", "é", "1", "٣", ".", "'s", "'re", "'", "<|endoftext|>", "<|", "😀", "​", "\x85", "漢", "\r\n", "²", "\U00011de0", "\x1c", "hello", " world"]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randint(0, 20)))) for i in range(2000)] + [(5000, prose(1, 5000))]
    got = {r.doc_id: r for r in tokencount.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()}
    for (i, t), e in zip(rows, tok.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        assert (got[i].n_tokens, got[i].n_bytes) == (len(e.ids), len(t.encode())), t
    assert tokencount.count_tokens(awkward, path).where("n_tokens IS NULL").count() == 0
    assert tokencount.count_tokens(awkward, path).where("doc_id = 0").first().n_tokens == 0
    assert tokencount.count_tokens(empty, path).count() == 0


def test_whole_tokens_are_single_tokens():
    from tokenizers import Tokenizer

    whole = sorted(tokencount.whole_tokens(queries.vocabulary()))
    tok = Tokenizer.from_file(queries.vocabulary())
    assert len(whole) > 40_000 and all(len(e.ids) == 1 for e in tok.encode_batch(whole[::37], add_special_tokens=False))


# 5 n-gram join


def join_by_hand(rows):
    sets, parent = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    links, others = Counter(), defaultdict(set)
    for a, b in itertools.combinations(range(len(rows)), 2):
        same = (rows[a][1] or "") == (rows[b][1] or "")
        if same or (sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])):
            links[a] += 1
            links[b] += 1
            parent[max(find(a), find(b))] = min(find(a), find(b))
            if not same:
                others[a].add(rows[b][1])
                others[b].add(rows[a][1])
    ids = defaultdict(list)
    for a in range(len(rows)):
        if rows[a][0] is not None:
            ids[find(a)].append(rows[a][0])
    return [(rows[a][0], min(ids[find(a)], default=None), links[a], len(others[a])) for a in range(len(rows))]


def near_copies():
    rng, rows = random.Random(4), []
    for g in range(25):
        w = prose(g, rng.randint(3, 150)).split()
        for _ in range(rng.choice([1, 1, 2, 6, 20])):
            x = list(w)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                x[rng.randrange(len(x))] = rng.choice(["kel", "mor", "tis"])
            rows.append((len(rows) * 3 + 1, " ".join(x)))
    return rows


@pytest.mark.parametrize(("block", "bytes_", "broadcast"), [(1000, 1 << 24, 200_000), (3, 1 << 24, 0), (1000, 900, 0)])
def test_ngram_join_matches_all_pairs(spark, monkeypatch, block, bytes_, broadcast):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", bytes_)
    monkeypatch.setattr(ngram_join, "MAX_BROADCAST_TEXTS", broadcast)
    rows = near_copies()
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted((r.doc_id, r.class_id, r.n_links, r.text_links) for r in got.collect()) == sorted(join_by_hand(rows))


def test_ngram_join_awkward_rows(spark, awkward, empty):
    got = ngram_join.ngram_join(awkward).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.text_links) for r in got), key=key) == sorted(join_by_hand([r[:2] for r in awkward_rows()]), key=key)
    kept = ngram_join.keep_one(awkward)
    assert kept.columns == awkward.columns
    classes = {r.class_id for r in got}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(classes)
    assert ngram_join.ngram_join(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    import numpy as np

    rng = np.random.default_rng(0)
    base = rng.integers(0, 256, (20_000, ngram_join.VALUES)).astype(np.uint8)
    for similarity, least in ((0.8, 0.9999), (0.95, 1.0)):
        other = np.where(rng.random(base.shape) < similarity, base, rng.integers(0, 256, base.shape)).astype(np.uint8)
        assert ngram_join.survive(base, other).mean() >= least
    assert ngram_join.survive(base, rng.permutation(base)).mean() < 1e-3


@pytest.mark.parametrize("hub", [1000, 5])
def test_components_match_union_find(spark, monkeypatch, hub):
    monkeypatch.setattr("fleetlens.llm.components.HUB", hub)
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(1, 60)] + [(5, 5)]
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {a: find(a) for a in parent}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# 6 toxicity


def toxic_corpus(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(600):
        bad = rng.random() < 0.2
        w = prose(i, 60).split()
        for _ in range(4 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["gloop", "snarf", "krimpel"]) + rng.choice(["", "s", "ing"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(docs), dict(labels)


def test_toxicity_on_held_out_rows(spark):
    docs, labels, _, truth = toxic_corpus(spark)
    index = toxicity.train(docs, labels)
    assert not any(zlib.crc32(str(i).encode()) % 4 == 2 for i in index.ids)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, index).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 100 and sum(got[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    assert {r.doc_id: r.score for r in toxicity.score_toxicity(docs, toxicity.train(docs, flipped)).collect()} == {i: r.score for i, r in got.items()}


def cosines_by_hand(index, examples, queries):
    """Dense TF-IDF vectors from plain counts of words and openings, and all cosines."""
    import numpy as np

    def counts(t):
        w = [x.strip(toxicity.EDGE) for x in (t or "").lower().split()]
        return Counter("w" + x for x in w if x) + Counter("o" + x[:4] for x in w if len(x) > 4)

    own, n, n1 = [counts(t) for t, _ in examples], len(examples), sum(y for _, y in examples)
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*own)))}
    weight = np.zeros(len(vocabulary))
    for t, k in vocabulary.items():
        df, df1 = sum(t in c for c in own), sum(t in c for c, (_, y) in zip(own, examples, strict=True) if y)
        g = 0.0
        for seen, due in ((df1, df * n1), (df - df1, df * (n - n1)), (n1 - df1, (n - df) * n1), (n - n1 - df + df1, (n - df) * (n - n1))):
            g += 2 * seen * math.log(seen * n / due) if seen else 0.0
        weight[k] = math.log(n / df) * g / (g + toxicity.HALF_WEIGHT)

    def dense(c):
        v = np.zeros(len(vocabulary))
        for t, k in c.items():
            if t in vocabulary:
                v[vocabulary[t]] = (1 + math.log(k)) * weight[vocabulary[t]]
        return v / (np.sqrt(v @ v) or 1.0)

    return np.array([dense(counts(q)) for q in queries]) @ np.array([dense(c) for c in own]).T


def test_neighbours_and_scores_match_brute_force(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(toxicity, "BLOCK", 4)
    docs, labels, texts, truth = toxic_corpus(spark)
    index = toxicity.train(docs, labels)
    assert index.blocks > 50 and len(index.ids) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in truth)  # clean examples too
    queries_ = [*list(texts.values())[:200], "", None, "zzz qqq", "gloop " * 70_000 + prose(3)]
    want = cosines_by_hand(index, [(texts[i], truth[i]) for i in index.ids], queries_)
    p, cosine, found = index.score(pa.array(queries_))
    base = (sum(truth[i] for i in index.ids) + 0.5) / (len(index.ids) + 1)
    for q in range(len(queries_)):
        order = np.argsort(-np.round(want[q], 10), kind="stable")[: toxicity.NEIGHBOURS]
        assert np.allclose(cosine[q], np.maximum(want[q][order], 0), atol=1e-9)
        s = np.sort(want[q])[::-1][: toxicity.NEIGHBOURS] ** 2
        assert abs((cosine[q] ** 2).sum() - s.sum()) < 1e-6
        if want[q].max() < 1e-9:
            assert p[q] == pytest.approx(base)
        else:
            toxic = (cosine[q] ** 2 * index.labels[found[q]]).sum()
            vote = (toxicity.PRIOR_WEIGHT * base + toxic) / (toxicity.PRIOR_WEIGHT + (cosine[q] ** 2).sum())
            odds = index.curve[0] * math.log(min(max(vote, 1e-6), 1 - 1e-6) / (1 - min(max(vote, 1e-6), 1 - 1e-6))) + index.curve[1]
            assert p[q] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_a_long_example_is_nearest_to_itself(spark):
    """Counts are not capped: 70,000 times one word."""
    import pyarrow as pa

    long = "gloop " * 70_000 + prose(7)
    index = toxicity.index_of(["a", "b", "c", "d"], [1, 0, 1, 0], [long, prose(8), "gloop " + prose(9), prose(10)])
    _, cosine, found = index.score(pa.array([long]))
    assert index.ids[found[0][0]] == "a" and cosine[0][0] == pytest.approx(1.0)


def test_toxicity_awkward_rows(spark, awkward, empty):
    docs, labels, *_ = toxic_corpus(spark)
    index = toxicity.train(docs, labels)
    got = toxicity.score_toxicity(awkward, index).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert toxicity.score_toxicity(empty, index).count() == 0
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    none = toxicity.train(awkward, odd)
    twice = toxicity.train(awkward, spark.createDataFrame([(10, 1), (4, 0), (5, 0), (0, 0)], "doc_id long, toxic int"))
    assert sorted(twice.ids) == sorted(i for i in (0, 4, 5, 10) if zlib.crc32(str(i).encode()) % 4 != 2)  # an id with two rows is one example
    assert not none.ids and toxicity.score_toxicity(awkward, none).count() == awkward.count()


# 7 decontamination


def test_decontamination(spark, awkward, empty, monkeypatch):
    items = [(1, "Tom Smith has 5 apples and gives 3 apples to Anna. How many apples does he have after 2 days?"), (2, prose(50, 30)), (3, prose(51, 14)), (4, None), (5, ""), (6, "too short"), (2, prose(50, 30))]
    other = "Later Maria Lee has 12 apples and gives 7 apples to Bob. How many apples does he have after 9 days? Well."
    mixed = "Later Maria Lee has 12 apples and gives 7 grams to Bob. Nothing of this is a question about fruit or days at all."
    docs = [(1, other), (2, prose(60, 50) + " " + prose(50, 30) + " " + prose(61, 50)), (3, prose(62)), (4, prose(51, 14)), (5, mixed), (6, None), (7, "too short"), (8, prose(63, 40) + " " + " ".join(prose(50, 30).split()[:20]) + " " + prose(64))]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 1, "reparameterised"), (2, 2, "verbatim"), (4, 3, "verbatim"), (8, 2, "verbatim"), (7, 6, "verbatim")}
    for size in (decontam.INDEX_BYTES, 100):  # by one index, and by the join of windows
        monkeypatch.setattr(decontam, "INDEX_BYTES", size)
        assert {(r.doc_id, r.item_id, r.kind) for r in decontam.contaminated(d, b).collect()} == want
        assert {r.doc_id for r in decontam.drop_contaminated(d, b).collect()} == {3, 5, 6}
        narrow = decontam.contaminated(d, b.selectExpr("cast(item_id AS int) AS item_id", "text"))
        assert narrow.schema["item_id"].dataType.simpleString() == "int" and {(r.doc_id, r.item_id, r.kind) for r in narrow.collect()} == want
        named = decontam.contaminated(d, b.selectExpr("concat('q', item_id) AS item_id", "text"))
        assert {(r.doc_id, r.item_id) for r in named.collect()} == {(i, f"q{k}") for i, k, _ in want}
    assert decontam.contaminated(awkward, b).count() == 0
    assert decontam.drop_contaminated(awkward, b).count() == awkward.count() and decontam.drop_contaminated(awkward, b).columns == awkward.columns
    assert decontam.contaminated(empty, b).count() == 0 and decontam.contaminated(d, b.limit(0)).count() == 0


def test_slots_must_stand_for_the_same_value():
    index = decontam.Index([(1, "take 5 of them and then 5 of those and 5 more of these and again 5 of all")])
    canon = decontam.Canon()
    assert index.find(canon, "take 8 of them and then 8 of those and 8 more of these and again 8 of all")[0][4] == "reparameterised"
    assert not index.find(canon, "take 8 of them and then 9 of those and 1 more of these and again 2 of all")


def test_values_are_assigned_one_to_one():
    text = "when {} coins went to {} the keeper of this small house by the sea he gave another {} coins to {} before the long winter came over all the land"
    index, canon = decontam.Index([(1, text.format(5, "Anna", 7, "Bob"))]), decontam.Canon()
    assert index.find(canon, text.format(9, "Zed", 4, "Kim"))[0][4] == "reparameterised"
    assert not index.find(canon, text.format(9, "Zed", 9, "Zed"))
    assert decontam.one_to_one({"5": Counter({"9": 2}), "7": Counter({"9": 1, "8": 1})}) == 0.75


def test_the_join_finds_what_the_index_finds(spark, monkeypatch):
    rng = random.Random(12)
    items = [(i, prose(800 + i, rng.randint(1, 40))) for i in range(40)] + [(99, "2, 4, 8, 16, 32, 64?"), (98, "go go go go go go go go go go go go go go go go go go")]
    docs = [(i, " ".join([prose(i, 30), *(items[rng.randrange(len(items))][1] for _ in range(rng.randint(0, 2))), prose(i + 500, 30)])) for i in range(120)]
    docs += [(500, docs[0][1]), (501, None), (502, "Then: 2, 4, 8, 16, 32, 64? No.")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, decontam.contaminated(d, b).collect()))
    assert len(want) > 60
    monkeypatch.setattr(decontam, "INDEX_BYTES", 0)
    assert sorted(map(tuple, decontam.contaminated(d, b).collect())) == want


# 8 compression


def test_compression_verdict_matches_plain_definition(spark):
    import zstandard

    pack, rng = zstandard.ZstdCompressor(level=3).compress, random.Random(13)
    noise = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789", k=9)) for _ in range(n))
    rows = [(k, " ".join(prose(k * 40 + j, 90) for j in range(rng.randint(1, 16))) + rng.choice(["", " " + "la " * 2500, " " + noise(300), " " + noise(140)])) for k in range(60)]
    rows += [(100, " ".join(prose(5000 + j, 95) for j in range(9)) + " " + "la " * 600)]  # a junk tail shorter than half a chunk
    got = {r.doc_id: r for r in compression.compression_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        raw, cuts = t.encode(), []
        if len(raw) > 4096:
            cuts = [raw[a : a + 4096] for a in range(0, len(raw), 4096)]
            if len(cuts[-1]) < 2048:
                cuts = [*cuts[:-2], cuts[-2] + cuts[-1]]
        assert b"".join(cuts) in (raw, b"")  # every byte meets the chunk rule
        bad = sum(not 0.40 <= len(pack(c)) / len(c) <= 0.66 for c in cuts)
        ratio = len(pack(raw)) / len(raw)
        low, high = next((a, b) for top, a, b in compression.BANDS if len(raw) <= top)
        assert (got[i].bad_chunks, got[i].n_chunks, got[i].zstd_ratio) == (bad, len(cuts), ratio)
        assert got[i].kept == (not got[i].base_failed and bad <= 0.3 * len(cuts) and low <= ratio <= high)


def test_compression_rules(spark, awkward, empty):
    rng = random.Random(7)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=12)) for _ in range(200))
    english = "The harbour was quiet when the first boats came back from the northern banks, heavy with cod and the smell of salt. Nobody spoke much; a boy counted the crates, an old woman mended a torn net by the wall, and somewhere behind the sheds a radio played songs that most of them had forgotten years ago. By noon the market had filled with buyers from three valleys, each certain that the others were paying too little."
    rows = [(1, english), (2, noise), (3, "spam " * 400), (4, "few words only"), (5, english + " " + "ha " * 3000)]
    got = {r.doc_id: r for r in compression.compression_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].kept for i in range(1, 6)] == [True, False, False, False, False]
    assert not got[2].base_failed and got[3].base_failed and got[4].base_failed
    for i, t in rows:
        assert (got[i].n_words, got[i].word_chars) == (len(words(t)), sum(map(len, words(t))))
        assert got[i].base_failed == (got[i].n_words < 50 or 100 * got[i].n_repeat_words > 50 * got[i].n_words)
    out = compression.compression_rules(awkward).collect()
    assert len(out) == awkward.count() and all(not r.kept for r in out if r.base_failed)
    assert compression.compression_rules(empty).count() == 0


# 9 sharding


def shards_by_hand(rows, n_shards=24):
    order = sorted(rows, key=lambda r: (hashlib.md5((r[1] or "").encode()).hexdigest(), -1 if r[0] is None else r[0]))
    size = [len((t or "").encode()) + 8 for _, t in order]
    total, off, at, start, out, slots, weight = sum(size), 0, None, 0, [], Counter(), Counter()
    for (_, t), s in zip(order, size, strict=True):
        weight[t or ""] += s
    for (i, t), s in zip(order, size, strict=True):
        if (t or "") != at:
            at, start = t or "", off
        anchor = start if weight[at] * n_shards <= total else off
        shard = min(n_shards - 1, (2 * anchor + s) * n_shards // (2 * total))
        out.append((i, s, zlib.crc32((t or "").encode()), shard, slots[shard]))
        slots[shard] += 1
        off += s
    return out


@pytest.mark.parametrize("parts", ["1", "4", "13"])
def test_sharding_matches_prefix_sums(spark, parts):
    rng = random.Random(9)
    rows = [(i, prose(rng.randrange(200), 40)) for i in range(400)] + [(1000 + i, "the same text") for i in range(900)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == sorted(shards_by_hand(rows))
    loads, homes = Counter(), defaultdict(set)
    for r in got:
        loads[r.shard] += r.size
        homes[r.text_crc32].add(r.shard)
    assert max(loads.values()) - min(loads.values()) < 0.1 * sum(loads.values()) / 24 + 2400
    assert len(homes.pop(zlib.crc32(b"the same text"))) > 4 and all(len(h) == 1 for h in homes.values())  # only the heavy group is cut


@pytest.mark.parametrize("row_bytes", [1 << 26, (1 << 27) - 50, 1 << 28])
def test_sharding_of_large_totals(spark, monkeypatch, row_bytes):
    """Totals below 2^30 bytes, from there to 2^31, and above."""
    monkeypatch.setattr(sharding, "ROW_BYTES", row_bytes)
    rows = [(i, prose(i, 5 + i % 3)) for i in range(12)]
    total = sum(len(t) + row_bytes for _, t in rows)
    assert total >> 30 == {1 << 26: 0, (1 << 27) - 50: 1, 1 << 28: 3}[row_bytes]
    want, off = {}, 0
    for i, t in sorted(rows, key=lambda r: hashlib.md5(r[1].encode()).hexdigest()):
        want[i] = (2 * off + len(t) + row_bytes) * 24 // (2 * total)
        off += len(t) + row_bytes
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.shard for r in sharding.assign_shards(docs).collect()} == want
    assert {r.row.doc_id: r.shard for r in sharding.assign_shards(docs, carry=True).collect()} == want


def test_sharding_just_below_a_cut(spark, monkeypatch):
    """Of two rows in four shards the middles lie a few bytes of a billion before 1 and 3, which six decimals do not tell from them."""
    monkeypatch.setattr(sharding, "ROW_BYTES", 500_000_000)
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    longer = next("x" * k for k in range(2, 99) if digest("x" * k) > digest("x"))
    docs = spark.createDataFrame([(1, "x"), (2, longer)], "doc_id long, text string")
    assert {r.doc_id: r.shard for r in sharding.assign_shards(docs, 4).collect()} == {1: 0, 2: 2}


def test_sharding_awkward_rows(awkward, empty):
    got = sharding.assign_shards(awkward)
    assert got.count() == awkward.count() and {r.shard for r in got.collect()} <= set(range(24))
    by = defaultdict(list)
    for r in got.collect():
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.assign_shards(awkward, carry=True).select("row.*").columns == awkward.columns
    assert sharding.assign_shards(empty).count() == 0


# 10 WARC


def test_warc_round_trip(spark):
    rows = [(1, "u", "<p>a</p>"), (2, "u", "<p>a</p>"), (3, "v", ""), (4, None, None), (5, "w\nx", "é€😀\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (9, "z", "<p>a</p>"), (6, "q", "x" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(i, last.get(h or "", 0))
    for i, _, h in rows:
        raw = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if last[h or ""] == i else ("revisit", last[h or ""]))
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_warc_of_awkward_ids(spark):
    rows = [("a:b c/é", "u", "one", 1), ("b%", "u", "one", 1), (None, "u", "two", 1), (None, None, None, 1), ("", "u", "three", 1), ("z\n", "u", "four", 1), ("z\n", "u", "four", 1)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string, payload int").withColumnRenamed("payload", "record_type")
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages).collect())
    assert got == {("a:b c/é", "revisit", "b%"): 1, ("b%", "response", None): 1, (None, "response", None): 2, ("", "response", None): 1, ("z\n", "response", None): 2}


def test_warc_reads_foreign_archives(spark, tmp_path):
    import gzip

    path = str(tmp_path)
    made = [
        b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <urn:x:0>\r\ncontent-length: 5\r\n\r\nhello\r\n\r\n",
        b"WARC/1.0\r\nwarc-type: response\r\nwarc-record-id: <urn:x:1>\r\ncontent-type: application/http; msgtype=response\r\ncontent-length: 41\r\n\r\nHTTP/1.1 200 OK\r\ncontent-length: 3\r\n\r\nabc\r\n\r\n",
    ]
    with open(f"{path}/one.warc.gz", "wb") as f:
        f.write(b"".join(map(gzip.compress, made)))
    with open(f"{path}/two.warc", "wb") as f:
        f.write(b"".join(made))
    got = sorted((r.record_id, r.record_type, r.payload_digest, r.payload_bytes, bytes(r.payload)) for r in warc.read_archives(spark, path).collect())
    assert got == sorted([("urn:x:0", "warcinfo", None, 5, b"hello"), ("urn:x:1", "response", None, 3, b"abc")] * 2)
    assert warc.read_archives(spark, path, payload=False).where("record_type = 'response'").count() == 2
    warc.write_archives(warc.plan_records(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")), path)  # beside what is there
    assert warc.read_archives(spark, path).count() == 5


def test_warc_source_pushes_filters_and_skips_payloads(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i % 3}" * 50) for i in range(30)], "page_id long, url string, html string").coalesce(1)
    path = warc.fresh_path(spark, "test")
    warc.register(spark)
    warc.plan_records(pages).coalesce(1).write.format("warc").mode("append").option("splitbytes", 500).save(path)
    read = warc.read_archives(spark, path, payload=False)
    assert read.rdd.getNumPartitions() > 3 and read.count() == 30
    only = read.where("record_type = 'response' AND target_uri IN ('u27', 'u28', 'u1')")
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "record_type#" in plan and "= response" not in plan  # the source has taken the filter
    assert {r.target_uri for r in only.collect()} == {"u27", "u28"} and all(r.payload is None for r in only.collect())
    assert {bytes(r.payload).decode()[:6] for r in warc.read_archives(spark, path).where("record_type = 'response'").collect()} == {"page 0", "page 1", "page 2"}


def test_warc_pushdown_only_takes_what_it_can_check():
    from pyspark.sql.datasource import EqualTo, GreaterThan

    reader = warc.WarcReader({"path": "/nowhere"}, False)
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("payload_bytes",), 3)]))
    assert len(left) == 1 and reader.wanted == {"record_type": {"response"}}


def test_warc_base32_equals_the_standard(spark):
    from pyspark.sql import functions as F

    rows = [(hashlib.sha1(str(i).encode()).hexdigest().upper(),) for i in range(50)]
    for r in spark.createDataFrame(rows, "h string").select("h", warc.base32(F.col("h")).alias("b")).collect():
        assert r.b == base64.b32encode(bytes.fromhex(r.h)).decode()
