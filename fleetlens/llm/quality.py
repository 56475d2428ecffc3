"""A quality classifier from weak labels.

Overlapping heuristic labellers vote on every document, good or bad or not at
all.  Expectation maximisation over the counts of vote patterns, of which there
are at most ``3 ** len(LABELLERS)`` whatever the corpus, estimates how often
each labeller is right and how common bad documents are; no true label is
read.  The posteriors of a bounded sample then train a linear scorer on hashed
features, which scores every document: shapes of its words, pairs of its
characters' bytes, and bands of the statistics.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, arrow_map, field, first_by_hash, texts, written
from .textstats import duplicate_lines, repeated_words, symbol_count, word_char_count, word_ids, words_of

#: Documents, chosen by a hash of their id, that train the scorer; all if there are fewer.
TRAIN_DOCS = 6000
#: Buckets of hashed shapes and bands, and of hashed pairs of bytes, which stand behind them.
BUCKETS, PAIRS = 2048, 512
#: How right labellers are taken to be at first, and the share of documents whose weight that has.
PRIOR_RIGHT, PRIOR_SHARE = 0.9, 0.05
#: Score from which a document is kept.
KEEP_FROM = 0.5

STATS = ("n_words", "symbols", "repeats", "upper", "variety", "dup_lines", "wordless", "word_len", "odd_ends", "packs")
#: A labeller: the statistics it reads, when it votes bad, when it votes good.
LABELLERS: dict[str, tuple[Callable, Callable]] = {
    "symbols": (lambda s: s["symbols"] > 0.10, lambda s: False),
    "odd_ends": (lambda s: s["odd_ends"] > 0.30 and s["n_words"] >= 5, lambda s: False),
    "wordless": (lambda s: s["wordless"] > 0.20 and s["n_words"] >= 5, lambda s: False),
    "shouting": (lambda s: s["upper"] > 0.50 and s["n_words"] >= 5, lambda s: False),
    "repeats": (lambda s: s["repeats"] > 0.40 and s["n_words"] >= 40, lambda s: False),
    "variety": (lambda s: s["variety"] < 3.0 and s["n_words"] >= 40, lambda s: False),
    "dup_lines": (lambda s: s["dup_lines"] > 0.30 and s["n_words"] >= 40, lambda s: False),
    "packs": (lambda s: s["packs"] < 0.25 and s["n_words"] >= 20, lambda s: False),
    "no_words": (lambda s: s["n_words"] < 1, lambda s: False),
    "prose_shape": (
        lambda s: False,
        lambda s: s["n_words"] >= 1 and s["symbols"] < 0.04 and s["upper"] < 0.30 and s["odd_ends"] < 0.12 and s["wordless"] < 0.08 and 2 <= s["word_len"] <= 14,
    ),
    "varied_wording": (
        lambda s: False,
        lambda s: s["n_words"] >= 1 and s["repeats"] < 0.20 and s["dup_lines"] < 0.20 and (s["packs"] > 0.30 or s["n_words"] < 20) and s["odd_ends"] < 0.30 and s["wordless"] < 0.20,
    ),
}
_LETTER = re.compile(r"[^\W\d_]")
_SHAPES = ((re.compile(r"[^\W\d_a-zà-ÿ]+"), "A"), (re.compile(r"[^\W\dA_]+"), "a"), (re.compile(r"\d+"), "0"))
_USUAL_ENDS = set(".,;:!?\"')]}”’»…-")
#: Distinct words that a task remembers.
MEMORY = 150_000


class Words(Memo):
    """What is known of a word: has a letter, ends oddly, its shape's bucket."""

    def __missing__(self, word: bytes) -> tuple[bool, bool, int]:
        if word.isalpha():  # ASCII letters only
            kind = 0 if word.islower() else 1 if word.istitle() else 2 if word.isupper() else 3
            if kind < 3:
                out = self[word] = _PLAIN[kind]
                return out
        text = word.decode("utf-8", "surrogatepass")
        shape = text
        for pattern, mark in _SHAPES:
            shape = pattern.sub(mark, shape)
        last = text.rstrip("\"')]}”’»")[-1:] or "."
        odd = not (last.isalnum() or last in _USUAL_ENDS) or text.endswith("!!")
        out = self[word] = bool(_LETTER.search(text)), odd, bucket(f"shape {shape}")
        return out


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


#: What is known of words in lower case, with a capital, and all capitals.
_PLAIN = [(True, False, bucket(f"shape {s}")) for s in ("a", "Aa", "A")]
_words = Words()


def describe(text: str) -> tuple[dict[str, float], np.ndarray, np.ndarray]:
    """Statistics of one text, and the buckets of its words' shapes and its pairs of bytes with their values."""
    if len(_words) > MEMORY:
        _words.clear()
    words, raw = words_of(text), text.encode("utf-8", "surrogatepass")
    n = len(words)
    ids, distinct = word_ids(words)
    seen = [_words[w] for w in dict.fromkeys(words)]
    times = np.bincount(ids, minlength=distinct)
    letter, odd, shape = (np.array(c) for c in zip(*seen, strict=True)) if seen else (np.zeros(0, bool), np.zeros(0, bool), np.zeros(0, int))
    chars = word_char_count(text)
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    up, low = int(codes[65:91].sum()), int(codes[97:123].sum())
    dup, lines = duplicate_lines(text)
    stats = {
        "n_words": n,
        "symbols": symbol_count(text) / max(chars, 1),
        "repeats": repeated_words(ids, distinct) / max(n, 1),
        "upper": up / max(up + low, 1),
        "variety": distinct / max(n, 1) ** 0.5,
        "dup_lines": dup / max(lines, 1),
        "wordless": float(times[~letter].sum()) / max(n, 1) if n else 0.0,
        "word_len": chars / max(n, 1),
        "odd_ends": float(times[odd].sum()) / max(n, 1) if n else 0.0,
        "packs": len(zlib.compress(raw, 1)) / max(len(raw), 1),
    }
    value = np.zeros(BUCKETS + PAIRS)
    if n:
        value[:BUCKETS] = np.bincount(shape, weights=times, minlength=BUCKETS) * (4 / n)
    value[BUCKETS:] = pairs(raw)
    at = np.flatnonzero(value)
    return stats, at, value[at]


def pairs(raw: bytes) -> np.ndarray:
    """Square roots of the shares of each bucket of neighbouring bytes."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint16)
    if len(b) < 2:
        return np.zeros(PAIRS)
    key = (((b[:-1] << np.uint16(8)) | b[1:]) * np.uint16(40503)) >> np.uint16(16 - PAIRS.bit_length() + 1)
    return np.sqrt(np.bincount(key, minlength=PAIRS) / len(key))


def vote_pattern(stats: dict[str, float]) -> str:
    """A character a labeller: b, g or -."""
    return "".join("b" if bad(stats) else "g" if good(stats) else "-" for bad, good in LABELLERS.values())


def features(stats: dict[str, float], at: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: those of ``describe``, and each statistic's band."""
    bands = [bucket(f"{k} {int(np.log2(1 + stats[k]) * 2) if k in ('n_words', 'word_len', 'variety') else int(stats[k] * 20)}") for k in STATS]
    return np.concatenate([at, bands]).astype(np.int16), np.concatenate([share, np.ones(len(bands))]).astype(np.float16)


def fit_labellers(counts: dict[str, int], rounds: int = 100, prior_bad: float = 0.2) -> tuple[dict[str, float], np.ndarray, float]:
    """Expectation maximisation: P(bad) of each vote pattern, each labeller's accuracy, the share of bad documents.

    A labeller that does not vote says nothing.  Accuracies start at
    ``PRIOR_RIGHT`` and are held there with the weight of ``PRIOR_SHARE`` of
    all documents, so a labeller whose few votes meet no other's keeps its
    good name, and none reaches 0 or 1.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}, np.full(len(LABELLERS), PRIOR_RIGHT), prior_bad
    n = np.array([counts[p] for p in patterns], dtype=float)
    votes = np.array([[{"b": 1, "g": -1, "-": 0}[c] for c in p] for p in patterns])
    right, share, weight = np.full(votes.shape[1], PRIOR_RIGHT), prior_bad, 10 + PRIOR_SHARE * n.sum()
    for _ in range(rounds):
        odds = np.log(share / (1 - share)) + votes @ np.log(right / (1 - right))
        bad = 1 / (1 + np.exp(-odds))
        agree = (n[:, None] * np.where(votes > 0, bad[:, None], np.where(votes < 0, 1 - bad[:, None], 0))).sum(0)
        cast = (n[:, None] * (votes != 0)).sum(0)
        before, right = right, np.clip((agree + PRIOR_RIGHT * weight) / (cast + weight), 0.51, 0.995)
        share = float(np.clip((n @ bad + prior_bad * 10) / (n.sum() + 10), 0.01, 0.6))
        if np.abs(before - right).max() < 1e-9:
            break
    return dict(zip(patterns, bad.tolist(), strict=True)), right, share


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, rounds: int = 150, rate: float = 0.3, shrink: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch Adagrad."""
    w, b = np.zeros(BUCKETS + PAIRS), 0.0
    if not rows:
        return w, b
    x = np.zeros((len(rows), len(w)), dtype=np.float32)
    for i, (at, value) in enumerate(rows):
        np.add.at(x[i], at, value)
    g2, gb2 = np.full(len(w), 1e-8), 1e-8
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w.astype(np.float32) + b)))
        gap = (p - good) / len(good)
        g = x.T @ gap.astype(np.float32) + shrink * w
        gb = float(gap.sum())
        g2 += g * g
        gb2 += gb * gb
        w -= rate * g / np.sqrt(g2)
        b -= rate * gb / gb2**0.5
    return w, b


class Model:
    """What scoring needs: posteriors of vote patterns, accuracies, and the scorer."""

    def __init__(self, bad: dict[str, float], right: np.ndarray, share: float, w: np.ndarray, b: float):
        self.bad, self.right, self.share, self.w, self.b = bad, right, share, w, b

    def posterior(self, votes: str) -> float:
        return 1 - self.bad.get(votes, self.share)

    def score(self, at: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.w[at] @ value.astype(float) + self.b, -30, 30))))


_MEASURED = [("votes", T.StringType()), ("at", T.BinaryType()), ("value", T.BinaryType())]


def measure(docs: DataFrame, key: str, text_col: str = "text", carry: bool = False) -> DataFrame:
    """Votes and hashed features of every row, and ``id``, its column ``key``; written once.

    With ``carry``, the row's own columns too, named c0, c1 and so on.
    """
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)] if carry else []
    body = f"c{docs.columns.index(text_col)}" if carry else "text"
    rows = docs.select(F.col(key).alias("id"), *(own or [F.col(text_col).alias("text")]))
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def measured(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t in texts(batch, body):
            stats, at, share = describe(t)
            i, v = features(stats, at, share)
            out.append((vote_pattern(stats), i.tobytes(), v.tobytes()))
        votes, at, value = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(votes), pa.array(at, pa.binary()), pa.array(value, pa.binary())], names=[*(f.name for f in kept), "votes", "at", "value"])

    return written(arrow_map(rows, measured, T.StructType([*kept, *(T.StructField(*f) for f in _MEASURED)])), "measured")[0]


def _features(at: bytes, value: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(at, np.int16), np.frombuffer(value, np.float16)


def train(measured: DataFrame) -> Model:
    """The model of a measured table.

    The scorer learns from the TRAIN_DOCS rows that come first by a hash of
    their id and features, so rows without ids are drawn like others.
    """
    counts = {r["votes"]: r["n"] for r in measured.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}  # 3 ** len(LABELLERS) rows at most
    bad, right, share = fit_labellers(counts)
    line = F.xxhash64("id", "votes", "at", "value", F.lit("scorer"))
    sample = first_by_hash(measured, TRAIN_DOCS, [line, *map(F.col, ("votes", "at", "value"))]).select("votes", "at", "value").collect()
    w, b = fit_scorer([_features(r["at"], r["value"]) for r in sample], np.array([1 - bad[r["votes"]] for r in sample]))
    return Model(bad, right, share, w, b)


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``votes``, ``posterior`` (P(good) by the labellers), ``score`` and ``kept``.

    Null and empty texts are judged as texts without words.  Very long texts
    are read whole.  Null and repeated ids do no harm; equal texts get equal
    scores; a score of exactly KEEP_FROM is kept.  An
    empty table trains nothing and gives an empty result.  Other columns are
    ignored, whatever their names.
    """
    measured = measure(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(train(measured))

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        votes = batch.column("votes").to_pylist()
        score = [shared.value.score(*_features(a, v)) for a, v in zip(batch.column("at").to_pylist(), batch.column("value").to_pylist(), strict=True)]
        posterior = list(map(shared.value.posterior, votes))
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(votes), pa.array(posterior, pa.float64()), pa.array(score, pa.float64()), pa.array([s >= KEEP_FROM for s in score])], names=[id_col, "votes", "posterior", "score", "kept"]
        )

    schema = T.StructType([field(docs, id_col), T.StructField("votes", T.StringType()), T.StructField("posterior", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    return arrow_map(measured, scored, schema)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that the classifier rejects, with all columns as they are.

    Each text is described once: its row is written beside its features.
    Awkward rows are judged as in ``score_quality``.
    """
    measured = measure(docs, id_col, text_col, carry=True)
    shared = docs.sparkSession.sparkContext.broadcast(train(measured))
    own = [T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(docs.schema.fields)]

    def good(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [shared.value.score(*_features(a, v)) >= KEEP_FROM for a, v in zip(batch.column("at").to_pylist(), batch.column("value").to_pylist(), strict=True)]
        return batch.select([f.name for f in own]).filter(pa.array(keep, pa.bool_()))

    return arrow_map(measured, good, T.StructType(own)).toDF(*docs.columns)
