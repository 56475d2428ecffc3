"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

The examples are a bounded, hash-chosen sample of the labelled documents that
may be learnt from, clean ones and toxic ones alike.  Terms are all words and
their opening letters (inflected forms share them); none is left out.  A term
weighs its logarithmic count, its inverse document frequency, and how much the
two labels differ in it: ``G / (G + HALF_WEIGHT)`` of the likelihood ratio
``G``, which nears 1 for telling terms and is small, not zero, for others.

The inverted index is cut into blocks of examples.  Of terms that many examples
have (at least one in ``COMMON``) it knows the largest weight in each block; the
postings of rarer terms are short and added up as they are.  Both together bound
the cosines in every block.  Blocks are visited from the highest bound on, and a
block that can hold no nearer example of a text is skipped for it.  The
neighbours found are exactly the nearest.  Texts are searched some at a time, so
that a visit is one matrix product.

Neighbours vote with their squared cosine against a prior of the share of toxic
examples.  A logistic curve, fitted to votes on examples whose own fold was
left out of index and weights, turns the vote into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, field, first_by_hash, written

#: Labelled documents that become examples, the first by a hash of their id; bytes of their texts together, and of one.
MAX_EXAMPLES, MAX_EXAMPLE_BYTES, MAX_TEXT_BYTES = 3000, 64 << 20, 1 << 20
#: Likelihood ratio at which a term has half of its weight.
HALF_WEIGHT = 30.0
#: Opening letters that are a term beside the longer word.
OPENING = 4
#: Examples of a block, neighbours that vote, and the weight of the prior.
BLOCK, NEIGHBOURS, PRIOR_WEIGHT = 32, 30, 0.02
#: Terms of at least one example in so many have block maxima; the postings of the others are short.
COMMON = 32
#: Folds of the examples, and examples scored, that fit the curve from votes to probabilities.
FOLDS, CURVE_EXAMPLES = 4, 2000
THRESHOLD = 0.3
EDGE = "\"'()[]{}.,;:!?…“”‘’«»¿¡*#$%&|<>-_"
#: Texts searched at a time, and blocks of the first visit; later visits double.
TOGETHER, VISIT = 128, 4


def terms_of(text: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """All words in lower case without punctuation at their ends, their openings (null for short ones), and each one's text."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(text, "")))
    word = pc.utf8_trim(split.flatten(), characters=EDGE)
    row = np.repeat(np.arange(len(text)), np.diff(split.offsets.to_numpy()))
    some = pc.greater(pc.utf8_length(word), 0)
    word, row = word.filter(some), row[some.to_numpy(zero_copy_only=False)]
    return word, pc.if_else(pc.greater(pc.utf8_length(word), OPENING), pc.utf8_slice_codeunits(word, 0, OPENING), None), row


def counted(row: np.ndarray, term: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term), sorted, and how often each occurs."""
    key, times = np.unique(row.astype(np.int64) * max(n_terms, 1) + term, return_counts=True)
    return key // max(n_terms, 1), key % max(n_terms, 1), times


def likelihood_ratio(df1: np.ndarray, df: np.ndarray, n1: int, n: int) -> np.ndarray:
    """G squared of each term's counts by label: ``df1`` of the ``n1`` toxic examples, ``df`` of all ``n``."""
    seen = np.stack([df1, df - df1, n1 - df1, n - n1 - df + df1]).astype(float)
    due = np.stack([df * n1, df * (n - n1), (n - df) * n1, (n - df) * (n - n1)]) / n
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * np.where(seen > 0, seen * np.log(seen / due), 0.0).sum(0)


def unit(row: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """The weights of each row at length 1."""
    norm = np.sqrt(np.bincount(row, w * w, minlength=n))[row]
    return np.divide(w, norm, out=np.zeros_like(w), where=norm > 0)


class Index:
    """Block-max inverted index over examples.

    ``vocabulary`` lists terms, words marked ``w`` and openings marked ``o``;
    example ``owner`` holds ``term`` ``times`` times, in order of owner and term.
    """

    def __init__(self, ids: list, labels: np.ndarray, vocabulary: pa.Array, owner: np.ndarray, term: np.ndarray, times: np.ndarray, curve: tuple[float, float] = (1.0, 0.0)):
        n, n1, size = len(ids), int(labels.sum()), len(vocabulary)
        self.base, self.curve = float((n1 + 0.5) / (n + 1)) if n else 0.1, curve
        df = np.bincount(term, minlength=size)
        self.weights = np.zeros(size)
        if 0 < n1 < n:  # labels that do not differ tell nothing
            ratio = likelihood_ratio(np.bincount(term, labels[owner], minlength=size), df, n1, n)
            self.weights = np.log(n / np.maximum(df, 1)) * ratio / (ratio + HALF_WEIGHT) * (df > 0)
        # terms by number: the most frequent first
        order = np.argsort(-df, kind="stable")
        number = np.empty(size, np.int64)
        number[order] = np.arange(size)
        self.vocabulary, self.weights, term = vocabulary.take(pa.array(order)), self.weights[order], number[term]
        self.common = int((df * COMMON >= max(n, 1)).sum())
        w = unit(owner, (1 + np.log(times)) * self.weights[term], n)
        # examples of a block are alike: those of one heaviest common term, and near in length
        near = term < self.common
        best, most = np.zeros(n), np.full(n, size)
        np.maximum.at(best, owner[near], w[near])
        top = near & (w >= best[owner])
        np.minimum.at(most, owner[top], term[top])
        line = np.lexsort((np.arange(n), np.bincount(owner, minlength=n), most))
        at = np.empty(n, np.int64)
        at[line] = np.arange(n)
        self.ids, self.labels, self.blocks = [ids[i] for i in line], labels[line], -(-n // BLOCK)
        doc = at[owner]
        by_term = np.lexsort((doc, term))
        self.start = np.searchsorted(term[by_term], np.arange(size + 1))
        self.doc, self.weight = doc[by_term].astype(np.int32), w[by_term]
        self._prepare()

    def _prepare(self) -> None:
        c, places = self.common, self.blocks * BLOCK
        upto = int(self.start[c]) if c else 0
        self.full = np.zeros((c, places))  # the common terms' weights, written out
        self.full[np.repeat(np.arange(c), np.diff(self.start[: c + 1])), self.doc[:upto]] = self.weight[:upto]
        self.top = self.full.reshape(c, self.blocks, BLOCK).max(2) if places else np.zeros((c, 0))
        kind, rest = pc.utf8_slice_codeunits(self.vocabulary, 0, 1), pc.utf8_slice_codeunits(self.vocabulary, 1)
        self.known = [(rest.filter(pc.equal(kind, k)), np.flatnonzero(pc.equal(kind, k).to_numpy(zero_copy_only=False))) for k in "wo"]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("full", "top", "known")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._prepare()

    def vectors(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts' terms that tell something, as row, number of the term, and weight.

        A term that no example has weighs nothing, as its likelihood ratio is 0.
        """
        word, opening, row = terms_of(text)
        rows, terms = [], []
        for found, (known, number) in zip((word, opening), self.known, strict=True):
            at = pc.index_in(found, value_set=known, skip_nulls=True) if len(known) else pa.nulls(len(found), pa.int32())
            here = at.is_valid().to_numpy(zero_copy_only=False)
            rows.append(row[here])
            terms.append(number[at.drop_null().to_numpy(zero_copy_only=False)])
        row, term, times = counted(np.concatenate(rows), np.concatenate(terms), len(self.vocabulary))
        return self.weighed(row, term, times, len(text))

    def weighed(self, row: np.ndarray, term: np.ndarray, times: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w = (1 + np.log(times)) * self.weights[term]
        some = w > 0
        return row[some], term[some], unit(row[some], w[some], n)

    def nearest(self, row: np.ndarray, term: np.ndarray, w: np.ndarray, n: int, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """For each of n vectors the k examples of highest positive cosine, ties by place: cosines (0 for none) and places."""
        places = self.blocks * BLOCK
        if not places or not n:
            return np.zeros((n, k)), np.zeros((n, k), np.int64)
        often = term < self.common
        q = np.zeros((n, self.common))
        q[row[often], term[often]] = w[often]
        rare = term[~often]
        length = self.start[rare + 1] - self.start[rare]
        posting = np.arange(int(length.sum())) + np.repeat(self.start[rare] - np.concatenate(([0], np.cumsum(length)[:-1])), length) if len(rare) else np.empty(0, np.int64)
        exact = np.bincount(np.repeat(row[~often] * places, length) + self.doc[posting], np.repeat(w[~often], length) * self.weight[posting], minlength=n * places)
        exact = exact.reshape(n, self.blocks, BLOCK)
        bound = exact.max(2) + q @ self.top
        line = np.argsort(-bound.max(0), kind="stable")
        cosine, least = np.zeros((n, self.blocks, BLOCK)), np.zeros(n)
        done, step = 0, VISIT
        while done < len(line):
            visit = line[done : done + step]
            live = np.flatnonzero((bound[:, visit] >= np.maximum(least - 1e-9, 1e-12)[:, None]).any(1))
            if len(live):
                at = (visit[:, None] * BLOCK + np.arange(BLOCK)).ravel()
                cosine[np.ix_(live, visit)] = exact[np.ix_(live, visit)] + (q[live] @ self.full[:, at]).reshape(len(live), len(visit), BLOCK)
                if places > k:
                    least[live] = np.partition(cosine[live].reshape(len(live), places), places - k, axis=1)[:, places - k]
            done, step = done + step, 2 * step
        cosine = np.round(cosine.reshape(n, places), 10)  # the order of summation does not show
        pad = np.zeros((n, max(0, k - places)))
        cosine = np.concatenate([cosine, pad], 1)
        order = np.argsort(-cosine, axis=1, kind="stable")[:, :k] if places <= 4 * k else self._first(cosine, k)
        return np.take_along_axis(cosine, order, 1), np.minimum(order, max(len(self.ids) - 1, 0))

    @staticmethod
    def _first(cosine: np.ndarray, k: int) -> np.ndarray:
        """Places of the k largest of each row, ties by place."""
        least = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, -k]
        out = np.empty((len(cosine), k), np.int64)
        for i, x in enumerate(cosine):
            at = np.flatnonzero(x >= least[i])
            out[i] = at[np.argsort(-x[at], kind="stable")[:k]]
        return out

    def vote(self, cosine: np.ndarray, found: np.ndarray) -> np.ndarray:
        """The neighbours' share for toxic, by squared cosine, with the prior."""
        s = cosine * cosine
        return (PRIOR_WEIGHT * self.base + (s * self.labels[found]).sum(1)) / (PRIOR_WEIGHT + s.sum(1)) if len(self.labels) else np.full(len(s), self.base)

    def probability(self, cosine: np.ndarray, found: np.ndarray) -> np.ndarray:
        a, b = self.curve
        p = 1 / (1 + np.exp(-(a * logit(self.vote(cosine, found)) + b)))
        return np.where(cosine[:, 0] > 0, p, self.base)

    def score(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities, cosines and places of the neighbours of each text."""
        row, term, w = self.vectors(text)
        out = []
        for at in range(0, len(text), TOGETHER):
            here = slice(*np.searchsorted(row, (at, at + TOGETHER)))
            cosine, found = self.nearest(row[here] - at, term[here], w[here], min(TOGETHER, len(text) - at))
            out.append((self.probability(cosine, found), cosine, found))
        return tuple(map(np.concatenate, zip(*out, strict=True)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_curve(votes: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve from the votes' log odds to the labels, by Newton steps.

    A ridge holds the curve near (1, 0), which leaves votes as they are where there are few.
    """
    x = np.stack([logit(votes), np.ones(len(votes))], 1)
    at, ridge = np.array([1.0, 0.0]), np.array([2.0, 2.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        grad = x.T @ (p - labels) + ridge * (at - (1.0, 0.0))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), grad)
        at = at - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 0.05), float(at[1])  # a higher vote never scores less


def calibrated(ids: list, labels: np.ndarray, vocabulary: pa.Array, owner: np.ndarray, term: np.ndarray, times: np.ndarray) -> Index:
    """An index of all examples, its curve fitted on folds that were left out of index and weights."""
    votes, truth = [], []
    for fold in range(FOLDS):
        out = np.arange(len(ids)) % FOLDS == fold
        rest, left = np.flatnonzero(~out), np.flatnonzero(out)[: CURVE_EXAMPLES // FOLDS]
        if not len(left) or not len(rest):
            continue
        place = np.empty(len(ids), np.int64)
        place[rest] = np.arange(len(rest))
        own = ~out[owner]
        index = Index([ids[i] for i in rest], labels[rest], vocabulary, place[owner[own]], term[own], times[own])
        number = np.empty(len(vocabulary), np.int64)
        number[np.argsort(-np.bincount(term[own], minlength=len(vocabulary)), kind="stable")] = np.arange(len(vocabulary))
        for at in range(0, len(left), TOGETHER):
            some = left[at : at + TOGETHER]
            place[some] = np.arange(len(some))
            own = np.isin(owner, some)
            order = np.lexsort((number[term[own]], place[owner[own]]))
            vector = index.weighed(place[owner[own]][order], number[term[own]][order], times[own][order], len(some))
            cosine, found = index.nearest(*vector, len(some))
            near = cosine[:, 0] > 0
            votes += index.vote(cosine, found)[near].tolist()
            truth += labels[some][near].tolist()
    curve = fit_curve(np.array(votes), np.array(truth, dtype=float)) if votes else (1.0, 0.0)
    return Index(ids, labels, vocabulary, owner, term, times, curve)


def marked(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The marked terms of all texts, and each one's text."""
    word, opening, row = terms_of(text)
    long = opening.is_valid().to_numpy(zero_copy_only=False)
    return pa.concat_arrays([pc.binary_join_element_wise("w", word, ""), pc.binary_join_element_wise("o", opening.drop_null(), "")]), np.concatenate([row, row[long]])


def index_of(ids: list, labels: list[int], text: list[str | None]) -> Index:
    """The calibrated index of these examples."""
    terms, row = marked(pa.array(text, pa.string()))
    coded = terms.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy() if len(terms) else np.empty(0, np.int64)  # the vocabulary's order does not depend on the texts'
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    owner, term, times = counted(row, number[coded.indices.to_numpy()] if len(terms) else np.empty(0, np.int64), len(order))
    return calibrated(ids, np.array(labels, dtype=np.int64), coded.dictionary.take(pa.array(order)), owner, term, times)


def learnable(id_col: str):
    """Rows whose labels may be learnt from: the others are held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) != 2, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Index:
    """An index of at most MAX_EXAMPLES labelled documents and MAX_EXAMPLE_BYTES of text.

    Labels that are null, held out or contradict each other, and repeated rows,
    are left out, as are ids without a document.  Of several texts of one id
    the least is taken.  Examples are read whole; a text above MAX_TEXT_BYTES
    is none.
    """
    line = F.xxhash64("id", F.lit("example"))
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & learnable(id_col))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).alias("toxic"), F.max(label_col).alias("most"))
        .where("toxic = most")
        .select("id", "toxic")
    )
    known = first_by_hash(known, MAX_EXAMPLES, [line, F.col("id")])
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.octet_length("text") <= MAX_TEXT_BYTES)
    examples, _ = written(text.join(F.broadcast(known), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).withColumn("line", line), "examples")
    size, last = 0, None
    for r in examples.select("id", "line", F.octet_length("text").alias("size")).orderBy("line", "id").collect():  # at most MAX_EXAMPLES rows
        size += r["size"]
        if size > MAX_EXAMPLE_BYTES:
            break
        last = r["line"]
    rows = [] if last is None else examples.where(F.col("line") <= last).orderBy("line", "id").collect()  # at most MAX_EXAMPLE_BYTES
    return index_of([r["id"] for r in rows], [int(r["toxic"] > 0) for r in rows], [r["text"] for r in rows])


def score_toxicity(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``score``, ``predicted``, and the three nearest neighbours as evidence.

    Null and empty texts, and texts that share no telling term with any
    example, score the share of toxic examples.  Equal texts score alike, so
    repeated rows do; among equally near examples the first in the index votes.
    Texts of any length are read whole; nothing but the text is read.  Without
    examples of both labels everything scores that share.  An empty table gives
    an empty result.  Other columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bound by MAX_EXAMPLES and MAX_EXAMPLE_BYTES

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        ix = shared.value
        p, cosine, found = ix.score(batch.column("text"))
        p = np.round(p, 9)
        near = [[{"example": str(ix.ids[i]), "similarity": c, "toxic": int(ix.labels[i])} for c, i in zip(cs[:3], at[:3], strict=True) if c > 0] for cs, at in zip(cosine.tolist(), found.tolist(), strict=True)]
        kind = pa.list_(pa.struct([("example", pa.string()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(near, kind)], names=[id_col, "score", "predicted", "evidence"])

    near = T.ArrayType(T.StructType([T.StructField("example", T.StringType()), T.StructField("similarity", T.DoubleType()), T.StructField("toxic", T.IntegerType())]))
    schema = T.StructType([field(docs, id_col), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", near)])
    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), scored, schema)
