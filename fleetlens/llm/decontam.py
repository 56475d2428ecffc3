"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question that was only
re-parameterised keeps its template.  Windows of ``WINDOW`` template tokens of
all documents are matched by hash against those of the benchmark.  The windows found
are put together by alignment into stretches of the document.  Where a stretch
has enough of an item's windows, or a long run of them, the slots behind the
placeholders are compared: over all windows of the stretch, each value of the
item must stand for one value of the stretch, and no two for the same.  One
stretch is enough; where none is, all together count.
Windows of mostly placeholders count where their values are the item's; with
other values they only do not break a run.  Where the windows found hold few
literal words, all values must be the item's.

A benchmark within ``INDEX_BYTES``, as is usual, is one index in every worker,
and documents are not shuffled.  For a larger one, windows of documents and
items are hash-joined, and only pairs that share as many as a find needs are
looked at; no task then holds more than one item's index at a time.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Callable
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, arrow_map, field, free, texts, written

WINDOW = 5
#: Share of an item's windows, or windows in one run (13 tokens), from which a document holds the item.
MIN_CONTAINMENT, MIN_RUN = 0.5, 9
#: Share of slot pairs that must agree with one assignment of values.
MIN_CONSISTENCY = 0.8
#: Different literal words that the windows found must hold, one more than a window can; with fewer the values must be the item's.
MIN_LITERAL = 6
#: Bytes of benchmark text that are held as one index in each worker.
INDEX_BYTES = 8 << 20
#: Distinct words that a task remembers.
MEMORY = 200_000

#: Words that are units behind a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound pounds lb lbs ml l liter liters litre litres gallon gallons "
    "ms s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent % degree degrees mph kmh v volt volts w watt watts hz"
).split()
NUMBER = re.compile(r"[+\-±]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%|[a-zµ°]{1,3})?$")
EDGE = "\"'()[]{}.,;:!?…“”‘’«»¿¡"
ENDS = re.compile(r"[.!?:…][\"')\]”’»]*$")
PLAIN, NUM, NAME, UNIT = 0, 1, 2, 3
DIGITS, CAP, UNITS_AT, END, BARE = 1, 2, 4, 8, 16
_UNITS = {u.encode() for u in UNITS}
_P = np.uint64(0x9E3779B97F4A7C15)


class Numbers(Memo):
    """Words' numbers; a new word is learnt."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: bytes) -> int:
        k = self[word] = self.learn(word)
        return k


class Canon:
    """Texts as template tokens.  What is known of a word is kept in arrays, looked up by number."""

    def __init__(self):
        import xxhash

        self.hash = xxhash.xxh64_intdigest
        self.marks = np.array([0, *(self.hash(m) for m in ("<num>", "<name>", "<unit>"))], dtype=np.uint64)
        self.clear()

    def clear(self) -> None:
        self.number = Numbers(self.learn)
        self.hashes, self.flags = array("Q"), bytearray()

    def learn(self, word: bytes) -> int:
        if word.isalpha():  # ASCII letters only
            low = word.lower()
            flags = CAP * (word[0] < 97) | UNITS_AT * (low in _UNITS)
        else:
            text = word.decode("utf-8", "surrogatepass")
            core = text.strip(EDGE)
            low = core.lower().encode("utf-8", "surrogatepass")
            flags = DIGITS * bool(NUMBER.match(core)) | CAP * core[:1].isupper() | UNITS_AT * (low in _UNITS) | END * bool(ENDS.search(text)) | BARE * (not core)
        self.hashes.append(self.hash(low))
        self.flags.append(flags)
        return len(self.flags) - 1

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Template hashes, their kinds, the words that they begin at, and the words."""
        words = text.encode("utf-8", "surrogatepass").split()
        if len(self.number) > MEMORY or (self.flags and not self.number):
            self.clear()
        ids = np.array(list(map(self.number.__getitem__, words)), dtype=np.int64)
        if not len(words):
            return np.empty(0, np.uint64), np.empty(0, np.int8), np.empty(0, np.int64), words
        h, flags = np.frombuffer(self.hashes, np.uint64)[ids], np.frombuffer(self.flags, np.uint8)[ids]
        num, cap, unit, ends, bare = ((flags & f) != 0 for f in (DIGITS, CAP, UNITS_AT, END, BARE))
        inside = np.concatenate(([False], ~ends[:-1]))  # no sentence ended before
        after = np.concatenate(([False], num[:-1]))
        kind = np.where(num, NUM, np.where(unit & after, UNIT, np.where(cap & inside, NAME, PLAIN))).astype(np.int8)
        follows = np.concatenate(([False], (kind[1:] == NAME) & (kind[:-1] == NAME)))
        at = np.flatnonzero(~follows & ~bare)  # names in a row are one name; punctuation alone is nothing
        kind = kind[at]
        return np.where(kind == PLAIN, h[at], self.marks[kind]), kind, at, words


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes) - width + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = (out ^ hashes[j : j + n]) * _P
            out ^= out >> np.uint64(29)
    return out


def slot_value(words: list[bytes], at: np.ndarray, kind: np.ndarray, i: int) -> str:
    end = at[i] + 1 if kind[i] != NAME else at[i + 1] if i + 1 < len(at) else len(words)
    return " ".join(filter(None, (w.decode("utf-8", "replace").strip(EDGE).lower() for w in words[at[i] : end])))


class Index:
    """A part of the benchmark: windows by hash, and each item's windows and slots."""

    def __init__(self, items: list[tuple]):
        canon, post = Canon(), defaultdict(list)
        self.heavy: dict[tuple[int, int], dict[tuple, list]] = defaultdict(lambda: defaultdict(list))  # windows of mostly placeholders, by their values too
        self.items = []
        for item_id, text in items:
            h, kind, at, words = canon.tokens(text or "")
            width = min(WINDOW, len(h))
            if not width:
                continue
            w = windows(h, width)
            literal = np.array([int((kind[i : i + width] == PLAIN).sum()) for i in range(len(w))])
            slots = {i: slot_value(words, at, kind, i) for i in range(len(kind)) if kind[i] != PLAIN}
            keys: list = w.tolist()
            heavy = np.flatnonzero(literal * 2 < width).tolist()  # mostly placeholders: the template alone tells nothing
            light = len(set(keys[i] for i in np.flatnonzero(literal * 2 >= width).tolist()))
            for i in heavy:
                keys[i] = (keys[i], tuple(slots[j] for j in range(i, i + width) if j in slots))
            for i, key in enumerate(keys):
                post_of = self.heavy[(width, key[0])][key[1]] if isinstance(key, tuple) else post[(width, key)]
                post_of.append((len(self.items), i))
            plain = {i: int(h[i]) for i in np.flatnonzero(kind == PLAIN).tolist()}
            self.items.append((item_id, width, keys, (len(set(keys)), light), slots, heavy, plain))
        self.widths = sorted({k for k, _ in [*post, *self.heavy]})
        self.known = {k: np.array(sorted({x for j, x in [*post, *self.heavy] if j == k}), dtype=np.uint64) for k in self.widths}
        self.post = dict(post)

    def find(self, canon: Canon, text: str) -> list[tuple]:
        """(item_id, containment, longest run, slot consistency, kind) of each item that the text holds."""
        h, kind, at, words = canon.tokens(text)
        hits: dict[int, set[tuple[int, int]]] = defaultdict(set)
        value = cache(lambda d: slot_value(words, at, kind, d))
        seen = {}
        for width in self.widths:
            w, known = windows(h, width), self.known[width]
            seen[width] = w
            if not len(w):
                continue
            there = np.flatnonzero(known[np.minimum(np.searchsorted(known, w), len(known) - 1)] == w)
            for d in there.tolist():
                at_window = (width, int(w[d]))
                there_too = self.post.get(at_window, ())
                if at_window in self.heavy:
                    there_too = [*there_too, *self.heavy[at_window].get(tuple(value(j) for j in range(d, d + width) if kind[j] != PLAIN), ())]
                for item, i in there_too:
                    hits[item].add((d - i, i))
        rows = (self.judge(item, found, self.bridges(item, found, seen), value) for item, found in hits.items())
        return [row for row in rows if row]

    def fewest(self, item: int) -> int:
        """Different template windows that a text must share with the item, at least, to hold it."""
        _, width, keys, (every, light), *_ = self.items[item]
        template = [k[0] if isinstance(k, tuple) else k for k in keys]
        by = sorted(Counter(t for t, _ in {(k[0] if isinstance(k, tuple) else k, k) for k in keys}).values(), reverse=True)
        half, n = 0, 0
        while half < MIN_CONTAINMENT * every:
            half, n = half + by[n], n + 1
        ways = [n, *([-int(-MIN_CONTAINMENT * light // 1)] if light else []), *(len(set(template[i : i + MIN_RUN])) for i in range(len(template) - MIN_RUN + 1))]
        return max(1, min(ways))

    def bridges(self, item: int, found: set[tuple[int, int]], seen: dict[int, np.ndarray]) -> set[tuple[int, int]]:
        """Windows of mostly placeholders whose template is there with other values: they do not count, but do not break a run."""
        _, width, keys, _, _, heavy, _ = self.items[item]
        if not heavy:
            return set()
        w = seen[width]
        return {(g, i) for g in {g for g, _ in found} for i in heavy if 0 <= g + i < len(w) and w[g + i] == keys[i][0]} - found

    def judge(self, item: int, found: set[tuple[int, int]], bridges: set[tuple[int, int]], value: Callable[[int], str]) -> tuple | None:
        """The best stretch of the text that holds the item, or else all stretches together if they do."""
        if not self.enough(item, found, bridges):  # then no part is
            return None
        parts = stretches(found, len(self.items[item][2]), lambda part: self.votes(item, part, value))
        held = [row for row in (self.held(item, part, bridges, value) for part in parts) if row]
        if held:
            return max(held, key=lambda row: (row[1], row[4] == "verbatim", row[2], row[3]))
        return self.held(item, found, bridges, value)

    def enough(self, item: int, found: set[tuple[int, int]], bridges: set[tuple[int, int]]) -> tuple[float, int] | None:
        """Containment and longest run, if they suffice; the share is of all windows or of the literal ones, whichever is more."""
        _, _, keys, (every, light), *_ = self.items[item]
        there = {keys[i] for _, i in found}
        share = max(len(there) / every, sum(not isinstance(k, tuple) for k in there) / max(light, 1))
        run = longest_run(found, bridges)
        return (share, run) if share >= MIN_CONTAINMENT or run >= MIN_RUN else None

    def votes(self, item: int, found: set[tuple[int, int]], value: Callable[[int], str]) -> dict[str, Counter]:
        """The text's values that stand for each value of the item."""
        _, width, _, _, slots, *_ = self.items[item]
        votes: dict[str, Counter] = defaultdict(Counter)
        for g, j in {(g, j) for g, i in found for j in range(i, i + width) if j in slots}:
            votes[slots[j]][value(g + j)] += 1
        return votes

    def held(self, item: int, found: set[tuple[int, int]], bridges: set[tuple[int, int]], value: Callable[[int], str]) -> tuple | None:
        item_id, width, _, _, slots, _, plain = self.items[item]
        if len({plain[j] for _, i in found for j in range(i, i + width) if j in plain}) < MIN_LITERAL:
            last = len(slots) + len(plain) - 1

            def equal(g: int, j: int) -> bool:  # a name that ends the item may go on in the text
                return value(g + j) == slots[j] or (j == last and value(g + j).startswith(slots[j] + " "))

            found = {(g, i) for g, i in found if all(equal(g, j) for j in range(i, i + width) if j in slots)}
            enough = self.enough(item, found, bridges)
            return (item_id, *enough, 1.0, "verbatim") if enough else None
        enough = self.enough(item, found, bridges)
        if not enough:
            return None
        votes = self.votes(item, found, value)
        agree = one_to_one(votes)
        if agree < MIN_CONSISTENCY:
            return None
        same = all(set(c) == {v} for v, c in votes.items())
        return item_id, *enough, agree, "verbatim" if same else "reparameterised"


def one_to_one(votes: dict[str, Counter]) -> float:
    """Share of the votes that agree with one assignment of text values to item values, in which no two item values share one.

    Pairs are assigned from the most votes down.
    """
    n = sum(c.total() for c in votes.values())
    given, taken, agree = set(), set(), 0
    for times, item_value, text_value in sorted(((k, v, t) for v, c in votes.items() for t, k in c.items()), key=lambda x: (-x[0], x[1] != x[2], x[1], x[2])):
        if item_value not in given and text_value not in taken:
            given.add(item_value)
            taken.add(text_value)
            agree += times
    return agree / n if n else 1.0


def stretches(found: set[tuple[int, int]], span: int, votes: Callable[[set[tuple[int, int]]], dict[str, Counter]]) -> list[set[tuple[int, int]]]:
    """Hits (offset, window of the item) by alignment: those of one offset, and chains of near offsets.

    A chain goes on in text and item alike, as where words were put in or left
    out; its offsets move by less than the item's length, so copies one after
    another stay apart, and its runs agree on the values that they share.
    """
    by_offset: dict[int, list[int]] = defaultdict(list)
    for g, i in found:
        by_offset[g].append(i)
    runs = []  # first and last place in the text, first and last window
    for g, at in by_offset.items():
        at.sort()
        cuts = [0, *(k for k in range(1, len(at)) if at[k] != at[k - 1] + 1), len(at)]
        runs += [(g + at[a], g + at[b - 1], at[a], at[b - 1]) for a, b in pairwise(cuts)]
    runs.sort()
    hits = [{(d - i, k) for k in range(i, last + 1)} for d, _, i, last in runs]
    values = [{v: c.most_common(1)[0][0] for v, c in votes(part).items()} for part in hits]
    score, before = [], []
    for r, (d, end, i, last) in enumerate(runs):
        best, link = 0, None
        for p in range(r - 1, -1, -1):
            d0, end0, i0, last0 = runs[p]
            if d0 < d - 2 * span:  # no nearer one is left
                break
            if d0 < d and end0 < end and i0 < i and last0 < last and abs((d - i) - (d0 - i0)) < span and score[p] > best:
                shared = [v for v in values[r] if v in values[p]]
                if sum(values[r][v] == values[p][v] for v in shared) >= MIN_CONSISTENCY * len(shared):
                    best, link = score[p], p
        score.append(best + last - i + 1)
        before.append(link)
    out, used = [{(g, i) for i in at} for g, at in by_offset.items()], set()
    for r in sorted(range(len(runs)), key=lambda r: -score[r]):
        if r in used or before[r] is None:
            continue
        part, k = set(), r
        while k is not None:
            part |= hits[k]
            used.add(k)
            k = before[k]
        out.append(part)
    return out


def longest_run(found: set[tuple[int, int]], bridges: set[tuple[int, int]]) -> int:
    """Most windows found in a row, not counting the bridges between them."""
    best, every = 0, found | bridges
    for g, i in every:
        if (g, i - 1) not in every:
            n = 0
            while (g, i) in every:
                n += (g, i) in found
                i += 1
            best = max(best, n)
    return best


class Finder:
    """Builds the index once in each worker."""

    def __init__(self, shared):
        self.shared, self.index, self.canon = shared, None, None

    def __getstate__(self):
        return {"shared": self.shared, "index": None, "canon": None}

    def __call__(self, text: str) -> list[tuple]:
        if self.index is None:
            self.index, self.canon = Index(self.shared.value), Canon()
        return self.index.find(self.canon, text) if self.index.items else []


FOUND = [T.StructField("containment", T.DoubleType()), T.StructField("longest_run", T.LongType()), T.StructField("slot_consistency", T.DoubleType()), T.StructField("kind", T.StringType())]


def _items(benchmark: DataFrame, item_col: str, item_text: str) -> tuple[DataFrame, int]:
    """The benchmark's different items with a text, numbered by ``key``, and their bytes."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL").distinct().withColumn("key", F.xxhash64("text"))
    return items, items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def _by_index(rows: DataFrame, items: DataFrame) -> Finder:
    """Finds keys of items; they are collected, as they are within INDEX_BYTES."""
    return Finder(rows.sparkSession.sparkContext.broadcast([(r["key"], r["text"]) for r in items.select("key", "text").distinct().orderBy("key", "text").collect()]))


def _by_join(rows: DataFrame, items: DataFrame) -> DataFrame:
    """text_key, key and the fields of FOUND for every text of ``rows`` (text_key, text) that holds an item, however many items there are."""
    window = [T.StructField("width", T.IntegerType()), T.StructField("window", T.LongType())]

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        at, need, widths, hashes = [], [], [], []
        for i, t in enumerate(texts(batch)):
            index = Index([(0, t)])
            if index.items:
                (_, width, keys, *_), = index.items
                for x in {k[0] if isinstance(k, tuple) else k for k in keys}:
                    at.append(i)
                    need.append(index.fewest(0))
                    widths.append(width)
                    hashes.append(x)
        return pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at)), pa.array(need, pa.int32()), pa.array(widths, pa.int32()), pa.array(np.array(hashes, np.uint64).view(np.int64))], names=["key", "need", "width", "window"]) if at else None

    own, _ = written(arrow_map(items.select("key", "text").distinct(), cut, T.StructType([T.StructField("key", T.LongType()), T.StructField("need", T.IntegerType()), *window])), "item-windows")
    used = sorted(r[0] for r in own.select("width").distinct().collect())  # WINDOW numbers at most
    canon = Finder(None)

    def slide(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        canon.canon = canon.canon or Canon()
        at, widths, hashes = [], [], []
        for i, t in enumerate(texts(batch)):
            h = canon.canon.tokens(t)[0]
            for width in used:
                found = np.unique(windows(h, width))
                at.append(np.full(len(found), i))
                widths.append(np.full(len(found), width))
                hashes.append(found)
        if not at:
            return None
        return pa.RecordBatch.from_arrays([batch.column("text_key").take(pa.array(np.concatenate(at))), pa.array(np.concatenate(widths), pa.int32()), pa.array(np.concatenate(hashes).view(np.int64))], names=["text_key", "width", "window"])

    bodies = rows.dropDuplicates(["text_key"])
    theirs = arrow_map(bodies, slide, T.StructType([field(rows, "text_key"), *window]))
    pairs = theirs.join(own, ["width", "window"]).groupBy("text_key", "key").agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("need")).where("n >= need").select("text_key", "key")
    both = bodies.join(pairs, "text_key").join(items.select("key", F.col("text").alias("item_text")).distinct(), "key")
    last: list = [None, None]

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        canon.canon = canon.canon or Canon()
        at, out = [], []
        for i, (t, key, body) in enumerate(zip(texts(batch), batch.column("key").to_pylist(), batch.column("item_text").to_pylist(), strict=True)):
            if last[0] != body:
                last[:] = body, Index([(key, body)])
            for row in last[1].find(canon.canon, t):
                at.append(i)
                out.append(row[1:])
        return _rows([batch.column("text_key").take(pa.array(at)), batch.column("key").take(pa.array(at))], ["text_key", "key"], out) if at else None

    return arrow_map(both, judged, T.StructType([field(rows, "text_key"), T.StructField("key", T.LongType()), *FOUND]))


def _rows(columns: list, names: list[str], found: list[tuple]) -> pa.RecordBatch:
    share, run, agree, kind = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([*columns, pa.array(share, pa.float64()), pa.array(run, pa.int64()), pa.array(agree, pa.float64()), pa.array(kind)], names=[*names, *(f.name for f in FOUND)])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and item that it holds; documents without one have no row.

    Null and empty texts hold nothing, null and empty items are held by
    nothing, items of fewer than WINDOW tokens are matched as a whole.  Texts
    of any length are read whole.  Repeated documents are reported again,
    repeated items once, different items of one text each.  Of equally good
    stretches the verbatim one counts.  Other columns are ignored, whatever
    their names.
    """
    items, size = _items(benchmark, item_col, item_text)
    names = items.select(F.col("key").alias("item_key"), F.col("item").alias("item"))
    if size > INDEX_BYTES:
        rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("text_key"), F.col(text_col).alias("text")).where("text IS NOT NULL")
        by_text, _ = written(_by_join(rows.select("text_key", "text"), items), "found")
        found = rows.select("id", "text_key").join(by_text, "text_key").drop("text_key")
    else:
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        finder = _by_index(rows, items)

        def look(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            at, out = [], []
            for i, t in enumerate(texts(batch)):
                for row in finder(t):
                    at.append(i)
                    out.append(row)
            return _rows([batch.column("id").take(pa.array(at)), pa.array([row[0] for row in out], pa.int64())], ["id", "key"], [row[1:] for row in out]) if at else None

        found = arrow_map(rows, look, T.StructType([field(docs, id_col, "id"), T.StructField("key", T.LongType()), *FOUND]))
    return found.join(names, F.col("key") == F.col("item_key")).select(F.col("id").alias(id_col), F.col("item").alias(item_col if item_col != id_col else f"item_{item_col}"), *(f.name for f in FOUND))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item, with all columns as they are.

    Awkward rows are judged as in ``contaminated``; those that hold nothing stay.
    """
    items, size = _items(benchmark, item_col, item_text)
    if size > INDEX_BYTES:
        key, gone = free(docs, "text_key"), free(docs, "gone_key")
        keyed = docs.withColumn(key, F.unhex(F.md5(F.col(f"`{text_col}`").cast("binary"))))
        by_text, _ = written(_by_join(keyed.select(F.col(key).alias("text_key"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL"), items).select(F.col("text_key").alias(gone)).distinct(), "gone")
        return keyed.join(by_text, F.col(key) == F.col(gone), "left_anti").drop(key)
    finder = _by_index(docs, items)
    return arrow_map(docs, lambda b: b.filter(pc.invert(pa.array([bool(finder(t)) for t in texts(b, text_col)], pa.bool_()))), docs.schema)
