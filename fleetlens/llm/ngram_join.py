"""N-gram Jaccard self-join with Bayesian candidate pruning.

1. One pass makes each text's MinHash values.  Equal texts, however many, become
   one text with a count before anything is compared.
2. Texts that share a band of values are candidates.  Inside a bucket their
   values are compared step by step, and a pair is dropped once the posterior
   probability that its similarity reaches the threshold is below a tolerance.
   A bucket only reports a spanning forest of its survivors, never all pairs;
   buckets larger than a block are cut into pairs of blocks.
3. Components of the survivors hold every true link.  In each, again by pairs
   of blocks, all similarities are computed exactly from whole texts; links are
   counted per text, and a forest of the true links gives the final classes.

A link between texts of similarity s is missed with probability at most
``(1 - s ** ROWS) ** BANDS`` (2.6e-5 at 0.8) plus the share of pairs that the
six decisions drop (7.1e-6 at 0.8, 3.1e-6 at 0.81, for independent values).
The tolerance bounds the posterior of each decision, not that share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, arrow_map, field, forget, free, fresh_path, scratch, small, texts, written
from .components import components

SHINGLE = 5
#: Similarity from which texts are linked, as a fraction: 4 / 5.
NUM, DEN = 4, 5
BANDS, ROWS, VALUES = 20, 4, 96
#: Values compared before each decision, and the posterior probability below which a pair is dropped.
STEP, TOLERANCE = 16, 1e-6
#: Texts of a block, and about how many bytes of them; a task never compares more than two blocks at a time.
BLOCK, BLOCK_BYTES = 1000, 16 << 20
#: Up to this many linked texts are broadcast to fetch their bodies; more are joined by shuffling.
MAX_BROADCAST_TEXTS = 200_000
#: Distinct words that a task remembers.
MEMORY = 150_000

_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(Memo):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMORY:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = WordHashes()


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of the text's five-word shingles; a shorter text is one shingle, an empty one none."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(_hashes.__getitem__, words)), dtype=np.uint64)
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = (out ^ h[j : j + n]) * _PLACES[j]
            out ^= out >> np.uint64(32)
    return np.unique(out)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """VALUES minima of each set; an empty set has none of its own and gets zeros."""
    out = np.zeros((len(sets), VALUES), np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        every = np.concatenate([sets[i] for i in full])
        start = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
        with np.errstate(over="ignore"):
            for k in range(VALUES):
                out[full, k] = np.minimum.reduceat(every * _FACTORS[k], start)
    return out


def bands_of(values: np.ndarray) -> np.ndarray:
    out = np.empty((len(values), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            h = np.full(len(values), b + 1, np.uint64)
            for r in range(ROWS):
                h = (h ^ values[:, b * ROWS + r]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out[:, b] = h
    return out


def _fewest_matches() -> np.ndarray:
    """After each STEP values: matches below which P(similarity >= threshold) < TOLERANCE under a uniform prior.

    A kept value is a byte, so two different ones agree once in 256.
    """
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 256
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(p) + (n - m) * np.log1p(-p)
        weight = np.exp(log - log.max(1, keepdims=True))
        reach = weight[:, s >= NUM / DEN].sum(1) / weight.sum(1)
        out.append(int(np.argmax(reach >= TOLERANCE)))
    return np.array(out)


FEWEST = _fewest_matches()


def survive(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows of values are not dropped; values are looked at STEP at a time."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, least in enumerate(FEWEST):
        at = slice(k * STEP, (k + 1) * STEP)
        matches = matches + (a[alive, at] == b[alive, at]).sum(1)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def forest(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the graph on n nodes, where ``linked(i, js)`` says which ``js`` link to i.

    A pair is only looked at while its ends are in different trees.
    """
    tree, edges = np.arange(n), []
    for i in range(n - 1):
        others = np.flatnonzero(tree[i + 1 :] != tree[i]) + i + 1
        if not len(others):
            if (tree == tree[0]).all():
                break
            continue
        for j in others[linked(i, others)].tolist():
            if tree[j] != tree[i]:
                tree[tree == tree[j]] = tree[i]
                edges.append((i, j))
    return edges


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of a partition sorted by ``keys``; several small ones come together.

    Holds one batch and the group that is open at its end.
    """
    kept: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        last = tuple(now[k][now.num_rows - 1].as_py() for k in keys)
        same = np.ones(now.num_rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= pc.equal(now[k], v).to_numpy()
        first = int(np.argmax(same))  # the open group's first row, as rows are sorted
        if first:
            yield pa.concat_tables([*kept, now.slice(0, first)])
            kept = [now.slice(first)]
        elif kept and tuple(kept[0][k][0].as_py() for k in keys) != last:
            yield pa.concat_tables(kept)
            kept = [now]
        else:
            kept.append(now)
    if kept:
        yield pa.concat_tables(kept)


def runs(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each group of a sorted table starts, and its end."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        c = table[k].to_numpy() if not pa.types.is_binary(table.schema.field(k).type) else np.array(table[k].to_pylist(), dtype=object)
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


EDGES = T.StructType([T.StructField("u", T.BinaryType()), T.StructField("v", T.BinaryType())])


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each bucket's pairs that are not dropped."""
    for group in grouped(batches, ["bucket", "i", "j"]):
        tid = group["tid"].to_pylist()
        values = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(-1, VALUES)
        start = runs(group, ["bucket", "i", "j"])
        hub = np.repeat(start[:-1], np.diff(start))
        with_hub = np.flatnonzero(hub != np.arange(len(hub)))
        alive = survive(values[with_hub], values[hub[with_hub]])
        edges = [(tid[h], tid[i]) for h, i in zip(hub[with_hub[alive]].tolist(), with_hub[alive].tolist(), strict=True)]
        left = np.zeros(len(hub), bool)
        left[with_hub[~alive]] = True
        for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
            if b - a > 2 and left[a:b].any():  # some texts do not go with the first: look at the other pairs
                own = values[a:b]
                edges += [(tid[a + x], tid[a + y]) for x, y in forest(b - a, lambda x, ys, own=own: survive(own[ys], np.broadcast_to(own[x], own[ys].shape)))]
        if edges:
            u, v = zip(*edges, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])
    forget()


LINKS = T.StructType(
    [T.StructField("tid", T.BinaryType()), T.StructField("to", T.BinaryType()), T.StructField("final", T.BooleanType()), T.StructField("text_links", T.LongType()), T.StructField("doc_links", T.LongType())]
)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links of each component's block pair: counts per text, and a forest of the links.

    A component of one block is settled here: its texts point at the least
    text of their class.
    """
    for group in grouped(batches, ["root", "i", "j"]):
        start = runs(group, ["root", "i", "j"])
        out: list[tuple] = []
        for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
            part = group.slice(a, b - a)
            tid = part["tid"].to_pylist()
            first = {t: k for k, t in reversed(list(enumerate(tid)))}  # rows repeated in the input are one text
            at = sorted(first.values())
            tid = [tid[k] for k in at]
            body, copies, block = (part[c].take(pa.array(at)) for c in ("text", "copies", "block"))
            copies, block = copies.to_numpy(), block.to_numpy()
            i, j, blocks = (part[c][0].as_py() for c in ("i", "j", "blocks"))
            inside = {c for c in (i, j) if blocks <= 2 or {c, (c + 1) % blocks} == {i, j}}  # blocks whose own pairs count here
            sets = [shingles(t or "") for t in body.to_pylist()]
            size = np.array([len(s) for s in sets])
            every, place = np.unique(np.concatenate(sets), return_inverse=True)
            begin = np.concatenate(([0], np.cumsum(size)))
            text_links, doc_links = np.zeros(len(tid), np.int64), np.zeros(len(tid), np.int64)
            tree = np.arange(len(tid))
            mark, edges = np.zeros(len(every), np.int64), []
            for x in range(len(tid) - 1):
                if not size[x]:
                    continue
                mark[place[begin[x] : begin[x + 1]]] = 1
                ys = np.arange(x + 1, len(tid))
                ys = ys[(size[ys] > 0) & (size[ys] * DEN >= size[x] * NUM) & (size[x] * DEN >= size[ys] * NUM) & ((block[ys] != block[x]) | (block[x] in inside))]
                if len(ys):
                    pieces = [place[begin[y] : begin[y + 1]] for y in ys.tolist()]
                    common = np.add.reduceat(mark[np.concatenate(pieces)], np.concatenate(([0], np.cumsum(size[ys])[:-1])))
                    linked = ys[common * DEN >= (size[x] + size[ys] - common) * NUM]
                    text_links[x] += len(linked)
                    text_links[linked] += 1
                    doc_links[x] += copies[linked].sum()
                    doc_links[linked] += copies[x]
                    for y in linked[tree[linked] != tree[x]].tolist():
                        if tree[y] != tree[x]:
                            tree[tree == tree[y]] = tree[x]
                            edges.append((x, y))
                mark[place[begin[x] : begin[x + 1]]] = 0
            out += [(t, None, None, int(n), int(m)) for t, n, m in zip(tid, text_links, doc_links, strict=True)]
            if blocks == 1:
                least: dict[int, bytes] = {}
                for k, t in zip(tree.tolist(), tid, strict=True):
                    least[k] = min(least.get(k, t), t)
                out += [(t, least[k], True, None, None) for k, t in zip(tree.tolist(), tid, strict=True)]
            else:
                out += [(tid[x], tid[y], False, None, None) for x, y in edges]
        cols = zip(*out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int64()), strict=True)], names=LINKS.names)
    forget()


def text_key(text: Column) -> Column:
    """128 bits that stand for a whole text; null reads as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def in_blocks(rows: DataFrame, size: str, n_bytes: Column | None = None) -> DataFrame:
    """Rows of a group of ``size`` members and ``n_bytes`` bytes, once for each pair of blocks that holds them; a small group is one block."""
    last = F.col("blocks") - 1
    others = F.when(last < 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda d: d != F.col("block")))
    return (
        rows.withColumn("blocks", F.greatest(F.ceil(F.col(size) / BLOCK), F.lit(1) if n_bytes is None else F.ceil(n_bytes / BLOCK_BYTES)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(others))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .drop("other")
    )


def _signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, tid, bytes, sketch and bands of every row."""

    def signed(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t) for t in texts(batch)]
        values = minhashes(sets)
        keys = bands_of(values).view(np.int64)
        sketch = ((values >> np.uint64(20)) & np.uint64(0xFF)).astype(np.uint8)
        bands = [keys[i] if len(s) else np.empty(0, np.int64) for i, s in enumerate(sets)]
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tid"), batch.column("bytes"), pa.array([r.tobytes() for r in sketch], pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "tid", "bytes", "sketch", "bands"])

    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("tid"), F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("bytes"), F.col(text_col).alias("text"))
    schema = T.StructType([field(docs, id_col, "id"), T.StructField("tid", T.BinaryType()), T.StructField("bytes", T.LongType()), T.StructField("sketch", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    return arrow_map(rows, signed, schema)


def _classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows' (id, tid), and for each text: class_id, first_id of its copies, copies, text_links, doc_links."""
    signed, _ = written(_signed(docs, id_col, text_col), "signed")
    path = fresh_path(docs.sparkSession, "classes")
    with scratch(docs.sparkSession):
        classes, _ = written(_classes_of(docs, signed, id_col, text_col), "classes", path)
    return signed.select("id", "tid"), classes


def _classes_of(docs: DataFrame, signed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    reps, _ = written(signed.groupBy("tid").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("bytes").alias("bytes"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "texts")

    banded = reps.select("tid", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = in_blocks(banded.join(shared, "bucket"), "n").select("bucket", "i", "j", "tid").join(reps.select("tid", "sketch"), "tid")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = members.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "tid").mapInArrow(_survivors, EDGES)
    roots, _ = written(components(pairs), "candidates")

    linked = roots.select(F.col("node").alias("tid"), "root").join(reps.select("tid", "first_id", "copies", "bytes"), "tid")
    sizes = linked.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("n_bytes"))
    wanted, _ = written(linked.drop("bytes").join(sizes, "root"), "linked")
    side = F.broadcast(wanted) if small(wanted, MAX_BROADCAST_TEXTS) else wanted
    bodies = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("own"), F.col(text_col).alias("text")).join(side, (F.col("own") == F.col("tid")) & F.col("id").eqNullSafe(F.col("first_id")))
    blocks = in_blocks(bodies, "n", F.col("n_bytes")).select("root", "i", "j", "blocks", "block", "tid", "copies", "text")
    found, _ = written(blocks.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j", "tid").mapInArrow(_links, LINKS), "links")

    counts = found.where("to IS NULL").groupBy("tid").agg(F.sum("text_links").alias("text_links"), F.sum("doc_links").alias("doc_links"))
    settled = found.where("final").select(F.col("tid").alias("node"), F.col("to").alias("root"))
    open_edges = found.where("NOT final").select(F.col("tid").alias("u"), F.col("to").alias("v"))
    if not open_edges.isEmpty():
        settled = settled.unionByName(components(open_edges))
    tied = settled.join(reps.select(F.col("tid").alias("node"), "first_id"), "node")
    heads = tied.groupBy("root").agg(F.min("first_id").alias("class_id"), F.min(F.struct(F.col("first_id").isNull(), "first_id", "node"))["node"].alias("head"))
    by_text = tied.join(heads, "root").select(F.col("node").alias("tid"), "class_id", (F.col("node") == F.col("head")).alias("is_head")).join(counts, "tid", "left")
    classes = reps.select("tid", "first_id", "copies").join(by_text.withColumn("in_class", F.lit(True)), "tid", "left")
    return classes.select(
        "tid",
        F.when(F.col("in_class"), F.col("class_id")).otherwise(F.col("first_id")).alias("class_id"),
        "first_id",
        F.coalesce("is_head", F.lit(True)).alias("is_head"),
        "copies",
        F.coalesce("text_links", F.lit(0)).alias("text_links"),
        (F.coalesce("doc_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``class_id``, ``copy_of``, ``n_links`` and ``text_links``.

    ``class_id`` is the least id of the documents that links connect, copies
    included; ``copy_of`` the least id with the same text; ``n_links`` counts
    the other documents of similarity 0.8 or more, copies included, and
    ``text_links`` the different texts among them.  Null text is the empty
    text, which links to its copies alone; texts of fewer than five words are
    one shingle, and very long ones are compared whole.  A similarity of
    exactly 0.8 links.  Rows with a null id take part, but name no class unless
    all of its rows do; repeated rows are copies.  An empty table gives an
    empty result.  Other columns are ignored, whatever their names.
    """
    rows, classes = _classes(docs, id_col, text_col)
    return rows.join(classes, "tid").select(F.col("id").alias(id_col), "class_id", F.col("first_id").alias("copy_of"), "n_links", "text_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class alone, and all columns as they are.

    It has the class's least id; where no row has one, or several texts share
    it, the text of least digest stays.
    """
    rows, classes = _classes(docs, id_col, text_col)
    marked = rows.join(classes, "tid").select("id", "tid", (F.col("is_head") & F.col("id").eqNullSafe(F.col("class_id"))).alias("stays"))
    own, gone_id, gone_tid = (free(docs, c) for c in ("own_key", "gone_id", "gone_tid"))
    key = (F.col(f"`{id_col}`").eqNullSafe(F.col(gone_id))) & (F.col(own) == F.col(gone_tid))

    def table(df: DataFrame, what: str) -> DataFrame:
        out, _ = written(df.select(F.col("id").alias(gone_id), F.col("tid").alias(gone_tid)), what)
        return F.broadcast(out) if small(out, MAX_BROADCAST_TEXTS) else out

    gone = table(marked.where("NOT stays"), "gone")  # repeated rows do no harm, and without a distinct the join's hot texts can be split
    kept = docs.withColumn(own, text_key(F.col(f"`{text_col}`"))).join(gone, key, "left_anti")
    twice = table(marked.where("stays").groupBy("id", "tid").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "twice")
    if not twice.isEmpty():  # rows repeated whole, or several with a null id: these alone are shuffled, one of each a task
        kept = kept.join(twice, key, "left_anti").unionByName(kept.join(twice, key, "left_semi").dropDuplicates([id_col, own]))
    return kept.drop(own)
