"""Token counts with a whole-token shortcut.

Once per driver it is proved, by encoding every vocabulary string, which of
them the merges turn into one token when they stand alone.  A pre-token among
these counts one without any merging; only the rest is merged by the library.
The table has at most one entry per vocabulary string, so its size is bound by
the vocabulary and not by the data.
"""

from __future__ import annotations

import functools
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, arrow_map, field, texts

#: Fixed value: the pre-token pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Counts of merged pre-tokens that a task remembers before it starts anew.
MEMORY = 150_000
#: Longer pre-tokens are merged but not remembered.
LONGEST = 64


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, turned round."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in printable}
    table.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))})
    return table


@functools.lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that, alone, are one pre-token and encode as one token."""
    import regex

    tok, back, pattern = _tokenizer(path), byte_chars(), regex.compile(PATTERN)
    special = {str(t.content) for t in tok.get_added_tokens_decoder().values()}
    plain = []
    for piece in tok.get_vocab():
        try:
            text = bytes(back[c] for c in piece).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if piece not in special and pattern.fullmatch(text):
            plain.append(text)
    found = tok.encode_batch(plain, add_special_tokens=False)
    return frozenset(t for t, e in zip(plain, found, strict=True) if len(e.ids) == 1)


class Counter:
    """Counts the tokens of whole texts for one vocabulary file.

    A single space between two characters that are no white space always opens
    a pre-token, so texts are first cut there and the pieces' counts remembered.
    Texts with other white space at such a cut are matched as a whole.
    """

    #: Marks pieces that can't be counted by themselves.
    OPEN = -(1 << 60)

    def __init__(self, path: str, whole: frozenset[str]):
        import regex

        self.tok, self.whole = _tokenizer(path), whole
        self.find = regex.compile(PATTERN).findall
        special = sorted((str(t.content) for t in self.tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = special
        self.split = regex.compile("|".join(map(regex.escape, special))).split
        self.merged = Memo()
        self.pieces = Memo()

    def one(self, pre_token: str) -> int:
        if pre_token in self.whole:
            return 1
        n = self.merged.get(pre_token)
        if n is None:
            n = len(self.tok.encode(pre_token, add_special_tokens=False).ids)
            if len(pre_token) <= LONGEST:
                if len(self.merged) >= MEMORY:
                    self.merged.clear()
                self.merged[pre_token] = n
        return n

    def piece(self, piece: str) -> int:
        """The count of a piece that a single space precedes."""
        n = self.OPEN if not piece or piece[0].isspace() or piece[-1].isspace() else sum(map(self.one, self.find(" " + piece)))
        if len(piece) <= LONGEST:
            if len(self.pieces) >= MEMORY:
                self.pieces.clear()
            self.pieces[piece] = n
        return n

    def plain(self, text: str) -> int:
        """A text without special strings."""
        first, *rest = text.split(" ")
        if rest and first and not first[-1].isspace():
            known, n = self.pieces.get, 0
            for p in rest:
                k = known(p)
                n += self.piece(p) if k is None else k
            if n >= 0:
                return n + sum(map(self.one, self.find(first)))
        return sum(map(self.one, self.find(text)))

    def count(self, text: str) -> int:
        """A special string inside a text counts one token, as the library has it by default.

        Beyond the basic plane the pattern's character classes depend on the
        Unicode version, so texts with such characters go to the library whole.
        """
        if len(text.encode("utf-16-le", "surrogatepass")) != 2 * len(text):
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        if any(s in text for s in self.special):
            parts = self.split(text)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(text)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes`` and ``n_tokens`` of its whole text under the byte-level vocabulary at ``path``.

    Null and empty texts have none of either; repeated rows count alike; an
    empty table gives an empty result.  Other columns are ignored.
    """
    whole = whole_tokens(path)
    shared = docs.sparkSession.sparkContext.broadcast(whole)  # bound by the vocabulary

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = texts(batch)
        n = list(map(_counter(path, shared).count, t))
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(x.encode()) for x in t], pa.int64()), pa.array(n, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(rows, counted, T.StructType([field(docs, id_col), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]))


_counters: dict[str, Counter] = {}


def _counter(path: str, shared) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path, shared.value)
    return _counters[path]
