"""Quality rules: base counts, then bands of zstandard ratios.

A ratio is compressed over plain UTF-8 bytes.  Repetitive text compresses too
well, noise too badly; how well clean prose compresses depends on its length,
so each length class has a band of its own.  The whole text is held against its
class's band, and long texts also in chunks of ``CHUNK`` bytes, so that a junk
half is seen beside a clean one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, field, texts
from .textstats import duplicate_lines, repeated_words, symbol_count, word_char_count, word_ids, words_of

LEVEL = 3
#: Bytes of a chunk; a rest shorter than half of it is judged with the chunk before.
CHUNK = 4096
#: Upper end of a length class in bytes, and the lowest and highest ratio kept in it.  Short
#: texts have little to repeat and carry the frame's bytes, so limits fall with length; the lower
#: ones lie 0.02 to 0.03 under the smallest ratio of labelled clean prose, the upper ones 0.1 above
#: the largest (random letters and digits reach 0.76).
BANDS = (
    (512, 0.49, 0.95), (768, 0.49, 0.80), (1024, 0.47, 0.78), (1536, 0.455, 0.75), (2048, 0.445, 0.72), (3072, 0.435, 0.70),
    (4096, 0.425, 0.68), (8192, 0.405, 0.66), (16384, 0.39, 0.64), (65536, 0.36, 0.62), (1 << 62, 0.30, 0.62),
)
#: Band of a chunk, and the share of chunks outside it beyond which a text goes.
CHUNK_BAND, MAX_BAD_CHUNKS = (0.40, 0.66), 0.30
#: Fixed values of the base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in BASE]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("zstd_ratio", T.DoubleType()), T.StructField("bad_chunks", T.LongType()), T.StructField("n_chunks", T.LongType()), T.StructField("kept", T.BooleanType())]
)


def measure(text: str, compress) -> tuple:
    """The fields of SCHEMA for one text; ``compress`` maps bytes to compressed bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    ids, distinct = word_ids(raw.split())
    n, repeat = len(ids), repeated_words(ids, distinct)
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    ratio = len(compress(raw)) / len(raw) if raw else None
    pieces = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)] if len(raw) > CHUNK else []
    if pieces and len(pieces[-1]) * 2 < CHUNK:
        pieces[-2:] = [pieces[-2] + pieces[-1]]
    bad = sum(not CHUNK_BAND[0] <= len(compress(p)) / len(p) <= CHUNK_BAND[1] for p in pieces)
    kept = not failed and ratio is not None and bad <= MAX_BAD_CHUNKS * len(pieces)
    if kept:
        low, high = next((a, b) for top, a, b in BANDS if len(raw) <= top)
        kept = low <= ratio <= high
    return n, word_char_count(text), symbol_count(text), duplicate_lines(text)[0], repeat, failed, ratio, bad, len(pieces), kept


def compression_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and the fields of SCHEMA for its whole text.

    Null and empty texts have no words, fail the base rules and have no ratio.
    Very long texts are compressed whole and in all their chunks.  A ratio at a
    band's end is inside it.  Repeated rows are judged alike; an empty table
    gives an empty result; other columns are ignored, whatever their names.
    """
    made: list = []  # one compressor a worker

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch:
        import zstandard

        if not made:
            made.append(zstandard.ZstdCompressor(level=LEVEL).compress)
        rows = [measure(t, made[0]) for t in texts(batch)]
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=[id_col, *SCHEMA.names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return arrow_map(rows, judged, T.StructType([field(docs, id_col), *SCHEMA.fields]))
