"""Quality rules: compression bands, with plain counting rules beside them.

Each text is compressed with zstandard as a whole and in fixed chunks. A ratio (raw bytes over compressed bytes) above
its band means repetition, below it noise. The band of the whole text depends on its length, since short texts hardly
compress; all chunks have one length and so one band. What is left at the end of a text is measured as its last
CHUNK_BYTES bytes, which overlap the chunk before; a text of at most CHUNK_BYTES is a single chunk, with the band of its
length.

Defined results: a null or empty text has no words, fails the rules and is not kept. Repeated rows get equal results,
one each. Other columns of the input are neither read nor changed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from .common import SPACES, as_bytes, map_batches, same_columns, table

#: (longest text in bytes, lowest and highest ratio kept): limits for the whole text.
WHOLE_BANDS = (
    (64, 0.0, 2.5), (256, 0.6, 3.0), (1024, 1.1, 3.5), (4096, 1.25, 4.0), (16384, 1.35, 5.0), (1 << 62, 1.35, 5.5),
)
CHUNK_BYTES, CHUNK_BAND, MOST_BAD_CHUNKS = 4096, (1.2, 6.0), 0.5
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more. window: a power of two.

    Windows get exact numbers by doubling: that of a span of 2k words comes from those of its two halves.
    """
    n = len(words)
    if n <= window:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter((first.setdefault(w, i) for i, w in enumerate(words)), np.int64, n)
    span = 1
    while span < window:
        ids = np.unique(ids[:-span] * n + ids[span:], return_inverse=True)[1]
        span *= 2
    again = np.flatnonzero(np.bincount(ids)[ids] > 1)
    if not len(again):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:n]))


def measure(raw: bytes, squeeze: zstandard.ZstdCompressor) -> tuple:
    words = raw.split()
    n = len(words)
    inked = raw.translate(None, SPACES)
    lines = [x for x in raw.split(b"\n") if x.translate(None, SPACES)]
    repeats = repeated_words(words)
    failed = n < 20 or 100 * repeats > 30 * n
    ratio = len(raw) / len(squeeze.compress(raw)) if raw else 0.0
    low, high = next((lo, hi) for most, lo, hi in WHOLE_BANDS if len(raw) <= most)
    last = len(raw) - CHUNK_BYTES
    chunks = [*range(0, last, CHUNK_BYTES), last] if last > 0 else []
    rates = [CHUNK_BYTES / len(squeeze.compress(raw[o : o + CHUNK_BYTES])) for o in chunks]
    bad = sum(not CHUNK_BAND[0] <= x <= CHUNK_BAND[1] for x in rates)
    kept = not failed and low <= ratio <= high and bad <= MOST_BAD_CHUNKS * len(rates)
    symbols = len(inked) - len(inked.translate(None, SYMBOLS))
    return n, len(inked.decode(errors="replace")), symbols, len(lines) - len(set(lines)), repeats, failed, kept, ratio, len(rates), bad


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per document: counts, ratios and the verdict. keep_text: the rows kept instead, with the input's own columns."""

    def verdicts(b: pa.RecordBatch, at: int = 1) -> list[tuple]:
        squeeze = zstandard.ZstdCompressor(level=3)
        return [measure(x or b"", squeeze) for x in as_bytes(b.column(at))]

    if keep_text:
        place = docs.columns.index(text_col)
        return same_columns(docs, lambda b: b.filter(pa.array([r[6] for r in verdicts(b, place)], pa.bool_())))

    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        cols = list(zip(*verdicts(b)))
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.int64(), pa.int64()]
        data = [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(data, names)

    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias(text_col))
    return map_batches(picked, rows, SCHEMA)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
