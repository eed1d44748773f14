"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of three hashed embeddings: of the whole word, and of its first four and first five bytes,
so that a word never seen still has the vectors of its family. Filters of several widths run over the words of a text;
each keeps its largest response, and a logistic unit reads these. Gradients reach only the winning windows.

Training rows are a sample of at most SAMPLE labelled rows (the lowest hashes of their ids; a parameter), with whole
texts of SAMPLE_BYTES together at most (a parameter). A fifth of them
is held back to map raw outputs to probabilities and to calibrate, for every language with enough rows, the
threshold that gives the best F1. Scores see the text alone.

Defined results: a null text is empty; an empty text has the score of no response of any filter. Repeated rows give
equal rows. Labels that are null are not used, equal label rows count once, and a document that has both labels learns
from both, in a fixed order; without any labels of both kinds all scores are 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_bytes, map_batches, table

SAMPLE_BYTES = 64 << 20
SAMPLE, BUCKETS, DIM, FILTERS, WIDTHS, PREFIXES = 10_000, 1 << 15, 12, 8, (1, 2, 3), (0, 4, 5)
EPOCHS, STEPS, BATCH, RATE, DECAY, PREDICT = 24, 900, 128, 0.02, 1e-4, 0.3
DROP = 0.3  # share of the words hidden at a step, so that no single word carries a text
CHUNK_BYTES = 1 << 20
LEAST_ROWS = 50  # for a threshold of a language's own
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, lang_threshold double, lang_predicted int"
#: A-Z becomes a-z; other ASCII bytes that are neither letters nor digits become spaces.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def hashed(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (words x PREFIXES), and for each text the place of its first word; one place more at the end.

    Words are hashed together: the sum of byte * BASE ** place over a span, brought back to place 0.
    """
    folded = [t.translate(FOLD) for t in texts]
    buf = np.frombuffer(b" ".join(folded) + b" ", np.uint8)
    if not len(buf) or not texts:
        return np.zeros((0, len(PREFIXES)), np.int32), np.zeros(len(texts) + 1, np.int64)
    ink = buf != 32
    edge = np.diff(ink.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power = np.full(len(buf), BASE, np.uint64)
    power[0] = 1
    total = np.concatenate([[np.uint64(0)], np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * np.cumprod(power))])
    power[1:] = INVERSE
    back = np.cumprod(power)[start]
    out = np.empty((len(start), len(PREFIXES)), np.int32)
    for i, n in enumerate(PREFIXES):
        stop = np.minimum(end, start + n) if n else end
        h = (total[stop] - total[start]) * back + np.uint64(i * 7919)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        out[:, i] = (h % np.uint64(buckets)).astype(np.int32)
    offset = np.cumsum([0, *(len(t) + 1 for t in folded)])
    return out, np.searchsorted(start, offset)


@dataclass
class Model:
    table: np.ndarray  # buckets x DIM
    filters: list[np.ndarray]  # width x DIM x FILTERS
    bias: np.ndarray  # FILTERS of all widths
    read: np.ndarray
    shift: np.ndarray  # of the logistic unit; one number
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    training: bool = False

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        x = self.table[ids[:, 0]]
        for i in range(1, ids.shape[1]):
            x = x + self.table[ids[:, i]]
        return x

    def pooled(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text and filter: the largest response (0 at least), the word where its window starts, and all vectors."""
        n, x = len(bounds) - 1, self.vectors(ids)
        best, where = np.zeros((n, len(self.bias)), np.float32), np.full((n, len(self.bias)), -1, np.int64)
        for k, w in enumerate(self.filters):
            size, f = len(w), slice(k * w.shape[2], (k + 1) * w.shape[2])
            last = len(x) - size + 1
            if last <= 0:
                continue
            r = x[:last] @ w[0]
            for j in range(1, size):
                r += x[j : last + j] @ w[j]
            full = np.flatnonzero(bounds[1:] - bounds[:-1] >= size)  # texts with a whole window
            if not len(full):
                continue
            lo, hi = bounds[full], bounds[full + 1] - size + 1
            cuts = np.stack([lo, hi], 1).ravel()
            cuts = cuts[:-1] if cuts[-1] >= last else cuts
            top = np.maximum.reduceat(r, cuts, axis=0)[::2] + self.bias[f]
            best[full, f] = np.maximum(top, 0)
            if self.training:
                for t, (a, b) in enumerate(zip(lo, hi)):
                    where[full[t], f] = np.where(top[t] > 0, a + r[a:b].argmax(0), -1)
        return best, where, x

    def raw(self, texts: list[bytes]) -> np.ndarray:
        out, i = [], 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK_BYTES):
                size += len(texts[j])
                j += 1
            ids, bounds = hashed(texts[i:j], len(self.table))
            out.append(self.pooled(ids, bounds)[0] @ self.read + self.shift[0])
            i = j
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * self.raw(texts).astype(np.float64) + self.scale[1], -30, 30)))


def gradients(m: Model, ids: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean log loss plus half DECAY times the squares of filters and reading weights, by m's parameters in order."""
    params = [m.table, *m.filters, m.bias, m.read, m.shift]
    pooled, where, x = m.pooled(ids, bounds)
    miss = (1 / (1 + np.exp(-np.clip(pooled @ m.read + m.shift[0], -30, 30))) - labels).astype(m.read.dtype) / len(labels)
    back = miss[:, None] * m.read * (where >= 0)
    grads = [np.zeros_like(p) for p in params]
    grads[-2], grads[-1][0], grads[-3] = pooled.T @ miss + DECAY * m.read, miss.sum(), back.sum(0)
    for k, w in enumerate(m.filters):
        for j in range(len(w)):
            for f in range(w.shape[2]):
                c = k * w.shape[2] + f
                on = np.flatnonzero(where[:, c] >= 0)
                at, g = where[on, c] + j, back[on, c]
                grads[1 + k][j, :, f] += x[at].T @ g + DECAY * w[j, :, f]
                for h in range(ids.shape[1]):
                    np.add.at(grads[0], ids[at, h], g[:, None] * w[j, :, f])
    return grads


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 2, epochs: int | None = None) -> Model:
    """epochs: EPOCHS, or as many as make STEPS steps if the rows are few."""
    rng = np.random.default_rng(seed)
    epochs = epochs or max(EPOCHS, STEPS // -(-len(texts) // BATCH))
    m = Model(
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
        [rng.normal(0, 0.5, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32), rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), np.full(1, -1.0, np.float32),
    )
    params = [m.table, *m.filters, m.bias, m.read, m.shift]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    data = [hashed([t])[0] for t in texts]
    m.training = True
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        rate = RATE * (1 - epoch / epochs) + 1e-3
        for o in range(0, len(order), BATCH):
            some = order[o : o + BATCH]
            ids = np.concatenate([data[i] for i in some])
            seen = rng.random(len(ids)) >= DROP
            bounds = np.concatenate([[0], np.cumsum(seen)])[np.cumsum([0, *(len(data[i]) for i in some)])]
            ids = ids[seen]
            grads = gradients(m, ids, bounds, labels[some])
            step += 1
            for p, g, a, b in zip(params, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    m.training = False
    return m


def calibrate(m: Model, texts: list[bytes], labels: np.ndarray, langs: list[str | None]) -> None:
    """Sets the map from outputs to probabilities, and the thresholds by language, from rows not trained on."""
    z = m.raw(texts).astype(np.float64)
    soft = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / (len(labels) - labels.sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(300):  # Newton steps with a weak pull to a = 1
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([((p - soft) * z).sum() + (a - 1), (p - soft).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * z * z).sum() + 1, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-3]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
    m.scale = (float(max(a, 0.05)), float(b))
    p = m.scores(texts)
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs])
        y, q = labels[own], p[own]
        if own.sum() >= LEAST_ROWS and 0 < y.sum() < own.sum():
            tries = np.unique(np.round(q, 3))
            f1 = [2 * ((q >= t) & (y > 0)).sum() / ((q >= t).sum() + y.sum()) for t in tries]
            m.thresholds[lang] = float(np.median(tries[np.array(f1) >= max(f1) - 1e-12]))


def train(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES, label_col: str = "toxic") -> Model | None:
    """learn: makes of doc_id the condition that says which labelled rows may be used."""
    marked = labels.select(labels["doc_id"].alias("__id"), labels[label_col].alias("__y")).where("__y is not null").where(learn(F.col("__id")))
    picked = marked.distinct().orderBy(F.xxhash64("__id", F.lit(2)), "__id", "__y").limit(sample)
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("t"), "lang", F.col("__y").cast("int").alias("y"))
    # the bounds again, as documents may repeat: rows up to the last place at which rows and bytes are still few enough
    rows = rows.withColumn("place", F.struct(F.xxhash64("doc_id", F.lit(2)), "doc_id", "y", F.xxhash64("t")))
    sizes = rows.select("place", F.length("t").cast("long").alias("size")).orderBy("place").limit(sample)
    so_far = F.sum("size").over(Window.orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = sizes.withColumn("so_far", so_far).where(F.col("so_far") <= most_bytes).agg(F.max("place").alias("last"))
    got = rows.join(F.broadcast(last), F.col("place") <= F.col("last")).select("doc_id", "t", "lang", "y").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("t", "ascending")])
    texts, y = got.column("t").to_pylist(), np.array(got.column("y").to_pylist(), np.float32)
    if not 0 < (y > 0).sum() < len(y):
        return None
    langs = got.column("lang").to_pylist()
    kept = np.random.default_rng(1).random(len(y)) < 0.2
    if not 0 < y[kept].sum() < kept.sum() or not 0 < y[~kept].sum() < (~kept).sum():
        kept[:] = False
    m = fit([t for t, k in zip(texts, kept) if not k], y[~kept])
    if not kept.any():
        kept[:] = True  # too few rows to hold any back
    calibrate(m, [t for t, k in zip(texts, kept) if k], y[kept], [x for x, k in zip(langs, kept) if k])
    return m


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def scored(docs: DataFrame, m: Model | None) -> DataFrame:
    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or b"" for t in as_bytes(b.column(1))]
        p = m.scores(texts) if m else np.zeros(len(texts))
        cut = np.array([m.thresholds.get(x, PREDICT) if m else PREDICT for x in b.column(2).to_pylist()])
        cols = [b.column(0), pa.array(p), pa.array((p >= PREDICT).astype(np.int32)), pa.array(cut), pa.array((p >= cut).astype(np.int32))]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "score", "predicted", "lang_threshold", "lang_predicted"])

    picked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), docs["lang"].cast("string").alias("lang"))
    out = map_batches(picked, rows, "doc_id long, score double, predicted int, lang_threshold double, lang_predicted int")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted", "lang_threshold", "lang_predicted")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels"), lambda i: ~held_out(i)))
