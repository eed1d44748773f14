"""Near-duplicates by similarity: sets of five-word shingles whose Jaccard similarity is 0.8 or more are linked.

Candidates come from two sources. The pivot distance tables of ``simhash`` link sets whose SimHash fingerprints, taken
from the same shingles, differ in at most its RADIUS bits; they lose none of these. Most pairs at 0.8 are farther apart
than that, so sets also meet by BANDS keys of ROWS minima each, of the set under as many hash functions. A pair at 0.8
shares no key once in 300,000 times, a closer one less often. Inside a block of one key, 64 of the minima, two bits
each, tell which pairs are surely below 0.8 (six standard deviations). The links of both sources make candidate groups.
Inside those the similarity of every pair that is not connected yet is counted exactly, from the shingles themselves.

Blocks and groups larger than CHUNK are dealt out as pairs of chunks, and only spanning links leave them.

Defined results: null, empty and white-space texts are one class; a text of up to five words is one shingle. Letters
count without ASCII case, as in ``simhash``. Equal sets are one class.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import as_bytes, cut, map_batches
from .components import components

WORDS, SIMILAR, SEED = 5, 0.8, 42
BANDS, ROWS, SKETCH, LEAST, CHUNK = 24, 4, 64, 37, 512
PAIRS_OF_BITS = 0x5555555555555555


def shingles(raw: bytes, k: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = raw.lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return np.zeros(0, np.uint64)
    joined, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: max(1, len(words) - k + 1)].tolist()
    stops = (ends[k - 1 :] - 1).tolist() or [len(joined)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, stops)), np.uint64, len(starts)))


def functions() -> tuple[np.ndarray, np.ndarray]:
    a, b = np.random.default_rng(5).integers(0, 2**64, (2, BANDS * ROWS), np.uint64)
    return a | np.uint64(1), b


def minima(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), 2**64 - 1, np.uint64)
    for o in range(0, len(h), 1024):
        np.minimum(least, (h[o : o + 1024, None] * a + b).min(0), out=least)
    return least


def sketched(keyed: DataFrame) -> DataFrame:
    """key, doc_id, set (a digest of the shingles), fp (their fingerprint), blocks, s0 and s1 for the (key, doc_id, text) rows."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = functions()
        sets, prints, blocks, sketches = [], [], [], []
        for raw in as_bytes(batch.column(2)):
            h = shingles(raw or b"")
            sets.append(xxhash.xxh3_64_intdigest(h.tobytes()))
            prints.append(simhash.majority(h))
            least = minima(h, a, b)
            blocks.append([xxhash.xxh3_64_intdigest(x.tobytes(), i) for i, x in enumerate(least.reshape(BANDS, ROWS))])
            low = np.stack([least[:SKETCH] >> np.uint64(40) & np.uint64(1), least[:SKETCH] >> np.uint64(41) & np.uint64(1)], 1).astype(np.uint8)
            sketches.append(np.packbits(low.ravel(), bitorder="little").view(np.uint64))
        longs = lambda x: pa.array(np.array(x, np.uint64).view(np.int64).ravel())
        s = np.array(sketches, np.uint64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), longs(blocks))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), longs(sets), longs(prints), lists, longs(s[:, 0].copy()), longs(s[:, 1].copy())], ["key", "doc_id", "set", "fp", "blocks", "s0", "s1"]
        )

    return map_batches(keyed, rows, "key string, doc_id long, set long, fp long, blocks array<long>, s0 long, s1 long")


def agreeing(x: Column) -> Column:
    """How many of the 32 pairs of bits of a difference are zero."""
    either = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(PAIRS_OF_BITS))
    return F.lit(32) - F.bit_count(either)


def spanning(n_left: int, n: int, within: bool, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links (root, member) that span what near(i, others) connects: left with the rest, or within all of them."""
    label = np.arange(n)
    for i in range(n_left):
        others = np.arange(i + 1, n) if within else np.arange(n_left, n)
        others = others[label[others] != label[i]]
        for j in near(i, others).tolist():
            if label[j] != label[i]:
                low, high = sorted((label[i], label[j]))
                label[label == high] = low
    return [(int(r), i) for i, r in enumerate(label.tolist()) if r != i]


def dealt(rows: DataFrame, block: str, chunk: int) -> DataFrame:
    """rows (with their block's size n) once for each pair (low, high) of chunks of their block that they belong to."""
    side = F.ceil(F.col("n") / chunk).cast("int")
    rows = rows.withColumn("side", side).withColumn("mine", F.pmod(F.xxhash64("set", F.lit(8)), F.col("side")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("side") - 1)))
    return rows.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other")).drop("n", "side", "other")


def linked(unit: pa.Table, near_of: Callable[[pa.Table], Callable]) -> pa.Table:
    low, high = unit.column("low")[0].as_py(), unit.column("high")[0].as_py()
    unit = unit.sort_by("set") if low == high else unit.sort_by([("mine", "ascending"), ("set", "ascending")])
    n_left = unit.num_rows if low == high else int((np.asarray(unit.column("mine")) == low).sum())
    found = spanning(n_left, unit.num_rows, low == high, near_of(unit))
    ids = np.asarray(unit.column("set"))
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})


def candidates(heads: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """a, b: links that span all pairs which share a block and are not surely below SIMILAR."""
    rows = heads.select(F.explode("blocks").alias("block"), "set", "s0", "s1")
    one = F.struct("set", "s0", "s1")
    sizes = rows.groupBy("block").agg(F.count("*").alias("n"), F.min(one).alias("x"), F.max(one).alias("y")).where("n > 1")
    sizes = cut(sizes)
    same = agreeing(F.col("x.s0").bitwiseXOR(F.col("y.s0"))) + agreeing(F.col("x.s1").bitwiseXOR(F.col("y.s1")))
    twos = sizes.where("n = 2").where(same >= LEAST).select(F.col("x.set").alias("a"), F.col("y.set").alias("b"))

    def near_of(unit: pa.Table) -> Callable:
        s = np.stack([np.asarray(unit.column(c)) for c in ("s0", "s1")], 1).view(np.uint64)

        def near(i: int, others: np.ndarray) -> np.ndarray:
            x = s[others] ^ s[i]
            apart = np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(PAIRS_OF_BITS)).astype(np.int64).sum(1)
            return others[SKETCH - apart >= LEAST]

        return near

    units = dealt(rows.join(sizes.where("n > 2").select("block", "n"), "block"), "block", chunk)
    more = units.groupBy("block", "low", "high").applyInArrow(lambda t: linked(t, near_of), "a long, b long")
    return twos.union(more).distinct()


def pivoted(heads: DataFrame) -> DataFrame:
    """a, b: links that span all pairs of sets whose fingerprints differ in at most simhash.RADIUS bits."""
    first = cut(heads.groupBy("fp").agg(F.min("set").alias("a")))
    same = heads.select("fp", F.col("set").alias("b")).join(first, "fp").where("a <> b").select("a", "b")
    near = simhash.links(first).join(first.select(F.col("fp").alias("a"), F.col("a").alias("x")), "a")
    near = near.join(first.select(F.col("fp").alias("b"), F.col("a").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    return same.union(near)


def links(keyed: DataFrame, prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """a, b: links whose components are those of all pairs of sets with similarity SIMILAR or more."""
    heads = prints.groupBy("set").agg(F.min("key").alias("key"), F.first("fp").alias("fp"), F.first("blocks").alias("blocks"), F.first("s0").alias("s0"), F.first("s1").alias("s1"))
    heads = cut(heads)
    found = components(pivoted(heads).union(candidates(heads, chunk)))
    found = cut(found.union(found.select("label", "label").distinct()))  # node, label: also the smallest node of each
    members = found.join(heads.select(F.col("set").alias("node"), F.col("key").alias("head")), "node")
    members = members.join(found.groupBy("label").agg(F.count("*").alias("n")), "label")

    def shingled(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = pa.array([shingles(x or b"").tobytes() for x in as_bytes(batch.column(3))], pa.binary())
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), sets], ["set", "label", "n", "hashes"])

    texts = keyed.select("key", "text").join(members, F.col("key") == F.col("head")).dropDuplicates(["key"]).select(F.col("node").alias("set"), "label", "n", "text")
    units = dealt(map_batches(texts, shingled, "set long, label long, n long, hashes binary"), "label", chunk)

    def near_of(unit: pa.Table) -> Callable:
        sets = [np.frombuffer(x, np.uint64) for x in unit.column("hashes").to_pylist()]
        sizes = np.array([len(x) for x in sets])

        def near(i: int, others: np.ndarray) -> np.ndarray:
            # 10 * common >= 8 * (both - common) in whole numbers; sizes too far apart cannot reach it
            others = others[(5 * np.minimum(sizes[others], sizes[i]) >= 4 * np.maximum(sizes[others], sizes[i]))]
            if not len(others):
                return others
            every, mine = np.concatenate([sets[j] for j in others]), sets[i]
            hit = mine[np.minimum(np.searchsorted(mine, every), len(mine) - 1)] == every if len(mine) else np.zeros(len(every), bool)
            common = np.add.reduceat(hit.astype(np.int64), np.concatenate(([0], np.cumsum(sizes[others])[:-1])))
            return others[9 * common >= 4 * (sizes[others] + sizes[i])]

        return near

    return units.groupBy("label", "low", "high").applyInArrow(lambda t: linked(t, near_of), "a long, b long").distinct()


def similar(keyed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """key, doc_id, label for the (key, doc_id, text) rows: label tells the classes apart."""
    prints = cut(sketched(keyed))
    found = components(links(keyed, prints, chunk)).withColumnRenamed("node", "set")
    return prints.select("key", "doc_id", "set").join(found, "set", "left").select("key", "doc_id", F.coalesce("label", "set").alias("label"))
