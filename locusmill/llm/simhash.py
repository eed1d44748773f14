"""SimHash near-duplicates by pivot distance tables.

Fingerprints x and y that differ in at most r bits satisfy |d(x, p) - d(y, p)| <= r for any reference fingerprint p.
Two tables of distances come of that.

Block table: its references are 0 and the unit fingerprints, in ``parts`` groups. The difference d(x, p) - d(x, 0)
moves only with the bits that belong to p, so r differing bits leave the differences of at least ``parts - r`` groups
as they are. Every choice of ``parts - r`` groups gives a block key; pairs linked at r bits share one of these keys.

Filter table: inside a block, pairs whose largest coordinate difference over SPREAD references is above r are
discarded; the survivors are verified with the exact Hamming distance.

Only spanning links of a block leave it, never all of its pairs. A block that is larger than CHUNK is dealt out as
pairs of chunks, so that no task ever holds it whole and none of its comparisons is left out.

Defined results: null, empty and white-space texts have fingerprint zero and link like any other. Repeated rows and
ties are members of one class; its id is the smallest doc_id, null ids last. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, cut, map_batches, table, whole_row
from .components import components

SHINGLE, SEED, BITS = 3, 42, 64
RADIUS, PARTS, CHUNK, SPREAD = 3, 5, 1024, 24


def fingerprint(raw: bytes, k: int = SHINGLE) -> int:
    words = raw.lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        h = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[: -k])).tolist()
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, (ends[k - 1 :] - 1).tolist())), np.uint64, len(starts))
    return majority(h)


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half the hashes; zero if there are none."""
    ones = np.zeros(BITS, np.int64)
    for o in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[o : o + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, fp: the fingerprint as a signed long; then the string columns to keep."""

    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(x or b"") for x in as_bytes(b.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], ["doc_id", "fp", *keep])

    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), *keep)
    return map_batches(picked, rows, ", ".join(["doc_id long, fp long", *(f"{c} string" for c in keep)]))


def references(n: int = SPREAD, seed: int = 8) -> np.ndarray:
    """The filter table's reference fingerprints, spread at random."""
    return np.random.default_rng(seed).integers(0, 2**64, n, np.uint64)


def groups(parts: int = PARTS) -> list[np.ndarray]:
    return np.array_split(np.arange(BITS), parts)


def block_keys(fp: np.ndarray, radius: int = RADIUS, parts: int = PARTS) -> np.ndarray:
    """A row of keys for each fingerprint: one for every choice of parts - radius groups of the block table."""
    zero = np.bitwise_count(fp).astype(np.int16)
    coords = np.empty((len(fp), BITS), np.int16)  # d(x, unit) - d(x, 0), that is 1 or -1
    for i in range(BITS):
        coords[:, i] = np.bitwise_count(fp ^ np.uint64(1 << i)).astype(np.int16) - zero
    keys = []
    for j, chosen in enumerate(combinations(groups(parts), parts - radius)):
        bits = np.concatenate(chosen)
        packed = np.zeros(len(fp), np.uint64)
        for place, i in enumerate(bits):
            packed |= (coords[:, i] < 0).astype(np.uint64) << np.uint64(place)
        keys.append(packed << np.uint64(6) | np.uint64(j) if len(bits) <= 58 else packed)
    return np.stack(keys, 1)


def spanning(left: np.ndarray, right: np.ndarray | None, radius: int, pivots: np.ndarray) -> list[tuple[int, int]]:
    """Links that span what the pairs of left with right (None: pairs within left) connect. All of these pairs are tried."""
    every = left if right is None else np.concatenate([left, right])
    other = left if right is None else right
    far = np.bitwise_count(every[:, None] ^ pivots).astype(np.int16)
    table, skip = far[-len(other) :], 0 if right is None else len(left)
    parent = list(range(len(every)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(left)):
        near = np.flatnonzero(np.abs(table[:, :4] - far[i, :4]).max(1) <= radius)
        near = near[np.abs(table[near] - far[i]).max(1) <= radius]
        near = near[np.bitwise_count(other[near] ^ left[i]) <= radius] + skip
        for j in near.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    # a star around the smallest of each component: what joins later then has no other hub
    value = every.view(np.int64).tolist()
    centre: dict[int, int] = {}
    roots = [root(i) for i in range(len(every))]
    for i, r in enumerate(roots):
        centre[r] = min(centre.get(r, value[i]), value[i])
    return [(centre[r], value[i]) for i, r in enumerate(roots) if centre[r] != value[i]]


def links(fps: DataFrame, radius: int = RADIUS, parts: int = PARTS, chunk: int = CHUNK, spread: int = SPREAD) -> DataFrame:
    """a, b: links whose components are those of all pairs of distinct fingerprints (column fp) at most radius bits apart."""

    def keyed(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.asarray(b.column(0))
        keys = block_keys(fp.view(np.uint64), radius, parts)
        n = keys.shape[1]
        return pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fp, n))], ["block", "fp"])

    rows = cut(map_batches(fps.select("fp"), keyed, "block long, fp long"))
    sizes = rows.groupBy("block").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(sizes, "block").withColumn("side", F.ceil(F.col("n") / chunk).cast("int"))
    # chunk c of a block meets the chunks from 0 to side - 1; a unit of work is a pair (low, high) of chunks
    mine = F.pmod(F.xxhash64("fp", F.lit(8)), F.col("side")).cast("int")
    units = rows.withColumn("mine", mine).select(
        "block", "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("side") - 1)).alias("other")
    ).select("block", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "fp")

    def within(block: pa.Table) -> pa.Table:
        pivots = references(spread)
        fp, mine = np.asarray(block.column("fp")).view(np.uint64), np.asarray(block.column("mine"))
        low, high = block.column("low")[0].as_py(), block.column("high")[0].as_py()
        found = spanning(fp, None, radius, pivots) if low == high else spanning(fp[mine == low], fp[mine == high], radius, pivots)
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return units.groupBy("block", "low", "high").applyInArrow(within, "a long, b long").distinct()


def classes(prints: DataFrame) -> DataFrame:
    """fp, label, component_id for the (doc_id, fp) rows: label tells the classes apart, component_id is the smallest doc_id among all documents that links reach."""
    heads = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("head")))
    found = components(links(heads))
    named = heads.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("head").alias("component_id"))
    return named.join(least, "label").select("fp", "label", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id: one row per row of docs."""
    prints = cut(fingerprints(docs, id_col, text_col))
    return prints.join(classes(prints), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def by_fingerprint(keyed: DataFrame) -> DataFrame:
    """key, doc_id, label for the (key, doc_id, text) rows: the classes of near_duplicates()."""
    prints = cut(fingerprints(keyed, id_col="doc_id", keep=["key"]))
    return prints.join(classes(prints), "fp").select("key", "doc_id", "label")


def representatives(docs: DataFrame, label: Callable[[DataFrame], DataFrame] = by_fingerprint) -> DataFrame:
    """One row of each class, other columns as they are: that with the smallest doc_id, null ids last, then by a digest of the text.

    Rows are told apart by id and text, so that neither null nor repeated ids join what is in different classes.
    """
    ident, text = F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.concat(F.lit(":"), F.col("text")), F.lit(""))
    key = F.md5(F.concat(ident, text)).alias("key")
    named = label(docs.select(key, F.col("doc_id").cast("long").alias("doc_id"), "text"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("best")
    heads = named.groupBy("label").agg(best).select(F.col("best.key").alias("head"))
    rows = docs.select(key, whole_row(docs))
    return rows.join(heads, F.col("key") == F.col("head"), "left_semi").dropDuplicates(["key"]).select("row.*")
