"""Exact top-k search over binary codes by incremental multi-index hashing, routed over the cluster.

Codes are cut into SEGMENTS parts, each with an index of its own. An index is dealt into cells by the first bits of its
part. At radius r a query asks for the codes whose part differs from its own in r bits, in every index, and it goes to
those cells only whose bits differ from its own in r places or fewer. After radius r every code at a distance of at most
SEGMENTS * (r + 1) - 1 has been met: a farther one would differ in more bits somewhere. A query is done once k rows
other than itself lie within that distance. A round over the cluster takes STEP radii. What is left when a radius
reaches all cells meets every code once.

Equal codes are one entry that holds its k + 1 smallest ids, more can never be returned. The number of cells grows with
the entries. A cell with more than BLOCK entries is dealt into blocks, the queries of one cell into batches; every batch
of a cell meets every block of that cell.

Defined results: rows without a code (null or empty vector) neither ask nor are found. A vector of fewer components than
bits has zeros for the rest; one of more is an error. A row is not its own neighbour; ties go to the smaller id; with k
or fewer other rows all are returned. Of rows with the same id that with the smallest code counts.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, map_batches, table

BITS, SEGMENTS, K, EVERY = 64, 4, 10, 50
CELL, BLOCK, BATCH = 4096, 65_536, 4096
LEAST_PREFIX = 4  #: bits that tell the cells of an index apart, at the least
STEP = 2


def codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = BITS) -> DataFrame:
    """vec_id, code: bit i is set if component i is above zero."""

    def signs(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for v in b.column(1).to_pylist():
            if len(v) > bits:
                raise ValueError(f"a vector has {len(v)} components, more than {bits}")
            out.append(sum(1 << i for i, x in enumerate(v) if x is not None and x > 0))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(out, np.uint64).view(np.int64))], ["vec_id", "code"])

    picked = rows.select(rows[id_col].cast("long").alias("vec_id"), rows[vector_col].alias("v")).where("vec_id is not null and size(v) > 0")
    return map_batches(picked, signs, "vec_id long, code long")


def flips(width: int) -> list[np.ndarray]:
    """By radius: the masks of width bits with so many bits set."""
    return [np.array([sum(1 << i for i in c) for c in combinations(range(width), r)], np.int64) for r in range(width + 1)]


class Index:
    """One block of a cell: its entries by the bits of their part that the cell leaves open."""

    def __init__(self, block: np.ndarray, counts: np.ndarray, shift: int, width: int):
        """block: distinct codes. counts: rows behind each. The open bits are the width ones from shift on."""
        self.block, self.counts, self.shift, self.width, self.masks = block, counts, shift, width, flips(width)
        part = self.open(block)
        self.order = np.argsort(part, kind="stable")
        self.edge = np.searchsorted(part[self.order], np.arange((1 << width) + 1))

    def open(self, code: np.ndarray) -> np.ndarray:
        return ((code >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def search(self, code: np.uint64, least: int, most: int, far: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of entries that differ in least to most open bits and lie within far: the k nearest rows, the nearest entries whole."""
        places = np.arange(len(self.block))
        if least > 0 or most < self.width:
            near = int(self.open(np.array([code]))[0]) ^ np.concatenate(self.masks[least : most + 1])
            lo, hi = self.edge[near], self.edge[near + 1]
            some = np.flatnonzero(hi > lo)
            places = np.concatenate([self.order[a:b] for a, b in zip(lo[some].tolist(), hi[some].tolist())]) if len(some) else places[:0]
        d = np.bitwise_count(self.block[places] ^ code).astype(np.int64)
        places, d = places[d <= far], d[d <= far]
        enough = np.flatnonzero(np.cumsum(np.bincount(d, weights=self.counts[places])) >= k) if len(d) else []
        keep = d <= enough[0] if len(enough) else slice(None)
        return places[keep], d[keep]


def met(index: DataFrame, cells: DataFrame, pending: DataFrame, radii: range | None, k: int, segments: int, width: int, prefix: int, batch: int) -> DataFrame:
    """code, distance, neighbor_id: for the codes of pending, the nearest of the rows at one of these radii in some segment (None: of all rows)."""
    rest = width - prefix
    low, high = (radii[0], radii[-1]) if radii else (0, width)
    masks = [m for m in range(1 << prefix) if low - rest <= m.bit_count() <= high]
    flip = F.explode(F.split(F.lit(",".join(map(str, masks))), ",").cast("array<int>"))  # one literal, however many
    home = [F.struct(F.lit(j).alias("segment"), cell_of("code", j, width, prefix).alias("home")) for j in range(segments if radii else 1)]
    probe = pending.select("code", "far", F.explode(F.array(*home)).alias("at")).select("code", "far", "at.*", flip.alias("flip"))
    apart, cell = F.bit_count("flip"), F.col("home").bitwiseXOR(F.col("flip"))
    least, most = F.greatest(F.lit(low) - apart, F.lit(0)), F.least(F.lit(high) - apart, F.lit(rest))
    probe = probe.select("code", "far", "segment", cell.alias("cell"), least.cast("int").alias("least"), most.cast("int").alias("most"))
    load = probe.groupBy("segment", "cell").agg(F.ceil(F.count("*") / batch).cast("int").alias("batches"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # load and cells have a row for each cell, 2 ** prefix a segment at most. They are named as what is broadcast, since Spark takes
    # what is exploded for no larger than what it comes from, and would send all that queries ask to the driver instead.
    ask = probe.join(F.broadcast(load.join(F.broadcast(cells), ["segment", "cell"])), ["segment", "cell"])
    ask = ask.withColumn("batch", F.pmod(F.xxhash64("code", F.lit(2)), F.col("batches")).cast("int")).withColumn("block", every("blocks"))
    have = index.join(F.broadcast(load), ["segment", "cell"]).withColumn("batch", every("batches"))

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if mine.num_rows and theirs.num_rows:
            ids = mine.column("ids").to_pylist()
            block = Index(np.asarray(mine.column("code")).view(np.uint64), np.array([len(x) for x in ids]), theirs.column("segment")[0].as_py() * width, rest)
            asked = (np.asarray(theirs.column(n)) for n in ("code", "least", "most", "far"))
            for code, least, most, far in zip(*asked):
                places, d = block.search(code.view(np.uint64), int(least), int(most), int(far), k)
                found = sorted((x, i) for p, x in zip(places.tolist(), d.tolist()) for i in ids[p])[:k]
                out += [(int(code), x, i) for x, i in found]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("code", "distance", "neighbor_id"), cols)})

    unit = ["segment", "cell", "block", "batch"]
    mine = have.select(*unit, "code", "ids").groupBy(*unit)
    return mine.cogroup(ask.select(*unit, "code", "least", "most", "far").groupBy(*unit)).applyInArrow(search, "code long, distance long, neighbor_id long")


def cell_of(code: str, segment: int, width: int, prefix: int) -> Column:
    """The first prefix bits of a segment."""
    return F.shiftrightunsigned(code, segment * width + width - prefix).bitwiseAND(F.lit((1 << prefix) - 1)).cast("int")


def top_k(
    rows: DataFrame, asks: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", segments: int = SEGMENTS, cell: int = CELL, block: int = BLOCK, batch: int = BATCH
) -> DataFrame:
    """vec_id, rank, neighbor_id, distance: the k nearest other rows of each row for which asks holds (a condition on vec_id).

    cell: entries that a cell should have on average. Of the k + 1 best rows of a query one may be itself.
    """
    least = F.min(F.col("code").bitwiseXOR(F.lit(-(1 << 63)))).bitwiseXOR(F.lit(-(1 << 63)))  # as unsigned
    coded = cut(codes(rows, id_col, vector_col).groupBy("vec_id").agg(least.alias("code")))
    first = Window.partitionBy("code").orderBy("vec_id")
    entries = coded.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    entries = cut(entries.groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    width = BITS // segments
    prefix = min(width, max(LEAST_PREFIX, (entries.count() // cell).bit_length()))
    home = F.explode(F.array(*(F.struct(F.lit(j).alias("segment"), cell_of("code", j, width, prefix).alias("cell")) for j in range(segments))))
    placed = entries.select("code", "ids", home.alias("at")).select("code", "ids", "at.*")
    cells = cut(placed.groupBy("segment", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))
    index = cut(placed.join(F.broadcast(cells), ["segment", "cell"]).withColumn("block", F.pmod(F.xxhash64("code", F.lit(1)), F.col("blocks")).cast("int")).drop("blocks"))

    # a row without a neighbour stands for those not found yet; it is farther than any other
    wanted = cut(coded.where(asks))
    none = [F.lit(BITS + 1).cast("long").alias("distance"), F.lit(None).cast("long").alias("neighbor_id"), F.lit(BITS + 1).cast("long").alias("far")]
    best, done = wanted.select("code").distinct().select("code", *none), []
    order = Window.partitionBy("code").orderBy("distance", F.col("neighbor_id").asc_nulls_last())
    for radii in [*(range(r, min(r + STEP, prefix)) for r in range(0, prefix, STEP)), None]:
        pending = best.groupBy("code").agg(F.max("distance").alias("far"))
        both = best.drop("far").unionByName(met(index, cells, pending, radii, k + 1, segments, width, prefix, batch)).distinct()
        kept = both.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
        fresh = cut(kept.select("code", "distance", "neighbor_id", F.max("distance").over(Window.partitionBy("code")).alias("far")))
        if radii is None:
            done.append(fresh)
            break
        covered = segments * (radii[-1] + 1) - 1
        done.append(fresh.where(F.col("far") <= covered))
        best = fresh.where(F.col("far") > covered)
        if best.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    mine = wanted.join(found.drop("far"), "code").where("vec_id <> neighbor_id")
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy("distance", "neighbor_id")).cast("long")
    return mine.withColumn("rank", rank).where(F.col("rank") <= k).select("vec_id", "rank", "neighbor_id", "distance")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


SQL = f"""
WITH bits AS (
  SELECT vec_id, array_to_string(list_transform(range({BITS}, 0, -1), lambda i: CASE WHEN coalesce(embedding[i] > 0, false) THEN '1' ELSE '0' END), '') AS b
  FROM embeddings WHERE len(embedding) > 0 AND vec_id IS NOT NULL
), codes AS (
  SELECT vec_id, min(b)::BIT AS b FROM bits GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id, e.vec_id AS neighbor_id, bit_count(xor(q.b, e.b))::BIGINT AS distance FROM codes q JOIN codes e ON q.vec_id <> e.vec_id WHERE q.vec_id % {EVERY} = 0
), ranked AS (
  SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS rank, neighbor_id, distance FROM pairs
)
SELECT vec_id, rank, neighbor_id, distance FROM ranked WHERE rank <= {K}
"""
