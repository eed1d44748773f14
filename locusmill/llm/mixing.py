"""Mixing sources to target weights by Pareto order sampling.

A source's target is shared among its documents by length: a document of k binary digits more is due 1 + k / LONGER times
as many copies, up to MOST_COPIES, and in such a proportion that the source comes to its target. Of what a document is due
the whole part is taken for certain; the fraction is its inclusion probability p for one copy more, which so differs
within a source. Documents are ranked by their random odds u / (1 - u) over their inclusion odds p / (1 - p), and the
lowest ranks are taken up to a fixed size, here counted in words: a document is in if at least half of it lies below what
the source still lacks. u is a hash of id and text, so reruns agree.

The place of the cut is found by sums over slices of the ranks, each 65536 slices finer than the one before, so that
no source is ever sorted or held in one task.

Defined results: a null text has size 0; null sources are one source, last in order; a source without words has target
0. Rows equal in id, source and text have random numbers of their own, which come of their places in the table: how many
of them are taken is the same in every run over the same files. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, table, text_of, whole_row

WEIGHTS, SHARE, MOST_COPIES = (3, 1, 2), 1.5, 2.0
#: So many doublings of the length make a document due once more what the shortest ones are.
LONGER = 8
STEP, BITS = 16, 48


def words(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def numbered(docs: DataFrame, *more: Column, seed: int = 9) -> DataFrame:
    """source, size, u for each row of docs, and more; written. Equal rows are told apart by their places in the table."""
    key = F.xxhash64(docs["doc_id"], docs["text"], docs["source"].cast("string"), F.lit(seed))
    rows = cut(docs.select(docs["source"].cast("string").alias("source"), words().alias("size"), key.alias("key"), F.monotonically_increasing_id().alias("at"), *more))
    # written, so that the planner knows its size, and need not deal out the rows where it is small
    again = cut(rows.groupBy(F.col("key").alias("again")).agg(F.count("*").alias("n")).where("n > 1").select("again"))
    h = F.when(F.col("again").isNull(), F.col("key")).otherwise(F.xxhash64("key", "at"))
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    return rows.join(again, F.col("key") == F.col("again"), "left").withColumn("u", u).drop("key", "at", "again")


def rank(u: Column, p: Column) -> Column:
    """The Pareto rank, mapped from odds to a whole number of BITS bits in the same order; null for p = 0."""
    q = u / (1 - u) * (1 - p) / F.nullif(p, F.lit(0.0))
    return F.floor(q / (1 + q) * float(1 << BITS)).cast("long")


def shared(rows: DataFrame, total: Column, w: str, cap: str, rise: list[Column], *keys: Column) -> DataFrame:
    """rows with got: what of a total each row of a group gets, by weight, none above its cap.

    rise: orders the rows by cap / weight, in which order they reach their caps as the common share / weight rises.
    """
    every = Window.partitionBy(*keys)
    before = every.orderBy(*rise).rowsBetween(Window.unboundedPreceding, -1)
    left = total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    weight = F.sum(w).over(every) - F.coalesce(F.sum(w).over(before), F.lit(0.0))
    n = F.row_number().over(every.orderBy(*rise))
    rows = rows.withColumn("at", F.struct(n.alias("n"), (left / F.nullif(weight, F.lit(0.0))).alias("level")))
    level = F.min(F.when(F.col("at.level") * F.col(w) <= F.col(cap), F.col("at"))).over(every)["level"]
    return rows.withColumn("got", F.least(cap, F.coalesce(level * F.col(w), F.col(cap)))).drop("at")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """source, source_size, target: weights repeat over sources in code-point order, no target is above most times its size."""
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    own = own.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("w", w)
    own = own.withColumn("cap", F.lit(most) * F.col("source_size"))
    total = F.sum(share * F.col("source_size")).over(Window.partitionBy(F.lit(0)))
    return shared(own, total, "w", "cap", [F.col("cap") / F.col("w"), F.col("place")], F.lit(0)).select("source", "source_size", F.col("got").alias("target"))


def kind(size: Column) -> Column:
    """The documents of a source that are due the same: by the binary digits of their sizes."""
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("int")


def goals(rows: DataFrame, of_sources: DataFrame, most: float = MOST_COPIES) -> DataFrame:
    """source, kind, source_size, target, copies, p, lack: what documents are due, and the words that their source lacks beyond its certain copies."""
    own = rows.groupBy("source", kind(F.col("size")).alias("kind")).agg(F.sum("size").cast("double").alias("words"))
    same = own["source"].eqNullSafe(of_sources["source"])
    own = own.join(of_sources, same).select(own["source"], "kind", "words", "source_size", "target")
    own = own.withColumn("w", F.col("words") * (1 + F.col("kind") / LONGER)).withColumn("cap", most * F.col("words"))
    own = shared(own, F.col("target"), "w", "cap", [F.desc("kind")], F.col("source"))
    due = F.when(F.col("words") > 0, F.least(F.col("got") / F.nullif("words", F.lit(0.0)), F.lit(most))).otherwise(0.0)
    own = own.withColumn("due", due).withColumn("copies", F.floor("due").cast("long")).withColumn("p", F.col("due") - F.floor("due"))
    lack = F.col("target") - F.sum(F.col("copies") * F.col("words")).over(Window.partitionBy("source"))
    return own.select("source", "kind", "source_size", "target", "copies", "p", lack.alias("lack"))


def with_goals(rows: DataFrame, due: DataFrame) -> DataFrame:
    """rows with what they are due; the planner broadcasts the written table while it is small."""
    due = due.withColumnsRenamed({"source": "__s", "kind": "__k"})
    return rows.join(due, F.col("source").eqNullSafe(F.col("__s")) & (kind(F.col("size")) == F.col("__k"))).drop("__s", "__k")


def cuts(rows: DataFrame, due: DataFrame) -> DataFrame:
    """source, last: one copy more for documents of ranks up to last. rows: source, size, u."""
    rows = with_goals(rows.select("source", "size", "u"), due).where("p > 0")
    rows = rows.select(F.col("source").alias("s"), "size", "lack", rank(F.col("u"), F.col("p")).alias("rank"))
    step, found = BITS, None
    while step:
        step -= STEP
        slices = rows.groupBy("s", F.shiftright("rank", step).alias("slice")).agg(F.sum("size").alias("n"), F.first("lack").alias("lack"))
        w = Window.partitionBy("s").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        slices = slices.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
        if not step:  # a slice is one rank now
            last = slices.where("before + n / 2 <= lack").groupBy("s").agg(F.max("slice").alias("least"))
            found = found.unionByName(last)
            break
        edge = slices.where("before < lack and before + n > lack or before + n <= lack")
        edge = edge.groupBy("s").agg(
            F.max(F.when(F.col("before") + F.col("n") <= F.col("lack"), F.col("slice"))).alias("whole"),
            F.max(F.when(F.col("before") + F.col("n") > F.col("lack"), F.struct("slice", "before"))).alias("split"),
        ).withColumn("at", F.col("split.slice")).withColumn("before", F.col("split.before"))
        edge = cut(edge.select("s", "whole", "at", "before"))
        done = edge.select("s", ((F.col("whole") + 1) * F.lit(1 << step) - 1).alias("least"))
        found = done if found is None else found.unionByName(done)
        e = edge.where("at is not null").select(F.col("s").alias("t"), "at", "before")
        rows = rows.join(e, F.col("s").eqNullSafe(F.col("t")) & (F.shiftright("rank", step) == F.col("at")))
        rows = cut(rows.select("s", "size", (F.col("lack") - F.col("before")).alias("lack"), "rank"))
    return found.groupBy(F.col("s").alias("source")).agg(F.max("least").alias("last"))


def decided(rows: DataFrame, weights: tuple, share: float, most: float) -> DataFrame:
    """rows with source_size, target, due and copies: how often the mix should and does take them. rows: numbered()."""
    due = cut(goals(rows, cut(targets(rows, weights, share, most)), most))
    last = cuts(rows, due)
    due = cut(due.join(last, due["source"].eqNullSafe(last["source"]), "left").select(due["source"], "kind", "source_size", "target", "copies", "p", F.coalesce("last", F.lit(-1)).alias("last")))
    more = F.coalesce(rank(F.col("u"), F.col("p")) <= F.col("last"), F.lit(False))
    return with_goals(rows, due).withColumn("due", F.col("copies") + F.col("p")).withColumn("copies", F.col("copies") + more.cast("long"))


def mixture(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES, seed: int = 9) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, copies, due: one row per document."""
    rows = numbered(docs, docs["doc_id"].cast("long").alias("doc_id"), seed=seed)
    return decided(rows, weights, share, most).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies", "due",
    )


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES, seed: int = 9) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken."""
    taken = decided(numbered(docs, whole_row(docs), seed=seed), weights, share, most).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))
