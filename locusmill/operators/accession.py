"""Issuing accessions: known ones by hash, new ones by rank through blocks of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut


def block_id(n: Column, start: int, interval: int) -> Column:
    """L2: the id of the n-th new row (from 0): every other interval is left to others."""
    return F.lit(start).cast("long") + F.floor(n / F.lit(interval)) * (2 * interval) + n % interval


def ranked(rows: DataFrame, key: str, number: str = "n") -> DataFrame:
    """rows with their rank by key (from 0). Sorted by range; each partition adds the sizes of those before it.

    No task sees more than its own range. Keys must be distinct. rows are read twice, once to choose the ranges.
    """
    ordered = rows.repartitionByRange(key).sortWithinPartitions(key).withColumn("__id", F.monotonically_increasing_id())
    ordered = cut(ordered.withColumn("__part", F.shiftright("__id", 33)).withColumn("__local", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__id"))
    sizes = ordered.groupBy("__part").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    return ordered.join(offsets, "__part").withColumn(number, F.col("__before") + F.col("__local")).drop("__part", "__local", "__before")


def get_or_create(wanted: DataFrame, known: DataFrame, key: str, start: int, interval: int, sources: tuple[str, ...] = ("legacy", "current")) -> DataFrame:
    """Key, accession, is_new for each distinct key of wanted.

    known: key, accession, source; the first of sources that has a key gives the accession, its smallest.
    """
    order = F.element_at(F.create_map(*(F.lit(x) for i, s in enumerate(sources) for x in (s, i))), F.col("source"))
    have = known.where(F.col("source").isin(list(sources))).groupBy(key).agg(F.min(F.struct(order.alias("o"), "accession"))["accession"].alias("accession"))
    asked = cut(wanted.select(key).distinct().join(have, key, "left"))
    old = asked.where("accession is not null").select(key, "accession", F.lit(False).alias("is_new"))
    new = ranked(asked.where("accession is null").select(key), key)
    return old.unionByName(new.select(key, block_id(F.col("n"), start, interval).alias("accession"), F.lit(True).alias("is_new")))


def recovered(blocks: DataFrame, used: DataFrame, cutoff: Column, width: int = 100_000) -> DataFrame:
    """L3: blocks not updated since cutoff are released; last_committed becomes the end of the unbroken run of used ids.

    used: accession. Blocks and ids meet in bins of width ids, an equi-join; a block spans as many bins as it needs.
    """
    stale = blocks.where(F.col("reserved") & (F.col("updated") < cutoff)).select("id", "first_value", "last_value")
    low, high = (F.floor(F.col(x) / width) for x in ("first_value", "last_value"))
    binned = stale.withColumn("bin", F.explode(F.sequence(low, high)))
    ids = used.select("accession").distinct().withColumn("bin", F.floor(F.col("accession") / width))
    inside = ids.join(binned, "bin").where(F.col("accession").between(F.col("first_value"), F.col("last_value")))
    n = F.row_number().over(Window.partitionBy("id").orderBy("accession"))
    run = inside.withColumn("gap", F.col("accession") - F.col("first_value") - n + 1).where("gap = 0")
    ends = run.groupBy("id").agg(F.max("accession").alias("__end"))
    old = F.col("reserved") & (F.col("updated") < cutoff)
    out = blocks.join(ends, "id", "left").withColumn("last_committed", F.when(old, F.coalesce("__end", F.col("first_value") - 1)).otherwise(F.col("last_committed")))
    return out.withColumn("reserved", F.col("reserved") & ~old).drop("__end")


def missing(wanted: DataFrame, accessioned: DataFrame, key: str) -> DataFrame:
    """Distinct keys that got no accession; a run with any has failed."""
    return wanted.select(key).distinct().join(accessioned.select(key), key, "left_anti")


def counts(wanted: DataFrame, accessioned: DataFrame, key: str) -> DataFrame:
    """One row: submitted rows, distinct ones, duplicates, distinct ones with an accession and those without."""
    keys = wanted.groupBy(key).agg(F.count("*").alias("n")).join(accessioned.select(key, F.lit(True).alias("has")).distinct(), key, "left")
    total = F.coalesce(F.sum("n"), F.lit(0))
    return keys.agg(
        total.alias("n_submitted"), F.count("has").alias("n_accessioned"), F.count("*").alias("n_distinct"),
        (total - F.count("*")).alias("n_duplicate"), F.count_if(F.col("has").isNull()).alias("n_discarded"),
    )


def active(rows: DataFrame, ids: DataFrame, assembly_column: str, assembly: str, current_from: int) -> DataFrame:
    """Rows of an assembly whose accession is asked for, each asked of the table that its number belongs to."""
    routed = ids.select("accession", F.when(F.col("accession") >= current_from, "current").otherwise("legacy").alias("source")).distinct()
    return rows.where(F.col(assembly_column) == assembly).join(routed, ["accession", "source"], "left_semi")
