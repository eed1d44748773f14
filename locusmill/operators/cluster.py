"""Clustering submitted variants: assignment, merges, splits and back-propagation.

Choices that a running job makes pair by pair are minima over a total order here, so they do not depend on the order
in which rows arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import expr as E
from .accession import block_id, ranked
from .graph import bipartite, cut

# Reasons written to the event logs, read back by the release
REASON_CLUSTERED = "Clustering submitted variant %d with rs%d"
REASON_MERGED = "Original rs%d associated with SS was merged into rs%d."
REASON_MERGED_RS = "After remapping to %s, RS IDs mapped to the same locus."
REASON_SPLIT = "SS was associated with the split RS rs%d after rs%d was split."


def best(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each group by an order; keeps one row per group even where rows are equal."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__n", n).where("__n = 1").drop("__n")


# --- choices ----------------------------------------------------------------------------------------------------


def merge_destinations(sve: DataFrame) -> DataFrame:
    """A5: seq, rs_hash, target, n_rs of loci with more than one RS: the smallest RS is the target."""
    found = sve.where("rs is not null").groupBy("seq", "rs_hash").agg(F.min("rs").alias("target"), F.countDistinct("rs").alias("n_rs"))
    return found.where("n_rs > 1")


def loci(sve: DataFrame) -> DataFrame:
    """seq, rs, rs_hash, n_ss, min_ss, summary of each locus of an RS: what the split policy looks at. A15: a row (hash, accession) counts once."""
    distinct = sve.where("rs is not null").select("seq", "rs", "rs_hash", "ss_hash", "accession", E.rs_summary().alias("summary")).distinct()
    return distinct.groupBy("seq", "rs", "rs_hash").agg(F.count("*").alias("n_ss"), F.min("accession").alias("min_ss"), F.min("summary").alias("summary"))


def split_ranks(sve: DataFrame) -> DataFrame:
    """loci() of RSs at several loci, with keeps: most submissions, then the oldest, then the first summary (what the hash is made of)."""
    one = Window.partitionBy("seq", "rs")
    rows = loci(sve).withColumn("n_loci", F.count("*").over(one)).where("n_loci > 1")
    n = F.row_number().over(one.orderBy(F.desc("n_ss"), "min_ss", "summary"))
    return rows.withColumn("keeps", n == 1)


def duplicate_ss_ranks(sve: DataFrame) -> DataFrame:
    """Rows of a submitted id at several loci of an assembly, with keeps: an RS, then evidence, then the first summary (what the hash is made of).

    Multimapped, mismatching and remapped rows are not looked at.
    """
    rows = sve.where(F.col("map_weight").isNull() & E.flag("alleles_match", True) & F.col("remapped_from").isNull())
    rows = rows.dropDuplicates(["seq", "accession", "ss_hash"])
    one = Window.partitionBy("seq", "accession")
    rows = rows.withColumn("n_rows", F.count("*").over(one)).where("n_rows > 1")
    n = F.row_number().over(one.orderBy(F.col("rs").isNull(), ~E.flag("evidence", True), E.ss_summary()))
    return rows.withColumn("keeps", n == 1)


# --- L4, L5 -----------------------------------------------------------------------------------------------------


def assign(unclustered: DataFrame, cve: DataFrame) -> DataFrame:
    """Unclustered rows of whose locus an RS is known, with that RS (the smallest). Multimapped RSs are not given."""
    known = cve.where("map_weight is null").groupBy("rs_hash").agg(F.min("accession").alias("new_rs"))
    return unclustered.where("map_weight is null").join(known, "rs_hash").withColumn("rs", F.col("new_rs")).drop("new_rs")


def update_events(changed: DataFrame, reason: Column, event: str = S.UPDATED, old_rs: str = "rs") -> DataFrame:
    """id, event, accession, reason, ss_hash, old_rs: one event per changed row; the id makes appends repeatable."""
    return changed.select(
        E.event_id(event, F.col("seq"), F.col("ss_hash"), F.coalesce(F.col(old_rs).cast("string"), F.lit("none"))).alias("id"),
        F.lit(event).alias("event"), "accession", reason.alias("reason"), "ss_hash", F.col(old_rs).alias("old_rs"),
    )


def classify(remapped: DataFrame, cve: DataFrame) -> DataFrame:
    """Remapped clustered rows as same, merge, split or new, by what is known of their hash and of their RS.

    In an order by accession and hash, the first RS of a locus owns it. Another RS there is a merge candidate, an RS
    that owns or meets a second locus a split candidate; a locus is new if neither it nor its RS was known.
    """
    stored = cve.groupBy("rs_hash").agg(F.min("accession").alias("owner"))
    rows = remapped.join(stored, "rs_hash", "left")
    first = F.first("rs").over(Window.partitionBy("rs_hash").orderBy("accession", "ss_hash"))
    rows = rows.withColumn("known", F.col("owner").isNotNull()).withColumn("owner", F.coalesce("owner", first))
    places = cve.select(F.col("accession").alias("rs"), "rs_hash").unionByName(remapped.select("rs", "rs_hash")).groupBy("rs").agg(F.countDistinct("rs_hash").alias("n_loci"))
    rows = rows.join(places, "rs")
    kind = F.when(F.col("owner") != F.col("rs"), "merge").when(F.col("n_loci") > 1, "split").when(F.col("known"), "same").otherwise("new")
    return rows.withColumn("kind", kind)


def merge_candidates(sve: DataFrame) -> DataFrame:
    """id, event, seq, rs_hash of loci with several RSs."""
    return merge_destinations(sve).select(E.event_id("RSMC", F.col("seq"), F.col("rs_hash")).alias("id"), F.lit(S.RS_MERGE_CANDIDATES).alias("event"), "seq", "rs_hash", "n_rs")


def split_candidates(sve: DataFrame) -> DataFrame:
    """id, event, seq, rs of RSs at several loci."""
    rows = loci(sve).groupBy("seq", "rs").agg(F.count("*").alias("n_loci")).where("n_loci > 1")
    return rows.select(E.event_id("RSSC", F.col("seq"), F.col("rs").cast("string")).alias("id"), F.lit(S.RS_SPLIT_CANDIDATES).alias("event"), "seq", "rs", "n_loci")


def without_candidates(events: DataFrame, assembly: str) -> DataFrame:
    """L9."""
    ours = F.col("id").startswith(f"RSMC_{assembly}_") | F.col("id").startswith(f"RSSC_{assembly}_")
    return events.where(~ours)


# --- L6 ---------------------------------------------------------------------------------------------------------


def merge_map(sve: DataFrame) -> DataFrame:
    """G1: seq, rs, target for RSs that are merged: all RSs that loci connect become the smallest of them."""
    return bipartite(sve.where("rs is not null"), ["seq"], "rs", "rs_hash").where("node <> label").select("seq", F.col("node").alias("rs"), F.col("label").alias("target"))


def merge(sve: DataFrame, mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The submitted rows after all merges, their UPDATED events, and the MERGED events.

    Each merged RS gets one event, to its final target, whatever the order in which candidates would be met.
    """
    mapping = merge_map(sve) if mapping is None else mapping
    rows = sve.withColumn("old_rs", F.col("rs")).join(mapping, ["seq", "rs"], "left").withColumn("rs", F.coalesce("target", "rs")).drop("target")
    changed = rows.where("old_rs <> rs")
    updates = update_events(changed, F.format_string(REASON_MERGED, "old_rs", "rs"), old_rs="old_rs")
    merges = mapping.select(
        E.event_id(S.MERGED, F.col("seq"), F.col("rs").cast("string"), F.col("target").cast("string")).alias("id"), F.lit(S.MERGED).alias("event"),
        F.col("rs").alias("accession"), F.col("target").alias("merge_into"), F.format_string(REASON_MERGED_RS, "seq").alias("reason"), "seq",
    )
    return rows.drop("old_rs").select(*sve.columns), updates, merges


# --- L7, L8 -----------------------------------------------------------------------------------------------------


def split(sve: DataFrame, start: int, interval: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The submitted rows after all splits, RS_SPLIT events, and the new clustered rows (rs, rs_hash, seq).

    The keeper stays; every other locus of an RS gets an id of its own, unless its hash has got one already, which is
    what makes a second run change nothing.
    """
    losers = cut(split_ranks(sve).where("not keeps").select("seq", "rs", "rs_hash"))
    fresh = ranked(losers.select("seq", "rs_hash").distinct(), "rs_hash").select("seq", "rs_hash", block_id(F.col("n"), start, interval).alias("new_rs"))
    moves = losers.join(fresh, ["seq", "rs_hash"])
    rows = sve.join(moves, ["seq", "rs", "rs_hash"], "left").withColumn("rs", F.coalesce("new_rs", "rs")).select(*sve.columns)
    events = moves.select(
        E.event_id("RS", "SPLIT", F.col("seq"), F.col("rs").cast("string"), F.col("rs_hash")).alias("id"), F.lit(S.RS_SPLIT).alias("event"),
        F.col("rs").alias("accession"), F.col("new_rs").alias("split_into"), "seq", "rs_hash",
    )
    return rows, events, fresh.select(F.col("new_rs").alias("rs"), "rs_hash", "seq")


def keeper_rows(sve: DataFrame, cve: DataFrame) -> DataFrame:
    """The clustered rows (rs, rs_hash, seq) of keepers whose hash no stored row has; a hash that several RSs keep goes to the smallest."""
    kept = split_ranks(sve).where("keeps").groupBy("rs_hash", "seq").agg(F.min("rs").alias("rs"))
    return kept.join(cve.select("rs_hash"), "rs_hash", "left_anti").select("rs", "rs_hash", "seq")


def split_duplicate_ss(sve: DataFrame, start: int, interval: int) -> DataFrame:
    """Id, event, accession, split_into, ss_hash: all but the keeper of a submitted id get new ids."""
    losers = cut(duplicate_ss_ranks(sve).where("not keeps").select("seq", "accession", "ss_hash"))
    fresh = ranked(losers.select("ss_hash").distinct(), "ss_hash").select("ss_hash", block_id(F.col("n"), start, interval).alias("split_into"))
    rows = losers.join(fresh, "ss_hash")
    return rows.select(
        F.concat(F.lit("SS_SPLIT_FROM_"), F.col("accession").cast("string"), F.lit("_TO_"), F.col("split_into").cast("string")).alias("id"),
        F.lit(S.SS_SPLIT).alias("event"), "accession", "split_into", "ss_hash", "seq",
    )


# --- L10 --------------------------------------------------------------------------------------------------------


def back_propagate(original: DataFrame, remapped: DataFrame) -> DataFrame:
    """Original rows that get a back-propagated RS: the largest of their twins on the later assembly.

    Rows whose alleles do not match, and those that have that RS already, are left alone.
    """
    found = remapped.where("rs is not null").groupBy("accession").agg(F.max("rs").alias("twin_rs"))
    rows = original.where(E.flag("alleles_match", True)).join(found, "accession")
    changed = ~F.col("twin_rs").eqNullSafe(F.col("rs")) & ~F.col("twin_rs").eqNullSafe(F.col("back_prop_rs"))
    return rows.where(changed).withColumn("back_prop_rs", F.col("twin_rs")).drop("twin_rs")


def metrics(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows, clustered before and after, newly clustered, changed and left unclustered."""
    old = before.select("ss_hash", "accession", "seq", F.col("rs").alias("old_rs"))
    both = old.join(after.select("ss_hash", "accession", "seq", "rs"), ["ss_hash", "accession", "seq"])
    return both.agg(
        F.count("*").alias("n_rows"), F.count("old_rs").alias("n_clustered_before"), F.count("rs").alias("n_clustered_after"),
        F.count_if(F.col("old_rs").isNull() & F.col("rs").isNotNull()).alias("n_newly_clustered"), F.count_if(F.col("old_rs") != F.col("rs")).alias("n_updated"),
        F.count_if(F.col("rs").isNull()).alias("n_kept_unclustered"),
    )


def operation_counts(cve_events: DataFrame, sve_events: DataFrame) -> DataFrame:
    """One row of counters, from the event logs of clustered and of submitted rows."""
    logs = cve_events.select(F.lit("rs").alias("what"), "event").unionByName(sve_events.select(F.lit("ss").alias("what"), "event"))
    counters = {
        "n_rs_split": ("rs", S.RS_SPLIT), "n_merge_operations": ("rs", S.MERGED), "n_rs_deprecated": ("rs", S.DEPRECATED),
        "n_update_operations": ("ss", S.UPDATED), "n_ss_split": ("ss", S.SS_SPLIT), "n_ss_deprecated": ("ss", S.DEPRECATED),
    }
    return logs.agg(*(F.count_if((F.col("what") == what) & (F.col("event") == event)).alias(n) for n, (what, event) in counters.items()))
