"""Lookups by accession or by fields, with what became of ids that are gone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import expr as E


def last_events(events: DataFrame, ids: DataFrame) -> DataFrame:
    """accession, event, merge_into, inactive of the last event of each id asked for; ties go to the larger id of the event."""
    rows = events.join(ids.select("accession").distinct(), "accession", "left_semi")
    last = F.max(F.struct("created", "id", "event", "merge_into", "inactive")).alias("e")
    return rows.groupBy("accession").agg(last).select("accession", "e.event", "e.merge_into", "e.inactive")


def status(rows: DataFrame, events: DataFrame, ids: DataFrame, legacy: bool = False) -> DataFrame:
    """Q1, Q4, Q9: accession, status, redirect: active, merged (to redirect), deprecated, empty or missing.

    The current table goes by the last event; an id whose last event is neither a merge nor a deprecation is empty. The
    legacy table goes by any merge (the smallest target), else by any deprecation.
    """
    asked = ids.select("accession").distinct()
    alive = rows.select("accession").distinct().withColumn("alive", F.lit(True))
    if legacy:
        found = events.groupBy("accession").agg(
            F.min(F.when(F.col("event") == S.MERGED, F.col("merge_into"))).alias("merge_into"), F.bool_or(F.col("event") == S.DEPRECATED).alias("dropped"), F.lit(True).alias("logged")
        )
        kind = F.when(F.col("merge_into").isNotNull(), "merged").when(F.col("dropped"), "deprecated")
    else:
        found = last_events(events, asked).withColumn("logged", F.lit(True)).withColumn("merge_into", F.when(F.col("event") == S.MERGED, F.col("merge_into")))
        kind = F.when(F.col("event") == S.MERGED, "merged").when(F.col("event") == S.DEPRECATED, "deprecated")
    out = asked.join(alive, "accession", "left").join(found, "accession", "left")
    kind = F.when(F.col("alive"), "active").otherwise(F.coalesce(kind, F.when(F.col("logged"), "empty").otherwise("missing")))
    return out.select("accession", kind.alias("status"), F.when(kind == "merged", F.col("merge_into")).alias("redirect"))


def by_accession(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Q1, Q4: all active rows of the ids, in every assembly."""
    return rows.join(ids.select("accession").distinct(), "accession", "left_semi")


def last_inactive(events: DataFrame, ids: DataFrame) -> DataFrame:
    """The last row that the last event of an id made inactive; an event without one is an error."""
    last = last_events(events, ids)
    row = F.when(F.size("inactive") < 1, F.raise_error(F.concat(F.lit("nothing inactive for "), F.col("accession").cast("string")))).otherwise(F.element_at("inactive", -1))
    return last.select("accession", "event", row.alias("row"))


def newest(rows: DataFrame, key: str = "accession") -> DataFrame:
    """The row of the highest version of each id; of equal ones that with the larger hash."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("version"), F.desc("ss_hash")))
    return rows.withColumn("__n", n).where("__n = 1").drop("__n")


def of_version(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """R6. asked: accession, version."""
    return rows.join(asked.select("accession", "version").distinct(), ["accession", "version"], "left_semi")


def patched(rows: DataFrame, change: DataFrame) -> DataFrame:
    """Rows with a further version of each changed id appended. change: accession and new values of some columns."""
    last = newest(rows)
    values = [c for c in change.columns if c != "accession"]
    new = last.drop(*values).join(change, "accession").withColumn("version", F.col("version") + 1)
    return rows.unionByName(new.select(*rows.columns))


def merge_allowed(origin: str, target: str, current_from: int) -> Column:
    """An id merges within its own source only."""
    return E.source_of(origin, current_from) == E.source_of(target, current_from)


def by_fields(sve: DataFrame, asked: DataFrame) -> DataFrame:
    """Q2: rows by assembly, contig, study, start and alleles, through their hash."""
    return sve.join(asked.select(E.ss_hash().alias("ss_hash")).distinct(), "ss_hash", "left_semi")


def clustered_by_fields(cve: DataFrame, asked: DataFrame) -> DataFrame:
    """Q7: rows by assembly, contig, start and type, through their hash."""
    return cve.join(asked.select(E.rs_hash("asm").alias("rs_hash")).distinct(), "rs_hash", "left_semi")


def beacon(sve: DataFrame, asked: DataFrame) -> DataFrame:
    """Q3: asked with exists; a start below 1 is an error."""
    start = F.when(F.col("start") < 1, F.raise_error(F.lit("start must be positive"))).otherwise(F.col("start"))
    rows = asked.withColumn("start", start).withColumn("ss_hash", E.ss_hash())
    have = sve.select("ss_hash").distinct().withColumn("__have", F.lit(True))
    return rows.join(have, "ss_hash", "left").withColumn("exists", F.coalesce("__have", F.lit(False))).drop("__have")


def clustered_beacon(cve: DataFrame, sve: DataFrame, asked: DataFrame) -> DataFrame:
    """rs_hash, exists, and by study the submitted ids as a sorted text."""
    rows = asked.select(E.rs_hash("asm").alias("rs_hash")).distinct()
    found = rows.join(cve.select("rs_hash", F.col("accession").alias("rs"), F.col("asm").alias("seq")).distinct(), "rs_hash")
    ss = found.join(sve.select("rs", "seq", "study", F.col("accession").alias("ss")), ["rs", "seq"]).groupBy("rs_hash", "study").agg(F.array_sort(F.collect_set("ss")).alias("ids"))
    have = found.select("rs_hash").distinct().withColumn("__have", F.lit(True))
    out = rows.join(have, "rs_hash", "left").join(ss, "rs_hash", "left")
    return out.select("rs_hash", F.coalesce("__have", F.lit(False)).alias("exists"), "study", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ss_ids"))


def history(cve: DataFrame, events: DataFrame, ids: DataFrame) -> DataFrame:
    """Q5: asked, event, accession, merge_into, split_into, created: all events that name an id, to be read in order of created."""
    names = F.array_distinct(F.array_compact(F.array("accession", "merge_into", "split_into")))
    long = events.select("*", F.explode(names).alias("asked")).join(ids.select(F.col("accession").alias("asked")).distinct(), "asked", "left_semi")
    return long.select("asked", "id", "event", "accession", "merge_into", "split_into", "created")


def submissions(cve: DataFrame, sve: DataFrame, ids: DataFrame) -> DataFrame:
    """Q6, R2: submitted rows of the ids that are active."""
    active = cve.join(ids.select("accession").distinct(), "accession", "left_semi").select(F.col("accession").alias("rs")).distinct()
    return sve.join(active, "rs", "left_semi")


def with_inactive(rows: DataFrame, events: DataFrame, ids: DataFrame) -> DataFrame:
    """Active rows of the ids and every row that their events made inactive."""
    asked = ids.select("accession").distinct()
    past = events.join(asked, "accession", "left_semi").select(F.inline("inactive"))
    now = rows.join(asked, "accession", "left_semi")
    names = [c for c in past.columns if c in now.columns]
    return now.select(*names, F.lit(True).alias("active")).unionByName(past.select(*names, F.lit(False).alias("active")))


def by_hash_with_inactive(rows: DataFrame, events: DataFrame, hashes: DataFrame, key: str = "rs_hash") -> DataFrame:
    """Active rows by hash, and inactive ones whose hash matches."""
    asked = hashes.select(key).distinct()
    past = events.select(F.inline("inactive")).join(asked, key, "left_semi")
    now = rows.join(asked, key, "left_semi")
    names = [c for c in past.columns if c in now.columns]
    return now.select(*names, F.lit(True).alias("active")).unionByName(past.select(*names, F.lit(False).alias("active")))
