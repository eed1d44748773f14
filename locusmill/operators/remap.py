"""Moving submissions between assemblies: export, and ingestion of what comes back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import expr as E
from ..sources import files, scans
from .graph import cut

#: What makes two rows the same submission. When a row was created or remapped, and by which run, does not count.
IDENTITY = ["accession", "ss_hash", "tax", "rs", "evidence", "asm_match", "alleles_match", "validated", "map_weight", "remapped_from", "back_prop_rs"]


def export(sve: DataFrame, sequence: DataFrame, assembly: str, studies=(), tax: int = 0) -> DataFrame:
    """The export chain: native rows without multimaps and mismatches, valid alleles, context bases, valid again."""
    rows = scans.remapping_export(sve, assembly, studies, tax)
    rows = rows.where((F.coalesce("map_weight", F.lit(1)) <= 1) & E.flag("alleles_match", True) & E.valid_alleles())
    rows = files.with_context(rows, sequence).where("context is not null")  # positions outside the contig
    empty = (F.length("ref") == 0) | (F.length("alt") == 0)
    v = E.anchored("start", "ref", "alt", "context", "context")
    rows = rows.withColumn("v", F.when(empty, v).otherwise(F.struct("start", "ref", "alt")))
    rows = rows.withColumns({x: F.col(f"v.{x}") for x in ("start", "ref", "alt")}).drop("v", "context")
    return rows.where(E.valid_alleles())


def submitted(variants: DataFrame, assembly: str, tax: int, study: str) -> DataFrame:
    """VCF variants as submitted rows: supported, matching, not validated, not clustered."""
    true = F.lit(True)
    rows = variants.withColumns({
        "seq": F.lit(assembly), "tax": F.lit(tax), "study": F.lit(study), "evidence": true, "asm_match": true, "alleles_match": true,
        "validated": F.lit(False), "rs": F.lit(None).cast("long"),
    })
    return rows.withColumn("ss_hash", E.ss_hash())


def remapped(vcf: DataFrame, assembly: str, source_assembly: str, remapping: str) -> DataFrame:
    """Rows of files.vcf_remapped as submitted rows. A back-propagated RS overrides the RS; both need the prefix rs."""

    def rs(x: str):
        number = F.regexp_extract(x, r"^rs(\d+)$", 1).try_cast("long")
        return F.when(F.col(x).isNotNull() & number.isNull(), F.raise_error(F.concat(F.lit("not an RS id: "), x))).otherwise(number)

    rows = vcf.withColumns({
        "seq": F.lit(assembly), "rs": F.coalesce(rs("back_prop_text"), rs("rs_text")), "back_prop_rs": rs("back_prop_text"), "remapped_from": F.lit(source_assembly),
        "remapping_id": F.lit(remapping), "created": F.to_timestamp_ntz("created_text", F.lit("yyyy-MM-dd'T'HH:mm:ss")), "evidence": F.lit(True),
        "asm_match": F.lit(True), "alleles_match": F.lit(True), "validated": F.lit(False), "map_weight": F.lit(None).cast("int"), "version": F.lit(1),
    })
    return rows.withColumn("ss_hash", E.ss_hash()).drop("rs_text", "back_prop_text", "created_text")


def checked_report(rows: DataFrame) -> DataFrame:
    """Accessioned VCF rows as submitted ones: an id must be ss and digits, a study must be there."""
    ids = F.col("ids")[0]
    bad = ids.isNull() | ~ids.rlike("^ss[0-9]+$") | F.col("study").isNull()
    accession = F.when(bad, F.raise_error(F.concat(F.lit("not an accessioned row: "), F.coalesce(ids, F.lit("(none)"))))).otherwise(F.substring(ids, F.lit(3), F.length(ids)))
    return rows.withColumn("accession", accession.cast("long"))


def keepers(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with keeps: a native row, then the oldest, then the smallest id. Rows that still tie stay in a fixed order.

    Groups of stored rows alone are no conflict of this run: all of them are kept.
    """
    one = Window.partitionBy(*keys)
    order = [F.col("remapped_from").isNotNull(), F.col("created").asc_nulls_last(), F.col("accession"), F.col("ss_hash"), F.col("is_stored").desc()]
    news = F.bool_or(~F.col("is_stored")).over(one)
    return rows.withColumn("keeps", (F.row_number().over(one.orderBy(*order)) == 1) | ~news)


def source_dates(incoming: DataFrame, source: DataFrame) -> DataFrame:
    """Incoming rows created when the earliest row of their id in the source assembly was, or as they say."""
    first = source.groupBy("accession").agg(F.min("created").alias("__first"))
    return incoming.join(first, "accession", "left").withColumn("created", F.coalesce("__first", "created")).drop("__first")


def ingest(incoming: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows to insert, discarded rows, skipped rows. stored: the rows of the target assembly.

    Identical rows are skipped. Then duplicate hashes are resolved, then duplicate ids among what is left. Of two equal
    rows that come together one is taken. Discarded rows say where they were (is_stored), so that the store drops them.
    """
    flags = {"evidence": True, "asm_match": True, "alleles_match": True, "validated": False}
    fill = {k: E.flag(k, v) for k, v in flags.items()}
    new, old = incoming.withColumns(fill), stored.withColumns(fill)
    known = old.select(*(F.col(k).alias(f"__{k}") for k in IDENTITY)).distinct().withColumn("__known", F.lit(True))
    marked = cut(new.join(known, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in IDENTITY], "left").select(*new.columns, "__known"))
    skipped = marked.where("__known").drop("__known")
    fresh = marked.where("__known is null").drop("__known").dropDuplicates(IDENTITY)
    touched = fresh.select("ss_hash").distinct(), fresh.select("accession").distinct()
    old = old.join(touched[0], "ss_hash", "left_semi").unionByName(old.join(touched[0], "ss_hash", "left_anti").join(touched[1], "accession", "left_semi"))
    rows = fresh.withColumn("is_stored", F.lit(False)).unionByName(old.withColumn("is_stored", F.lit(True)).select(*fresh.columns, "is_stored"))
    by_hash = cut(keepers(rows, ["seq", "ss_hash"]))
    by_id = keepers(by_hash.where("keeps").drop("keeps"), ["seq", "accession"])
    lost = by_hash.where("not keeps").unionByName(by_id.where("not keeps")).drop("keeps")
    return by_id.where("keeps and not is_stored").drop("keeps", "is_stored"), lost, skipped


def discard_events(lost: DataFrame) -> DataFrame:
    """id, event, accession, ss_hash of discarded rows."""
    source = F.coalesce("remapped_from", F.lit("native"))
    text = F.concat(F.lit("DISCARD_SS_"), F.col("accession").cast("string"), F.lit("_HASH_"), "ss_hash", F.lit("_SOURCE_"), source)
    return lost.select(text.alias("id"), F.lit(S.DISCARDED).alias("event"), "accession", "ss_hash", "is_stored").dropDuplicates(["id"])


def ingest_counts(incoming: DataFrame, inserted: DataFrame, lost: DataFrame) -> DataFrame:
    """One row: ingested rows, events of discarded rows, and skipped rows (stored already, or equal to another that came along)."""
    tallies = incoming.select(F.lit("in").alias("what")).unionByName(inserted.select(F.lit("new").alias("what")))
    tallies = tallies.unionByName(lost.where("not is_stored").select(F.lit("lost").alias("what")))
    tallies = tallies.unionByName(discard_events(lost).select(F.lit("event").alias("what")))
    n = {x: F.count_if(F.col("what") == x) for x in ("in", "new", "lost", "event")}
    return tallies.agg(n["new"].alias("n_ingested"), n["event"].alias("n_discarded"), (n["in"] - n["new"] - n["lost"]).alias("n_skipped"))
