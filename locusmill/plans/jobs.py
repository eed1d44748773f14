"""The jobs of the warehouse, each a pure function from tables to tables; what to write is up to the caller."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import contigs as C
from ..functions import expr as E
from ..operators import accession, cluster, deprecate, imports, qc, release, remap
from ..operators.graph import cut
from ..sources import files, scans, sinks


class Clustered(NamedTuple):
    submitted: DataFrame
    created: DataFrame  # rs, rs_hash, seq of new clustered rows
    updates: DataFrame
    merges: DataFrame
    splits: DataFrame


def accession_vcf(lines: DataFrame, contigs: DataFrame, known: DataFrame, assembly: str, tax: int, study: str, start: int, interval: int) -> tuple[DataFrame, DataFrame]:
    """Submitted rows with accessions, and the rows that were dropped as structural. known: ss_hash, accession, source."""
    rows = files.vcf(lines)
    kept = C.to_genbank(rows.where(~E.structural()), contigs)
    rows = remap.submitted(kept, assembly, tax, study)
    ids = accession.get_or_create(rows, known, "ss_hash", start, interval)
    return rows.join(ids, "ss_hash"), files.vcf(lines).where(E.structural())


def accession_report(accessioned: DataFrame, sequence: DataFrame, contigs: DataFrame, naming: str = "NO_REPLACEMENT") -> DataFrame:
    """The report of accessioned rows: lines in order, anchored and under the contig names asked for."""
    rows = files.with_context(accessioned, sequence)
    empty = (F.length("ref") == 0) | (F.length("alt") == 0)
    rows = rows.withColumn("v", F.when(empty, E.anchored("start", "ref", "alt", "context", "context")).otherwise(F.struct("start", "ref", "alt")))
    rows = rows.withColumns({x: F.col(f"v.{x}") for x in ("start", "ref", "alt")}).withColumn("row_no", F.col("accession"))
    rows = C.renamed(rows, contigs, naming)
    return sinks.assembled(sinks.header(rows, {}), sinks.accession_report(rows))


def check_report(report: DataFrame, source: DataFrame) -> DataFrame:
    """The verdict on a report against the input it was made of."""
    return qc.report_status(report, source, ["contig", "start", "ref", "alt"])


def cluster_assembly(sve: DataFrame, cve: DataFrame, assembly: str, start: int, interval: int, remapped_from: str | None = None) -> Clustered:
    """Merge, split, then assign or create RSs for unclustered rows; with remapped_from, propagate RSs back at the end."""
    merged, updates, merges = cluster.merge(sve)
    merged = cut(merged)
    split, splits, fresh = cluster.split(merged, start, interval)
    split = cut(split)
    # a locus belongs to the RS that its submissions have by now; else to a stored row, unless that RS was merged away
    now = split.where("rs is not null and map_weight is null").groupBy("rs_hash").agg(F.min("rs").alias("accession"))
    stored = cve.where("map_weight is null").join(merges.select("accession").distinct(), "accession", "left_anti").join(now, "rs_hash", "left_anti")
    mine = scans.clustering(split, assembly, False)
    used = now.unionByName(stored.select("rs_hash", "accession")).withColumn("source", F.lit("current"))
    offset = fresh.count()
    ids = accession.get_or_create(mine.where("map_weight is null"), used, "rs_hash", start + 2 * interval * (-(-offset // interval)), interval)
    ids = cut(ids)
    keys = ["ss_hash", "accession", "seq"]
    assigned = mine.where("map_weight is null").join(ids.select("rs_hash", F.col("accession").alias("new_rs")), "rs_hash").select(*keys, "new_rs").distinct()
    rows = split.join(assigned, keys, "left").withColumn("rs", F.coalesce("rs", "new_rs")).drop("new_rs").select(*sve.columns)
    created = fresh.unionByName(cluster.keeper_rows(merged, cve)).unionByName(ids.where("is_new").select(F.col("accession").alias("rs"), "rs_hash", F.lit(assembly).alias("seq")))
    if remapped_from:
        back = cluster.back_propagate(rows.where(F.col("seq") == remapped_from), rows.where(F.col("seq") == assembly)).select(*keys, F.col("back_prop_rs").alias("new_back")).distinct()
        rows = rows.join(back, keys, "left").withColumn("back_prop_rs", F.coalesce("new_back", "back_prop_rs")).drop("new_back").select(*sve.columns)
    return Clustered(rows, created, updates, merges, splits)


def cluster_study(sve: DataFrame, cve: DataFrame, assembly: str, studies: list[str]) -> DataFrame:
    """Rows of some studies that get an RS known already."""
    return cluster.assign(scans.study_unclustered(sve, assembly, studies), cve)


def release_current(cve: DataFrame, sve: DataFrame, sequence: DataFrame, contigs: DataFrame, assembly: str, tax: int, naming: str = "NO_REPLACEMENT") -> DataFrame:
    """The lines of the current release."""
    body = C.renamed(release.report(release.active(cve, sve, assembly, tax), sequence), contigs, naming)
    return sinks.assembled(sinks.header(body, sinks.RELEASE_INFO, assembly), by_name(body))


def by_name(body: DataFrame) -> DataFrame:
    """body with the rank of its contig by name. The window is over the table of contigs, not over variants."""
    names = body.select("contig").distinct().withColumn("contig_rank", F.row_number().over(Window.orderBy("contig")))
    return body.join(names, "contig")


def release_merged(cve_events: DataFrame, sve_events: DataFrame, cve: DataFrame, sequence: DataFrame, assembly: str, tax: int) -> tuple[DataFrame, DataFrame]:
    """The lines of the merged release, and the ids whose chains end in a deprecation."""
    body = by_name(release.report(release.merged(cve_events, sve_events, cve, assembly, tax), sequence))
    gone = release.chains(cve_events, cve, assembly).where("status = 'deprecated'").select(F.col("rs").alias("accession"))
    return sinks.assembled(sinks.header(body, sinks.MERGED_INFO, assembly), body), sinks.id_lines(gone)


def export_submitted(sve: DataFrame, sequence: DataFrame, assembly: str, studies: list[str] = (), tax: int = 0) -> DataFrame:
    """The lines of a remapping export."""
    body = by_name(sinks.export_lines(remap.export(sve, sequence, assembly, studies, tax)))
    return sinks.assembled(sinks.header(body, sinks.EXPORT_INFO, assembly), body)


def ingest_remapped(lines: DataFrame, contigs: DataFrame, sve: DataFrame, assembly: str, source: str, versions: tuple[str, str], runs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows to insert, events of discarded rows, and the run's own row if it is new. runs: remapping_id."""
    spark = lines.sparkSession
    run = spark.createDataFrame([(*versions, source, assembly)], "remapping_version string, accessioning_version string, source string, target string")
    run = run.withColumn("remapping_id", E.remapping_id("remapping_version", "accessioning_version", "source", "target"))
    key = run.first()["remapping_id"]
    rows = remap.remapped(C.to_genbank(files.vcf_remapped(lines), contigs), assembly, source, key)
    rows = remap.source_dates(rows, sve.where(F.col("seq") == source))
    stored = sve.where(F.col("seq") == assembly)
    names = [c for c in rows.columns if c in stored.columns]
    insert, lost, _ = remap.ingest(rows.select(*names), stored.select(*names))
    return insert, remap.discard_events(lost), sinks.appendable(run, runs, "remapping_id")


def deprecate_study(sve: DataFrame, cve: DataFrame, assembly: str, study: str, suffix: str, reason: str):
    return deprecate.deprecate(sve, cve, scans.study(sve, assembly, study), suffix, reason)


def deprecate_ids(sve: DataFrame, cve: DataFrame, lines: DataFrame, assembly: str, suffix: str, reason: str):
    return deprecate.deprecate(sve, cve, scans.by_ids(sve, files.id_list(lines), assembly), suffix, reason)


def import_dbsnp(lines: DataFrame, contigs: DataFrame, stored: DataFrame, merged: DataFrame, refseq: str, genbank: str, newer_than: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Clustered rows to insert and merge events; contigs that cannot be replaced keep their names, hashes follow."""
    rows = C.to_genbank(files.dbsnp_json(lines, refseq, genbank, newer_than=newer_than), contigs, strict=False)
    return imports.import_clustered(rows.withColumn("rs_hash", E.rs_hash("asm")), stored, merged)


def clustering_qc(sve: DataFrame, cve: DataFrame, assembly: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Unclustered rows, pending merges and splits, clustered rows that nothing refers to."""
    ss, rs = scans.qc(sve, assembly), scans.qc(cve, assembly, "asm")
    return qc.unclustered(ss), qc.pending_merges(ss).unionByName(qc.pending_splits(ss)), qc.extraneous(rs, ss)


def duplicate_rs_qc(lines: DataFrame, cve: DataFrame, sve: DataFrame) -> DataFrame:
    """RSs of a list whose rows do not hang together."""
    return qc.disconnected(cve.join(files.id_list(lines), "accession", "left_semi"), sve)


def duplicate_ss_qc(lines: DataFrame, sve: DataFrame) -> DataFrame:
    """Lines for submitted ids of a report that several rows have."""
    return sinks.duplicates_json(qc.rows_of_repeated(sve.join(files.ss_ids_of_vcf(lines).distinct(), "accession", "left_semi"), ["accession"]))
