"""Quality control: conflicts, missing and surplus rows, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import bipartite


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A10: keys, n of keys that several rows have."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def rows_of_repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A10: the rows themselves."""
    return rows.join(repeated(rows, keys).drop("n"), keys, "left_semi")


def pending_merges(sve: DataFrame) -> DataFrame:
    """Hashes with several RSs."""
    rows = sve.where("rs is not null").groupBy("seq", "rs_hash").agg(F.countDistinct("rs").alias("n"), F.min("rs").alias("first"))
    return rows.where("n > 1").select(F.lit("merge").alias("kind"), "seq", F.col("rs_hash").alias("key"), "n")


def pending_splits(sve: DataFrame) -> DataFrame:
    """RSs with several hashes."""
    rows = sve.where("rs is not null").groupBy("seq", "rs").agg(F.countDistinct("rs_hash").alias("n"))
    return rows.where("n > 1").select(F.lit("split").alias("kind"), "seq", F.col("rs").cast("string").alias("key"), "n")


def report_difference(report: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, side, n: variants that only the report, or only the input has. Duplicates count once."""
    left, right = report.select(*keys).distinct(), expected.select(*keys).distinct()
    extra = left.join(right, keys, "left_anti").withColumn("side", F.lit("report"))
    return extra.unionByName(right.join(left, keys, "left_anti").withColumn("side", F.lit("input")))


def report_status(report: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """One row: what is missing on either side, duplicates (rows beyond the distinct ones), and the verdict."""
    zero = F.lit(0).cast("long")

    def part(rows: DataFrame, **counts) -> DataFrame:
        names = ("only_report", "only_input", "duplicates_report", "duplicates_input")
        return rows.agg(*(counts.get(n, zero).alias(n) for n in names))

    repeats = F.count("*") - F.countDistinct(F.struct(*keys))
    diff = part(report_difference(report, expected, keys), only_report=F.count_if(F.col("side") == "report"), only_input=F.count_if(F.col("side") == "input"))
    both = diff.unionByName(part(report, duplicates_report=repeats)).unionByName(part(expected, duplicates_input=repeats))
    both = both.agg(*(F.sum(n).alias(n) for n in both.columns))
    return both.withColumn("status", F.when(F.col("only_report") + F.col("only_input") > 0, "FAILED").otherwise("COMPLETED"))


def missing_clustered(report: DataFrame, cve: DataFrame) -> DataFrame:
    """Rs, rs_hash, problem of reported rows that are not stored, or stored with another hash only."""
    have = cve.select(F.col("accession").alias("rs"), F.col("rs_hash").alias("stored_hash")).distinct()
    same = have.select("rs", F.col("stored_hash").alias("rs_hash"))
    rows = report.select("rs", "rs_hash").distinct().join(same, ["rs", "rs_hash"], "left_anti")
    known = have.select("rs").distinct().withColumn("known", F.lit(True))
    return rows.join(known, "rs", "left").select("rs", "rs_hash", F.when(F.col("known"), "mismatch").otherwise("missing").alias("problem"))


def extraneous(cve: DataFrame, sve: DataFrame) -> DataFrame:
    """Clustered rows to which no submitted row of their assembly refers."""
    used = sve.where("rs is not null").select(F.col("seq").alias("asm"), F.col("rs").alias("accession")).distinct()
    return cve.join(used, ["asm", "accession"], "left_anti")


def unclustered(sve: DataFrame) -> DataFrame:
    """Current submitted rows without an RS; legacy ones are not looked at."""
    return sve.where("rs is null and source = 'current'")


def submissions_of_repeated_rs(cve: DataFrame, sve: DataFrame) -> DataFrame:
    """Submitted rows of RSs that have several rows."""
    many = repeated(cve, ["accession"]).select(F.col("accession").alias("rs"))
    return sve.join(many, "rs", "left_semi")


def disconnected(cve: DataFrame, sve: DataFrame) -> DataFrame:
    """Rs, n_components of RSs with several rows whose places do not hang together by shared submitted ids."""
    rows = submissions_of_repeated_rs(cve, sve).withColumn("place", F.concat_ws("_", "seq", "contig", F.col("start").cast("string")))
    parts = bipartite(rows, ["rs"], "place", "accession")
    return parts.groupBy("rs").agg(F.countDistinct("label").alias("n_components")).where("n_components > 1")
