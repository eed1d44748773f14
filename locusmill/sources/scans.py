"""Scans of the warehouse's tables: the filters that a job starts with, pushed down to Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def clustering(sve: DataFrame, assembly: str, clustered: bool, resumable: bool = False) -> DataFrame:
    """Rows of an assembly with or without an RS; those without come from the current table alone.

    Rows with a back-propagated RS are left out; the resumable reader does not leave them out.
    """
    rows = sve.where((F.col("seq") == assembly) & (F.col("rs").isNotNull() if clustered else F.col("rs").isNull()))
    rows = rows if resumable else rows.where(F.col("back_prop_rs").isNull())
    return rows if clustered else rows.where("source = 'current'")


def study_unclustered(sve: DataFrame, assembly: str, studies: Sequence[str]) -> DataFrame:
    """S7."""
    return clustering(sve, assembly, False).where(F.col("study").isin(list(studies)))


def candidates(events: DataFrame, assembly: str, prefix: str) -> DataFrame:
    """Merge (RSMC) or split (RSSC) candidates of an assembly, by their ids."""
    return events.where(F.col("id").startswith(f"{prefix}_{assembly}_"))


def qc(rows: DataFrame, assembly: str, column: str = "seq") -> DataFrame:
    """Rows of an assembly without a mapping weight."""
    return rows.where((F.col(column) == assembly) & F.col("map_weight").isNull())


def split_or_merged_targets(cve_events: DataFrame, sve: DataFrame, remapped: str, original: str) -> DataFrame:
    """Rows of the original assembly whose remapped twins have an RS that was split or merged there."""
    ids = cve_events.where(F.col("event").isin(S.RS_SPLIT, S.MERGED)).where(F.exists("inactive", lambda x: x["asm"] == remapped))
    ids = ids.select(F.explode(F.array("accession", "merge_into", "split_into")).alias("rs")).where("rs is not null").distinct()
    twins = sve.where((F.col("seq") == remapped) & (F.col("remapped_from") == original)).join(ids, "rs", "left_semi")
    return sve.where(F.col("seq") == original).join(twins.select("accession").distinct(), "accession", "left_semi")


def study(sve: DataFrame, assembly: str, name: str) -> DataFrame:
    """S11."""
    return sve.where((F.col("seq") == assembly) & (F.col("study") == name) & (F.col("source") == "current"))


def by_ids(sve: DataFrame, ids: DataFrame, assembly: str) -> DataFrame:
    """Rows of an assembly whose accession is in a list."""
    return sve.where(F.col("seq") == assembly).join(ids.select("accession").distinct(), "accession", "left_semi")


def remapping_export(sve: DataFrame, assembly: str, studies: Sequence[str] = (), tax: int = 0) -> DataFrame:
    """Native rows of an assembly, of some studies and of a taxonomy if these are given."""
    tests: list[Column] = [F.col("seq") == assembly, F.col("remapped_from").isNull()]
    tests += [F.col("study").isin(list(studies))] if studies else []
    tests += [F.col("tax") == tax] if tax else []
    for t in tests:
        sve = sve.where(t)
    return sve


def accession_range(rows: DataFrame, first: int, last: int) -> DataFrame:
    """R1."""
    return rows.where(F.col("accession").between(first, last))


def clustered_remapped(sve: DataFrame) -> DataFrame:
    """F6."""
    return sve.where(F.col("rs").isNotNull() & (F.trim(F.coalesce("remapped_from", F.lit(""))) != "") & F.col("map_weight").isNull())
