"""Contig names: an assembly's synonyms as a dimension table, looked up by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NAMINGS = {"SEQUENCE_NAME": "sequence_name", "ASSIGNED_MOLECULE": "assigned_molecule", "INSDC": "genbank", "REFSEQ": "refseq", "UCSC": "ucsc"}
LOOKUP_ORDER = ("refseq", "genbank", "assigned_molecule", "sequence_name", "ucsc")
MOLECULE = "assembled-molecule"


def normalized(contigs: DataFrame) -> DataFrame:
    """'na' is null; an assigned molecule counts for assembled molecules only."""
    names = {n: F.nullif(F.col(n), F.lit("na")) for n in NAMINGS.values()}
    names["assigned_molecule"] = F.when(F.col("role") == MOLECULE, names["assigned_molecule"])
    return contigs.withColumns(names)


def checked(contigs: DataFrame) -> DataFrame:
    """normalized(), where a sequence name that is not unique is an error when it is read."""
    rows = normalized(contigs)
    n = F.count("sequence_name").over(Window.partitionBy("sequence_name"))
    return rows.withColumn("sequence_name", F.when(n > 1, F.raise_error(F.concat(F.lit("sequence name is not unique: "), "sequence_name"))).otherwise(F.col("sequence_name")))


def by_name(contigs: DataFrame) -> DataFrame:
    """name and its synonyms: one row for each name, that of the naming first in LOOKUP_ORDER, assembled molecules first."""
    rows = normalized(contigs)
    names = F.array(*(F.struct(F.lit(i).alias("priority"), F.col(n).alias("name")) for i, n in enumerate(LOOKUP_ORDER)))
    long = rows.select("*", F.inline(names)).where("name is not null")
    first = Window.partitionBy("name").orderBy("priority", F.when(F.col("role") == MOLECULE, 0).otherwise(1), "sequence_name")
    return long.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n", "priority")


def replaceable() -> Column:
    """GenBank and RefSeq agree, or there is no RefSeq; and there is a GenBank name."""
    return (F.coalesce("identical", F.lit(False)) | F.col("refseq").isNull()) & F.col("genbank").isNotNull()


def with_synonyms(rows: DataFrame, contigs: DataFrame, contig: str = "contig") -> DataFrame:
    """rows with the synonyms of their contig; the planner broadcasts the dimension while it is small."""
    names = by_name(contigs)
    return rows.join(names.withColumnRenamed("name", contig), contig, "left")


def to_genbank(rows: DataFrame, contigs: DataFrame, contig: str = "contig", strict: bool = True) -> DataFrame:
    """P9. strict: a contig that cannot be replaced is an error; else only one that is unknown is."""
    unknown = F.coalesce("genbank", "refseq", "sequence_name", "assigned_molecule", "ucsc").isNull()
    fail = F.raise_error(F.concat(F.lit("contig cannot be replaced: "), contig))
    new = F.when(replaceable(), F.col("genbank")).when(unknown, fail).otherwise(fail if strict else F.col(contig))
    return with_synonyms(rows, contigs, contig).withColumn(contig, new).select(*rows.columns)


def renamed(rows: DataFrame, contigs: DataFrame, naming: str, contig: str = "contig") -> DataFrame:
    """P10: the synonym of a naming, or the name as it is where there is none or GenBank and RefSeq differ."""
    if naming == "NO_REPLACEMENT":
        return rows
    crosses = naming in ("INSDC", "REFSEQ") and ~F.coalesce("identical", F.lit(False))
    new = F.coalesce(F.col(NAMINGS[naming]), contig)
    new = F.when(crosses, F.col(contig)).otherwise(new) if naming in ("INSDC", "REFSEQ") else new
    return with_synonyms(rows, contigs, contig).withColumn(contig, new).select(*rows.columns)


def translated(rows: DataFrame, aliases: DataFrame, source: str, target: str, contig: str = "contig") -> DataFrame:
    """Names of one convention to another by a table of aliases; names without an alias stay."""
    pairs = aliases.select(F.col(source).alias("__from"), F.col(target).alias("__to")).where("__from is not null").dropDuplicates(["__from"])
    return rows.join(pairs, rows[contig] == F.col("__from"), "left").withColumn(contig, F.coalesce("__to", contig)).select(*rows.columns)


def not_one_to_one(used: DataFrame, original: str = "original", replaced: str = "replaced") -> DataFrame:
    """Names that a run maps to several others, in either direction."""

    def several(a: str, b: str, side: str) -> DataFrame:
        found = used.groupBy(F.col(a).alias("name")).agg(F.countDistinct(b).alias("n_others")).where("n_others > 1")
        return found.select("name", F.lit(side).alias("side"), "n_others")

    return several(original, replaced, "original").unionByName(several(replaced, original, "replaced"))
