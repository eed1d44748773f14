"""Sinks: reports as rows of text with an order, and appends that a repeated run leaves unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as E

VCF_FIELDS = ("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO")

#: INFO keys of the reports with their number and type, and what they say
RELEASE_INFO = {
    "VC": ("1", "String", "Kind of variant, a term of the Sequence Ontology"),
    "SID": (".", "String", "Studies that submitted it"),
    "RS_VALIDATED": ("0", "Flag", "The RS itself is marked as validated"),
    "SS_VALIDATED": ("1", "Integer", "How many of its submissions are marked as validated"),
    "ALMM": ("0", "Flag", "A submission's alleles do not fit its list of alleles"),
    "ASMM": ("0", "Flag", "A submission's reference allele is not what the assembly has there"),
    "LOE": ("0", "Flag", "No submission comes with genotypes or frequencies"),
    "REMAPPED": ("0", "Flag", "All submissions came here from other assemblies"),
}
MERGED_INFO = RELEASE_INFO | {"CURR": ("1", "String", "The RS that it was merged into")}
MULTIMAP_INFO = RELEASE_INFO | {"MAP_WEIGHT": ("1", "Integer", "At how many places it lies")}
EXPORT_INFO = {
    "SS_HASH": ("1", "String", "Hash of the submission"),
    "RS": ("1", "String", "RS of the submission"),
    "BACKPROP_RS": ("1", "String", "RS that came back from a later assembly"),
    "PROJECT": ("1", "String", "Study of the submission"),
    "TAX": ("1", "Integer", "Taxonomy of the submission"),
    "CREATED": ("1", "String", "When the submission was created"),
}


def header_lines(info: dict[str, tuple[str, str, str]], assembly: str | None = None, name: str | None = None, url: str | None = None) -> list[str]:
    """The lines before the contigs. name: the assembly's display name (R12); url: where people can look it up."""
    fields = [f"ID={name or assembly}", *([f"accession={assembly}"] if name else []), *([f"URL={url}"] if url else [])]
    head = ["##fileformat=VCFv4.3", *([f"##reference=<{','.join(fields)}>"] if assembly else [])]
    return head + [f'##INFO=<ID={k},Number={n},Type={t},Description="{d}">' for k, (n, t, d) in sorted(info.items())]


def header(contigs: DataFrame, info: dict[str, tuple[str, str, str]], assembly: str | None = None, name: str | None = None, url: str | None = None) -> DataFrame:
    """part, line: the lines before the body. contigs: a column contig."""
    spark = contigs.sparkSession
    head = header_lines(info, assembly, name, url)
    fixed = spark.createDataFrame([(i, x) for i, x in enumerate(head)] + [(1_000_000, "\t".join(VCF_FIELDS))], "part long, line string")
    named = contigs.select("contig").distinct().select(F.lit(1000).cast("long").alias("part"), F.format_string("##contig=<ID=%s>", "contig").alias("line"))
    return fixed.unionByName(named)


def vcf_line(ids: Column, info: Column, contig="contig", start="start", ref="ref", alt="alt") -> Column:
    empty = F.lit(".")
    return F.concat_ws("\t", contig, E.c(start).cast("string"), ids, ref, alt, empty, empty, F.when(info == "", ".").otherwise(info))


def info_text(pairs: list[tuple[str, Column]], flags: list[tuple[str, Column]] = ()) -> Column:
    """KEY=value for values that are not null and KEY for flags that hold, by semicolons."""
    parts = [F.concat(F.lit(f"{k}="), v) for k, v in pairs] + [F.when(v, F.lit(k)) for k, v in flags]
    return F.concat_ws(";", *parts)


def assembled(head: DataFrame, body: DataFrame) -> DataFrame:
    """K2: header and body as one text in order. body: contig_rank, start and line."""
    rows = head.select("part", F.lit(0).cast("long").alias("contig_rank"), F.lit(0).cast("long").alias("start"), "line")
    rows = rows.unionByName(body.select(F.lit(2_000_000).cast("long").alias("part"), F.col("contig_rank").cast("long").alias("contig_rank"), "start", "line"))
    return rows.orderBy("part", "contig_rank", "start", "line").select("line")


def contig_ranks(rows: DataFrame, position: str = "row_no") -> DataFrame:
    """contig, contig_rank: contigs in the order in which they are first seen."""
    return rows.groupBy("contig").agg(F.min(position).alias("contig_rank"))


def accession_report(rows: DataFrame, position: str = "row_no") -> DataFrame:
    """K1: contig_rank, start, line: the body of an accession report, anchored indels included. rows: anchored variants."""
    line = vcf_line(E.prefixed("ss", "accession"), F.lit(""))
    return rows.join(contig_ranks(rows, position), "contig").select("contig_rank", "start", line.alias("line"))


def write_text(lines: DataFrame, path: str, single: bool = False) -> None:
    """Sorted lines to text. single: one file, which a report for people needs and a large one cannot have."""
    (lines.coalesce(1) if single else lines).write.mode("overwrite").text(path)


def id_lines(rows: DataFrame, prefix: str = "rs", into: str | None = None) -> DataFrame:
    """K4: rsN, or rsA and rsB by a tab."""
    parts = [E.prefixed(prefix, "accession")] + ([E.prefixed(prefix, into)] if into else [])
    return rows.select(F.concat_ws("\t", *parts).alias("line"))


def contig_lines(rows: DataFrame, contigs: DataFrame) -> DataFrame:
    """K6: contig and its sequence name; an empty contig or one without a synonym is an error."""
    from ..functions.contigs import with_synonyms

    bad = (F.coalesce("contig", F.lit("")) == "") | F.col("sequence_name").isNull()
    line = F.when(bad, F.raise_error(F.concat(F.lit("no sequence name for contig "), F.coalesce("contig", F.lit("(none)"))))).otherwise(F.concat_ws(",", "contig", "sequence_name"))
    return with_synonyms(rows.select("contig").distinct(), contigs).select(line.alias("line"))


def export_lines(rows: DataFrame) -> DataFrame:
    """K7: contig, start, line of a remapping export. rows: anchored variants with their submitted columns."""
    info = info_text([
        ("SS_HASH", F.col("ss_hash")), ("RS", E.prefixed("rs", "rs")), ("BACKPROP_RS", E.prefixed("rs", "back_prop_rs")),
        ("PROJECT", E.info_escaped("study")), ("TAX", F.col("tax").cast("string")), ("CREATED", F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss")),
    ])
    return rows.select("contig", "start", vcf_line(E.prefixed("ss", "accession"), info).alias("line"))


def duplicates_json(rows: DataFrame, key: str = "accession") -> DataFrame:
    """K8: a key and its row as JSON."""
    return rows.select(F.concat_ws(" ", F.col(key).cast("string"), F.to_json(F.struct(*sorted(rows.columns)))).alias("line"))


def rs_report_lines(created: DataFrame) -> DataFrame:
    """K9: rs and hash by a tab."""
    return created.select(F.concat_ws("\t", F.col("rs").cast("string"), "rs_hash").alias("line"))


def appendable(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The rows to append, keys stored already and repeats within rows left out."""
    return rows.join(stored.select(key), key, "left_anti").dropDuplicates([key])


def conflicts(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The keys that an insert would find taken."""
    return rows.select(key).distinct().join(stored.select(key).distinct(), key, "left_semi")


def corrected_contigs(sve: DataFrame, contigs: DataFrame, most: int | None = None) -> DataFrame:
    """Rows whose contig has a GenBank name of its own, with that name and a new hash; a stored hash that is wrong is an error."""
    from ..functions.contigs import replaceable, with_synonyms

    rows = with_synonyms(sve, contigs).where(replaceable() & (F.col("genbank") != F.col("contig")))
    rows = rows.limit(most) if most else rows
    old = F.when(F.col("ss_hash") != E.ss_hash(), F.raise_error(F.concat(F.lit("hash does not match its row: "), "ss_hash"))).otherwise(F.col("ss_hash"))
    rows = rows.withColumn("old_hash", old).withColumn("contig", F.col("genbank")).withColumn("ss_hash", E.ss_hash())
    return rows.select("old_hash", *sve.columns)


def flattened(rows: DataFrame, column: str) -> DataFrame:
    """One row per element of a nested list, its fields as columns; empty and missing lists give none."""
    return rows.select(F.inline(column))
