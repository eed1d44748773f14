"""File scans: VCF, assembly reports, id lists, dbSNP JSON and FASTA, all by Spark's own readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expr as E

COLUMNS = ("contig", "start", "ids", "ref", "alt", "qual", "filter", "info")


def body(lines: DataFrame, *more: str) -> DataFrame:
    """Tab-separated VCF fields as columns; missing trailing ones are null. lines: a column value, and more to keep."""
    f = F.split("value", "\t")
    fields = [F.try_element_at(f, F.lit(i + 1)).alias(n) for i, n in enumerate(COLUMNS)]
    rows = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(*fields, *more)
    return rows.withColumn("start", F.col("start").try_cast("long"))


def usable(rows: DataFrame) -> DataFrame:
    """rows without a position or alleles, and those whose alternate is no variant, are left out."""
    return rows.where(F.col("start").isNotNull() & F.col("ref").isNotNull() & F.col("alt").isNotNull())


def rejected(lines: DataFrame) -> DataFrame:
    """the lines that usable() and the unwinding leave out."""
    rows = body(lines)
    return rows.where(F.col("start").isNull() | F.col("ref").isNull() | F.col("alt").isNull() | F.col("alt").isin(".", ""))


def unwound(rows: DataFrame) -> DataFrame:
    """One row per alternate allele, alleles in upper case; an alternate equal to the reference or '.' is no variant."""
    out = usable(rows).select("*", F.posexplode(F.split("alt", ",")).alias("alt_index", "one_alt"))
    out = out.withColumn("alt", F.upper("one_alt")).withColumn("ref", F.upper("ref")).drop("one_alt")
    return out.where((F.col("alt") != ".") & (F.col("alt") != F.col("ref")))


def vcf_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def vcf(lines: DataFrame) -> DataFrame:
    """Contig, start, ref, alt and the other fields, a row per alternate allele."""
    return unwound(body(lines))


def info_map(info: Column | str = "info") -> Column:
    return F.str_to_map(F.coalesce(E.c(info), F.lit("")), F.lit(";"), F.lit("="))


def vcf_aggregated(lines: DataFrame) -> DataFrame:
    """vcf() with INFO as a map."""
    return vcf(lines).withColumn("attributes", info_map())


def vcf_accessioned(lines: DataFrame) -> DataFrame:
    """S3: a report read back: ids by semicolon, and context bases taken off."""
    rows = vcf(lines).withColumn("v", E.unanchored("start", "ref", "alt"))
    return rows.select("contig", F.col("v.start").alias("start"), F.col("v.ref").alias("ref"), F.col("v.alt").alias("alt"), F.split("ids", ";").alias("ids"))


def vcf_remapped(lines: DataFrame) -> DataFrame:
    """Remapped submissions; an id is needed."""
    rows = vcf_aggregated(lines).where(F.col("ids").isNotNull() & (F.col("ids") != "."))
    a = F.col("attributes")
    return rows.select(
        "contig", "start", "ref", "alt", F.regexp_extract("ids", r"ss(\d+)", 1).try_cast("long").alias("accession"), a["TAX"].try_cast("int").alias("tax"),
        a["PROJECT"].alias("study"), a["RS"].alias("rs_text"), a["BACKPROP_RS"].alias("back_prop_text"), a["CREATED"].alias("created_text"),
    )


def ss_ids_of_vcf(lines: DataFrame) -> DataFrame:
    """S13."""
    ids = F.regexp_extract_all("ids", F.lit(r"ss(\d+)"), 1)
    return body(lines).select(F.explode(F.transform(ids, lambda x: x.cast("long"))).alias("accession"))


def id_list(lines: DataFrame) -> DataFrame:
    """The first token of each line that is not blank, without a prefix rs or ss."""
    token = F.regexp_extract("value", r"^\s*(?:rs|ss)?(\d+)", 1)
    return lines.select(token.try_cast("long").alias("accession")).where("accession is not null")


def rs_report(lines: DataFrame) -> DataFrame:
    """Rs and hash; a line that is not that is an error."""
    f = F.split("value", "\t")
    bad = (F.size(f) != 2) | f[0].try_cast("long").isNull()
    rs = F.when(bad, F.raise_error(F.concat(F.lit("malformed line: "), "value"))).otherwise(f[0].try_cast("long"))
    return lines.where(F.trim("value") != "").select(rs.alias("rs"), F.try_element_at(f, F.lit(2)).alias("rs_hash"))


def assembly_report(lines: DataFrame) -> DataFrame:
    """The columns of schema.CONTIGS; a short line is an error."""
    f = F.split("value", "\t")
    field = lambda i: F.try_element_at(f, F.lit(i))
    name = F.when(F.size(f) < 10, F.raise_error(F.concat(F.lit("short line: "), "value"))).otherwise(field(1))
    rows = lines.where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return rows.select(
        name.alias("sequence_name"), field(2).alias("role"), field(3).alias("assigned_molecule"), field(5).alias("genbank"),
        field(7).alias("refseq"), field(10).alias("ucsc"), (field(6) == "=").alias("identical"),
    )


# dbSNP's variant types
DBSNP_TYPES = {"SNV": "SNV", "MNV": "MNV", "INS": "INS", "DEL": "DEL", "DELINS": "INDEL", "IDENTITY": "NO_SEQUENCE_ALTERATION"}
DBSNP_SCHEMA = (
    "refsnp_id string, create_date string, present_obs_movements array<struct<last_added_to_this_rs:string>>, "
    "primary_snapshot_data struct<variant_type:string, placements_with_allele:array<struct<is_ptlp:boolean, "
    "placement_annot:struct<seq_id_traits_by_assembly:array<struct<assembly_accession:string>>>, "
    "alleles:array<struct<allele:struct<spdi:struct<seq_id:string, position:long>>>>>>>"
)


def dbsnp_json(lines: DataFrame, refseq_assembly: str, genbank_assembly: str, tax: int = 9606, newer_than: int | None = None) -> DataFrame:
    """A clustered row per JSON line whose primary placement is on the assembly. Spark reads .bz2 text itself.

    newer_than: keep ids added after that build, and those that do not say.
    """
    j = lines.select(F.from_json("value", DBSNP_SCHEMA).alias("j"))
    placed = F.filter("j.primary_snapshot_data.placements_with_allele", lambda p: p["is_ptlp"] & (F.size(p["placement_annot"]["seq_id_traits_by_assembly"]) > 0))
    first = F.try_element_at(placed, F.lit(1))
    there = F.exists(first["placement_annot"]["seq_id_traits_by_assembly"], lambda a: a["assembly_accession"] == refseq_assembly)
    spdi = F.try_element_at(first["alleles"], F.lit(1))["allele"]["spdi"]
    kinds = F.create_map(*(F.lit(x) for kv in DBSNP_TYPES.items() for x in kv))
    kind = F.col("j.primary_snapshot_data.variant_type")
    kind = F.coalesce(F.try_element_at(kinds, F.upper(kind)), F.raise_error(F.concat(F.lit("unknown variant type: "), kind)))
    rows = j
    if newer_than is not None:
        builds = F.transform(F.coalesce("j.present_obs_movements", F.array().cast("array<struct<last_added_to_this_rs:string>>")), lambda m: m["last_added_to_this_rs"].try_cast("int"))
        rows = rows.where(F.coalesce(F.array_min(builds) > newer_than, F.lit(True)))
    created = F.to_timestamp_ntz("j.create_date", F.lit("yyyy-MM-d'T'HH:mm'Z'"))
    out = rows.where(there).select(
        F.col("j.refsnp_id").cast("long").alias("accession"), F.lit(genbank_assembly).alias("asm"), F.lit(tax).alias("tax"),
        spdi["seq_id"].alias("contig"), (spdi["position"] + 1).alias("start"), kind.alias("type"), F.lit(False).alias("validated"), created.alias("created"),
    )
    return out.withColumn("rs_hash", E.rs_hash("asm"))


# --- FASTA ------------------------------------------------------------------------------------------------------

CHUNK = 1000


def fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, line_no, value: lines in order within the blocks in which Spark reads a file, and blocks by their start.

    A compressed file is an error, by its name or by its first bytes: it cannot be read in blocks.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    packed = F.col("file_path").rlike(r"\.(gz|bz2|zst|xz)$") | F.startswith(F.col("value").cast("binary"), F.lit(b"\x1f\xef\xbf\xbd")) | F.startswith(F.col("value").cast("binary"), F.lit(b"\x1f\x8b"))
    value = F.when(packed, F.raise_error(F.concat(F.lit("FASTA must not be compressed: "), "file_path"))).otherwise(F.trim("value"))
    return lines.select(F.col("file_path").alias("file"), F.col("file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_no"), value.alias("value"))


def fasta(lines: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Contig, chunk_no, bases: a FASTA text cut into chunks. lines: as of fasta_lines().

    A line's contig and place are running values within its block; what a block's first lines lack comes of the blocks
    before, of which a file has few. No task reads more than a block. A contig that comes twice is an error.
    """
    w = Window.partitionBy("file", "block").orderBy("line_no")
    head = F.col("value").startswith(">")
    rows = lines.where("value <> ''").withColumns({
        "name": F.last(F.when(head, F.regexp_extract("value", r"^>(\S+)", 1)), ignorenulls=True).over(w),
        "part": F.sum(F.when(head, 1).otherwise(0)).over(w), "size": F.when(head, 0).otherwise(F.length("value")),
    })
    last = Window.partitionBy("file", "block")
    ends = rows.withColumn("parts", F.max("part").over(last)).groupBy("file", "block").agg(
        F.max_by("name", "part").alias("end_name"), F.max("part").alias("parts"), F.sum(F.when(F.col("part") == F.col("parts"), F.col("size")).otherwise(0)).alias("tail")
    )
    order = Window.partitionBy("file").orderBy("block")
    ends = ends.withColumn("run", F.sum(F.when(F.col("parts") > 0, 1).otherwise(0)).over(order))
    so_far = Window.partitionBy("file", "run").orderBy("block")
    ends = ends.withColumn("sum", F.sum("tail").over(so_far))
    carried = ends.select("file", "block", F.last("end_name", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("old_name"), F.coalesce(F.lag("sum").over(order), F.lit(0)).alias("old_at"))
    before = Window.partitionBy("file", "block", "part").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0))).where(~head).join(carried, ["file", "block"])
    first_part = F.col("part") == 0
    rows = rows.select(
        F.when(first_part, F.col("old_name")).otherwise(F.col("name")).alias("contig"), (F.col("at") + F.when(first_part, F.col("old_at")).otherwise(0)).alias("at"), F.col("value").alias("bases")
    )
    first = F.floor(F.col("at") / chunk)
    last_chunk = F.floor((F.col("at") + F.length("bases") - 1) / chunk)
    parts = rows.select("contig", "at", "bases", F.explode(F.sequence(first, last_chunk)).alias("chunk_no"))
    lo = F.greatest(F.col("chunk_no") * chunk - F.col("at"), F.lit(0))
    hi = F.least((F.col("chunk_no") + 1) * chunk - F.col("at"), F.length("bases"))
    piece = F.substring("bases", (lo + 1).cast("int"), (hi - lo).cast("int"))
    parts = parts.select("contig", "chunk_no", F.struct((F.col("at") + lo).alias("at"), piece.alias("piece")).alias("p"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["piece"]), "")
    twice = F.sum(F.length("p.piece")) > F.max(F.col("p.at") + F.length("p.piece")) - F.min("p.at")
    bases = F.when(twice, F.raise_error(F.concat(F.lit("contig comes twice: "), "contig"))).otherwise(joined)
    return parts.groupBy("contig", "chunk_no").agg(bases.alias("bases"))


def base_at(rows: DataFrame, sequence: DataFrame, position: Column, name: str, contig: str = "contig", chunk: int = CHUNK, strict: bool = False) -> DataFrame:
    """Rows with the base at a position of their contig; null where there is none, or if strict an error. One equi-join on the chunk."""
    have = sequence.select(F.col("contig").alias("__contig"), F.col("chunk_no").alias("__no"), F.col("bases").alias("__bases"))
    at = rows.withColumn("__at", position)
    out = at.join(have, (F.col(contig) == F.col("__contig")) & (F.floor((F.col("__at") - 1) / chunk) == F.col("__no")), "left")
    base = F.nullif(F.substring("__bases", ((F.col("__at") - 1) % chunk + 1).cast("int"), F.lit(1)), F.lit(""))
    if strict:
        where = F.concat_ws(":", F.col(contig), F.col("__at").cast("string"))
        base = F.coalesce(base, F.raise_error(F.concat(F.lit("no such contig, or a place outside of it: "), where)))
    return out.withColumn(name, base).drop("__at", "__contig", "__no", "__bases")


def with_context(rows: DataFrame, sequence: DataFrame, contig: str = "contig", chunk: int = CHUNK) -> DataFrame:
    """The base that anchors a variant: the one before, or the one after where it starts its contig. Column context."""
    at = F.when(F.col("start") == 1, F.lit(1)).otherwise(F.col("start") - 1)
    return base_at(rows, sequence, at, "context", contig, chunk)


def through_synonyms(rows: DataFrame, sequence: DataFrame, contigs: DataFrame) -> DataFrame:
    """Rows with the name under which the FASTA has their contig: a synonym, if GenBank and RefSeq agree, or as it is."""
    from ..functions.contigs import by_name

    have = sequence.select(F.col("contig").alias("__have")).distinct()
    order = ("sequence_name", "genbank", "refseq", "ucsc", "assigned_molecule")
    names = by_name(contigs).where("identical").select(F.col("name").alias("__name"), F.posexplode(F.array(*order)).alias("__i", "__synonym"))
    first = names.join(have, F.col("__synonym") == F.col("__have")).groupBy("__name").agg(F.min_by("__have", "__i").alias("__fasta"))
    return rows.join(first, rows["contig"] == F.col("__name"), "left").withColumn("fasta_contig", F.coalesce("__fasta", "contig")).drop("__name", "__fasta")
