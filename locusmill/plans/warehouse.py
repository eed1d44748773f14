"""The driver's tables seen as a warehouse of variants: DataFrames through the library's expressions, and SQL for an oracle.

Both come of one list of projections, which Spark and DuckDB read alike; types and hashes are written twice, so that the
library's own are checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import expr as E
from ..operators.graph import cut

ASSEMBLY, REMAPPED_FROM, TAX = "GCA_000000001.1", "GCA_000000000.1", 9913
CURRENT_FROM = 30_000  # of the projection's submitted ids

#: lineitem as submitted variants
SUBMITTED = {
    "accession": "cast(l_orderkey * 10 + l_linenumber AS bigint)",
    "seq": "concat('GCA_', lpad(cast(l_suppkey % 3 AS varchar(9)), 9, '0'), '.1')",
    "tax": "cast(9913 + l_suppkey % 2 AS int)",
    "study": "concat('PRJEB', cast(l_suppkey % 20 AS varchar(9)))",
    "contig": "concat('CM', lpad(cast(l_partkey % 25 AS varchar(9)), 6, '0'), '.1')",
    "start": "cast(l_partkey + 1 AS bigint)",
    "ref": "CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'C' ELSE '' END",
    "alt": "CASE l_linestatus WHEN 'F' THEN 'T' ELSE 'GT' END",
    "rs": "cast(CASE WHEN l_quantity > 45 THEN NULL ELSE 3000000000 + (l_partkey * 4 + l_suppkey % 4) END AS bigint)",
    "evidence": "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_orderkey % 5 <> 0 END",
    "asm_match": "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_orderkey % 6 <> 0 END",
    "alleles_match": "CASE WHEN l_linenumber = 4 THEN NULL ELSE l_orderkey % 7 <> 0 END",
    "validated": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_orderkey % 3 = 0 END",
    "map_weight": "cast(CASE WHEN l_partkey % 50 = 0 THEN 2 END AS int)",
    "remapped_from": "CASE WHEN l_suppkey % 3 = 1 AND l_orderkey % 2 = 0 THEN 'GCA_000000000.1' END",
    "created": "cast(l_shipdate AS timestamp)",
    "back_prop_rs": "cast(CASE WHEN l_partkey % 97 = 0 THEN 3000000000 + l_partkey END AS bigint)",
    "version": "cast(1 + l_linenumber % 2 AS int)",
    "source": "CASE WHEN l_orderkey * 10 + l_linenumber >= 30000 THEN 'current' ELSE 'legacy' END",
}
COLUMNS = [*SUBMITTED, "type", "ss_hash", "rs_hash"]
TYPE_SQL = """CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNV' WHEN length(ref) = length(alt) THEN 'MNV'
    WHEN length(ref) = 0 THEN 'INS' WHEN length(alt) = 0 THEN 'DEL' ELSE 'INDEL' END"""

SVE_SQL = f"""
sve0 AS (SELECT {", ".join(f"{e} AS {n}" for n, e in SUBMITTED.items())} FROM lineitem),
sve1 AS (SELECT *, {TYPE_SQL} AS type FROM sve0),
sve AS (SELECT *, upper(sha1(concat_ws('_', seq, study, contig, cast(start AS varchar), ref, alt))) AS ss_hash,
    upper(sha1(concat_ws('_', seq, contig, cast(start AS varchar), type))) AS rs_hash FROM sve1)"""

#: Which ids count as stored clustered rows, and what became of the others. Multiples of ten merge into one that merges again.
IS_EVENT = "rs % 5 = 0"
EVENT = {
    "event": "CASE WHEN rs % 15 = 0 THEN 'DEPRECATED' ELSE 'MERGED' END",
    "merge_into": "cast(CASE WHEN rs % 15 = 0 THEN NULL WHEN rs % 10 = 0 THEN rs + 5 ELSE rs + 1 END AS bigint)",
}
UPDATE = {
    "event": "CASE WHEN accession % 10 = 7 THEN 'DEPRECATED' ELSE 'UPDATED' END",
    "reason": "CASE WHEN accession % 9 = 0 THEN 'Declustered: no place in common' ELSE concat('Original rs', cast(rs AS varchar(20)), ' associated with SS was merged.') END",
}
CVE_SQL = f"""{SVE_SQL},
loci AS (SELECT seq AS asm, contig, start, type, rs_hash, rs AS accession, min(tax) AS tax, max(map_weight) AS map_weight,
    bool_or(coalesce(validated, false)) AS validated, min(created) AS created, min(source) AS source
    FROM sve WHERE rs IS NOT NULL GROUP BY seq, contig, start, type, rs_hash, rs),
cve AS (SELECT * FROM loci WHERE accession % 5 <> 0)"""
#: Logs, flat: the columns of the one inactive row stand beside the event's own.
EVENTS_SQL = f"""{CVE_SQL},
cvoe AS (SELECT *, {EVENT["event"]} AS event, {EVENT["merge_into"]} AS merge_into FROM (SELECT *, accession AS rs FROM loci) WHERE {IS_EVENT}),
svoe AS (SELECT *, {UPDATE["event"]} AS event, {UPDATE["reason"]} AS reason FROM sve WHERE {IS_EVENT})"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def submitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr(*(f"{e} AS {n}" for n, e in SUBMITTED.items()))
    return rows.withColumn("type", E.variant_type()).withColumns({"ss_hash": E.ss_hash(), "rs_hash": E.rs_hash()})


def loci(sve: DataFrame) -> DataFrame:
    keys = [F.col("seq").alias("asm"), "contig", "start", "type", "rs_hash", F.col("rs").alias("accession")]
    return sve.where("rs is not null").groupBy(*keys).agg(
        F.min("tax").alias("tax"), F.max("map_weight").alias("map_weight"), F.bool_or(E.flag("validated", False)).alias("validated"),
        F.min("created").alias("created"), F.min("source").alias("source"),
    )


def clustered(sve: DataFrame) -> DataFrame:
    return loci(sve).where("accession % 5 <> 0")


def written(log: DataFrame) -> DataFrame:
    """A log is a stored table: a scan with column pruning, instead of all that made it folded into every plan."""
    return cut(log)


def clustered_events(sve: DataFrame) -> DataFrame:
    rows = loci(sve).withColumn("rs", F.col("accession")).where(IS_EVENT).selectExpr("*", *(f"{e} AS {n}" for n, e in EVENT.items()))
    inactive = F.array(F.struct("rs_hash", "accession", "asm", "tax", "contig", "start", "type", "validated", "map_weight", "created"))
    return written(rows.select(
        E.event_id("event", F.col("asm"), F.col("rs_hash"), F.col("accession").cast("string")).alias("id"), "event", "accession", "merge_into",
        F.lit(None).cast("long").alias("split_into"), F.lit("").alias("reason"), "created", "source", inactive.alias("inactive"),
    ))


def submitted_events(sve: DataFrame) -> DataFrame:
    rows = sve.where(IS_EVENT).selectExpr("*", *(f"{e} AS {n}" for n, e in UPDATE.items()))
    inactive = F.array(F.struct(*COLUMNS))
    return written(rows.select(
        E.event_id("event", F.col("ss_hash"), F.col("accession").cast("string")).alias("id"), "event", "accession", F.lit(None).cast("long").alias("merge_into"),
        F.lit(None).cast("long").alias("split_into"), "reason", "created", "source", inactive.alias("inactive"),
    ))


# --- contigs ----------------------------------------------------------------------------------------------------

#: nation as an assembly report: names that are missing, differing and shared occur
CONTIGS = {
    "sequence_name": "concat('chr', cast(n_nationkey AS varchar(9)))",
    "role": "CASE WHEN n_nationkey % 4 = 3 THEN 'unplaced-scaffold' ELSE 'assembled-molecule' END",
    "assigned_molecule": "CASE WHEN n_nationkey % 6 = 5 THEN 'na' ELSE cast(n_nationkey AS varchar(9)) END",
    "genbank": "CASE WHEN n_nationkey % 8 = 7 THEN 'na' ELSE concat('CM', lpad(cast(n_nationkey AS varchar(9)), 6, '0'), '.1') END",
    "refseq": "CASE WHEN n_nationkey % 5 = 4 THEN 'na' ELSE concat('NC_', lpad(cast(n_nationkey AS varchar(9)), 6, '0'), '.1') END",
    "ucsc": "concat('chrU', cast(n_nationkey AS varchar(9)))",
    "identical": "n_nationkey % 3 <> 1",
}
CONTIGS_SQL = f"""contigs0 AS (SELECT {", ".join(f"{e} AS {n}" for n, e in CONTIGS.items())} FROM nation),
contigs AS (SELECT role, identical, nullif(sequence_name, 'na') AS sequence_name, CASE WHEN role = 'assembled-molecule' THEN nullif(assigned_molecule, 'na') END AS assigned_molecule,
    nullif(genbank, 'na') AS genbank, nullif(refseq, 'na') AS refseq, nullif(ucsc, 'na') AS ucsc FROM contigs0),
long AS (SELECT 0 AS priority, refseq AS name, * FROM contigs UNION ALL SELECT 1, genbank, * FROM contigs UNION ALL SELECT 2, assigned_molecule, * FROM contigs
    UNION ALL SELECT 3, sequence_name, * FROM contigs UNION ALL SELECT 4, ucsc, * FROM contigs),
by_name AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY priority, CASE WHEN role = 'assembled-molecule' THEN 0 ELSE 1 END, sequence_name) AS n
    FROM long WHERE name IS NOT NULL) WHERE n = 1)"""


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(*(f"{e} AS {n}" for n, e in CONTIGS.items()))


#: part as a FASTA: one contig for each of 25 names, a base per part key
BASE = "substr('ACGTN', cast(p_partkey % 5 + 1 AS int), 1)"


def sequence(spark: SparkSession, sf_dir: str, chunk: int = 1000) -> DataFrame:
    """contig, chunk_no, bases: the same sequence under every contig name of the projection, base i + 1 by BASE of key i."""
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey + 1 AS at", f"{BASE} AS base")
    parts = rows.groupBy(F.floor((F.col("at") - 1) / chunk).alias("chunk_no")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "base"))), lambda x: x["base"]), "").alias("bases")
    )
    names = F.transform(F.sequence(F.lit(0), F.lit(24)), lambda i: F.concat(F.lit("CM"), F.lpad(i.cast("string"), 6, "0"), F.lit(".1")))
    return parts.select(F.explode(names).alias("contig"), "chunk_no", "bases")
