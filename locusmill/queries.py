"""Every query of the engine over the driver's tables, and the SQL twin of each.

A query's name is followed by the ids of the operators that it stands for.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schema as S
from .functions import contigs as C
from .functions import expr as E
from .operators import accession, cluster, deprecate as dep, imports, lookup, qc, release, remap
from .operators.graph import shared_dir
from .plans import warehouse as W
from .plans.warehouse import ASSEMBLY, CONTIGS_SQL, CURRENT_FROM, CVE_SQL, EVENTS_SQL, REMAPPED_FROM, SVE_SQL, TAX
from .sources import files, scans, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
START, INTERVAL = 5_000_000_000, 1000


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


def of(*tables: str) -> Callable:
    """Gives a query the warehouse's tables by name instead of (spark, sf_dir)."""

    def wrap(f: Callable[..., DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            sve = W.submitted(spark, sf_dir)
            made = {
                "sve": lambda: sve, "cve": lambda: W.clustered(sve), "loci": lambda: W.loci(sve), "cvoe": lambda: W.clustered_events(sve), "svoe": lambda: W.submitted_events(sve),
                "contigs": lambda: W.contigs(spark, sf_dir), "sequence": lambda: W.sequence(spark, sf_dir),
            }
            return f(*(made[t]() if t in made else W.table(spark, sf_dir, t) for t in tables))

        run.__doc__ = f.__doc__
        return run

    return wrap


def text(x: str):
    """Timestamps and flags as text, which both engines write alike."""
    return F.date_format(x, "yyyy-MM-dd HH:mm:ss").alias(x)


def stored(lines: DataFrame, folder: str | None = None, **options: str) -> DataFrame:
    """The lines of a column value, as a text file that is read again."""
    spark = lines.sparkSession
    path = folder or f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    lines.select("value").write.options(**options).text(path)
    return spark.read.text(path)


# --- identity ---------------------------------------------------------------------------------------------------


@query("ss_hash_keys", f"WITH {SVE_SQL} SELECT accession, ss_hash, type FROM sve")
@of("sve")
def ss_hash_keys(sve):
    """P1, P3."""
    return sve.select("accession", "ss_hash", "type")


@query("rs_hash_keys", f"WITH {SVE_SQL} SELECT DISTINCT seq, contig, start, type, rs_hash FROM sve")
@of("sve")
def rs_hash_keys(sve):
    """P1, P2."""
    return sve.select("seq", "contig", "start", "type", "rs_hash").distinct()


@query("flag_defaults", f"""WITH {SVE_SQL} SELECT source, CAST(sum(CASE WHEN coalesce(evidence, true) THEN 1 ELSE 0 END) AS BIGINT) AS n_evidence,
    CAST(sum(CASE WHEN coalesce(validated, false) THEN 1 ELSE 0 END) AS BIGINT) AS n_validated, count(nullif(map_weight, 1)) AS n_weighted, count(*) AS n FROM sve GROUP BY source""")
@of("sve")
def flag_defaults(sve):
    """P5, routing by threshold."""
    return sve.groupBy(E.source_of("accession", W.CURRENT_FROM).alias("source")).agg(
        F.count_if(E.flag("evidence", True)).alias("n_evidence"), F.count_if(E.flag("validated", False)).alias("n_validated"), F.count(E.stored_weight()).alias("n_weighted"), F.count("*").alias("n")
    )


@query("vcf_positions", f"""WITH {SVE_SQL} SELECT accession, start + greatest(length(ref), length(alt)) - 1 AS variant_end, start + length(ref) - 1 AS vcf_stop,
    concat('ss', CAST(accession AS VARCHAR)) AS ss_id, replace(replace(concat(study, ',', type, '=', ref), ',', '_'), '=', '_') AS masked,
    replace(replace(concat('5%', study, ';x=', ref), '%', '%25'), ';', '%3B') AS half_escaped FROM sve""")
@of("sve")
def vcf_positions(sve):
    """P14-P17."""
    half = F.replace(E.info_escaped(F.concat(F.lit("5%"), "study", F.lit(";x="), "ref")), F.lit("%3D"), F.lit("="))
    return sve.select(
        "accession", E.variant_end().alias("variant_end"), E.vcf_stop().alias("vcf_stop"), E.prefixed("ss", "accession").alias("ss_id"),
        E.info_masked(F.concat("study", F.lit(","), "type", F.lit("="), "ref")).alias("masked"), half.alias("half_escaped"),
    )


ALLELES = "CASE l_partkey % 12 WHEN 0 THEN '<DEL>' WHEN 1 THEN 'A' WHEN 2 THEN '*' WHEN 3 THEN '<*>' WHEN 4 THEN 'G]chr1:12]' WHEN 5 THEN '.AC' WHEN 6 THEN '' WHEN 7 THEN '.' WHEN 8 THEN '[<c1>:5[T' WHEN 9 THEN '<INS:ME:L1>' WHEN 10 THEN 'acgtN' ELSE 'AX' END"


@query("structural_filter", f"""SELECT alt, count(*) AS n FROM (SELECT {ALLELES} AS alt FROM lineitem)
    WHERE NOT regexp_full_match(alt, '{E.STRUCTURAL.replace("'", "''")}') GROUP BY alt""")
@of("lineitem")
def structural_filter(lineitem):
    """F1."""
    return lineitem.selectExpr(f"{ALLELES} AS alt").where(~E.structural()).groupBy("alt").agg(F.count("*").alias("n"))


@query("valid_alleles", f"""SELECT ref, alt, count(*) AS n FROM (SELECT CASE WHEN l_linenumber = 1 THEN '' ELSE 'C' END AS ref, {ALLELES} AS alt FROM lineitem)
    WHERE regexp_full_match(concat(ref, alt), '[ACGTNacgtn]+') GROUP BY ref, alt""")
@of("lineitem")
def valid_alleles(lineitem):
    """F2, F3."""
    rows = lineitem.selectExpr("CASE WHEN l_linenumber = 1 THEN '' ELSE 'C' END AS ref", f"{ALLELES} AS alt")
    return rows.where(E.valid_alleles()).groupBy("ref", "alt").agg(F.count("*").alias("n"))


NAMED = "CASE l_partkey % 5 WHEN 0 THEN '(LARGEDELETION)' WHEN 1 THEN '<a b,c>' ELSE 'T' END"


@query("symbolic_alleles", f"""SELECT CASE WHEN special THEN 'G' ELSE 'G' END AS ref, CASE WHEN special THEN concat('<', regexp_replace(substr(x, 2, length(x) - 2), '[ ,<>]', '_', 'g'), '>') ELSE x END AS alt,
    count(*) AS n FROM (SELECT x, x <> 'T' AS special FROM (SELECT {NAMED} AS x FROM lineitem)) GROUP BY ALL""")
@of("lineitem")
def symbolic_alleles(lineitem):
    """Even rows have the special allele as reference."""
    rows = lineitem.selectExpr(f"{NAMED} AS x", "l_linenumber").withColumn("swap", (F.col("x") != "T") & (F.col("l_linenumber") % 2 == 0))
    v = E.symbolic_alleles(F.when(F.col("swap"), F.col("x")).otherwise("G"), F.when(F.col("swap"), F.lit("G")).otherwise(F.col("x")))
    return rows.select(F.inline(F.array(v))).groupBy("ref", "alt").agg(F.count("*").alias("n"))


# --- accessions -------------------------------------------------------------------------------------------------


def new_ids(key: str, source: str, known: str, start: int) -> str:
    return f"""
    have AS (SELECT {key}, min(accession) AS accession FROM {known} GROUP BY {key}),
    asked AS (SELECT DISTINCT {key} FROM {source}),
    fresh AS (SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS n FROM asked WHERE {key} NOT IN (SELECT {key} FROM have))
    SELECT a.{key}, h.accession, false AS is_new FROM asked a JOIN have h USING ({key})
    UNION ALL SELECT {key}, {start} + (n // {INTERVAL}) * {2 * INTERVAL} + n % {INTERVAL}, true FROM fresh"""


@query("accession_new", f"WITH {SVE_SQL}, old AS (SELECT * FROM sve WHERE version = 1), {new_ids('ss_hash', 'sve', 'old', START)}")
@of("sve")
def accession_new(sve):
    """Rows of version 1 are known."""
    return accession.get_or_create(sve, sve.where("version = 1").select("ss_hash", "accession", F.lit("current").alias("source")), "ss_hash", START, INTERVAL)


@query("rs_accession_new", f"WITH {CVE_SQL}, {new_ids('rs_hash', 'sve', 'cve', 3_500_000_000)}")
@of("sve", "cve")
def rs_accession_new(sve, cve):
    """L1b."""
    return accession.get_or_create(sve, cve.select("rs_hash", "accession", F.lit("current").alias("source")), "rs_hash", 3_500_000_000, INTERVAL)


BLOCKS = """blocks AS (SELECT DISTINCT l_orderkey // 1000 AS id, (l_orderkey // 1000) * 10000 + 1 AS first_value, (l_orderkey // 1000) * 10000 + 10000 AS last_value,
    (l_orderkey // 1000) % 2 = 0 AS stale FROM lineitem)"""


@query("block_recovery", f"""WITH {SVE_SQL}, {BLOCKS}, inside AS (SELECT b.id, u.accession, u.accession - b.first_value + 1 - row_number() OVER (PARTITION BY b.id ORDER BY u.accession) AS gap
    FROM blocks b JOIN (SELECT DISTINCT accession FROM sve) u ON u.accession BETWEEN b.first_value AND b.last_value WHERE b.stale),
    ends AS (SELECT id, max(accession) AS e FROM inside WHERE gap = 0 GROUP BY id)
    SELECT b.id, CASE WHEN stale THEN coalesce(e, first_value - 1) ELSE last_value END AS last_committed, NOT stale AS reserved FROM blocks b LEFT JOIN ends USING (id)""")
@of("lineitem", "sve")
def block_recovery(lineitem, sve):
    """L3."""
    blocks = lineitem.selectExpr("l_orderkey div 1000 AS id").distinct().selectExpr(
        "id", "id * 10000 + 1 AS first_value", "id * 10000 + 10000 AS last_value", "id * 10000 + 10000 AS last_committed", "true AS reserved",
        "CASE WHEN id % 2 = 0 THEN timestamp_ntz'2024-01-01 00:00:00' ELSE timestamp_ntz'2024-06-01 00:00:00' END AS updated",
    )
    return accession.recovered(blocks, sve, F.expr("timestamp_ntz'2024-03-01 00:00:00'")).select("id", "last_committed", "reserved")


@query("accession_count_check", f"WITH {CVE_SQL} SELECT DISTINCT rs_hash FROM sve WHERE rs_hash NOT IN (SELECT rs_hash FROM cve)")
@of("sve", "cve")
def accession_count_check(sve, cve):
    """R9."""
    return accession.missing(sve, cve, "rs_hash")


#: Every order asks for the id of its first line.
ASKED_IDS = "cast(o_orderkey * 10 + 1 AS bigint)"


@query("active_by_ids", f"WITH {SVE_SQL} SELECT accession, ss_hash FROM sve WHERE seq = '{ASSEMBLY}' AND accession IN (SELECT {ASKED_IDS} FROM orders)")
@of("sve", "orders")
def active_by_ids(sve, orders):
    """Asked for the first line of every order."""
    return accession.active(sve, orders.selectExpr(f"{ASKED_IDS} AS accession"), "seq", ASSEMBLY, W.CURRENT_FROM).select("accession", "ss_hash")


# --- scans ------------------------------------------------------------------------------------------------------

SCANS: dict[str, tuple[str, Callable]] = {
    "S5_clustered": (f"seq = '{ASSEMBLY}' AND rs IS NOT NULL AND back_prop_rs IS NULL", lambda d: scans.clustering(d, ASSEMBLY, True)),
    "S5_unclustered": (f"seq = '{ASSEMBLY}' AND rs IS NULL AND back_prop_rs IS NULL AND source = 'current'", lambda d: scans.clustering(d, ASSEMBLY, False)),
    "S6_resumable": (f"seq = '{ASSEMBLY}' AND rs IS NOT NULL", lambda d: scans.clustering(d, ASSEMBLY, True, resumable=True)),
    "S7_study": (f"seq = '{ASSEMBLY}' AND rs IS NULL AND back_prop_rs IS NULL AND source = 'current' AND study IN ('PRJEB1', 'PRJEB4')", lambda d: scans.study_unclustered(d, ASSEMBLY, ["PRJEB1", "PRJEB4"])),
    "S9_qc": (f"seq = '{ASSEMBLY}' AND map_weight IS NULL", lambda d: scans.qc(d, ASSEMBLY)),
    "S11_study": (f"seq = '{ASSEMBLY}' AND study = 'PRJEB7' AND source = 'current'", lambda d: scans.study(d, ASSEMBLY, "PRJEB7")),
    "S16_export": (f"seq = '{ASSEMBLY}' AND remapped_from IS NULL AND study IN ('PRJEB1') AND tax = {TAX + 1}", lambda d: scans.remapping_export(d, ASSEMBLY, ["PRJEB1"], TAX + 1)),
    "F6_remapped": ("rs IS NOT NULL AND remapped_from IS NOT NULL AND map_weight IS NULL", scans.clustered_remapped),
    "R1_range": (f"accession BETWEEN 0 AND {CURRENT_FROM - 1}", lambda d: scans.accession_range(d, 0, CURRENT_FROM - 1)),
    "R10_unclustered": ("rs IS NULL AND source = 'current'", qc.unclustered),
}


@query("job_scans", f"WITH {SVE_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS scan, accession, ss_hash, rs, version FROM sve WHERE {w}" for n, (w, _) in SCANS.items()))
@of("sve")
def job_scans(sve):
    """S5-S7, S9, S11, S16, F6, R1, R10."""
    parts = [f(sve).select(F.lit(n).alias("scan"), "accession", "ss_hash", "rs", "version") for n, (_, f) in SCANS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("back_prop_targets", f"""WITH {EVENTS_SQL}, ids AS (SELECT accession AS rs FROM cvoe WHERE event = 'MERGED' AND asm = '{ASSEMBLY}' UNION SELECT merge_into FROM cvoe WHERE event = 'MERGED' AND asm = '{ASSEMBLY}'),
    twins AS (SELECT accession FROM sve WHERE seq = '{ASSEMBLY}' AND remapped_from = '{REMAPPED_FROM}' AND rs IN (SELECT rs FROM ids WHERE rs IS NOT NULL))
    SELECT accession, ss_hash FROM sve WHERE seq = '{REMAPPED_FROM}' AND accession - 10 IN (SELECT accession FROM twins)""")
@of("cvoe", "sve")
def back_prop_targets(cvoe, sve):
    """Rows of the original assembly are taken as twins of those ten ids below."""
    shifted = sve.withColumn("accession", F.when(F.col("seq") == REMAPPED_FROM, F.col("accession") - 10).otherwise(F.col("accession")))
    found = scans.split_or_merged_targets(cvoe, shifted, ASSEMBLY, REMAPPED_FROM)
    return found.select((F.col("accession") + 10).alias("accession"), "ss_hash")


# --- clustering -------------------------------------------------------------------------------------------------


@query("merge_destination", f"WITH {SVE_SQL} SELECT seq, rs_hash, min(rs) AS target, count(DISTINCT rs) AS n_rs FROM sve WHERE rs IS NOT NULL GROUP BY seq, rs_hash HAVING count(DISTINCT rs) > 1")
@of("sve")
def merge_destination(sve):
    """A5."""
    return cluster.merge_destinations(sve)


@query("merge_candidates", f"""WITH {SVE_SQL} SELECT concat('RSMC_', seq, '_', rs_hash) AS id, 'RS_MERGE_CANDIDATES' AS event, seq, rs_hash, count(DISTINCT rs) AS n_rs
    FROM sve WHERE rs IS NOT NULL AND seq = '{ASSEMBLY}' GROUP BY seq, rs_hash HAVING count(DISTINCT rs) > 1""")
@of("sve")
def merge_candidates(sve):
    """S8, P20, L5."""
    return scans.candidates(cluster.merge_candidates(sve), ASSEMBLY, "RSMC")


@query("split_candidates", f"""WITH {SVE_SQL} SELECT concat('RSSC_', seq, '_', CAST(rs AS VARCHAR)) AS id, 'RS_SPLIT_CANDIDATES' AS event, seq, rs, count(DISTINCT rs_hash) AS n_loci
    FROM sve WHERE rs IS NOT NULL AND seq <> '{ASSEMBLY}' GROUP BY seq, rs HAVING count(DISTINCT rs_hash) > 1""")
@of("sve")
def split_candidates(sve):
    """Candidates left when those of one assembly are cleared."""
    return cluster.without_candidates(cluster.split_candidates(sve), ASSEMBLY)


LABELS = """
edges AS (SELECT DISTINCT a.seq, a.rs AS x, b.rs AS y FROM sve a JOIN (SELECT seq, rs_hash, min(rs) AS rs FROM sve WHERE rs IS NOT NULL GROUP BY seq, rs_hash) b USING (seq, rs_hash) WHERE a.rs IS NOT NULL),
pairs AS (SELECT seq, x, y FROM edges UNION SELECT seq, y, x FROM edges),
reach(seq, x, y) AS (SELECT DISTINCT seq, x, x FROM pairs UNION SELECT r.seq, r.x, b.y FROM reach r JOIN pairs b ON r.seq = b.seq AND r.y = b.x),
labels AS (SELECT seq, x AS rs, min(y) AS target FROM reach GROUP BY seq, x)"""


@query("merge_components", f"WITH RECURSIVE {SVE_SQL}, {LABELS} SELECT seq, rs, target FROM labels WHERE rs <> target")
@of("sve")
def merge_components(sve):
    """G1."""
    return cluster.merge_map(sve)


@query("merge_events", f"""WITH RECURSIVE {SVE_SQL}, {LABELS} SELECT DISTINCT concat('UPDATED_', s.seq, '_', ss_hash, '_', CAST(s.rs AS VARCHAR)) AS id, accession,
    concat('Original rs', CAST(s.rs AS VARCHAR), ' associated with SS was merged into rs', CAST(target AS VARCHAR), '.') AS reason FROM sve s JOIN labels l ON s.seq = l.seq AND s.rs = l.rs WHERE s.rs <> target""")
@of("sve")
def merge_events(sve):
    """L6."""
    return cluster.merge(sve)[1].select("id", "accession", "reason").distinct()


SPLITS = """
ranks AS (SELECT seq, rs, rs_hash, count(*) AS n_ss, min(accession) AS min_ss, min(concat_ws('_', seq, contig, CAST(start AS VARCHAR), type)) AS summary
    FROM (SELECT DISTINCT seq, rs, rs_hash, contig, start, type, ss_hash, accession FROM sve WHERE rs IS NOT NULL) GROUP BY seq, rs, rs_hash),
split AS (SELECT *, count(*) OVER (PARTITION BY seq, rs) AS n_loci, row_number() OVER (PARTITION BY seq, rs ORDER BY n_ss DESC, min_ss, summary) = 1 AS keeps FROM ranks)"""


@query("split_keeper", f"WITH {SVE_SQL}, {SPLITS} SELECT seq, rs, rs_hash, n_ss, min_ss, n_loci, keeps FROM split WHERE n_loci > 1")
@of("sve")
def split_keeper(sve):
    """A6, A15."""
    return cluster.split_ranks(sve).select("seq", "rs", "rs_hash", "n_ss", "min_ss", "n_loci", "keeps")


@query("split_new_rs", f"""WITH {SVE_SQL}, {SPLITS}, fresh AS (SELECT rs_hash, row_number() OVER (ORDER BY rs_hash) - 1 AS n FROM (SELECT DISTINCT rs_hash FROM split WHERE n_loci > 1 AND NOT keeps))
    SELECT concat('RS_SPLIT_', seq, '_', CAST(rs AS VARCHAR), '_', rs_hash) AS id, rs AS accession, 3600000000 + (n // {INTERVAL}) * {2 * INTERVAL} + n % {INTERVAL} AS split_into
    FROM split JOIN fresh USING (rs_hash) WHERE n_loci > 1 AND NOT keeps""")
@of("sve")
def split_new_rs(sve):
    """L7."""
    return cluster.split(sve, 3_600_000_000, INTERVAL)[1].select("id", "accession", "split_into")


@query("split_keeper_rows", f"WITH {CVE_SQL}, {SPLITS} SELECT min(rs) AS rs, rs_hash, seq FROM split WHERE n_loci > 1 AND keeps AND rs_hash NOT IN (SELECT rs_hash FROM cve) GROUP BY rs_hash, seq")
@of("sve", "cve")
def split_keeper_rows(sve, cve):
    """L7."""
    return cluster.keeper_rows(sve, cve)


DUP_SS = """dup AS (SELECT *, count(*) OVER (PARTITION BY seq, accession) AS n_rows, row_number() OVER (PARTITION BY seq, accession ORDER BY rs IS NULL, NOT coalesce(evidence, true), concat_ws('_', seq, study, contig, CAST(start AS VARCHAR), ref, alt)) = 1 AS keeps
    FROM (SELECT DISTINCT seq, accession // 4 AS accession, ss_hash, rs, evidence, study, contig, start, ref, alt FROM (SELECT *, row_number() OVER (PARTITION BY seq, accession // 4, ss_hash ORDER BY accession) AS k FROM sve
    WHERE map_weight IS NULL AND coalesce(alleles_match, true) AND remapped_from IS NULL) WHERE k = 1))"""


def quartered(sve: DataFrame) -> DataFrame:
    """Ids four to one, so that ids repeat; of equal hashes under an id the row of the smallest former id."""
    rows = sve.where("map_weight is null and coalesce(alleles_match, true) and remapped_from is null").withColumn("old", F.col("accession")).withColumn("accession", F.floor(F.col("accession") / 4))
    return cluster.best(rows, ["seq", "accession", "ss_hash"], F.col("old"))


@query("ss_split_keeper", f"WITH {SVE_SQL}, {DUP_SS} SELECT seq, accession, ss_hash, n_rows, keeps FROM dup WHERE n_rows > 1")
@of("sve")
def ss_split_keeper(sve):
    """A7."""
    return cluster.duplicate_ss_ranks(quartered(sve)).select("seq", "accession", "ss_hash", "n_rows", "keeps")


@query("ss_split_events", f"""WITH {SVE_SQL}, {DUP_SS}, fresh AS (SELECT ss_hash, row_number() OVER (ORDER BY ss_hash) - 1 AS n FROM (SELECT DISTINCT ss_hash FROM dup WHERE n_rows > 1 AND NOT keeps))
    SELECT concat('SS_SPLIT_FROM_', CAST(accession AS VARCHAR), '_TO_', CAST({START} + (n // {INTERVAL}) * {2 * INTERVAL} + n % {INTERVAL} AS VARCHAR)) AS id, accession, ss_hash
    FROM dup JOIN fresh USING (ss_hash) WHERE n_rows > 1 AND NOT keeps""")
@of("sve")
def ss_split_events(sve):
    """L8."""
    return cluster.split_duplicate_ss(quartered(sve), START, INTERVAL).select("id", "accession", "ss_hash")


@query("assign_rs", f"""WITH {CVE_SQL}, known AS (SELECT rs_hash, min(accession) AS new_rs FROM cve WHERE map_weight IS NULL GROUP BY rs_hash)
    SELECT DISTINCT accession, ss_hash, new_rs AS rs FROM sve JOIN known USING (rs_hash) WHERE rs IS NULL AND map_weight IS NULL AND back_prop_rs IS NULL AND source = 'current' AND seq = '{ASSEMBLY}'""")
@of("sve", "cve")
def assign_rs(sve, cve):
    """S5, F7, J10, L4."""
    return cluster.assign(scans.clustering(sve, ASSEMBLY, False), cve).select("accession", "ss_hash", "rs").distinct()


@query("classify_remapped", f"""WITH {CVE_SQL}, r AS (SELECT * FROM sve WHERE rs IS NOT NULL AND remapped_from IS NOT NULL AND map_weight IS NULL),
    stored AS (SELECT rs_hash, min(accession) AS owner FROM cve GROUP BY rs_hash),
    places AS (SELECT rs, count(DISTINCT rs_hash) AS n_loci FROM (SELECT accession AS rs, rs_hash FROM cve UNION ALL SELECT rs, rs_hash FROM r) GROUP BY rs),
    o AS (SELECT r.rs_hash, r.rs, owner IS NOT NULL AS known, coalesce(owner, first_value(r.rs) OVER (PARTITION BY r.rs_hash ORDER BY r.accession, r.ss_hash)) AS own FROM r LEFT JOIN stored USING (rs_hash))
    SELECT CASE WHEN own <> o.rs THEN 'merge' WHEN n_loci > 1 THEN 'split' WHEN known THEN 'same' ELSE 'new' END AS kind, count(*) AS n, min(rs_hash) AS first_hash FROM o JOIN places USING (rs) GROUP BY 1""")
@of("sve", "cve")
def classify_remapped(sve, cve):
    """F6, L5."""
    return cluster.classify(scans.clustered_remapped(sve), cve).groupBy("kind").agg(F.count("*").alias("n"), F.min("rs_hash").alias("first_hash"))


@query("backprop_rs", f"""WITH {SVE_SQL}, twins AS (SELECT accession + 10 AS accession, max(rs) AS twin FROM sve WHERE seq = '{ASSEMBLY}' AND rs IS NOT NULL GROUP BY accession)
    SELECT DISTINCT accession, ss_hash, twin AS back_prop_rs FROM sve JOIN twins USING (accession) WHERE seq = '{REMAPPED_FROM}' AND coalesce(alleles_match, true) AND twin IS DISTINCT FROM rs AND twin IS DISTINCT FROM back_prop_rs""")
@of("sve")
def backprop_rs(sve):
    """Twins are ten ids apart."""
    later = sve.where(F.col("seq") == ASSEMBLY).withColumn("accession", F.col("accession") + 10)
    return cluster.back_propagate(sve.where(F.col("seq") == REMAPPED_FROM), later).select("accession", "ss_hash", "back_prop_rs").distinct()


@query("clustering_metrics", f"""WITH RECURSIVE {SVE_SQL}, {LABELS}, d AS (SELECT DISTINCT ss_hash, accession, seq, rs FROM sve), a AS (SELECT d.*, coalesce(target, d.rs) AS new_rs FROM d LEFT JOIN labels l ON d.seq = l.seq AND d.rs = l.rs)
    SELECT count(*) AS n_rows, count(o.rs) AS n_clustered_before, count(a.new_rs) AS n_clustered_after, CAST(sum(CASE WHEN o.rs IS NULL AND a.new_rs IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_newly_clustered,
    CAST(sum(CASE WHEN o.rs <> a.new_rs THEN 1 ELSE 0 END) AS BIGINT) AS n_updated, count(*) - count(a.new_rs) AS n_kept_unclustered FROM d o JOIN a USING (ss_hash, accession, seq)""")
@of("sve")
def clustering_metrics(sve):
    """A14."""
    rows = sve.dropDuplicates(["ss_hash", "accession", "seq", "rs"])
    return cluster.metrics(rows, cluster.merge(rows)[0])


@query("operation_counts", f"""WITH {EVENTS_SQL} SELECT count(*) FILTER (what = 'rs' AND event = 'RS_SPLIT') AS n_rs_split, count(*) FILTER (what = 'rs' AND event = 'MERGED') AS n_merge_operations,
    count(*) FILTER (what = 'rs' AND event = 'DEPRECATED') AS n_rs_deprecated, count(*) FILTER (what = 'ss' AND event = 'UPDATED') AS n_update_operations,
    count(*) FILTER (what = 'ss' AND event = 'SS_SPLIT') AS n_ss_split, count(*) FILTER (what = 'ss' AND event = 'DEPRECATED') AS n_ss_deprecated
    FROM (SELECT 'rs' AS what, event FROM cvoe UNION ALL SELECT 'ss', event FROM svoe)""")
@of("cvoe", "svoe")
def operation_counts(cvoe, svoe):
    """A14."""
    return cluster.operation_counts(cvoe, svoe)


@query("accession_counts", f"""WITH {SVE_SQL}, k AS (SELECT ss_hash, count(*) AS n, bool_or(version = 1) AS has FROM sve GROUP BY ss_hash)
    SELECT CAST(sum(n) AS BIGINT) AS n_submitted, count(*) FILTER (has) AS n_accessioned, count(*) AS n_distinct, CAST(sum(n) - count(*) AS BIGINT) AS n_duplicate, count(*) FILTER (NOT has) AS n_discarded FROM k""")
@of("sve")
def accession_counts(sve):
    """A14, with the hashes of first versions as those that got an accession."""
    return accession.counts(sve, sve.where("version = 1"), "ss_hash")


# --- ingest, import, deprecation --------------------------------------------------------------------------------

INGEST = f"""
inc0 AS (SELECT DISTINCT ON (accession, ss_hash) * FROM sve WHERE seq = '{ASSEMBLY}' AND remapped_from IS NOT NULL ORDER BY accession, ss_hash, rs, created),
sto AS (SELECT DISTINCT ON (accession, ss_hash) * FROM sve WHERE seq = '{ASSEMBLY}' AND (remapped_from IS NULL OR coalesce(validated, false)) ORDER BY accession, ss_hash, rs, created),
inc AS (SELECT * FROM inc0 UNION ALL SELECT * REPLACE (accession + 20 AS accession) FROM inc0 WHERE version = 1),
fill AS (SELECT *, coalesce(evidence, true) AS e, coalesce(asm_match, true) AS a, coalesce(alleles_match, true) AS l, coalesce(validated, false) AS v FROM inc),
fillo AS (SELECT *, coalesce(evidence, true) AS e, coalesce(asm_match, true) AS a, coalesce(alleles_match, true) AS l, coalesce(validated, false) AS v FROM sto),
fresh0 AS (SELECT * FROM fill n WHERE NOT EXISTS (SELECT 1 FROM fillo o WHERE o.accession = n.accession AND o.ss_hash = n.ss_hash AND o.tax = n.tax AND o.rs IS NOT DISTINCT FROM n.rs AND o.e = n.e AND o.a = n.a AND o.l = n.l
    AND o.v = n.v AND o.map_weight IS NOT DISTINCT FROM n.map_weight AND o.remapped_from IS NOT DISTINCT FROM n.remapped_from AND o.back_prop_rs IS NOT DISTINCT FROM n.back_prop_rs)),
fresh AS (SELECT DISTINCT ON (accession, ss_hash, tax, rs, e, a, l, v, map_weight, remapped_from, back_prop_rs) * FROM fresh0),
rows1 AS (SELECT *, false AS is_stored FROM fresh UNION ALL SELECT *, true FROM fillo WHERE ss_hash IN (SELECT ss_hash FROM fresh) OR accession IN (SELECT accession FROM fresh)),
h AS (SELECT *, CASE WHEN bool_or(NOT is_stored) OVER (PARTITION BY seq, ss_hash) THEN row_number() OVER (PARTITION BY seq, ss_hash ORDER BY remapped_from IS NOT NULL, created, accession, ss_hash, is_stored DESC) ELSE 1 END AS k FROM rows1),
i AS (SELECT * EXCLUDE (k), CASE WHEN bool_or(NOT is_stored) OVER (PARTITION BY seq, accession) THEN row_number() OVER (PARTITION BY seq, accession ORDER BY remapped_from IS NOT NULL, created, accession, ss_hash, is_stored DESC) ELSE 1 END AS k FROM h WHERE k = 1)"""


def ingested(sve: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What comes in, then what remap.ingest() makes of it."""
    order = [F.col("rs").asc_nulls_last(), F.col("created")]
    ours = sve.where(F.col("seq") == ASSEMBLY)
    incoming = cluster.best(ours.where("remapped_from is not null"), ["accession", "ss_hash"], *order)
    stored = cluster.best(ours.where("remapped_from is null or coalesce(validated, false)"), ["accession", "ss_hash"], *order)
    again = incoming.where("version = 1").withColumn("accession", F.col("accession") + 20)
    incoming = incoming.unionByName(again)
    return incoming, *remap.ingest(incoming, stored)


@query("ingest_inserted", f"WITH {SVE_SQL}, {INGEST} SELECT accession, ss_hash FROM i WHERE k = 1 AND NOT is_stored")
@of("sve")
def ingest_inserted(sve):
    """A8, L12."""
    return ingested(sve)[1].select("accession", "ss_hash")


@query("discard_duplicates", f"""WITH {SVE_SQL}, {INGEST}, lost AS (SELECT accession, ss_hash, remapped_from FROM h WHERE k > 1 UNION ALL SELECT accession, ss_hash, remapped_from FROM i WHERE k > 1)
    SELECT DISTINCT concat('DISCARD_SS_', CAST(accession AS VARCHAR), '_HASH_', ss_hash, '_SOURCE_', coalesce(remapped_from, 'native')) AS id, accession, ss_hash FROM lost""")
@of("sve")
def discard_duplicates(sve):
    """A8, A10, L12, P20."""
    return remap.discard_events(ingested(sve)[2]).select("id", "accession", "ss_hash")


@query("ingest_counts", f"""WITH {SVE_SQL}, {INGEST}, lost AS (SELECT accession, ss_hash, remapped_from, is_stored FROM h WHERE k > 1 UNION ALL SELECT accession, ss_hash, remapped_from, is_stored FROM i WHERE k > 1),
    ins AS (SELECT count(*) AS n FROM i WHERE k = 1 AND NOT is_stored)
    SELECT n AS n_ingested, (SELECT count(*) FROM (SELECT DISTINCT accession, ss_hash, coalesce(remapped_from, 'native') FROM lost)) AS n_discarded,
    (SELECT count(*) FROM inc) - n - (SELECT count(*) FROM lost WHERE NOT is_stored) AS n_skipped FROM ins""")
@of("sve")
def ingest_counts(sve):
    """A14."""
    incoming, inserted, lost, _ = ingested(sve)
    return remap.ingest_counts(incoming, inserted, lost)


@query("source_dates", f"""WITH {SVE_SQL}, f AS (SELECT accession + 10 AS accession, min(created) AS first FROM sve WHERE seq = '{REMAPPED_FROM}' GROUP BY accession)
    SELECT s.accession, ss_hash, strftime(coalesce(first, created), '%Y-%m-%d %H:%M:%S') AS created FROM sve s LEFT JOIN f USING (accession) WHERE seq = '{ASSEMBLY}' AND remapped_from IS NOT NULL""")
@of("sve")
def source_dates(sve):
    """J13, H18."""
    source = sve.where(F.col("seq") == REMAPPED_FROM).withColumn("accession", F.col("accession") + 10)
    return remap.source_dates(sve.where((F.col("seq") == ASSEMBLY) & F.col("remapped_from").isNotNull()), source).select("accession", "ss_hash", text("created"))


@query("remapping_export", f"""WITH {SVE_SQL}, e AS (SELECT *, substr('ACGTN', CAST(((CASE WHEN start = 1 THEN 1 ELSE start - 1 END) - 1) % 5 + 1 AS INT), 1) AS base FROM sve
    WHERE seq = '{ASSEMBLY}' AND remapped_from IS NULL AND map_weight IS NULL AND coalesce(alleles_match, true) AND length(concat(ref, alt)) > 0)
    SELECT accession, ss_hash, contig, CASE WHEN ref = '' AND start > 1 THEN start - 1 ELSE start END AS start, CASE WHEN ref = '' THEN base ELSE ref END AS ref,
    CASE WHEN ref <> '' THEN alt WHEN start = 1 THEN concat(alt, base) ELSE concat(base, alt) END AS alt FROM e""")
@of("sve", "sequence")
def remapping_export(sve, sequence):
    """S16, F3-F5, P11, C1."""
    return remap.export(sve, sequence, ASSEMBLY).select("accession", "ss_hash", "contig", "start", "ref", "alt")


@query("export_lines", f"""WITH {SVE_SQL} SELECT contig, start, concat_ws('\t', contig, CAST(start AS VARCHAR), concat('ss', CAST(accession AS VARCHAR)), ref, alt, '.', '.', concat_ws(';', concat('SS_HASH=', ss_hash),
    CASE WHEN rs IS NOT NULL THEN concat('RS=rs', CAST(rs AS VARCHAR)) END, CASE WHEN back_prop_rs IS NOT NULL THEN concat('BACKPROP_RS=rs', CAST(back_prop_rs AS VARCHAR)) END,
    concat('PROJECT=', study), concat('TAX=', CAST(tax AS VARCHAR)), concat('CREATED=', strftime(created, '%Y-%m-%dT%H:%M:%S')))) AS line FROM sve WHERE seq = '{ASSEMBLY}'""")
@of("sve")
def export_lines(sve):
    """K7, P15, P17."""
    return sinks.export_lines(sve.where(F.col("seq") == ASSEMBLY))


DEPRECATION = """
gone AS (SELECT DISTINCT ON (ss_hash, accession, seq) * FROM sve WHERE seq = 'GCA_000000001.1' AND study = 'PRJEB7' AND source = 'current'),
alive AS (SELECT * FROM sve s WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.ss_hash = s.ss_hash AND g.accession = s.accession AND g.seq = s.seq)),
orphans AS (SELECT DISTINCT rs_hash, rs FROM gone g WHERE rs IS NOT NULL AND NOT EXISTS (SELECT 1 FROM alive a WHERE a.rs_hash = g.rs_hash AND a.rs = g.rs))"""


@query("deprecate_cascade", f"""WITH {CVE_SQL}, {DEPRECATION} SELECT DISTINCT concat('SS_DEPRECATED_X_', ss_hash) AS id, accession, seq FROM gone
    UNION ALL SELECT DISTINCT concat('RS_DEPRECATED_X_', c.rs_hash), c.accession, c.asm FROM cve c JOIN orphans o ON c.rs_hash = o.rs_hash AND c.accession = o.rs""")
@of("sve", "cve")
def deprecate_cascade(sve, cve):
    """S11, L11, J12, P20."""
    _, _, ss, rs = dep.deprecate(sve, cve, scans.study(sve, ASSEMBLY, "PRJEB7"), "X", "withdrawn")
    return ss.select("id", "accession", "seq").distinct().unionByName(rs.select("id", "accession", "seq").distinct())


@query("deprecate_remaining", f"""WITH {CVE_SQL}, {DEPRECATION} SELECT 'submitted' AS what, count(*) AS n FROM alive UNION ALL
    SELECT 'clustered', count(*) FROM cve c WHERE NOT EXISTS (SELECT 1 FROM orphans o WHERE c.rs_hash = o.rs_hash AND c.accession = o.rs)""")
@of("sve", "cve")
def deprecate_remaining(sve, cve):
    """L11, H15."""
    alive, kept, _, _ = dep.deprecate(sve, cve, scans.study(sve, ASSEMBLY, "PRJEB7"), "X", "withdrawn")
    return alive.agg(F.lit("submitted").alias("what"), F.count("*").alias("n")).unionByName(kept.agg(F.lit("clustered").alias("what"), F.count("*").alias("n")))


@query("import_merges", f"""WITH {EVENTS_SQL}, owner AS (SELECT rs_hash, min(accession) AS owner FROM cve GROUP BY rs_hash), first AS (SELECT rs_hash, min(accession) AS first FROM loci GROUP BY rs_hash),
    l AS (SELECT i.accession, coalesce(owner, first) AS merge_into FROM loci i JOIN first USING (rs_hash) LEFT JOIN owner USING (rs_hash))
    SELECT accession, min(merge_into) AS merge_into FROM l WHERE accession <> merge_into AND accession NOT IN (SELECT accession FROM cvoe WHERE event = 'MERGED') GROUP BY accession""")
@of("loci", "cve", "cvoe")
def import_merges(loci, cve, cvoe):
    """All loci come in again; those of the log were merged before."""
    return imports.import_clustered(loci, cve, cvoe.where("event = 'MERGED'"))[1].select("accession", "merge_into")


@query("import_inserts", f"""WITH {CVE_SQL} SELECT rs_hash, min(accession) AS accession FROM loci WHERE rs_hash NOT IN (SELECT rs_hash FROM cve) GROUP BY rs_hash""")
@of("loci", "cve", "cvoe")
def import_inserts(loci, cve, cvoe):
    """K10, L13."""
    return imports.import_clustered(loci, cve, cvoe)[0].select("rs_hash", "accession")


# --- release ----------------------------------------------------------------------------------------------------

INFO = """array_to_string(list_sort(list(DISTINCT class)), ',') AS vc, array_to_string(list_sort(list(DISTINCT study)), ',') AS sid, CAST(sum(CASE WHEN ss_validated THEN 1 ELSE 0 END) AS BIGINT) AS ss_validated,
    bool_or(rs_validated) AS rs_validated, bool_or(NOT alleles_match) AS almm, bool_or(NOT asm_match) AS asmm, bool_or(remapped_rs) AS remapped, NOT bool_or(evidence) AS loe"""
SO = "CASE {0} WHEN 'SNV' THEN 'SO:0001483' WHEN 'DEL' THEN 'SO:0000159' WHEN 'INS' THEN 'SO:0000667' WHEN 'INDEL' THEN 'SO:1000032' WHEN 'MNV' THEN 'SO:0002007' END AS class"
SS_FLAGS = "coalesce(s.evidence, true) AS evidence, coalesce(s.asm_match, true) AS asm_match, coalesce(s.alleles_match, true) AS alleles_match, coalesce(s.validated, false) AS ss_validated"
NEAR = "c.contig = s.contig AND (c.start = s.start OR (c.type IN ('INS', 'DEL') AND abs(c.start - s.start) = 1))"
ACTIVE = f"""ss AS (SELECT * FROM sve WHERE seq = '{ASSEMBLY}' AND tax = {TAX} AND rs IS NOT NULL), allr AS (SELECT rs, bool_and(remapped_from IS NOT NULL) AS remapped_rs FROM ss GROUP BY rs),
    j AS (SELECT c.accession AS rs, c.contig, s.start, s.ref, s.alt, {SO.format('c.type')}, s.study, c.validated AS rs_validated, {SS_FLAGS}, remapped_rs FROM cve c JOIN ss s ON c.accession = s.rs JOIN allr r ON r.rs = s.rs
    WHERE c.asm = '{ASSEMBLY}' AND c.map_weight IS NULL AND {NEAR}), act AS (SELECT rs, contig, start, ref, alt, {INFO} FROM j GROUP BY rs, contig, start, ref, alt)"""


@query("release_active", f"WITH {CVE_SQL}, {ACTIVE} SELECT * FROM act")
@of("cve", "sve")
def release_active(cve, sve):
    """S21, J1, J3, F8, A2-A4."""
    return release.active(cve, sve, ASSEMBLY, TAX)


@query("release_report", f"""WITH {CVE_SQL}, {ACTIVE}, b AS (SELECT *, substr('ACGTN', CAST(((CASE WHEN start = 1 THEN 1 ELSE start - 1 END) - 1) % 5 + 1 AS INT), 1) AS base FROM act),
    v AS (SELECT * REPLACE (CASE WHEN ref = '' AND start > 1 THEN start - 1 ELSE start END AS start, CASE WHEN ref = '' THEN base ELSE ref END AS ref,
    CASE WHEN ref <> '' THEN alt WHEN start = 1 THEN concat(alt, base) ELSE concat(base, alt) END AS alt) FROM b)
    SELECT contig, start, concat_ws('\t', contig, CAST(start AS VARCHAR), concat('rs', CAST(rs AS VARCHAR)), ref, alt, '.', '.', concat_ws(';', concat('VC=', vc), concat('SID=', sid), concat('SS_VALIDATED=', CAST(ss_validated AS VARCHAR)),
    CASE WHEN rs_validated THEN 'RS_VALIDATED' END, CASE WHEN almm THEN 'ALMM' END, CASE WHEN asmm THEN 'ASMM' END, CASE WHEN loe THEN 'LOE' END, CASE WHEN remapped THEN 'REMAPPED' END)) AS line FROM v""")
@of("cve", "sve", "sequence")
def release_report(cve, sve, sequence):
    """P12-P14, P16, F2, K3."""
    return release.report(release.active(cve, sve, ASSEMBLY, TAX), sequence)


@query("release_multimap", f"""WITH {CVE_SQL}, j AS (SELECT c.accession AS rs, c.contig, s.start, s.ref, s.alt, {SO.format('c.type')}, s.study, c.validated AS rs_validated, {SS_FLAGS}, false AS remapped_rs, c.map_weight
    FROM cve c JOIN sve s ON c.accession = s.rs AND c.source = s.source WHERE c.asm = '{ASSEMBLY}' AND c.map_weight >= 2 AND {NEAR})
    SELECT rs, contig, start, ref, alt, {INFO}, max(map_weight) AS map_weight FROM j GROUP BY rs, contig, start, ref, alt""")
@of("cve", "sve")
def release_multimap(cve, sve):
    """J4."""
    return release.multimap(cve, sve, ASSEMBLY)


CHAIN = f"""ours AS (SELECT * FROM cvoe WHERE asm = '{ASSEMBLY}'), live AS (SELECT DISTINCT accession FROM cve WHERE asm = '{ASSEMBLY}'),
    steps AS (SELECT DISTINCT accession, merge_into FROM ours WHERE event = 'MERGED'),
    met(origin, node, hop) AS (SELECT DISTINCT accession, accession, 0 FROM ours WHERE accession NOT IN (SELECT accession FROM live) UNION ALL SELECT m.origin, s.merge_into, hop + 1 FROM met m JOIN steps s ON m.node = s.accession WHERE hop < 20),
    hit AS (SELECT origin, merge_into, node, hop FROM met m JOIN steps s ON m.node = s.accession WHERE merge_into IN (SELECT accession FROM live)),
    best AS (SELECT DISTINCT ON (origin) origin, merge_into AS target, node AS via FROM hit ORDER BY origin, merge_into, hop, node),
    dropped AS (SELECT DISTINCT origin FROM met WHERE node IN (SELECT accession FROM ours WHERE event = 'DEPRECATED')),
    chain AS (SELECT o.origin AS rs, CASE WHEN target IS NOT NULL THEN 'merged' WHEN d.origin IS NOT NULL THEN 'deprecated' ELSE 'undetermined' END AS status, target, via
    FROM (SELECT DISTINCT origin FROM met) o LEFT JOIN best b ON o.origin = b.origin LEFT JOIN dropped d ON o.origin = d.origin)"""


@query("merge_chain", f"WITH RECURSIVE {EVENTS_SQL}, {CHAIN} SELECT rs, status, target, via FROM chain")
@of("cvoe", "cve")
def merge_chain(cvoe, cve):
    """L15, G3, H8."""
    return release.chains(cvoe, cve, ASSEMBLY)


@query("release_merged", f"""WITH RECURSIVE {EVENTS_SQL}, {CHAIN}, f AS (SELECT rs AS origin, target, via FROM chain WHERE status = 'merged'),
    place AS (SELECT DISTINCT ON (accession, merge_into) accession AS via, merge_into AS target, contig, start, type, validated AS rs_validated FROM ours WHERE event = 'MERGED' ORDER BY accession, merge_into, rs_hash),
    s AS (SELECT * FROM svoe WHERE event = 'UPDATED' AND seq = '{ASSEMBLY}' AND tax = {TAX + 1}), allr AS (SELECT rs, bool_and(remapped_from IS NOT NULL) AS remapped_rs FROM s GROUP BY rs),
    j AS (SELECT via AS rs, c.contig, s.start, s.ref, s.alt, {SO.format('c.type')}, s.study, rs_validated, {SS_FLAGS}, remapped_rs, target FROM f JOIN place c USING (via, target) JOIN s ON origin = s.rs JOIN allr r ON r.rs = origin
    WHERE s.reason LIKE 'Original%' AND {NEAR})
    SELECT rs, contig, start, ref, alt, {INFO}, array_to_string(list_sort(list(DISTINCT CAST(target AS VARCHAR))), ',') AS curr FROM j GROUP BY rs, contig, start, ref, alt""")
@of("cvoe", "svoe", "cve")
def release_merged(cvoe, svoe, cve):
    """J2, J5, S22, F11, H7, H9. Of several merges of an id into the same target the one with the first hash gives the place."""
    first = cvoe.where(F.col("inactive")[0]["asm"] == ASSEMBLY).where("event = 'MERGED'")
    first = cluster.best(first, ["accession", "merge_into"], F.col("inactive")[0]["rs_hash"])
    return release.merged(first.unionByName(cvoe.where("event <> 'MERGED'")), svoe, cve, ASSEMBLY, TAX + 1)


@query("release_deprecated", f"""WITH {EVENTS_SQL} SELECT DISTINCT accession AS rs FROM cvoe WHERE event = 'DEPRECATED' AND asm = '{ASSEMBLY}' AND accession IN
    (SELECT rs FROM svoe GROUP BY rs HAVING bool_or(seq = '{ASSEMBLY}') AND bool_or(tax = {TAX}) AND bool_or(event IN ('UPDATED', 'DEPRECATED')))""")
@of("cvoe", "svoe")
def release_deprecated(cvoe, svoe):
    """J6, H6."""
    return release.deprecated(cvoe, svoe, ASSEMBLY, TAX)


@query("release_merged_deprecated", f"""WITH {EVENTS_SQL} SELECT DISTINCT accession AS rs, merge_into FROM cvoe c WHERE event = 'MERGED' AND asm = '{ASSEMBLY}' AND accession IN
    (SELECT rs FROM svoe GROUP BY rs HAVING bool_or(seq = '{ASSEMBLY}') AND bool_or(tax = {TAX})) AND NOT EXISTS (SELECT 1 FROM sve s WHERE s.rs = c.merge_into AND s.source = c.source)""")
@of("cvoe", "svoe", "sve")
def release_merged_deprecated(cvoe, svoe, sve):
    """J7, K4."""
    return release.merged_deprecated(cvoe, svoe, sve, ASSEMBLY, TAX)


@query("rs_dump", f"""WITH {EVENTS_SQL} SELECT 'active' AS category, concat('rs', CAST(accession AS VARCHAR)) AS line, count(*) AS n FROM cve WHERE asm = '{ASSEMBLY}' GROUP BY accession
    UNION ALL SELECT 'events', concat('rs', CAST(accession AS VARCHAR)), count(*) FROM cvoe WHERE asm = '{ASSEMBLY}' GROUP BY accession""")
@of("cve", "cvoe")
def rs_dump(cve, cvoe):
    """K4, K5."""
    parts = [sinks.id_lines(rows).groupBy("line").agg(F.count("*").alias("n")).select(F.lit(n).alias("category"), "line", "n")
             for n, rows in (("active", release.dump_active(cve, ASSEMBLY)), ("events", release.dump_events(cvoe, ASSEMBLY)))]
    return parts[0].unionByName(parts[1])


@query("distinct_contigs", f"""WITH {EVENTS_SQL} SELECT DISTINCT 'active' AS category, contig FROM sve WHERE seq = '{ASSEMBLY}' AND tax = {TAX} UNION ALL SELECT DISTINCT 'merged', contig FROM cvoe WHERE asm = '{ASSEMBLY}' AND event = 'MERGED'
    UNION ALL SELECT DISTINCT 'deprecated', contig FROM cvoe WHERE asm = '{ASSEMBLY}' AND event = 'DEPRECATED' UNION ALL SELECT DISTINCT 'multimap', contig FROM cve WHERE asm = '{ASSEMBLY}' AND map_weight >= 2""")
@of("sve", "cve", "cvoe")
def distinct_contigs(sve, cve, cvoe):
    """A11."""
    parts = {
        "active": release.contigs_active(sve, ASSEMBLY, TAX), "merged": release.contigs_of_events(cvoe, ASSEMBLY, S.MERGED),
        "deprecated": release.contigs_of_events(cvoe, ASSEMBLY, S.DEPRECATED), "multimap": release.contigs_multimap(cve, ASSEMBLY),
    }
    out = None
    for n, rows in parts.items():
        rows = rows.select(F.lit(n).alias("category"), "contig")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("release_records", f"""WITH {CVE_SQL}, d AS (SELECT seq, rs, array_to_string(list(concat_ws(':', CAST(accession AS VARCHAR), ss_hash, study, ref, alt) ORDER BY accession, ss_hash, study, ref, alt), ' ') AS submissions
    FROM sve WHERE rs IS NOT NULL GROUP BY seq, rs) SELECT rs_hash, accession AS rs, submissions FROM cve LEFT JOIN d ON accession = rs AND asm = seq""")
@of("cve", "sve")
def release_records(cve, sve):
    """The denormalised release record, its nested part written out as text."""
    one = lambda x: F.concat_ws(":", x["accession"].cast("string"), *(x[n] for n in ("ss_hash", "study", "ref", "alt")))
    return release.records(cve, sve).select("rs_hash", "rs", F.array_join(F.transform("submissions", one), " ").alias("submissions"))


# --- contigs ----------------------------------------------------------------------------------------------------


@query("contig_synonyms", f"WITH {CONTIGS_SQL} SELECT name, sequence_name, assigned_molecule, genbank, refseq, ucsc, identical FROM by_name")
@of("contigs")
def contig_synonyms(contigs):
    """J8, A1."""
    return C.by_name(contigs).select("name", "sequence_name", "assigned_molecule", "genbank", "refseq", "ucsc", "identical")


@query("contig_renaming", f"""WITH {SVE_SQL}, {CONTIGS_SQL} SELECT contig, refseq_name, sequence_name, genbank_name, count(*) AS n FROM (SELECT s.contig, CASE WHEN coalesce(identical, false) THEN coalesce(refseq, s.contig) ELSE s.contig END AS refseq_name,
    coalesce(sequence_name, s.contig) AS sequence_name, CASE WHEN (coalesce(identical, false) OR refseq IS NULL) AND genbank IS NOT NULL THEN genbank ELSE s.contig END AS genbank_name
    FROM (SELECT concat('chr', CAST((start - 1) % 25 AS VARCHAR)) AS contig FROM sve) s LEFT JOIN by_name b ON s.contig = b.name) GROUP BY ALL""")
@of("sve", "contigs")
def contig_renaming(sve, contigs):
    """Rows under the sequence names of their contigs, all of which the report knows."""
    rows = sve.select(F.concat(F.lit("chr"), ((F.col("start") - 1) % 25).cast("string")).alias("contig"))
    rows = C.renamed(rows.withColumn("refseq_name", F.col("contig")), contigs, "REFSEQ", "refseq_name")
    rows = C.renamed(rows.withColumn("seq_name", F.col("contig")), contigs, "SEQUENCE_NAME", "seq_name").withColumnRenamed("seq_name", "sequence_name")
    plain = rows.select(F.col("contig"), "refseq_name", F.col("sequence_name").alias("sn"), F.col("contig").alias("genbank_name"))
    out = C.to_genbank(plain, contigs, "genbank_name", strict=False).withColumnRenamed("sn", "sequence_name")
    return out.groupBy("contig", "refseq_name", "sequence_name", "genbank_name").agg(F.count("*").alias("n"))


@query("contig_translation", f"""WITH {SVE_SQL}, {CONTIGS_SQL} SELECT coalesce(c.ucsc, s.contig) AS contig, count(*) AS n FROM sve s LEFT JOIN contigs c ON s.contig = c.genbank GROUP BY 1""")
@of("sve", "contigs")
def contig_translation(sve, contigs):
    """P19."""
    return C.translated(sve.select("contig"), C.normalized(contigs), "genbank", "ucsc").groupBy("contig").agg(F.count("*").alias("n"))


@query("contig_one_to_one", """WITH used AS (SELECT concat('c', CAST(l_partkey % 25 AS VARCHAR)) AS original, concat('g', CAST(l_partkey % 10 AS VARCHAR)) AS replaced FROM lineitem)
    SELECT original AS name, 'original' AS side, count(DISTINCT replaced) AS n_others FROM used GROUP BY original HAVING count(DISTINCT replaced) > 1
    UNION ALL SELECT replaced, 'replaced', count(DISTINCT original) FROM used GROUP BY replaced HAVING count(DISTINCT original) > 1""")
@of("lineitem")
def contig_one_to_one(lineitem):
    """R11."""
    return C.not_one_to_one(lineitem.selectExpr("concat('c', cast(l_partkey % 25 AS string)) AS original", "concat('g', cast(l_partkey % 10 AS string)) AS replaced"))


@query("contig_correction", f"""WITH {SVE_SQL} SELECT ss_hash AS old_hash, concat('GB_', contig) AS contig, upper(sha1(concat_ws('_', seq, study, concat('GB_', contig), CAST(start AS VARCHAR), ref, alt))) AS ss_hash, accession FROM sve""")
@of("sve")
def contig_correction(sve):
    """K12."""
    names = sve.select("contig").distinct().select(
        F.col("contig").alias("sequence_name"), F.lit(C.MOLECULE).alias("role"), F.lit("na").alias("assigned_molecule"), F.concat(F.lit("GB_"), "contig").alias("genbank"),
        F.lit("na").alias("refseq"), F.lit("na").alias("ucsc"), F.lit(True).alias("identical"),
    )
    return sinks.corrected_contigs(sve, names).select("old_hash", "contig", "ss_hash", "accession")


@query("context_base", f"""WITH {SVE_SQL} SELECT DISTINCT start, ref, alt, CASE WHEN start = 1 THEN 1 ELSE start - 1 END AS new_start, CASE WHEN start = 1 THEN concat(ref, base) ELSE concat(base, ref) END AS new_ref,
    CASE WHEN start = 1 THEN concat(alt, base) ELSE concat(base, alt) END AS new_alt FROM (SELECT *, substr('ACGTN', CAST(((CASE WHEN start = 1 THEN 1 ELSE start - 1 END) - 1) % 5 + 1 AS INT), 1) AS base FROM sve) WHERE ref = ''""")
@of("sve", "sequence")
def context_base(sve, sequence):
    """P11, C1."""
    rows = files.with_context(sve.where("ref = ''").select("contig", "start", "ref", "alt"), sequence)
    v = E.anchored("start", "ref", "alt", "context", "context")
    return rows.select("start", "ref", "alt", v["start"].alias("new_start"), v["ref"].alias("new_ref"), v["alt"].alias("new_alt")).distinct()


# --- texts ------------------------------------------------------------------------------------------------------

VCF_ROW = "concat_ws('\t', concat('chr', cast(l_partkey % 25 AS varchar(9))), cast(l_partkey + 1 AS varchar(9)), concat('ss', cast(l_orderkey AS varchar(9))), 'GA', CASE l_linenumber WHEN 1 THEN 'G' WHEN 2 THEN 'GA' WHEN 3 THEN 'T,GATC' WHEN 4 THEN '.' ELSE 'CC' END, '.', '.', concat('TAX=9913;PROJECT=P', cast(l_suppkey AS varchar(9)), CASE WHEN l_quantity > 25 THEN ';RS=rs7' ELSE '' END))"


@query("vcf_scan", """WITH v AS (SELECT l_partkey, l_orderkey, l_suppkey, unnest(string_split(CASE l_linenumber WHEN 1 THEN 'G' WHEN 2 THEN 'GA' WHEN 3 THEN 'T,GATC' WHEN 4 THEN '.' ELSE 'CC' END, ',')) AS alt FROM lineitem)
    SELECT concat('chr', CAST(l_partkey % 25 AS VARCHAR)) AS contig, CAST(l_partkey + 1 AS BIGINT) AS start, 'GA' AS ref, alt, concat('P', CAST(l_suppkey AS VARCHAR)) AS project, count(*) AS n
    FROM v WHERE alt NOT IN ('.', 'GA') GROUP BY ALL""")
@of("lineitem")
def vcf_scan(lineitem):
    """S1, S2, F10."""
    rows = files.vcf_aggregated(lineitem.selectExpr(f"{VCF_ROW} AS value"))
    return rows.groupBy("contig", "start", "ref", "alt", F.col("attributes")["PROJECT"].alias("project")).agg(F.count("*").alias("n"))


@query("vcf_accessioned_scan", """WITH v AS (SELECT l_partkey, l_orderkey, unnest(string_split(CASE l_linenumber WHEN 1 THEN 'G' WHEN 2 THEN 'GA' WHEN 3 THEN 'T,GATC' WHEN 4 THEN '.' ELSE 'CC' END, ',')) AS alt FROM lineitem)
    SELECT CAST(l_orderkey AS BIGINT) AS ss, CAST(l_partkey + CASE WHEN alt = 'G' THEN 2 ELSE 1 END AS BIGINT) AS start, CASE WHEN alt = 'G' THEN 'A' ELSE 'GA' END AS ref, CASE WHEN alt = 'G' THEN '' ELSE alt END AS alt, count(*) AS n
    FROM v WHERE alt NOT IN ('.', 'GA') GROUP BY ALL""")
@of("lineitem")
def vcf_accessioned_scan(lineitem):
    """S3, P8."""
    rows = remap.checked_report(files.vcf_accessioned(lineitem.selectExpr(f"{VCF_ROW} AS value")).withColumn("study", F.lit("s")))
    return rows.groupBy(F.col("accession").alias("ss"), "start", "ref", "alt").agg(F.count("*").alias("n"))


@query("vcf_remapped_scan", f"""WITH v AS (SELECT *, unnest(string_split(CASE l_linenumber WHEN 1 THEN 'G' WHEN 2 THEN 'GA' WHEN 3 THEN 'T,GATC' WHEN 4 THEN '.' ELSE 'CC' END, ',')) AS alt FROM lineitem)
    SELECT DISTINCT CAST(l_orderkey AS BIGINT) AS accession, CAST(CASE WHEN l_quantity > 25 THEN 7 END AS BIGINT) AS rs, upper(sha1(concat_ws('_', '{ASSEMBLY}', concat('P', CAST(l_suppkey AS VARCHAR)),
    concat('chr', CAST(l_partkey % 25 AS VARCHAR)), CAST(l_partkey + 1 AS VARCHAR), 'GA', alt))) AS ss_hash, '{REMAPPED_FROM}' AS remapped_from FROM v WHERE alt NOT IN ('.', 'GA')""")
@of("lineitem")
def vcf_remapped_scan(lineitem):
    """S4, P7."""
    rows = files.vcf_remapped(lineitem.selectExpr(f"{VCF_ROW} AS value"))
    return remap.remapped(rows, ASSEMBLY, REMAPPED_FROM, "run").select("accession", "rs", "ss_hash", "remapped_from").distinct()


DBSNP = """concat('{"refsnp_id":"', cast(o_orderkey AS varchar(9)), '","create_date":"2000-09-1T12:30Z","present_obs_movements":[{"last_added_to_this_rs":"', cast(o_custkey % 9 + 150 AS varchar(9)),
'"}],"primary_snapshot_data":{"variant_type":"', CASE o_orderkey % 3 WHEN 0 THEN 'snv' WHEN 1 THEN 'delins' ELSE 'identity' END, '","placements_with_allele":[{"is_ptlp":', CASE WHEN o_orderkey % 5 = 0 THEN 'false' ELSE 'true' END,
',"placement_annot":{"seq_id_traits_by_assembly":[{"assembly_accession":"GCF_', cast(o_orderkey % 2 AS varchar(9)), '"}]},"alleles":[{"allele":{"spdi":{"seq_id":"NC_1","position":', cast(o_custkey AS varchar(9)), '}}}]}]}}')"""


@query("dbsnp_import", f"""WITH r AS (SELECT CAST(o_orderkey AS BIGINT) AS accession, CAST(o_custkey + 1 AS BIGINT) AS start, CASE o_orderkey % 3 WHEN 0 THEN 'SNV' WHEN 1 THEN 'INDEL' ELSE 'NO_SEQUENCE_ALTERATION' END AS type
    FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 2 = 1 AND o_custkey % 9 + 150 > 152)
    SELECT accession, 'NC_1' AS contig, start, type, '2000-09-01 12:30:00' AS created, upper(sha1(concat_ws('_', 'GCA_1', 'NC_1', CAST(start AS VARCHAR), type))) AS rs_hash FROM r""")
@of("orders")
def dbsnp_import(orders):
    """Through a file that is compressed by bzip2."""
    rows = files.dbsnp_json(stored(orders.selectExpr(f"{DBSNP} AS value"), compression="bzip2"), "GCF_1", "GCA_1", newer_than=152)
    return rows.select("accession", "contig", "start", "type", text("created"), "rs_hash")


@query("event_properties", "SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n FROM events GROUP BY ALL")
@of("events")
def event_properties(events):
    """JSON paths over a log."""
    return events.groupBy("event_type", (F.get_json_object("props", "$.k").cast("long") % 10).alias("k")).agg(F.count("*").alias("n"))


@query("accession_report", f"""WITH {SVE_SQL}, r AS (SELECT contig, min(accession) AS contig_rank FROM sve GROUP BY contig)
    SELECT contig_rank, start, concat_ws('\t', contig, CAST(start AS VARCHAR), concat('ss', CAST(accession AS VARCHAR)), ref, alt, '.', '.', '.') AS line FROM sve JOIN r USING (contig)""")
@of("sve")
def accession_report(sve):
    """K1: contigs rank by their smallest id."""
    return sinks.accession_report(sve, "accession")


@query("duplicate_lines", f"""WITH {SVE_SQL} SELECT accession, count(*) AS n, concat(CAST(accession AS VARCHAR), ' {{"accession":', CAST(accession AS VARCHAR), ',"ss_hash":"', ss_hash, '"}}') AS line
    FROM sve WHERE accession IN (SELECT accession FROM sve GROUP BY accession HAVING count(*) > 1) GROUP BY accession, ss_hash""")
@of("sve")
def duplicate_lines(sve):
    """K8, A10."""
    rows = qc.rows_of_repeated(sve, ["accession"]).groupBy("accession", "ss_hash").agg(F.count("*").alias("n"))
    lines = rows.select("accession", "n", "ss_hash", F.to_json(F.struct("accession", "ss_hash")).alias("j"))
    return lines.select("accession", "n", F.concat_ws(" ", F.col("accession").cast("string"), "j").alias("line"))


# --- quality control --------------------------------------------------------------------------------------------


@query("dup_ss_qc", f"WITH {SVE_SQL} SELECT accession, count(*) AS n FROM sve GROUP BY accession HAVING count(*) > 1")
@of("sve")
def dup_ss_qc(sve):
    """A10."""
    return qc.repeated(sve, ["accession"])


@query("pending_merge_split", f"""WITH {SVE_SQL} SELECT 'merge' AS kind, seq, rs_hash AS key, count(DISTINCT rs) AS n FROM sve WHERE rs IS NOT NULL GROUP BY seq, rs_hash HAVING count(DISTINCT rs) > 1
    UNION ALL SELECT 'split', seq, CAST(rs AS VARCHAR), count(DISTINCT rs_hash) FROM sve WHERE rs IS NOT NULL GROUP BY seq, rs HAVING count(DISTINCT rs_hash) > 1""")
@of("sve")
def pending_merge_split(sve):
    """A12, A13."""
    return qc.pending_merges(sve).unionByName(qc.pending_splits(sve))


REPORTS = """rep AS (SELECT contig, start, CASE WHEN version = 2 AND validated THEN 'N' ELSE ref END AS ref, alt FROM sve), inp AS (SELECT contig, start, ref, CASE WHEN evidence IS NULL THEN 'N' ELSE alt END AS alt FROM sve)"""


def reports(sve: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two reports of all rows that differ in some alleles."""
    ref, alt = F.when((F.col("version") == 2) & F.col("validated"), "N").otherwise(F.col("ref")), F.when(F.col("evidence").isNull(), "N").otherwise(F.col("alt"))
    return sve.withColumn("ref", ref), sve.withColumn("alt", alt)


@query("report_diff", f"""WITH {SVE_SQL}, {REPORTS} SELECT *, 'report' AS side FROM (SELECT * FROM rep EXCEPT SELECT * FROM inp) UNION ALL SELECT *, 'input' FROM (SELECT * FROM inp EXCEPT SELECT * FROM rep)""")
@of("sve")
def report_diff(sve):
    """J14."""
    return qc.report_difference(*reports(sve), ["contig", "start", "ref", "alt"])


@query("report_status", f"""WITH {SVE_SQL}, {REPORTS}, a AS (SELECT count(*) AS only_report FROM (SELECT * FROM rep EXCEPT SELECT * FROM inp)), b AS (SELECT count(*) AS only_input FROM (SELECT * FROM inp EXCEPT SELECT * FROM rep)),
    c AS (SELECT (SELECT count(*) FROM rep) - (SELECT count(*) FROM (SELECT DISTINCT * FROM rep)) AS duplicates_report, (SELECT count(*) FROM inp) - (SELECT count(*) FROM (SELECT DISTINCT * FROM inp)) AS duplicates_input)
    SELECT *, CASE WHEN only_report + only_input > 0 THEN 'FAILED' ELSE 'COMPLETED' END AS status FROM a, b, c""")
@of("sve")
def report_status(sve):
    """L16, A14, H4."""
    return qc.report_status(*reports(sve), ["contig", "start", "ref", "alt"])


@query("missing_cve", f"""WITH {CVE_SQL}, r AS (SELECT DISTINCT rs, rs_hash FROM sve WHERE rs IS NOT NULL), x AS (SELECT DISTINCT accession, rs_hash FROM cve WHERE tax = {TAX})
    SELECT rs, rs_hash, CASE WHEN rs IN (SELECT accession FROM x) THEN 'mismatch' ELSE 'missing' END AS problem FROM r WHERE NOT EXISTS (SELECT 1 FROM x WHERE accession = rs AND x.rs_hash = r.rs_hash)""")
@of("sve", "cve")
def missing_cve(sve, cve):
    """J15, S15."""
    lines = sinks.rs_report_lines(sve.where("rs is not null").select("rs", "rs_hash").distinct())
    return qc.missing_clustered(files.rs_report(lines.withColumnRenamed("line", "value")), cve.where(F.col("tax") == TAX))


@query("extraneous_rs", f"WITH {CVE_SQL} SELECT DISTINCT asm, accession FROM cve WHERE (asm, accession) NOT IN (SELECT (seq, rs) FROM sve WHERE rs IS NOT NULL AND tax = {TAX})")
@of("cve", "sve")
def extraneous_rs(cve, sve):
    """J16."""
    return qc.extraneous(cve, sve.where(F.col("tax") == TAX)).select("asm", "accession").distinct()


@query("dup_rs_components", f"""WITH RECURSIVE {CVE_SQL}, many AS (SELECT accession FROM cve GROUP BY accession HAVING count(*) > 1),
    p AS (SELECT DISTINCT rs, concat_ws('_', seq, contig, CAST(start AS VARCHAR)) AS place, accession AS ss FROM sve WHERE rs IN (SELECT accession FROM many)),
    e AS (SELECT DISTINCT a.rs, a.place AS x, b.place AS y FROM p a JOIN (SELECT rs, ss, min(place) AS place FROM p GROUP BY rs, ss) b USING (rs, ss)), b2 AS (SELECT rs, x, y FROM e UNION SELECT rs, y, x FROM e),
    reach(rs, x, y) AS (SELECT rs, x, x FROM b2 UNION SELECT r.rs, r.x, b2.y FROM reach r JOIN b2 ON r.rs = b2.rs AND r.y = b2.x), l AS (SELECT rs, x, min(y) AS label FROM reach GROUP BY rs, x)
    SELECT rs, count(DISTINCT label) AS n_components FROM l GROUP BY rs HAVING count(DISTINCT label) > 1""")
@of("cve", "sve")
def dup_rs_components(cve, sve):
    """L14, G2, J18."""
    return qc.disconnected(cve, sve)


# --- lookups ----------------------------------------------------------------------------------------------------


@query("lookup_status", f"""WITH {EVENTS_SQL}, asked AS (SELECT DISTINCT accession FROM loci), e AS (SELECT DISTINCT ON (accession) accession, event, merge_into FROM cvoe
    ORDER BY accession, created DESC, concat_ws('_', event, asm, rs_hash, CAST(accession AS VARCHAR)) DESC)
    SELECT a.accession, CASE WHEN a.accession IN (SELECT accession FROM cve) THEN 'active' WHEN event = 'MERGED' THEN 'merged' WHEN event = 'DEPRECATED' THEN 'deprecated' WHEN event IS NOT NULL THEN 'empty' ELSE 'missing' END AS status,
    CASE WHEN event = 'MERGED' AND a.accession NOT IN (SELECT accession FROM cve) THEN merge_into END AS redirect FROM asked a LEFT JOIN e USING (accession)""")
@of("cve", "cvoe", "loci")
def lookup_status(cve, cvoe, loci):
    """Q1, Q4, Q9."""
    return lookup.status(cve, cvoe, loci.select("accession"))


@query("lookup_status_legacy", f"""WITH {EVENTS_SQL}, e AS (SELECT accession, min(CASE WHEN event = 'MERGED' THEN merge_into END) AS m, bool_or(event = 'DEPRECATED') AS d FROM cvoe GROUP BY accession)
    SELECT a.accession, CASE WHEN a.accession IN (SELECT accession FROM cve) THEN 'active' WHEN m IS NOT NULL THEN 'merged' WHEN d THEN 'deprecated' WHEN d IS NOT NULL THEN 'empty' ELSE 'missing' END AS status,
    CASE WHEN a.accession NOT IN (SELECT accession FROM cve) THEN m END AS redirect FROM (SELECT DISTINCT accession FROM loci) a LEFT JOIN e USING (accession)""")
@of("cve", "cvoe", "loci")
def lookup_status_legacy(cve, cvoe, loci):
    """Q1 of the legacy source."""
    return lookup.status(cve, cvoe, loci.select("accession"), legacy=True)


@query("lookup_by_accession", f"WITH {SVE_SQL} SELECT accession, seq, ss_hash FROM sve WHERE accession IN (SELECT {ASKED_IDS} FROM orders)")
@of("sve", "orders")
def lookup_by_accession(sve, orders):
    """Q1: asked for the first line of every order."""
    return lookup.by_accession(sve, orders.selectExpr(f"{ASKED_IDS} AS accession")).select("accession", "seq", "ss_hash")


@query("lookup_by_fields", f"WITH {SVE_SQL} SELECT accession, ss_hash FROM sve WHERE ss_hash IN (SELECT upper(sha1(concat_ws('_', seq, study, contig, CAST(start AS VARCHAR), ref, 'T'))) FROM sve)")
@of("sve")
def lookup_by_fields(sve):
    """Q2: asked for every place with T as alternate."""
    return lookup.by_fields(sve, sve.withColumn("alt", F.lit("T"))).select("accession", "ss_hash")


@query("lookup_clustered_by_fields", f"WITH {CVE_SQL} SELECT accession, rs_hash FROM cve WHERE rs_hash IN (SELECT upper(sha1(concat_ws('_', seq, contig, CAST(start AS VARCHAR), 'SNV'))) FROM sve)")
@of("sve", "cve")
def lookup_clustered_by_fields(sve, cve):
    """Q7: asked for every place as SNV."""
    return lookup.clustered_by_fields(cve, sve.withColumnRenamed("seq", "asm").withColumn("type", F.lit("SNV"))).select("accession", "rs_hash")


@query("beacon", f"""WITH {SVE_SQL}, a AS (SELECT DISTINCT seq, study, contig, start, ref, 'T' AS alt FROM sve)
    SELECT start, study, upper(sha1(concat_ws('_', seq, study, contig, CAST(start AS VARCHAR), ref, alt))) IN (SELECT ss_hash FROM sve) AS found, count(*) AS n FROM a GROUP BY ALL""")
@of("sve")
def beacon(sve):
    """Q3, F12."""
    asked = sve.select("seq", "study", "contig", "start", "ref", F.lit("T").alias("alt")).distinct()
    return lookup.beacon(sve, asked).groupBy("start", "study", F.col("exists").alias("found")).agg(F.count("*").alias("n"))


@query("clustered_beacon", f"""WITH {CVE_SQL}, a AS (SELECT DISTINCT rs_hash FROM sve), f AS (SELECT DISTINCT rs_hash, accession AS rs, asm FROM cve WHERE rs_hash IN (SELECT rs_hash FROM a)),
    g AS (SELECT f.rs_hash, study, array_to_string(list_sort(list(DISTINCT s.accession)), ',') AS ss_ids FROM f JOIN sve s ON f.rs = s.rs AND f.asm = s.seq GROUP BY f.rs_hash, study)
    SELECT a.rs_hash, a.rs_hash IN (SELECT rs_hash FROM f) AS found, study, ss_ids FROM a LEFT JOIN g USING (rs_hash)""")
@of("cve", "sve")
def clustered_beacon(cve, sve):
    """Q8, A16, J17."""
    return lookup.clustered_beacon(cve, sve, sve.withColumnRenamed("seq", "asm")).withColumnRenamed("exists", "found")


@query("rs_history", f"""WITH {EVENTS_SQL}, n AS (SELECT accession AS asked, * FROM cvoe UNION ALL SELECT merge_into, * FROM cvoe WHERE merge_into IS NOT NULL AND merge_into <> accession)
    SELECT asked, event, accession, merge_into, strftime(created, '%Y-%m-%d %H:%M:%S') AS created FROM n WHERE asked IN (SELECT accession FROM loci)""")
@of("cve", "cvoe", "loci")
def rs_history(cve, cvoe, loci):
    """Q5."""
    return lookup.history(cve, cvoe, loci).select("asked", "event", "accession", "merge_into", text("created"))


@query("rs_submissions", f"WITH {CVE_SQL} SELECT rs, accession, ss_hash FROM sve WHERE rs IN (SELECT accession FROM cve)")
@of("cve", "sve")
def rs_submissions(cve, sve):
    """Q6, R2."""
    return lookup.submissions(cve, sve, cve).select("rs", "accession", "ss_hash")


@query("last_inactive", f"""WITH {EVENTS_SQL} SELECT DISTINCT ON (accession) accession, event, rs_hash, contig, start FROM cvoe ORDER BY accession, created DESC, concat_ws('_', event, asm, rs_hash, CAST(accession AS VARCHAR)) DESC""")
@of("cvoe")
def last_inactive(cvoe):
    """R4."""
    return lookup.last_inactive(cvoe, cvoe).select("accession", "event", "row.rs_hash", "row.contig", "row.start")


@query("newest_version", f"WITH {SVE_SQL} SELECT DISTINCT ON (accession // 10) accession // 10 AS accession, version, ss_hash FROM sve ORDER BY accession // 10, version DESC, ss_hash DESC")
@of("sve")
def newest_version(sve):
    """Ids ten to one."""
    return lookup.newest(sve.withColumn("accession", F.floor(F.col("accession") / 10))).select("accession", "version", "ss_hash")


@query("with_inactive", f"""WITH {EVENTS_SQL} SELECT accession, rs_hash, true AS active FROM cve UNION ALL SELECT accession, rs_hash, false FROM cvoe""")
@of("cve", "cvoe", "loci")
def with_inactive(cve, cvoe, loci):
    """R7, R8."""
    return lookup.by_hash_with_inactive(cve, cvoe, loci).select("accession", "rs_hash", "active")


# --- files that are written and read again ----------------------------------------------------------------------


@query("id_list_scan", f"WITH {SVE_SQL} SELECT accession, ss_hash FROM sve WHERE seq = '{ASSEMBLY}' AND accession IN (SELECT {ASKED_IDS} FROM orders)")
@of("sve", "orders")
def id_list_scan(sve, orders):
    """S12, S14."""
    lines = orders.selectExpr("concat(' ', CASE o_orderkey % 3 WHEN 0 THEN 'ss' WHEN 1 THEN 'rs' ELSE '' END, cast(o_orderkey * 10 + 1 AS string), ' a note\\n') AS value")
    return scans.by_ids(sve, files.id_list(stored(lines)), ASSEMBLY).select("accession", "ss_hash")


@query("vcf_ids", f"WITH {SVE_SQL} SELECT accession FROM sve WHERE seq = '{ASSEMBLY}'")
@of("sve")
def vcf_ids(sve):
    """S13, K7."""
    return files.ss_ids_of_vcf(stored(sinks.export_lines(sve.where(F.col("seq") == ASSEMBLY)).select(F.col("line").alias("value"))))


@query("assembly_report_scan", f"WITH {CONTIGS_SQL} SELECT sequence_name, role, assigned_molecule, genbank, refseq, ucsc, identical FROM contigs0")
@of("contigs")
def assembly_report_scan(contigs):
    """S18."""
    same = F.when(F.col("identical"), "=").otherwise("<>")
    line = F.concat_ws("\t", "sequence_name", "role", "assigned_molecule", F.lit("Chromosome"), "genbank", same, "refseq", F.lit("Primary"), F.lit("100"), "ucsc")
    return files.assembly_report(stored(contigs.select(F.concat(F.lit("# a comment\n"), line, F.lit("\n")).alias("value"))))


FASTA_SIZE, FASTA_FIRST = "(61 + s_suppkey % 90)", "(s_suppkey % 5)"


@query("fasta_bases", """SELECT l_suppkey AS supplier, l_linenumber AS line, CASE WHEN l_linenumber * 25 <= 61 + l_suppkey % 90 THEN substr('ACGTN', CAST((l_suppkey % 5 + l_linenumber * 25 - 1) % 5 + 1 AS INT), 1) END AS base, count(*) AS n
    FROM lineitem GROUP BY ALL""")
@of("lineitem", "supplier")
def fasta_bases(lineitem, supplier):
    """A contig for each supplier, in lines of 60 bases."""
    bases = f"substr(repeat('ACGTN', 40), cast({FASTA_FIRST} + 1 AS int), cast({FASTA_SIZE} AS int))"
    lines = supplier.selectExpr(f"concat('>S', cast(s_suppkey AS string), ' a contig\\n', substr({bases}, 1, 60), '\\n', substr({bases}, 61)) AS value")
    path = f"{shared_dir(supplier.sparkSession)}/{uuid.uuid4().hex}"
    stored(lines, path)
    sequence = files.fasta(files.fasta_lines(supplier.sparkSession, path), chunk=50)
    rows = lineitem.select(F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").alias("line"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("contig"))
    return files.base_at(rows, sequence, F.col("line").cast("long") * 25, "base", chunk=50).groupBy("supplier", "line", "base").agg(F.count("*").alias("n"))


@query("fasta_synonyms", f"""WITH {SVE_SQL}, {CONTIGS_SQL} SELECT s.contig, CASE WHEN identical AND genbank IS NOT NULL THEN genbank ELSE s.contig END AS fasta_contig, count(*) AS n
    FROM (SELECT concat('chr', CAST((start - 1) % 25 AS VARCHAR)) AS contig FROM sve) s LEFT JOIN by_name b ON s.contig = b.name GROUP BY ALL""")
@of("sve", "sequence", "contigs")
def fasta_synonyms(sve, sequence, contigs):
    """S20."""
    rows = sve.select(F.concat(F.lit("chr"), ((F.col("start") - 1) % 25).cast("string")).alias("contig"))
    return files.through_synonyms(rows, sequence, contigs).groupBy("contig", "fasta_contig").agg(F.count("*").alias("n"))


HEAD = sinks.header_lines(sinks.RELEASE_INFO, ASSEMBLY, "Assembly 1", "https://example.org/1")
HEAD_SQL = " UNION ALL ".join("SELECT '" + x.replace("'", "''") + "' AS value" for x in [*HEAD, "\t".join(sinks.VCF_FIELDS)])


@query("report_file", f"""{SQL["release_report"].replace("SELECT contig, start, concat_ws", "SELECT concat_ws").replace(" AS line FROM v", " AS value FROM v")} UNION ALL {HEAD_SQL}
    UNION ALL SELECT DISTINCT concat('##contig=<ID=', contig, '>') FROM act""")
@of("cve", "sve", "sequence")
def report_file(cve, sve, sequence):
    """The whole release report, header and body, as a file under its name."""
    spark = cve.sparkSession
    body = release.report(release.active(cve, sve, ASSEMBLY, TAX), sequence)
    names = body.select("contig").distinct().withColumn("contig_rank", F.row_number().over(Window.orderBy("contig")))
    whole = sinks.assembled(sinks.header(body, sinks.RELEASE_INFO, ASSEMBLY, "Assembly 1", "https://example.org/1"), body.join(names, "contig"))
    return stored(whole.select(F.col("line").alias("value")), release.report_path(f"{shared_dir(spark)}/{uuid.uuid4().hex}", ASSEMBLY, "current"))


@query("assembly_names", """WITH names AS (SELECT concat('GCA_', CAST(n_regionkey AS VARCHAR)) AS asm, n_name AS name, n_nationkey % 4 = 1 AS curated FROM nation)
    SELECT concat('GCA_', CAST(s_nationkey % 7 AS VARCHAR)) AS asm, (SELECT name FROM names n WHERE n.asm = concat('GCA_', CAST(s_nationkey % 7 AS VARCHAR)) ORDER BY NOT curated, name LIMIT 1) AS assembly_name, s_suppkey AS supplier FROM supplier""")
@of("supplier", "nation")
def assembly_names(supplier, nation):
    """R12."""
    names = nation.selectExpr("concat('GCA_', cast(n_regionkey AS string)) AS accession", "n_name AS name", "n_nationkey % 4 = 1 AS curated")
    rows = supplier.selectExpr("concat('GCA_', cast(s_nationkey % 7 AS string)) AS asm", "s_suppkey AS supplier")
    return release.assembly_name(rows, names).select("asm", "assembly_name", "supplier")


@query("contig_list", f"WITH {CONTIGS_SQL} SELECT concat(ucsc, ',', sequence_name) AS line FROM contigs")
@of("contigs")
def contig_list(contigs):
    """K6."""
    return sinks.contig_lines(C.normalized(contigs).select(F.col("ucsc").alias("contig")), contigs)


def run_columns(key: str, nation: str) -> list[str]:
    """A remapping run as a projection that both engines read."""
    version, accessioning = f"concat('v', cast({key}key % 7 AS varchar(9)))", f"concat('a', cast({nation} AS varchar(9)))"
    return [f"{version} AS remapping_version", f"{accessioning} AS accessioning_version", "'GCA_0' AS source", "'GCA_1' AS target"]


@query("remapping_runs", f"""WITH s AS (SELECT {', '.join(run_columns('s_supp', 's_nationkey'))} FROM supplier), n AS (SELECT {', '.join(run_columns('n_nation', 'n_nationkey'))} FROM nation)
    SELECT DISTINCT upper(sha1(concat_ws('_', remapping_version, accessioning_version, source, target))) AS remapping_id, remapping_version, accessioning_version FROM (SELECT * FROM s EXCEPT SELECT * FROM n)""")
@of("supplier", "nation")
def remapping_runs(supplier, nation):
    """Runs of suppliers are stored unless nations have stored them."""
    key = E.remapping_id("remapping_version", "accessioning_version", "source", "target")
    runs, have = supplier.selectExpr(*run_columns("s_supp", "s_nationkey")), nation.selectExpr(*run_columns("n_nation", "n_nationkey"))
    return sinks.appendable(runs.withColumn("remapping_id", key), have.withColumn("remapping_id", key), "remapping_id").select("remapping_id", "remapping_version", "accessioning_version")


@query("alleles_upper", "SELECT upper(concat(lower(l_returnflag), 'n', l_linestatus)) AS allele, count(*) AS n FROM lineitem GROUP BY 1")
@of("lineitem")
def alleles_upper(lineitem):
    """P4."""
    return lineitem.select(E.alleles_upper(F.concat(F.lower("l_returnflag"), F.lit("n"), "l_linestatus")).alias("allele")).groupBy("allele").agg(F.count("*").alias("n"))


@query("submitted_from_vcf", f"""WITH v AS (SELECT *, unnest(string_split(CASE l_linenumber WHEN 1 THEN 'G' WHEN 2 THEN 'GA' WHEN 3 THEN 'T,GATC' WHEN 4 THEN '.' ELSE 'CC' END, ',')) AS alt FROM lineitem)
    SELECT concat('chr', CAST(l_partkey % 25 AS VARCHAR)) AS contig, CAST(l_partkey + 1 AS BIGINT) AS start, 'GA' AS ref, alt, upper(sha1(concat_ws('_', '{ASSEMBLY}', 'PRJ', concat('chr', CAST(l_partkey % 25 AS VARCHAR)),
    CAST(l_partkey + 1 AS VARCHAR), 'GA', alt))) AS ss_hash, {TAX} AS tax, true AS evidence, false AS validated, CAST(NULL AS BIGINT) AS rs FROM v WHERE alt NOT IN ('.', 'GA')""")
@of("lineitem")
def submitted_from_vcf(lineitem):
    """Through a file."""
    rows = remap.submitted(files.vcf(stored(lineitem.selectExpr(f"{VCF_ROW} AS value"))), ASSEMBLY, TAX, "PRJ")
    return rows.select("contig", "start", "ref", "alt", "ss_hash", "tax", "evidence", "validated", "rs")


@query("version_of", f"WITH {SVE_SQL} SELECT accession, version, ss_hash FROM sve WHERE accession IN (SELECT {ASKED_IDS} FROM orders) AND version = 2")
@of("sve", "orders")
def version_of(sve, orders):
    """The second version of the first line of every order."""
    return lookup.of_version(sve, orders.selectExpr(f"{ASKED_IDS} AS accession", "2 AS version")).select("accession", "version", "ss_hash")


@query("patched_versions", f"""WITH {SVE_SQL}, last AS (SELECT DISTINCT ON (accession) accession, version, ss_hash FROM sve ORDER BY accession, version DESC, ss_hash DESC)
    SELECT accession, version, ss_hash, study FROM sve UNION ALL SELECT accession, version + 1, ss_hash, 'PATCHED' FROM last""")
@of("sve")
def patched_versions(sve):
    """Every id gets a version with another study."""
    rows = sve.select("accession", "version", "ss_hash", "study")
    return lookup.patched(rows, sve.select("accession", F.lit("PATCHED").alias("study")).distinct()).select("accession", "version", "ss_hash", "study")


@query("merge_routing", f"WITH {EVENTS_SQL} SELECT DISTINCT accession, merge_into, (accession >= 3000000400) = (merge_into >= 3000000400) AS allowed FROM cvoe WHERE event = 'MERGED'")
@of("cvoe")
def merge_routing(cvoe):
    """R6."""
    return cvoe.where("event = 'MERGED'").select("accession", "merge_into", lookup.merge_allowed("accession", "merge_into", 3_000_000_400).alias("allowed")).distinct()


@query("inactive_rows", f"WITH {EVENTS_SQL} SELECT rs_hash, accession, asm, contig, start, type, validated, map_weight FROM cvoe")
@of("cvoe")
def inactive_rows(cvoe):
    """R14."""
    return sinks.flattened(cvoe, "inactive").select("rs_hash", "accession", "asm", "contig", "start", "type", "validated", "map_weight")


@query("insert_conflicts", f"WITH {CVE_SQL} SELECT DISTINCT rs_hash FROM sve WHERE rs_hash IN (SELECT rs_hash FROM cve)")
@of("sve", "cve")
def insert_conflicts(sve, cve):
    """R15, K10."""
    return sinks.conflicts(sve, cve, "rs_hash")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
