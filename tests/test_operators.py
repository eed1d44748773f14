"""The lifecycle of identifiers on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from locusmill.functions import expr as E
from locusmill.operators import accession, cluster, deprecate, graph, imports, lookup, qc, release, remap
from locusmill.plans import jobs
from locusmill.sources import scans

ASM, OLD = "GCA_1.1", "GCA_0.1"
FIELDS = (
    "accession long, rs long, start long, seq string, study string, contig string, ref string, alt string, tax int, evidence boolean, asm_match boolean, alleles_match boolean, "
    "validated boolean, map_weight int, remapped_from string, created string, back_prop_rs long, version int, source string"
)
DEFAULTS = dict(seq=ASM, study="P1", contig="c1", ref="A", alt="C", tax=9913, evidence=None, asm_match=None, alleles_match=None, validated=None, map_weight=None, remapped_from=None,
                created="2020-01-01 00:00:00", back_prop_rs=None, version=1, source="current")


def sve(spark, *rows):
    """rows: (accession, rs, start) or with a dict of other fields."""
    made = []
    for r in rows:
        d = DEFAULTS | dict(zip(("accession", "rs", "start"), r)) | (r[3] if len(r) > 3 else {})
        made.append(tuple(d[f.split()[0]] for f in FIELDS.split(", ")))
    df = spark.createDataFrame(made, FIELDS).withColumn("created", F.col("created").cast("timestamp_ntz")).withColumn("type", E.variant_type())
    return df.withColumns({"ss_hash": E.ss_hash(), "rs_hash": E.rs_hash()})


def cve(spark, *rows):
    base = sve(spark, *((a, a, s, *more) for a, s, *more in rows))
    return base.select("rs_hash", F.col("rs").alias("accession"), F.col("seq").alias("asm"), "tax", "contig", "start", "type", "validated", "map_weight", "created", "version", "source")


def pairs(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_block_ids(spark):
    got = [r[0] for r in spark.range(22).select(accession.block_id(F.col("id"), 500, 10)).collect()]
    assert got == [*range(500, 510), *range(520, 530), 540, 541]


def test_get_or_create(spark):
    want = spark.createDataFrame([(x,) for x in "abcab"], "h string")
    known = spark.createDataFrame([("a", 7, "current"), ("a", 9, "legacy"), ("z", 1, "legacy")], "h string, accession long, source string")
    got = accession.get_or_create(want, known, "h", 100, 10)
    assert pairs(got, "h", "accession", "is_new") == [("a", 9, False), ("b", 100, True), ("c", 101, True)]
    again = accession.get_or_create(want, got.select("h", "accession", F.lit("current").alias("source")), "h", 500, 10)
    assert again.where("is_new").count() == 0
    assert accession.missing(want, got, "h").count() == 0


def test_ranks_are_dense_and_ordered(spark):
    df = spark.range(1000).select(F.sha1(F.col("id").cast("string")).alias("h"))
    got = [r.n for r in accession.ranked(df, "h").orderBy("h").collect()]
    assert got == list(range(1000))


def test_merge_of_all_loci(spark):
    rows = sve(spark, (1, 1, 100), (4, 4, 100, {"alt": "G"}), (2, 2, 103), (5, 5, 103, {"alt": "G"}), (6, 4, 104), (7, 4, 105), (8, 2, 106), (9, 5, 107))
    after, updates, merges = cluster.merge(rows)
    assert pairs(after, "accession", "rs") == [(1, 1), (2, 2), (4, 1), (5, 2), (6, 1), (7, 1), (8, 2), (9, 2)]
    assert pairs(merges, "accession", "merge_into") == [(4, 1), (5, 2)]
    assert "Original rs4 associated with SS was merged into rs1." in {r.reason for r in updates.collect()}
    assert cluster.merge(after)[2].count() == 0


def test_merge_over_several_levels(spark):
    rows = sve(spark, (1, 1, 100), (2, 2, 100, {"alt": "G"}), (3, 2, 103), (4, 3, 103, {"alt": "G"}), (9, 3, 500, {"seq": "other"}))
    after, _, merges = cluster.merge(rows)
    assert pairs(after.where(F.col("seq") == ASM), "rs") == [(1,)] * 4 and pairs(merges, "accession", "merge_into") == [(2, 1), (3, 1)]
    assert pairs(after.where("seq = 'other'"), "rs") == [(3,)]


def test_ties_of_splits_go_by_summary(spark):
    """Equal support and the same oldest submission: the first of the texts that the hashes are made of keeps the id, whatever the hashes."""
    rows = sve(spark, *((1, 5, at) for at in (100, 20, 3, 1000)))
    kept = cluster.split_ranks(rows).where("keeps").join(rows, "rs_hash").select("start").distinct().collect()
    assert [r.start for r in kept] == [1000]  # ..._c1_1000_SNV comes before ..._c1_100_SNV, as digits come before the underscore
    twice = sve(spark, *((7, None, 50, {"contig": c, "evidence": e}) for c, e in (("c9", True), ("c10", True), ("c2", True), ("c1", False))))
    assert [r.contig for r in cluster.duplicate_ss_ranks(twice).where("keeps").collect()] == ["c10"]


def test_split_by_support(spark):
    rows = sve(spark, (1, 5, 100), (2, 5, 101), (3, 5, 101, {"alt": "G"}), (4, 5, 102))
    after, events, created = cluster.split(rows, 900, 10)
    by = dict(pairs(after, "accession", "rs"))
    assert by[2] == by[3] == 5 and {by[1], by[4]} == {900, 901} and events.count() == 2 and created.count() == 2
    assert cluster.split(after, 950, 10)[1].count() == 0


def test_split_tie_goes_to_the_oldest(spark):
    rows = sve(spark, *((i, 5, 100 + (i - 1) // 2, {"alt": "G" if i % 2 else "T"}) for i in range(1, 7)))
    by = dict(pairs(cluster.split(rows, 900, 10)[0], "accession", "rs"))
    assert by[1] == by[2] == 5 and by[3] == by[4] != 5 and by[5] == by[6] != 5 and by[3] != by[5]


def test_keeper_gets_a_row_where_its_hash_has_none(spark):
    rows = sve(spark, (1, 5, 100), (2, 5, 101), (3, 5, 101, {"alt": "G"}), (4, 6, 101), (5, 6, 300), (6, 7, 400))
    assert pairs(cluster.keeper_rows(rows, cve(spark, (5, 100))), "rs", "seq") == [(5, ASM)]  # 6 keeps the same hash
    assert cluster.keeper_rows(rows, cve(spark, (8, 101))).count() == 0  # whatever RS the hash has
    job = jobs.cluster_assembly(sve(spark, (1, 5, 100), (2, 5, 101), (3, 5, 101, {"alt": "G"})), cve(spark, (5, 100)), ASM, 900, 10)
    assert pairs(job.created, "rs") == [(5,), (900,)]


def test_counters(spark):
    rows = sve(spark, (1, 5, 100), (2, 6, 100), (3, None, 200), (4, None, 300))
    assert tuple(accession.counts(rows, rows.where("start < 300"), "ss_hash").first()) == (4, 2, 3, 1, 1)
    assert tuple(accession.counts(rows.limit(0), rows, "ss_hash").first()) == (0, 0, 0, 0, 0)
    assert cluster.metrics(rows, rows).first().n_kept_unclustered == 2
    rs = spark.createDataFrame([("MERGED",), ("MERGED",), ("RS_SPLIT",), ("DEPRECATED",), (None,)], "event string")
    ss = spark.createDataFrame([("UPDATED",), ("DEPRECATED",), ("SS_SPLIT",), ("MERGED",), ("DISCARDED",)], "event string")
    assert cluster.operation_counts(rs, ss).first().asDict() == dict(n_rs_split=1, n_merge_operations=2, n_rs_deprecated=1, n_update_operations=1, n_ss_split=1, n_ss_deprecated=1)


def test_duplicate_ss(spark):
    rows = sve(spark, (1, None, 100), (1, 7, 101), (1, 7, 102, {"remapped_from": OLD}), (2, None, 5, {"evidence": False}), (2, None, 6), (3, 1, 1), (4, 1, 1, {"map_weight": 2}), (4, 1, 2, {"map_weight": 2}))
    got = pairs(cluster.duplicate_ss_ranks(rows), "accession", "start", "keeps")
    assert got == [(1, 100, False), (1, 101, True), (2, 5, False), (2, 6, True)]
    assert [r.id for r in cluster.split_duplicate_ss(rows, 50, 10).orderBy("accession").collect()][0].startswith("SS_SPLIT_FROM_1_TO_5")


def test_assign_and_back_propagate(spark):
    rows = sve(spark, (1, None, 100), (2, None, 200), (3, None, 300, {"map_weight": 3}))
    stored = cve(spark, (50, 100), (40, 100), (60, 200, {"map_weight": 2}), (70, 300))
    assert pairs(cluster.assign(rows, stored), "accession", "rs") == [(1, 40)]
    old = sve(spark, (1, 8, 5, {"seq": OLD}), (2, 9, 6, {"seq": OLD}), (3, 8, 7, {"seq": OLD, "alleles_match": False}))
    new = sve(spark, (1, 10, 5), (1, 12, 6), (2, 9, 7), (3, 12, 8))
    assert pairs(cluster.back_propagate(old, new), "accession", "back_prop_rs") == [(1, 12)]


def test_classify(spark):
    rows = sve(spark, (1, 5, 100), (2, 6, 100, {"alt": "G"}), (3, 5, 200), (4, 7, 300), (5, 8, 400))
    got = dict(pairs(cluster.classify(rows, cve(spark, (8, 400))), "accession", "kind"))
    assert got == {1: "split", 2: "merge", 3: "split", 4: "new", 5: "same"}


def test_job_is_idempotent(spark):
    rows = sve(spark, (1, 1, 100), (2, 2, 100, {"alt": "G"}), (3, 2, 103), (4, None, 103, {"alt": "G"}), (5, None, 400), (6, 9, 1), (7, 9, 2))
    stored = cve(spark, (1, 100), (2, 103), (9, 1))
    first = jobs.cluster_assembly(rows, stored, ASM, 900, 10)
    assert first.submitted.where("rs is null").count() == 0
    more = stored.select("rs_hash", "accession", "map_weight").unionByName(first.created.select("rs_hash", F.col("rs").alias("accession"), F.lit(None).cast("int").alias("map_weight")))
    again = jobs.cluster_assembly(graph.cut(first.submitted), more, ASM, 2000, 10)
    assert again.merges.count() == again.splits.count() == again.created.count() == 0


def test_discards(spark):
    stored = sve(spark, (1, 5, 100), (2, 5, 200), (3, 5, 300, {"remapped_from": OLD}))
    new = sve(spark, (1, 5, 150, {"remapped_from": OLD}), (9, 5, 200, {"remapped_from": OLD}), (3, 5, 300, {"remapped_from": OLD, "created": "2021-01-01 00:00:00"}), (7, 5, 700, {"remapped_from": OLD}))
    insert, lost, skipped = remap.ingest(new, stored)
    assert pairs(insert, "accession", "start") == [(7, 700)]
    assert pairs(lost, "accession", "start") == [(1, 150), (9, 200)] and pairs(skipped, "accession") == [(3,)]
    assert tuple(remap.ingest_counts(new, insert, lost).first()) == (1, 2, 1)
    assert remap.discard_events(lost).where("id like 'DISCARD_SS_9_HASH_%'").count() == 1
    twice = remap.ingest(new.where("accession = 7").unionByName(new.where("accession = 7")), stored)
    assert twice[0].count() == 1 and remap.ingest(new.where("accession = 7"), stored.unionByName(twice[0]))[0].count() == 0


def test_source_dates(spark):
    new = sve(spark, (1, None, 5), (2, None, 6))
    old = sve(spark, (1, None, 7, {"created": "2010-01-01 00:00:00"}), (1, None, 8, {"created": "2009-01-01 00:00:00"}))
    assert [(r[0], str(r[1])[:4]) for r in pairs(remap.source_dates(new, old), "accession", "created")] == [(1, "2009"), (2, "2020")]


def test_deprecation(spark):
    rows = sve(spark, (1, 5, 100, {"study": "X"}), (2, 5, 100, {"alt": "G"}), (3, 6, 200, {"study": "X"}), (4, None, 300, {"study": "X", "source": "legacy"}))
    alive, kept, ss, rs = jobs.deprecate_study(rows, cve(spark, (5, 100), (6, 200)), ASM, "X", "s", "why")
    assert pairs(alive, "accession") == [(2,), (4,)] and pairs(kept, "accession") == [(5,)] and pairs(rs, "accession") == [(6,)] and ss.count() == 2
    ids = spark.createDataFrame([("2",), ("",)], "value string")
    assert pairs(jobs.deprecate_ids(rows, cve(spark, (5, 100)), ids, ASM, "s", "why")[2], "accession") == [(2,)]
    assert deprecate.deprecate(alive, kept, alive.limit(0), "s", "why")[2].count() == 0


def test_import(spark):
    stored = cve(spark, (10, 100))
    insert, merges = imports.import_clustered(cve(spark, (20, 100), (30, 200), (31, 200), (40, 200)), stored, spark.createDataFrame([(40, 30)], "accession long, merge_into long"))
    assert pairs(insert, "accession") == [(30,)] and pairs(merges, "accession", "merge_into") == [(20, 10), (31, 30)]


def test_duplicate_rs_graph(spark):
    chain = sve(spark, (1, 5, 10), (1, 5, 20), (2, 5, 20), (2, 5, 30))
    apart = sve(spark, (1, 6, 10), (2, 6, 20))
    both = chain.unionByName(apart)
    assert pairs(qc.disconnected(cve(spark, (5, 10), (5, 20), (6, 10), (6, 20)), both), "rs", "n_components") == [(6, 2)]


def test_components_against_brute_force(spark):
    import random

    rng = random.Random(3)
    edges = [(rng.randrange(3), rng.randrange(60), rng.randrange(60)) for _ in range(110)] + [(9, i, i + 1) for i in range(40)] + [(8, 0, i) for i in range(50)]
    got = {(r.k, r.node): r.label for r in graph.components(spark.createDataFrame(edges, "k long, a long, b long"), ["k"], "a", "b").collect()}
    want = {(k, x): x for k, a, b in edges for x in (a, b)}
    for _ in range(80):
        for k, a, b in edges:
            want[k, a] = want[k, b] = min(want[k, a], want[k, b])
    assert got == want


def events(spark, *rows):
    """rows: (event, accession, merge_into, start) on ASM."""
    base = cve(spark, *((a, s) for _, a, _, s in rows)).withColumnRenamed("accession", "acc")
    inactive = base.select("acc", "start", F.array(F.struct("rs_hash", F.col("acc").alias("accession"), "asm", "tax", "contig", "start", "type", "validated", "map_weight", "created")).alias("inactive")).distinct()
    log = spark.createDataFrame([(f"{i}", e, a, m, s) for i, (e, a, m, s) in enumerate(rows)], "id string, event string, acc long, merge_into long, start long")
    log = log.join(inactive, ["acc", "start"]).withColumn("created", F.timestamp_add("day", F.col("id").cast("int"), F.lit("2020-01-01").cast("timestamp_ntz")))
    return log.select("id", "event", F.col("acc").alias("accession"), "merge_into", F.lit(None).cast("long").alias("split_into"), F.lit("").alias("reason"), "created", F.lit("current").alias("source"), "inactive")


def test_merge_chains(spark):
    log = events(spark, ("MERGED", 1, 2, 10), ("MERGED", 2, 3, 20), ("MERGED", 4, 5, 40), ("DEPRECATED", 5, None, 50), ("MERGED", 6, 7, 60), ("MERGED", 7, 6, 70), ("MERGED", 3, 9, 30))
    got = pairs(release.chains(log, cve(spark, (3, 30)), ASM), "rs", "status", "target", "via")
    assert got == [(1, "merged", 3, 2), (2, "merged", 3, 2), (4, "deprecated", None, None), (5, "deprecated", None, None), (6, "undetermined", None, None), (7, "undetermined", None, None)]


def ss_events(spark, rows, reason):
    names = [f.split()[0] for f in FIELDS.split(", ")] + ["type", "ss_hash", "rs_hash"]
    return rows.select(F.col("ss_hash").alias("id"), F.lit("UPDATED").alias("event"), "accession", F.lit(None).cast("long").alias("merge_into"), F.lit(None).cast("long").alias("split_into"),
                       F.lit(reason).alias("reason"), "created", "source", F.array(F.struct(*names)).alias("inactive"))


def test_merged_release(spark):
    log = events(spark, ("MERGED", 1, 3, 10), ("MERGED", 2, 3, 20))
    ss = ss_events(spark, sve(spark, (11, 1, 10), (12, 1, 99)), "Original rs1 associated with SS was merged into rs3.").unionByName(ss_events(spark, sve(spark, (13, 2, 20)), "Declustered: x"))
    got = release.merged(log, ss, cve(spark, (3, 30)), ASM, 9913)
    assert pairs(got, "rs", "start", "curr", "vc") == [(1, 10, "3", "SO:0001483")]
    assert release.merged(log, ss, cve(spark, (3, 30)), ASM, 1).count() == 0
    assert pairs(release.deprecated(events(spark, ("DEPRECATED", 1, None, 10)), ss, ASM, 9913), "rs") == [(1,)]
    assert pairs(release.merged_deprecated(log, ss, sve(spark, (1, 8, 1)), ASM, 9913), "rs", "merge_into") == [(1, 3), (2, 3)]
    assert release.merged_deprecated(log, ss, sve(spark, (1, 3, 1)), ASM, 9913).count() == 0


def test_active_release_flags(spark):
    ss = sve(
        spark, (1, 5, 100, {"remapped_from": OLD, "evidence": False, "study": "a;b"}), (2, 5, 100, {"validated": True, "study": "P2", "asm_match": False}), (3, 5, 101), (4, 6, 201, {"ref": "", "alt": "T"}),
        (5, 7, 300, {"remapped_from": OLD, "evidence": False}), (6, 8, 400, {"tax": 1}),
    )
    rs = cve(spark, (5, 100), (6, 200, {"ref": "", "alt": "A"}), (7, 300), (8, 400), (9, 500))
    got = {r.rs: r for r in release.active(rs, ss, ASM, 9913).collect()}
    assert set(got) == {5, 6, 7} and got[6].start == 201
    assert (got[5].sid, got[5].ss_validated, got[5].almm, got[5].asmm, got[5].remapped, got[5].loe) == ("P2,a_b", 1, False, True, False, False)
    assert got[7].remapped and got[7].loe
    seq = spark.createDataFrame([("c1", 0, "ACGT" * 250)], "contig string, chunk_no long, bases string")
    lines = [r.line for r in jobs.release_current(rs, ss, seq, none(spark), ASM, 9913).collect()]
    assert lines[0].startswith("##fileformat") and [x.split("\t")[1] for x in lines if x[0] != "#"] == ["100", "200", "300"]
    assert lines[-1].endswith("VC=SO:0001483;SID=P1;SS_VALIDATED=0;LOE;REMAPPED")


def none(spark):
    return spark.createDataFrame([], "sequence_name string, role string, assigned_molecule string, genbank string, refseq string, ucsc string, identical boolean")


def test_multimap_release(spark):
    rs = cve(spark, (5, 100, {"map_weight": 3}), (6, 100, {"contig": "c2"}))
    ss = sve(spark, (1, 5, 100, {"seq": "elsewhere"}), (2, 5, 100, {"source": "legacy"}))
    assert pairs(release.multimap(rs, ss, ASM), "rs", "map_weight") == [(5, 3)]
    assert pairs(release.contigs_multimap(rs, ASM), "contig") == [("c1",)]


def test_lookups(spark):
    log = events(spark, ("MERGED", 1, 3, 10), ("DEPRECATED", 2, None, 20), ("UPDATED", 4, None, 40), ("DEPRECATED", 1, None, 10))
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5)], "accession long")
    rs = cve(spark, (3, 30))
    assert pairs(lookup.status(rs, log, ids), "accession", "status") == [(1, "deprecated"), (2, "deprecated"), (3, "active"), (4, "empty"), (5, "missing")]
    assert pairs(lookup.status(rs, log, ids, legacy=True).where("accession < 3"), "accession", "status", "redirect") == [(1, "merged", 3), (2, "deprecated", None)]
    assert [r.event for r in lookup.history(rs, log, ids.where("accession = 3")).collect()] == ["MERGED"]
    assert lookup.with_inactive(rs, log, ids.where("accession in (1, 3)")).where("active").count() == 1
    ss = sve(spark, (7, 3, 30), (8, None, 30))
    assert pairs(lookup.submissions(rs, ss, ids), "accession") == [(7,)]
    asked = ss.select("seq", "study", "contig", "start", "ref", "alt").distinct()
    assert lookup.beacon(ss, asked).first()["exists"] and lookup.by_fields(ss, asked).count() == 2
    with pytest.raises(Exception, match="positive"):
        lookup.beacon(ss, asked.withColumn("start", F.lit(0).cast("long"))).collect()
    changed = lookup.patched(ss, spark.createDataFrame([(7, "PX")], "accession long, study string"))
    assert lookup.of_version(changed, spark.createDataFrame([(7, 2)], "accession long, version int")).first().study == "PX" and lookup.newest(changed).where("accession = 7").first().version == 2
    moves = spark.createDataFrame([(5, 6), (5, 16), (12, 16)], "a long, b long")
    assert [r[0] for r in moves.select(lookup.merge_allowed("a", "b", 10)).collect()] == [True, False, True]


def test_qc(spark):
    ss, rs = sve(spark, (1, 5, 100), (2, None, 100), (2, 6, 200), (3, 7, 100, {"alt": "G"})), cve(spark, (5, 100), (9, 900))
    unclustered, pending, extra = jobs.clustering_qc(ss, rs, ASM)
    assert pairs(unclustered, "accession") == [(2,)] and pairs(pending, "kind", "n") == [("merge", 2)] and pairs(extra, "accession") == [(9,)]
    assert pairs(qc.missing_clustered(ss.where("rs is not null").select("rs", "rs_hash"), rs), "rs", "problem") == [(6, "missing"), (7, "missing")]
    report = jobs.check_report(ss, ss.where("accession <> 3"))
    assert report.first().status == "FAILED" and jobs.check_report(ss, ss).first().status == "COMPLETED"
    lines = spark.createDataFrame([("c\t1\tss2\tA\tC",), ("#x",)], "value string")
    assert all(r.line.startswith("2 {") for r in jobs.duplicate_ss_qc(lines, ss).collect())


def test_recovery(spark):
    blocks = spark.createDataFrame([(1, 0, 9, 9, True, "2020-01-01"), (2, 20, 29, 29, True, "2024-01-01"), (3, 40, 49, 49, True, "2020-01-01")], "id long, first_value long, last_value long, last_committed long, reserved boolean, updated string")
    used = spark.createDataFrame([(i,) for i in (0, 1, 2, 5, 20)], "accession long")
    got = accession.recovered(blocks.withColumn("updated", F.col("updated").cast("timestamp_ntz")), used, F.lit("2022-01-01").cast("timestamp_ntz"))
    assert pairs(got, "id", "last_committed", "reserved") == [(1, 2, False), (2, 29, True), (3, 39, False)]


def test_scans(spark):
    rows = sve(spark, (1, None, 1), (2, None, 2, {"source": "legacy"}), (3, 5, 3, {"back_prop_rs": 4}), (4, 5, 4))
    assert pairs(scans.clustering(rows, ASM, False), "accession") == [(1,)]
    assert pairs(scans.clustering(rows, ASM, True), "accession") == [(4,)]
    assert pairs(scans.clustering(rows, ASM, True, resumable=True), "accession") == [(3,), (4,)]


def test_export_and_ingest_job(spark):
    seq = spark.createDataFrame([("c1", 0, "ACGT" * 250)], "contig string, chunk_no long, bases string")
    rows = sve(spark, (1, 5, 1, {"ref": "", "alt": "T"}), (2, 5, 10, {"map_weight": 2}), (3, 5, 10, {"alleles_match": False}), (4, 5, 2000), (5, 5, 10, {"alt": "(X)"}), (6, None, 7))
    lines = [r.line for r in jobs.export_submitted(rows, seq, ASM).collect() if not r.line.startswith("#")]
    assert [x.split("\t")[:5] for x in lines] == [["c1", "1", "ss1", "A", "TA"], ["c1", "7", "ss6", "A", "C"]]
    names = spark.createDataFrame([("c1", "assembled-molecule", "na", "CM1", "na", "na", True)], "sequence_name string, role string, assigned_molecule string, genbank string, refseq string, ucsc string, identical boolean")
    back = spark.createDataFrame([("c1\t70\tss6\tA\tC\t.\t.\tTAX=9913;PROJECT=P1;CREATED=2022-01-01T00:00:00",)], "value string")
    target = rows.withColumn("seq", F.when(F.col("accession") == 6, F.lit(OLD)).otherwise(F.col("seq")))
    insert, lost, run = jobs.ingest_remapped(back, names, target, ASM, OLD, ("r1", "a1"), spark.createDataFrame([], "remapping_id string"))
    assert pairs(insert, "accession", "contig") == [(6, "CM1")] and str(insert.first().created)[:4] == "2020" and lost.count() == 0 and run.count() == 1


def test_walk_along_long_chains_and_cycles(spark):
    """Rounds follow the logarithm of the length; a cycle ends where it began."""
    steps = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100)], "accession long, merge_into long")
    met = graph.walk(spark.createDataFrame([(1,), (100,), (7,), (999,)], "origin long"), steps)
    got = {(r.origin, r["at"]): r.hop for r in met.collect()}
    assert got == {(1, i): i - 1 for i in range(1, 41)} | {(7, i): i - 7 for i in range(7, 41)} | {(100, 100): 0, (100, 101): 1, (100, 102): 2, (999, 999): 0}


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), type("Conf", (), {"get": lambda self, key, default: default})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        graph.shared_dir(Session())
