"""File scans and sinks on small texts."""

import bz2
import json

import pytest
from pyspark.sql import functions as F

from locusmill.functions import contigs as C
from locusmill.operators import remap
from locusmill.plans import jobs
from locusmill.sources import files, sinks
from locusmill.streaming import ingest


def lines(spark, text):
    return spark.createDataFrame([(x,) for x in text.strip("\n").split("\n")], "value string")


VCF = "##fileformat=VCFv4.3\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n1\t100\tss7\tGA\tG,GATC,GA\t.\t.\tTAX=9913;FLAG\n1\tx\tss8\tA\tC\t.\t.\t.\n2\t5\t.\ta\tc\n2\t6\t.\tA\t.\t.\t.\t."


def test_vcf(spark):
    got = [tuple(r) for r in files.vcf_aggregated(lines(spark, VCF)).select("contig", "start", "ref", "alt", F.col("attributes")["TAX"]).collect()]
    assert sorted(got) == [("1", 100, "GA", "G", "9913"), ("1", 100, "GA", "GATC", "9913"), ("2", 5, "A", "C", None)]
    assert files.rejected(lines(spark, VCF)).count() == 2
    back = files.vcf_accessioned(lines(spark, VCF)).where("contig = '1'").select("start", "ref", "alt", "ids").collect()
    assert sorted(map(tuple, back)) == [(100, "GA", "GATC", ["ss7"]), (101, "A", "", ["ss7"])]
    assert [r.accession for r in files.ss_ids_of_vcf(lines(spark, VCF)).collect()] == [7, 8]


def test_remapped_vcf(spark):
    text = "1\t9\tss5000000001\tA\tC\t.\t.\tTAX=9913;PROJECT=P;RS=rs3;BACKPROP_RS=rs9;CREATED=2016-05-05T13:43:00"
    row = remap.remapped(files.vcf_remapped(lines(spark, text)), "ASM", "OLD", "run").first()
    assert (row.accession, row.rs, row.back_prop_rs, row.tax, str(row.created)) == (5000000001, 9, 9, 9913, "2016-05-05 13:43:00")
    with pytest.raises(Exception, match="not an RS id"):
        remap.remapped(files.vcf_remapped(lines(spark, text.replace("=rs3;BACKPROP_RS=rs9", "=3"))), "ASM", "OLD", "run").collect()


def test_id_lists(spark):
    assert [r.accession for r in files.id_list(lines(spark, "rs5  x\n\n  7\ty\nss8")).collect()] == [5, 7, 8]
    assert files.rs_report(lines(spark, "5\tABC")).first() == (5, "ABC")
    with pytest.raises(Exception, match="malformed"):
        files.rs_report(lines(spark, "5 ABC")).collect()


REPORT = """# comment
chr1\tassembled-molecule\t1\tChromosome\tCM1.1\t=\tNC_1.1\tU\t10\tucsc1
chr3\tassembled-molecule\t3\tChromosome\tCM3.1\t<>\tNC_3.1\tU\t10\tucsc3
chr4\tassembled-molecule\t4\tChromosome\tna\t<>\tNC_4.1\tU\t10\tna
chr6\tassembled-molecule\t6\tChromosome\tCM6.1\t<>\tna\tU\t10\tna
scaf\tunplaced-scaffold\t1\tScaffold\tCM7.1\t=\tNC_7.1\tU\t10\tna"""


def test_contigs(spark):
    report = files.assembly_report(lines(spark, REPORT))
    names = {r.name: r.sequence_name for r in C.by_name(report).collect()}
    assert names["1"] == "chr1" and names["CM7.1"] == "scaf" and names["NC_4.1"] == "chr4" and "na" not in names
    ask = lambda *x: spark.createDataFrame([(i,) for i in x], "contig string")
    assert [r.contig for r in C.to_genbank(ask("chr1", "ucsc1", "chr6"), report).orderBy("contig").collect()] == ["CM1.1", "CM1.1", "CM6.1"]
    assert C.to_genbank(ask("chr3"), report, strict=False).first().contig == "chr3"
    for bad in ("chr3", "chr4", "nowhere"):
        with pytest.raises(Exception, match="cannot be replaced"):
            C.to_genbank(ask(bad), report).collect()
    renamed = {r.contig for r in C.renamed(ask("CM1.1", "CM3.1", "other"), report, "REFSEQ").collect()}
    assert renamed == {"NC_1.1", "CM3.1", "other"}
    assert {r.contig for r in C.renamed(ask("CM3.1"), report, "UCSC").collect()} == {"ucsc3"}
    with pytest.raises(Exception, match="not unique"):
        C.checked(report.union(report)).collect()
    with pytest.raises(Exception, match="short line"):
        files.assembly_report(lines(spark, "chr1\tx")).collect()


def test_context_base(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">22 first\nTAC\nGGA\n>33\nCCCC\n")
    seq = files.fasta(files.fasta_lines(spark, str(tmp_path / "a.fa")), chunk=4)
    assert {(r.contig, r.chunk_no): r.bases for r in seq.collect()} == {("22", 0): "TACG", ("22", 1): "GA", ("33", 0): "CCCC"}
    rng = __import__("random").Random(1)
    genome = {f"k{i}": "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 400))) for i in range(12)}
    (tmp_path / "b.fa").write_text("".join(f">{k} x\n" + "".join(v[i : i + 7] + "\n" for i in range(0, len(v), 7)) for k, v in genome.items()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        many = files.fasta_lines(spark, str(tmp_path / "b.fa"))
        assert many.select("block").distinct().count() > 5
        got = {}
        for r in files.fasta(many, chunk=16).orderBy("contig", "chunk_no").collect():
            got[r.contig] = got.get(r.contig, "") + r.bases
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == genome
    from locusmill.functions import expr as E

    df = spark.createDataFrame([("22", 1, "", "A"), ("22", 2, "", "A"), ("22", 1, "", "CA"), ("22", 6, "A", ""), ("22", 9, "", "A")], "contig string, start long, ref string, alt string")
    got = files.with_context(df, seq, chunk=4).select("context", F.inline(F.array(E.anchored("start", "ref", "alt", "context", "context"))))
    assert {tuple(r) for r in got.collect()} == {("T", 1, "T", "AT"), ("T", 1, "T", "TA"), ("T", 1, "T", "CAT"), ("G", 5, "GA", "G"), (None, 8, None, None)}
    report = files.assembly_report(lines(spark, REPORT.replace("chr1", "22")))
    assert {r.fasta_contig for r in files.through_synonyms(spark.createDataFrame([("CM1.1",), ("zz",)], "contig string"), seq, report).collect()} == {"22", "zz"}


def test_dbsnp(spark, tmp_path):
    def doc(rs, asm="GCF_1", kind="snv", build="155"):
        place = {"is_ptlp": True, "placement_annot": {"seq_id_traits_by_assembly": [{"assembly_accession": asm}]}, "alleles": [{"allele": {"spdi": {"seq_id": "NC_1", "position": 9}}}]}
        return json.dumps({"refsnp_id": rs, "create_date": "2000-09-19T17:02Z", "present_obs_movements": [{"last_added_to_this_rs": build}],
                           "primary_snapshot_data": {"variant_type": kind, "placements_with_allele": [{**place, "is_ptlp": False}, place]}})

    (tmp_path / "x.json.bz2").write_bytes(bz2.compress("\n".join([doc("1"), doc("2", asm="GCF_9"), doc("3", kind="delins", build="150")]).encode()))
    text = spark.read.text(str(tmp_path / "x.json.bz2"))
    got = files.dbsnp_json(text, "GCF_1", "GCA_1").select("accession", "start", "type", "created").orderBy("accession").collect()
    assert [(r[0], r[1], r[2], str(r[3])) for r in got] == [(1, 10, "SNV", "2000-09-19 17:02:00"), (3, 10, "INDEL", "2000-09-19 17:02:00")]
    assert [r.accession for r in files.dbsnp_json(text, "GCF_1", "GCA_1", newer_than=152).collect()] == [1]
    with pytest.raises(Exception, match="unknown variant type"):
        files.dbsnp_json(lines(spark, doc("1", kind="odd")), "GCF_1", "GCA_1").collect()


def test_report_of_new_accessions(spark, tmp_path):
    known = spark.createDataFrame([], "ss_hash string, accession long, source string")
    text = "chr1\t2\t.\tA\tC,<DEL>\t.\t.\t.\nchr1\t1\t.\tA\tG\t.\t.\t."
    rows, dropped = jobs.accession_vcf(lines(spark, text), files.assembly_report(lines(spark, REPORT)), known, "ASM", 9913, "P", 500, 10)
    assert sorted(r.accession for r in rows.collect()) == [500, 501] and dropped.count() == 1
    seq = spark.createDataFrame([("CM1.1", 0, "ACGT")], "contig string, chunk_no long, bases string")
    out = [r.line for r in jobs.accession_report(rows, seq, files.assembly_report(lines(spark, REPORT)), "SEQUENCE_NAME").collect()]
    assert out[0] == "##fileformat=VCFv4.3" and out[1] == "##contig=<ID=chr1>" and out[2].startswith("#CHROM") and [x.split("\t")[1] for x in out[3:]] == ["1", "2"]
    sinks.write_text(spark.createDataFrame([(x,) for x in out], "line string"), str(tmp_path / "out"), single=True)
    assert spark.read.text(str(tmp_path / "out")).count() == len(out)


def test_sinks(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "accession long, merge_into long")
    assert {r.line for r in sinks.id_lines(df, into="merge_into").collect()} == {"rs1\trs2", "rs3\trs4"}
    assert sinks.appendable(df, df.where("accession = 3"), "accession").count() == 1
    assert [r.accession for r in sinks.conflicts(df, df.where("accession = 3"), "accession").collect()] == [3]
    names = files.assembly_report(lines(spark, REPORT))
    assert sinks.contig_lines(spark.createDataFrame([("CM1.1",)], "contig string"), names).first().line == "CM1.1,chr1"
    with pytest.raises(Exception, match="no sequence name"):
        sinks.contig_lines(spark.createDataFrame([("zz",)], "contig string"), names).collect()


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.vcf").write_text(VCF + "\n1\t100\tss9\tGA\tG\n")
    rows = ingest.submissions(spark, str(tmp_path / "in"), "ASM", 9913, "P")
    q = rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 3 and got.select("ss_hash").distinct().count() == 3
    assert ingest.counts(got).first().n == 3


def test_fasta_errors(spark, tmp_path):
    import gzip

    text = ">c1 first\nACGT\nAC\n>c2\nGG\n"
    for name, data in (("a.fa.gz", gzip.compress(text.encode())), ("b.fa", gzip.compress(text.encode()))):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Exception, match="must not be compressed"):
            files.fasta(files.fasta_lines(spark, str(tmp_path / name))).collect()
    (tmp_path / "c.fa").write_text(text + ">c1 again\nAAAA\n")
    with pytest.raises(Exception, match="contig comes twice"):
        files.fasta(files.fasta_lines(spark, str(tmp_path / "c.fa"))).collect()
    (tmp_path / "d.fa").write_text(text)
    seq = files.fasta(files.fasta_lines(spark, str(tmp_path / "d.fa")), chunk=4)
    rows = spark.createDataFrame([("c1", 6), ("c2", 2)], "contig string, at long")
    assert sorted(r.base for r in files.base_at(rows, seq, F.col("at"), "base", chunk=4, strict=True).collect()) == ["C", "G"]
    for bad in (("c1", 7), ("zz", 1)):
        with pytest.raises(Exception, match="no such contig"):
            files.base_at(spark.createDataFrame([bad], "contig string, at long"), seq, F.col("at"), "base", chunk=4, strict=True).collect()


def test_header_names_the_assembly():
    assert sinks.header_lines({}, "GCA_1.1", "One", "https://example.org/GCA_1.1")[1] == "##reference=<ID=One,accession=GCA_1.1,URL=https://example.org/GCA_1.1>"
    assert sinks.header_lines({}, "GCA_1.1")[1] == "##reference=<ID=GCA_1.1>"
