"""Golden values of identity, types, filters and VCF encodings."""

import pytest
from pyspark.sql import functions as F

from locusmill.functions import expr as E


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_hashes(spark):
    one = spark.createDataFrame(
        [("GCA_000002285.2", "BROAD_DBSNP.2005.2.4.16.57", "CM000028.3", 41173146, "C", "G")], "seq string, study string, contig string, start long, ref string, alt string"
    ).withColumn("type", E.variant_type())
    assert rows(one.select(E.ss_hash(), E.rs_hash())) == [("F91D9B43DCD5F6F31FC1C0655DCF942EC5BF2F27", "8A2D7C34562DAC4B6FB824E2CD28D98D0FDAECB2")]


def test_null_part_is_an_error(spark):
    one = spark.createDataFrame([(None,)], "a string")
    with pytest.raises(Exception, match="must not be null"):
        one.select(E.digest("a", F.lit("x"))).collect()


@pytest.mark.parametrize("ref, alt, kind", [("A", "C", "SNV"), ("AC", "GT", "MNV"), ("", "A", "INS"), ("A", "", "DEL"), ("A", "AC", "INDEL"), ("(X)", "A", "SEQUENCE_ALTERATION")])
def test_types(spark, ref, alt, kind):
    assert rows(spark.range(1).select(E.variant_type(F.lit(ref), F.lit(alt)))) == [(kind,)]


def test_both_alleles_empty(spark):
    with pytest.raises(Exception, match="empty"):
        spark.range(1).select(E.variant_type(F.lit(""), F.lit(""))).collect()


KEPT = ["A", "ACGT", "", ".", "acgtN"]
DROPPED = ["<DEL>", "<INS:ME:L1>", "<DUP:TANDEM>", "*", "<*>", "G]17:198982]", "]13:123456]T", "C[2:321682[", "[17:198983[A", "]<ctg1>:329]A", ".A", "G.", "<UNKNOWN_1>"]


def test_structural(spark):
    df = spark.createDataFrame([(x,) for x in KEPT + DROPPED], "alt string")
    assert {r.alt for r in df.where(E.structural()).collect()} == set(DROPPED)


def test_valid_alleles(spark):
    df = spark.createDataFrame([("A", "C", True), ("A", "X", False), ("", "", False), ("", "acgtn", True), ("A", "<S>", False)], "ref string, alt string, fine boolean")
    assert df.where(E.valid_alleles() != F.col("fine")).count() == 0
    assert df.where(E.valid_alleles(exempt=F.col("alt").startswith("<"))).count() == 3


def test_symbolic_alleles(spark):
    df = spark.createDataFrame([("(LARGE DEL)", "A"), ("A", "<a,b>"), ("G", "T")], "ref string, alt string")
    assert rows(df.select(F.inline(F.array(E.symbolic_alleles())))) == [("A", "<LARGE_DEL>"), ("A", "<a_b>"), ("G", "T")]
    with pytest.raises(Exception, match="symbolic"):
        spark.createDataFrame([("<A>", "(B)")], "ref string, alt string").select(E.symbolic_alleles()).collect()


def test_info(spark):
    df = spark.createDataFrame([("a b,c;d=e%f",)], "x string")
    assert rows(df.select(E.info_masked("x"), E.info_escaped("x"))) == [("a_b_c_d_e%f", "a b%2Cc%3Bd%3De%25f")]


def test_same_place(spark):
    df = spark.createDataFrame([("c", 5, "c", 6, "INS", True), ("c", 5, "c", 6, "SNV", False), ("c", 5, "d", 5, "SNV", False), ("c", 5, "c", 5, "SNV", True), ("c", 5, "c", 7, "DEL", False)], "a string, s long, b string, t long, k string, x boolean")
    assert df.where(E.same_place("a", "s", "b", "t", "k") != F.col("x")).count() == 0


def test_positions(spark):
    df = spark.createDataFrame([(10, "A", "ACG")], "start long, ref string, alt string")
    assert rows(df.select(E.variant_end(), E.vcf_stop(), E.prefixed("rs", "start"), E.event_id("RSMC", F.lit("asm"), F.lit("h")))) == [(12, 10, "rs10", "RSMC_asm_h")]
