"""Release queries: current, merged, deprecated and multimapped RSs with their submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import expr as E
from .graph import walk

# How the reasons of the two kinds of update begin
FROM_MERGE, FROM_DECLUSTER = "Original", "Declustered: "


def ontology(kind: Column | str = "type") -> Column:
    terms = F.create_map(*(F.lit(x) for kv in E.ONTOLOGY.items() for x in kv))
    return F.try_element_at(terms, E.c(kind))


def flags(prefix: str) -> dict[str, Column]:
    col = lambda n: F.col(f"{prefix}.{n}")
    return {
        "evidence": E.flag(col("evidence"), True), "asm_match": E.flag(col("asm_match"), True),
        "alleles_match": E.flag(col("alleles_match"), True), "ss_validated": E.flag(col("validated"), False),
    }


def joined(cve: DataFrame, sve: DataFrame, assembly: str, tax: int) -> DataFrame:
    """A row per RS of the assembly and submission under it at the same place.

    remapped_rs says whether all submissions of the RS are remapped, those at other places included. F8 is a filter on
    top of an equi-join, which keeps the join hashed.
    """
    rs = cve.where((F.col("asm") == assembly) & F.col("map_weight").isNull()).alias("c")
    ss = sve.where((F.col("seq") == assembly) & (F.col("tax") == tax) & F.col("rs").isNotNull())
    all_remapped = ss.groupBy("rs").agg(F.bool_and(F.col("remapped_from").isNotNull()).alias("remapped_rs"))
    rows = rs.join(ss.alias("s"), F.col("c.accession") == F.col("s.rs")).join(all_remapped.alias("r"), F.col("c.accession") == F.col("r.rs"))
    rows = rows.where(E.same_place(F.col("c.contig"), F.col("c.start"), F.col("s.contig"), F.col("s.start"), F.col("c.type")))
    return rows.select(
        F.col("c.accession").alias("rs"), F.col("c.rs_hash").alias("rs_hash"), F.col("c.contig").alias("contig"), F.col("s.start").alias("start"),
        F.upper("s.ref").alias("ref"), F.upper("s.alt").alias("alt"), ontology("c.type").alias("class"), F.col("s.study").alias("study"),
        E.flag("c.validated", False).alias("rs_validated"), *(v.alias(k) for k, v in flags("s").items()), "remapped_rs",
    )


def collapsed(rows: DataFrame, *more: Column) -> DataFrame:
    """A2, A3: one variant per RS, place and alleles, with its INFO values. more: further aggregates."""
    listed = lambda x: F.array_join(F.array_sort(F.collect_set(E.info_masked(x))), ",")
    return rows.groupBy("rs", "contig", "start", "ref", "alt").agg(
        listed("class").alias("vc"), listed("study").alias("sid"), F.count_if("ss_validated").alias("ss_validated"),
        F.bool_or("rs_validated").alias("rs_validated"), F.bool_or(~F.col("alleles_match")).alias("almm"), F.bool_or(~F.col("asm_match")).alias("asmm"),
        F.bool_or("remapped_rs").alias("remapped"), (~F.bool_or("evidence")).alias("loe"), *more,
    )


def active(cve: DataFrame, sve: DataFrame, assembly: str, tax: int) -> DataFrame:
    """The current release."""
    return collapsed(joined(cve, sve, assembly, tax))


def multimap(cve: DataFrame, sve: DataFrame, assembly: str) -> DataFrame:
    """RSs that map to several places, with all submissions of their own source, of any assembly."""
    rs = cve.where((F.col("asm") == assembly) & (F.col("map_weight") >= 2)).alias("c")
    rows = rs.join(sve.alias("s"), (F.col("c.accession") == F.col("s.rs")) & (F.col("c.source") == F.col("s.source")))
    rows = rows.where(E.same_place(F.col("c.contig"), F.col("c.start"), F.col("s.contig"), F.col("s.start"), F.col("c.type")))
    rows = rows.select(
        F.col("c.accession").alias("rs"), F.col("c.contig").alias("contig"), F.col("s.start").alias("start"), F.upper("s.ref").alias("ref"), F.upper("s.alt").alias("alt"),
        ontology("c.type").alias("class"), F.col("s.study").alias("study"), E.flag("c.validated", False).alias("rs_validated"), *(v.alias(k) for k, v in flags("s").items()),
        F.lit(False).alias("remapped_rs"), F.col("c.map_weight").alias("map_weight"),
    )
    return collapsed(rows, F.max("map_weight").alias("map_weight"))


def event_rows(events: DataFrame) -> DataFrame:
    """Events with their first inactive row's columns; the log's own come first where names meet."""
    x = F.col("inactive")[0]
    own = {"id", "event", "merge_into", "split_into", "reason", "event_accession", "event_created"}
    base = events.select("id", "event", F.col("accession").alias("event_accession"), "merge_into", "split_into", "reason", F.col("created").alias("event_created"), x.alias("x"))
    return base.select(*[c for c in base.columns if c != "x"], *(F.col(f"x.{f.name}").alias(f.name) for f in base.schema["x"].dataType.fields if f.name not in own))


def holds_somewhere(events: DataFrame, key: Column, tests: dict[str, Column]) -> DataFrame:
    """H6: key and whether each test holds for some element under it; the elements may differ by test."""
    long = events.select(key.alias("key"), "event", F.explode("inactive").alias("x"))
    return long.groupBy("key").agg(*(F.bool_or(t).alias(n) for n, t in tests.items()))


def deprecated(cve_events: DataFrame, sve_events: DataFrame, assembly: str, tax: int) -> DataFrame:
    """Rs of deprecation events on the assembly with a submission that was updated or deprecated."""
    tests = {"t_asm": F.col("x.seq") == assembly, "t_tax": F.col("x.tax") == tax, "t_event": F.col("event").isin(S.UPDATED, S.DEPRECATED)}
    seen = holds_somewhere(sve_events, F.col("inactive")[0]["rs"], tests).where("t_asm and t_tax and t_event")
    rows = cve_events.where((F.col("event") == S.DEPRECATED) & F.exists("inactive", lambda x: x["asm"] == assembly))
    return rows.join(seen, rows["accession"] == seen["key"], "left_semi").select(F.col("accession").alias("rs")).distinct()


def merged_deprecated(cve_events: DataFrame, sve_events: DataFrame, sve: DataFrame, assembly: str, tax: int) -> DataFrame:
    """Rs, merge_into of merges into an id that no submission has any more, with evidence in the log."""
    tests = {"t_asm": F.col("x.seq") == assembly, "t_tax": F.col("x.tax") == tax}
    seen = holds_somewhere(sve_events, F.col("inactive")[0]["rs"], tests).where("t_asm and t_tax")
    rows = cve_events.where((F.col("event") == S.MERGED) & F.exists("inactive", lambda x: x["asm"] == assembly))
    rows = rows.join(seen, rows["accession"] == seen["key"], "left_semi")
    alive = sve.where("rs is not null").select(F.col("rs").alias("merge_into"), "source").distinct()
    return rows.join(alive, ["merge_into", "source"], "left_anti").select(F.col("accession").alias("rs"), "merge_into").distinct()


def chains(cve_events: DataFrame, cve: DataFrame, assembly: str) -> DataFrame:
    """Rs, status, target, via: what became of each RS with MERGED or DEPRECATED events on the assembly.

    Active ids are not asked about. merged: some chain of merges reaches an active id (target: that of the last step
    whose target is smallest; via: the id that took this step). deprecated: none does, and some id met was deprecated.
    Otherwise undetermined. Ids met twice end their chain.
    """
    ours = cve_events.where(F.col("event").isin(S.MERGED, S.DEPRECATED) & F.exists("inactive", lambda x: x["asm"] == assembly))
    alive = cve.where(F.col("asm") == assembly).select("accession").distinct()
    start = ours.select("accession").distinct().join(alive, "accession", "left_anti").select(F.col("accession").alias("origin"))
    steps = ours.where(F.col("event") == S.MERGED).select("accession", "merge_into").distinct()
    met = walk(start, steps)
    last = met.join(steps, met["at"] == steps["accession"]).join(alive.withColumnRenamed("accession", "merge_into"), "merge_into", "left_semi")
    target = last.groupBy("origin").agg(F.min("merge_into").alias("target"), F.min(F.struct("merge_into", "hop", "at"))["at"].alias("via"))
    gone = ours.where(F.col("event") == S.DEPRECATED).select(F.col("accession").alias("at")).distinct()
    dropped = met.join(gone, "at", "left_semi").select("origin").distinct().withColumn("dropped", F.lit(True))
    rows = start.join(target, "origin", "left").join(dropped, "origin", "left")
    status = F.when(F.col("target").isNotNull(), "merged").when(F.col("dropped"), "deprecated").otherwise("undetermined")
    return rows.select(F.col("origin").alias("rs"), status.alias("status"), "target", "via")


def merged(cve_events: DataFrame, sve_events: DataFrame, cve: DataFrame, assembly: str, tax: int) -> DataFrame:
    """The merged release: variants of merged RSs, from the submissions' update events.

    Place and class are those that the last step's id had when it was merged; submissions are those of the RS asked for.
    """
    found = chains(cve_events, cve, assembly).where("status = 'merged'").select(F.col("rs").alias("origin"), "target", "via")
    place = event_rows(cve_events.where(F.col("event") == S.MERGED)).where(F.col("asm") == assembly)
    place = place.select(F.col("event_accession").alias("via"), F.col("merge_into").alias("target"), "contig", "start", "type", E.flag("validated", False).alias("rs_validated")).dropDuplicates(["via", "target"])
    fits = F.exists("inactive", lambda x: x["seq"] == assembly) & F.exists("inactive", lambda x: x["tax"] == tax)
    ss = event_rows(sve_events.where((F.col("event") == S.UPDATED) & fits)).alias("s")
    all_remapped = ss.groupBy(F.col("rs").alias("r_rs")).agg(F.bool_and(F.col("remapped_from").isNotNull()).alias("remapped_rs"))
    rows = found.join(place.alias("c"), ["via", "target"]).join(ss, F.col("origin") == F.col("s.rs")).join(all_remapped, F.col("origin") == F.col("r_rs"))
    rows = rows.where(F.col("s.reason").startswith(FROM_MERGE))
    rows = rows.where(E.same_place(F.col("c.contig"), F.col("c.start"), F.col("s.contig"), F.col("s.start"), F.col("c.type")))
    rows = rows.select(
        F.col("via").alias("rs"), F.col("c.contig").alias("contig"), F.col("s.start").alias("start"), F.upper("s.ref").alias("ref"), F.upper("s.alt").alias("alt"),
        ontology("c.type").alias("class"), F.col("s.study").alias("study"), "rs_validated", *(v.alias(k) for k, v in flags("s").items()), "remapped_rs", "target",
    )
    return collapsed(rows, F.array_join(F.array_sort(F.collect_set(F.col("target").cast("string"))), ",").alias("curr"))


def dump_active(cve: DataFrame, assembly: str) -> DataFrame:
    """K5: accessions, repeats included."""
    return cve.where(F.col("asm") == assembly).select("accession")


def dump_events(cve_events: DataFrame, assembly: str) -> DataFrame:
    """K5: accessions of merges and deprecations on the assembly, repeats included."""
    return cve_events.where(F.col("event").isin(S.MERGED, S.DEPRECATED) & F.exists("inactive", lambda x: x["asm"] == assembly)).select("accession")


def contigs_active(sve: DataFrame, assembly: str, tax: int) -> DataFrame:
    """A11."""
    return sve.where((F.col("seq") == assembly) & (F.col("tax") == tax)).select("contig").distinct()


def contigs_of_events(cve_events: DataFrame, assembly: str, event: str) -> DataFrame:
    """Of the first inactive row."""
    rows = cve_events.where((F.col("event") == event) & F.exists("inactive", lambda x: x["asm"] == assembly))
    return rows.select(F.col("inactive")[0]["contig"].alias("contig")).distinct()


def contigs_multimap(cve: DataFrame, assembly: str) -> DataFrame:
    """A11."""
    return cve.where((F.col("asm") == assembly) & (F.col("map_weight") >= 2)).select("contig").distinct()


def records(cve: DataFrame, sve: DataFrame) -> DataFrame:
    """rs_hash, rs and all submissions as an array: the denormalised record of a release."""
    ss = sve.where("rs is not null").groupBy("seq", "rs").agg(F.array_sort(F.collect_list(F.struct("accession", "ss_hash", "study", "ref", "alt"))).alias("submissions"))
    return cve.join(ss, (cve["accession"] == ss["rs"]) & (cve["asm"] == ss["seq"]), "left").select("rs_hash", cve["accession"].alias("rs"), "submissions")


def report(variants: DataFrame, sequence: DataFrame | None = None) -> DataFrame:
    """The chain of the release report: symbolic alleles, F2, context bases, F2, and K3's lines. variants: collapsed()."""
    from ..sources.files import with_context
    from ..sources.sinks import info_text, vcf_line

    rows = variants.withColumn("v", E.symbolic_alleles()).withColumns({"ref": F.col("v.ref"), "alt": F.col("v.alt")}).drop("v")
    kind = F.when(E.special("alt"), "SEQUENCE_ALTERATION").otherwise("PLAIN")
    fine = E.valid_alleles(exempt=kind == "SEQUENCE_ALTERATION")
    rows = rows.where(fine)
    if sequence is not None:
        rows = with_context(rows, sequence)
        v = E.anchored_release("start", "ref", "alt", kind, "context", "context")
        rows = rows.withColumn("v", v).withColumns({x: F.col(f"v.{x}") for x in ("start", "ref", "alt")}).where(fine)
    info = info_text(
        [("VC", F.col("vc")), ("SID", F.col("sid")), ("SS_VALIDATED", F.col("ss_validated").cast("string")), *([("CURR", E.prefixed("rs", "curr"))] if "curr" in variants.columns else []),
         *([("MAP_WEIGHT", F.col("map_weight").cast("string"))] if "map_weight" in variants.columns else [])],
        [("RS_VALIDATED", F.col("rs_validated")), ("ALMM", F.col("almm")), ("ASMM", F.col("asmm")), ("LOE", F.col("loe")), ("REMAPPED", F.col("remapped"))],
    )
    return rows.select("contig", "start", vcf_line(E.prefixed("rs", "rs"), info).alias("line"))


# --- names of what is released (R12, R13) -----------------------------------------------------------------------


def assembly_name(rows: DataFrame, names: DataFrame, accession: str = "asm") -> DataFrame:
    """Rows with the display name of their assembly from a table (accession, name, curated); curated names win; none: null."""
    pick = names.groupBy("accession").agg(F.min_by("name", F.struct((~F.col("curated")).alias("o"), "name")).alias("assembly_name"))
    return rows.join(pick.withColumnRenamed("accession", accession), accession, "left")


def report_path(folder: str, assembly: str, category: str, source: str = "current") -> str:
    """Where a report of a source goes. category: current, merged and multimap (VCF), deprecated and merged_deprecated (lists of ids, in no order)."""
    return f"{folder.rstrip('/')}/{source}_{assembly}_{category}_ids.{'unsorted.txt' if category.endswith('deprecated') else 'vcf'}"
