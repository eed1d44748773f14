"""Scalar expressions: identity, types, defaults and VCF encodings, each a Column made of Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sequence Ontology terms of the variant types
ONTOLOGY = {
    "SNV": "SO:0001483",
    "DEL": "SO:0000159",
    "INS": "SO:0000667",
    "INDEL": "SO:1000032",
    "TANDEM_REPEAT": "SO:0000705",
    "SEQUENCE_ALTERATION": "SO:0001059",
    "MNV": "SO:0002007",
}


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def required(x: Column | str, what: str) -> Column:
    """x as text; a null is an error, since concat_ws would leave it out without a word."""
    return F.when(c(x).isNull(), F.raise_error(F.lit(f"{what} must not be null"))).otherwise(c(x).cast("string"))


def summary(*parts: Column | str) -> Column:
    """The parts joined by underscores: what an identity is made of, and what breaks ties between identities."""
    return F.concat_ws("_", *(required(p, str(i)) for i, p in enumerate(parts)))


def digest(*parts: Column | str) -> Column:
    """The upper-case SHA-1 of the summary of the parts."""
    return F.upper(F.sha1(summary(*parts)))


def ss_summary(seq="seq", study="study", contig="contig", start="start", ref="ref", alt="alt") -> Column:
    return summary(seq, study, contig, start, ref, alt)


def rs_summary(asm="seq", contig="contig", start="start", kind="type") -> Column:
    return summary(asm, contig, start, kind)


def ss_hash(seq="seq", study="study", contig="contig", start="start", ref="ref", alt="alt") -> Column:
    return digest(seq, study, contig, start, ref, alt)


def rs_hash(asm="seq", contig="contig", start="start", kind="type") -> Column:
    return digest(asm, contig, start, kind)


def remapping_id(remapping_version, accessioning_version, source, target) -> Column:
    """P21."""
    return digest(remapping_version, accessioning_version, source, target)


def variant_type(ref="ref", alt="alt") -> Column:
    """By lengths for plain alleles; anything else is a sequence alteration; two empty alleles are an error."""
    r, a = c(ref), c(alt)
    plain = F.concat(r, a).rlike("^[A-Za-z]*$")
    return (
        F.when(F.length(r) + F.length(a) == 0, F.raise_error(F.lit("both alleles are empty")))
        .when(~plain, "SEQUENCE_ALTERATION")
        .when((F.length(r) == F.length(a)) & (F.length(r) == 1), "SNV")
        .when(F.length(r) == F.length(a), "MNV")
        .when(F.length(r) == 0, "INS")
        .when(F.length(a) == 0, "DEL")
        .otherwise("INDEL")
    )


def alleles_upper(x) -> Column:
    """P4."""
    return F.upper(c(x))


def flag(x, default: bool) -> Column:
    """P5: a flag with its default in place of null."""
    return F.coalesce(c(x), F.lit(default))


def stored_weight(x="map_weight") -> Column:
    """P5: a mapping weight of 1 is stored as null."""
    return F.nullif(c(x), F.lit(1))


def source_of(accession, current_from: int) -> Column:
    return F.when(c(accession) >= current_from, "current").otherwise("legacy")


def variant_end(start="start", ref="ref", alt="alt") -> Column:
    """The last position that the longer allele covers."""
    return c(start) + F.greatest(F.length(c(ref)), F.length(c(alt))) - 1


def vcf_stop(start="start", ref="ref") -> Column:
    return c(start) + F.length(c(ref)) - 1


def prefixed(prefix: str, accession) -> Column:
    """rs123, ss456."""
    return F.concat(F.lit(prefix), c(accession).cast("string"))


def info_masked(x) -> Column:
    """Characters that VCF's INFO forbids become underscores."""
    return F.regexp_replace(c(x), "[ ,;=]", "_")


def info_escaped(x) -> Column:
    """The same characters in per-cent form, the per-cent sign itself first."""
    out = c(x)
    for sign in "%,;=":
        out = F.replace(out, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
    return out


def event_id(*parts) -> Column:
    """P20: ids that make a repeated append a no-op."""
    return F.concat_ws("_", *(p if isinstance(p, Column) else F.lit(p) for p in parts))


# --- predicates -------------------------------------------------------------------------------------------------

CONTIG_CHAR = r"""[A-Za-z0-9!"#$%&'()+\-./;?@\\^_`{|}~]"""
CONTIG_START = CONTIG_CHAR.replace('"#', '"')
PLACE = rf"(?:{CONTIG_START}{CONTIG_CHAR}*|<{CONTIG_START}{CONTIG_CHAR}*>):[0-9]+"
BASES = "[ACGTNacgtn]"
SYMBOL = r"""<[A-Za-z0-9][A-Za-z0-9!"#$%&'()*+\-./:;=?@\[\\\]^_`{|}~]*>"""
#: F1: symbolic alleles, the missing allele, the reference block, break ends on four sides, and single break ends.
STRUCTURAL = "|".join(
    (SYMBOL, r"\*", r"<\*>", rf"\]{PLACE}\]{BASES}*", rf"\[{PLACE}\[{BASES}*", rf"{BASES}*\]{PLACE}\]", rf"{BASES}*\[{PLACE}\[", rf"\.{BASES}+", rf"{BASES}+\.")
)
STRUCTURAL = f"^(?:{STRUCTURAL})$"


def structural(alt="alt") -> Column:
    return c(alt).rlike(STRUCTURAL)


def valid_alleles(ref="ref", alt="alt", exempt: Column | None = None) -> Column:
    """nothing but bases in both alleles together, which are not both empty; exempt rows pass."""
    fine = F.concat(c(ref), c(alt)).rlike(f"^{BASES}+$")
    return fine if exempt is None else fine | exempt


def same_place(contig_a, start_a, contig_b, start_b, kind) -> Column:
    """F8: the same contig and start; insertions and deletions may start one apart."""
    near = c(kind).isin("INS", "DEL") & (F.abs(c(start_a) - c(start_b)) == 1)
    return (c(contig_a) == c(contig_b)) & ((c(start_a) == c(start_b)) | near)


# --- VCF alleles ------------------------------------------------------------------------------------------------


def special(x) -> Column:
    """Named, in parentheses, or symbolic, in angle brackets."""
    return (c(x).startswith("(") & c(x).endswith(")")) | (c(x).startswith("<") & c(x).endswith(">"))


def symbolic_alleles(ref="ref", alt="alt") -> Column:
    """struct(ref, alt) with a special allele in alt only, in angle brackets; two special alleles are an error."""
    swap = special(ref)
    both = swap & special(alt)
    new_alt = F.when(swap, c(ref)).otherwise(c(alt))
    inner = F.regexp_replace(F.substring(new_alt, F.lit(2), F.length(new_alt) - 2), "[ ,<>]", "_")
    tidy = F.when(special(new_alt), F.concat(F.lit("<"), inner, F.lit(">"))).otherwise(new_alt)
    checked = F.when(both, F.raise_error(F.lit("both alleles are symbolic"))).otherwise(tidy)
    return F.struct(F.when(swap, c(alt)).otherwise(c(ref)).alias("ref"), checked.alias("alt"))


def anchored(start, ref, alt, before, after) -> Column:
    """struct(start, ref, alt) with a context base: the one before, or at the start of the contig the one after."""
    at_first = c(start) == 1
    with_base = lambda x: F.when(at_first, F.concat(c(x), c(after))).otherwise(F.concat(c(before), c(x)))
    return F.struct(F.when(at_first, c(start)).otherwise(c(start) - 1).alias("start"), with_base(ref).alias("ref"), with_base(alt).alias("alt"))


def anchored_release(start, ref, alt, kind, before, after) -> Column:
    """Only rows with an empty allele are anchored; a sequence alteration takes the base in ref alone."""
    whole = anchored(start, ref, alt, before, after)
    empty_ref = anchored(start, F.lit(""), F.lit(""), before, after)
    keep = F.struct(c(start).alias("start"), c(ref).alias("ref"), c(alt).alias("alt"))
    named = F.struct(empty_ref["start"].alias("start"), empty_ref["ref"].alias("ref"), c(alt).alias("alt"))
    altered = c(kind) == "SEQUENCE_ALTERATION"
    return (
        F.when(altered & (F.length(c(ref)) == 0), named)
        .when(~altered & ((F.length(c(ref)) == 0) | (F.length(c(alt)) == 0)), whole)
        .otherwise(keep)
    )


def unanchored(start, ref, alt) -> Column:
    """S3: struct(start, ref, alt) without the context base, where one allele is the other's single first base."""
    r, a = c(ref), c(alt)
    drop_alt = (F.length(a) == 1) & (F.length(r) > 1) & r.startswith(a)
    drop_ref = (F.length(r) == 1) & (F.length(a) > 1) & a.startswith(r)
    rest = lambda x: F.substring(x, F.lit(2), F.length(x))
    return F.struct(
        F.when(drop_alt | drop_ref, c(start) + 1).otherwise(c(start)).alias("start"),
        F.when(drop_alt, rest(r)).when(drop_ref, F.lit("")).otherwise(r).alias("ref"),
        F.when(drop_alt, F.lit("")).when(drop_ref, rest(a)).otherwise(a).alias("alt"),
    )
