"""Column layouts of the warehouse's tables. Lower-case snake names; nulls stand for the defaults of ``functions.expr``."""

from __future__ import annotations

SUBMITTED = (
    "ss_hash string, accession long, seq string, tax int, study string, contig string, start long, ref string, alt string, "
    "rs long, evidence boolean, asm_match boolean, alleles_match boolean, validated boolean, map_weight int, "
    "remapped_from string, remapping_id string, remapped_date timestamp_ntz, created timestamp_ntz, back_prop_rs long, version int"
)
CLUSTERED = (
    "rs_hash string, accession long, asm string, tax int, contig string, start long, type string, "
    "validated boolean, map_weight int, created timestamp_ntz, version int"
)
#: An event holds the rows it made inactive, as they were.
EVENTS = "id string, event string, accession long, merge_into long, split_into long, reason string, created timestamp_ntz"
SUBMITTED_EVENTS = f"{EVENTS}, inactive array<struct<{SUBMITTED.replace(' ', ':').replace(',:', ',')}>>"
CLUSTERED_EVENTS = f"{EVENTS}, inactive array<struct<{CLUSTERED.replace(' ', ':').replace(',:', ',')}>>"
ID_BLOCKS = (
    "id long, instance string, category string, first_value long, last_committed long, last_value long, reserved boolean, updated timestamp_ntz"
)
CONTIGS = "sequence_name string, role string, assigned_molecule string, genbank string, refseq string, ucsc string, identical boolean"

# The events of the two logs
MERGED, DEPRECATED, UPDATED, RS_SPLIT, SS_SPLIT, DISCARDED = "MERGED", "DEPRECATED", "UPDATED", "RS_SPLIT", "SS_SPLIT", "DISCARDED"
RS_BACK_PROPAGATED = "RS_BACK_PROPAGATED"
RS_MERGE_CANDIDATES, RS_SPLIT_CANDIDATES, SS_SPLIT_CANDIDATES = "RS_MERGE_CANDIDATES", "RS_SPLIT_CANDIDATES", "SS_SPLIT_CANDIDATES"

# Accessions from which on a row belongs to the current table, not the legacy one
SUBMITTED_CURRENT_FROM, CLUSTERED_CURRENT_FROM = 5_000_000_000, 3_000_000_000
