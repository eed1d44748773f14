"""Deprecation of submitted variants, with the clustered ones that nothing refers to afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import expr as E


def deprecate(sve: DataFrame, cve: DataFrame, batch: DataFrame, suffix: str, reason: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Remaining submitted and clustered rows, and the events of both. batch: the submitted rows to deprecate.

    An RS goes only if no surviving row has the same pair of hash and id; surviving means outside the batch.
    """
    keys = ["ss_hash", "accession", "seq"]
    gone = batch.dropDuplicates(keys)
    alive = sve.join(gone.select(*keys), keys, "left_anti")
    pair = ["rs_hash", "rs"]
    orphans = gone.where("rs is not null").select(*pair).distinct().join(alive.select(*pair), pair, "left_anti")
    match = (cve["rs_hash"] == orphans["rs_hash"]) & (cve["accession"] == orphans["rs"])
    dropped, kept = cve.join(orphans, match, "left_semi"), cve.join(orphans, match, "left_anti")

    def events(rows: DataFrame, prefix: str, hashed: str, assembly: str) -> DataFrame:
        return rows.select(E.event_id(prefix, suffix, F.col(hashed)).alias("id"), F.lit(S.DEPRECATED).alias("event"), "accession", F.lit(reason).alias("reason"), F.col(assembly).alias("seq"))

    return alive, kept, events(gone, "SS_DEPRECATED", "ss_hash", "seq"), events(dropped, "RS_DEPRECATED", "rs_hash", "asm")
