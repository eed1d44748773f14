"""Importing clustered variants whose loci may be taken already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import expr as E

# Fixed value: the reason of these merges
REASON = "Identical clustered variant received multiple RS identifiers"


def import_clustered(incoming: DataFrame, stored: DataFrame, merged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to insert, and MERGED events of the ids that lost. merged: accession, merge_into of earlier events.

    A stored row owns its hash, else the smallest incoming id does; A15: an id is merged once, and not if it was before.
    """
    owner = stored.groupBy("rs_hash").agg(F.min("accession").alias("owner"))
    first = incoming.groupBy("rs_hash").agg(F.min("accession").alias("first"))
    rows = incoming.join(first, "rs_hash").join(owner, "rs_hash", "left")
    insert = rows.where("owner is null and accession = first").drop("first", "owner").dropDuplicates(["rs_hash"])
    losers = rows.withColumn("merge_into", F.coalesce("owner", "first")).where("accession <> merge_into")
    losers = losers.groupBy("accession").agg(F.min_by("merge_into", F.struct("merge_into", "rs_hash")).alias("merge_into"), F.min(F.struct("merge_into", "rs_hash"))["rs_hash"].alias("rs_hash"))
    new = losers.join(merged.select("accession"), "accession", "left_anti")
    return insert, new.select(
        E.event_id("RS", S.MERGED, F.col("accession").cast("string"), F.col("rs_hash")).alias("id"), F.lit(S.MERGED).alias("event"), "accession", "merge_into", F.lit(REASON).alias("reason"), "rs_hash"
    )
