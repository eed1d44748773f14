"""New VCF files as a stream: each submission once, by its hash, within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as E
from ..operators.remap import submitted
from ..sources import files


def submissions(spark: SparkSession, folder: str, assembly: str, tax: int, study: str, delay: str = "1 day", files_per_trigger: int = 100) -> DataFrame:
    """A streaming frame of submitted rows from the VCF files that arrive in a folder, without structural variants.

    A hash is remembered for as long as the delay says; repeats after that are left to the store's own anti-join.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder).withColumn("arrived", F.current_timestamp())
    rows = files.unwound(files.body(lines, "arrived")).where(~E.structural())
    return submitted(rows, assembly, tax, study).withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["ss_hash"])


def counts(rows: DataFrame, window: str = "1 hour", delay: str = "1 day", at: str = "arrived") -> DataFrame:
    """Submissions by study and window of arrival, of a streaming or a bounded frame."""
    return rows.withWatermark(at, delay).groupBy(F.window(at, window).alias("window"), "study").agg(F.count("*").alias("n"))
