"""What the operators of this subpackage share: reading, mapping over Arrow batches, cutting lineage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import cut, drop_cut  # noqa: F401

#: A word: a run of characters other than ASCII white space. ``bytes.split()`` splits at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no name of ours can clash with one of theirs."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column without decoding it."""
    return column.cast(pa.binary()).to_pylist()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """One batch in, one batch out; a partition is never held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield fn(b)

    return df.mapInArrow(run, schema)


def same_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """map_batches() with the columns of df, whatever their names; fn finds them by place."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return map_batches(plain, fn, plain.schema).toDF(*df.columns)


def per_worker(key: str, make: Callable):
    """make(), kept for the life of the Python process, so that the tasks of one worker share it."""
    kept = sys.__dict__.setdefault("_locusmill_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
