"""Iterative operators: connected components and merge chains, over written tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, one of this machine if all runs on it, else an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="locusmill-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again: short lineage that survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Removes the files behind a frame that cut() made, once nothing reads it any more."""
    spark = df.sparkSession
    for f in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
        if path.toString().startswith(shared_dir(spark)):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Keys, node, label: per key, the smallest node that edges (a, b) reach. Nodes are of one type.

    Large-star and small-star rounds: the number of rounds follows the logarithm of a chain's length, not its length.
    """
    k = [F.col(x) for x in keys]
    given = cut(edges.select(*k, F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct())
    loops, links, state = given.where("lo = hi"), given.where("lo < hi"), None
    while True:
        both = links.select(*k, F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select(*k, F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy(*k, "u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, [*keys, "u"]).select(*k, F.col("m").alias("lo"), F.col("v").alias("hi"))
        low = large.groupBy(*k, "hi").agg(F.min("lo").alias("m"))
        small = large.join(low, [*keys, "hi"]).select(*k, F.col("m").alias("lo"), F.col("lo").alias("hi"))
        fresh = cut(small.union(low.select(*k, F.col("m").alias("lo"), "hi")).where("lo < hi").distinct())
        if state is not None:
            drop_cut(links)
        links = fresh
        now = links.agg(F.count("*"), F.sum(F.xxhash64(*keys, "lo", "hi").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    found = links.select(*k, F.col("hi").alias("node"), F.col("lo").alias("label"))
    alone = loops.select(*k, F.col("lo").alias("node"), F.col("lo").alias("label")).unionByName(links.select(*k, F.col("lo").alias("node"), F.col("lo").alias("label")))
    return found.unionByName(alone.distinct().join(found, [*keys, "node"], "left_anti"))


def bipartite(rows: DataFrame, keys: list[str], node: str, group: str) -> DataFrame:
    """keys, node, label: nodes that share a group are linked, each to the smallest of the group."""
    pairs = rows.select(*keys, F.col(group).alias("__g"), F.col(node).alias("__n")).where("__n is not null").distinct()
    least = pairs.groupBy(*keys, "__g").agg(F.min("__n").alias("__m"))
    edges = pairs.join(least, [*keys, "__g"]).select(*keys, F.col("__m").alias("__a"), F.col("__n").alias("__b"))
    return components(edges, keys, "__a", "__b")


def walk(start: DataFrame, steps: DataFrame) -> DataFrame:
    """Origin, at, hop: every accession met from an origin (hop 0: itself), each once, by its shortest way; cycles end.

    start: origin. steps: accession, merge_into. Each round joins ways to ways, so rounds follow the logarithm of a
    chain's length.
    """
    moves = steps.select(F.col("accession").alias("origin"), F.col("merge_into").alias("at"), F.lit(1).alias("hop")).where("at is not null and origin <> at")
    ways, n = cut(moves.distinct()), -1
    while n != (n := ways.count()):
        on = ways.select(F.col("origin").alias("at"), F.col("at").alias("to"), F.col("hop").alias("more"))
        longer = ways.join(on, "at").select("origin", F.col("to").alias("at"), (F.col("hop") + F.col("more")).alias("hop")).where("origin <> at")
        more = cut(ways.unionByName(longer).groupBy("origin", "at").agg(F.min("hop").alias("hop")))
        drop_cut(ways)
        ways = more
    origins = start.select("origin").distinct()
    return origins.select("origin", F.col("origin").alias("at"), F.lit(0).alias("hop")).unionByName(ways.join(origins, "origin", "left_semi").select("origin", "at", "hop"))
