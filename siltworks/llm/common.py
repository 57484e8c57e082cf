"""What the operators of this subpackage share: staged tables, table reading, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local one only where it is unset and Spark is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="siltworks-stage-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_in_buckets(df: DataFrame, label: str, key: str) -> DataFrame:
    """As stage, with the rows of a key in one bucket, so that grouping by it later moves none of them. There are as many buckets as shuffle partitions."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{stage_root(spark)}/{name}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(name)
    return spark.table(name)


def text_of(name: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Smallest id reachable from every id of edges(a, b): columns id, component.

    Min-label hooking with pointer jumping on DataFrames. Each round sends every
    vertex the smallest label among its neighbours, then shortcuts labels through
    labels. The state is a staged table of (id, component) and of the
    edges between different components; both shrink or keep their size, and only
    one count a round reaches the driver. Hubs are safe: neighbours are reduced
    by a partial min before the shuffle. An empty input gives an empty result;
    null ends and self links are ignored.
    """
    live = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    live = stage(live, f"{label}-edges")
    vertices = live.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = stage(vertices.select("id", F.col("id").alias("component")), f"{label}-labels")
    while live.limit(1).count():
        # hook: each current label to the smallest label that an edge joins it to
        both = live.select("a", "b").union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("to"))
        hook = stage(hook, f"{label}-hook")
        # jump: hooks point to smaller labels only, so following them twice a pass ends
        while True:
            nxt = hook.alias("h").join(hook.alias("g"), F.col("h.to") == F.col("g.a"), "left")
            nxt = nxt.select(F.col("h.a").alias("a"), F.coalesce("g.to", "h.to").alias("to"), (F.coalesce("g.to", "h.to") != F.col("h.to")).alias("moved"))
            nxt = stage(nxt, f"{label}-jump")
            hook = nxt.select("a", "to")
            if not nxt.where("moved").limit(1).count():
                break
        labels = stage(
            labels.join(hook, labels.component == hook.a, "left").select("id", F.coalesce("to", "component").alias("component")),
            f"{label}-labels",
        )
        left = hook.select(F.col("a").alias("la"), F.col("to").alias("ta"))
        right = hook.select(F.col("a").alias("lb"), F.col("to").alias("tb"))
        live = live.join(left, live.a == left.la).join(right, F.col("b") == right.lb).select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a < b").distinct()
        live = stage(live, f"{label}-edges")
    return labels
