"""Exact deduplication by skew-safe combining."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import fresh, stage, text_of

#: A table of so many rows (of about 80 bytes) is broadcast; a larger one is joined by a shuffle.
ROWS = 300_000
#: A digest is hot from this many rows on, and from this share of all rows on: there are at most 1 / HOT_SHARE hot digests.
HOT_ROWS, HOT_SHARE = 1_000, 1e-5
SALTS = 64


def _digest(body: Column) -> Column:
    return F.sha2(body, 256)


def _few(df: DataFrame) -> DataFrame:
    """A staged table, broadcast only if it has few rows."""
    return F.broadcast(df) if df.count() <= ROWS else df


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=None) -> DataFrame:
    """Group rows whose normalised texts are identical: doc_id, keep_id, group_size, kept, text_sha256, one row per input row.

    normalise maps the text column to the compared one (default: no change).
    Stages, each grouping by digest AND full text, so that equal digests of
    different texts never merge unseen:

    1. local: Spark's partial aggregation makes one row of a partition's copies;
    2. salted: copies of a hot digest are merged per (digest, salt), where the
       salt is the partition's number, so that no task gets a hot group whole;
    3. global: the winners of the salts are merged.

    Cold digests have few rows each and need no salt. The digest table is
    counted first; at most 1 / HOT_SHARE digests can be hot, which bounds what is broadcast.

    Texts that share a digest but differ are told apart by their whole text in every
    stage, the last join included.

    Null text counts as empty and empty texts are equal to each other. Null ids
    rank lowest; a group of null ids has keep_id null. Rows that repeat id and
    text are ties: one of them (the first in the staged digest table) is kept. Other columns
    are never read, whatever their names. An empty table gives no rows.
    """
    norm = normalise or (lambda c: c)
    texts = df.select(F.col(id_col).alias("doc_id"), norm(text_of(text_col)).alias("body"))
    rows = stage(texts.select("doc_id", _digest(F.col("body")).alias("sha")).withColumn("row_id", F.monotonically_increasing_id()), "exact-digests")
    hot_from = max(HOT_ROWS, int(rows.count() * HOT_SHARE))
    hot = stage(rows.groupBy("sha").count().where(F.col("count") >= hot_from).select("sha"), "exact-hot")

    bodies = texts.withColumn("sha", _digest(F.col("body")))
    cold = bodies.join(F.broadcast(hot), "sha", "left_anti").groupBy("sha", "body").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    salted = bodies.join(F.broadcast(hot), "sha", "left_semi").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    winners = salted.groupBy("sha", "salt", "body").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    merged = winners.groupBy("sha", "body").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    one = lambda groups: groups.groupBy("sha").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count("*").alias("texts"))
    cold, merged = (stage(one(g.drop("body")), name) for g, name in ((cold, "exact-cold"), (merged, "exact-merged")))
    shared = stage(cold.union(merged).where("texts > 1").select("sha"), "exact-shared")
    out = rows.join(F.broadcast(hot), "sha", "left_anti").join(cold, "sha").unionByName(rows.join(F.broadcast(merged), "sha"))
    out = out.where("texts = 1").drop("texts")
    # ties of id and text: every row but the first of its id and text stands down
    ties = stage(rows.groupBy("sha", "doc_id").agg(F.min("row_id").alias("first_row"), F.count("*").alias("n")).where("n > 1").drop("n"), "exact-ties")
    ties = _few(ties.select(F.col("sha").alias("tie_sha"), F.col("doc_id").alias("tie_id"), "first_row"))
    out = out.join(ties, (F.col("sha") == F.col("tie_sha")) & F.col("doc_id").eqNullSafe(F.col("tie_id")), "left").select("doc_id", "sha", "row_id", "keep_id", "group_size", "first_row")
    if shared.limit(1).count():
        out = out.unionByName(_told_apart(texts, shared))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.coalesce(F.col("row_id") == F.col("first_row"), F.lit(True))
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"), "row_id")


def _told_apart(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows of digests that different texts share, grouped and joined by their whole texts; row_id is below 0."""
    own = texts.withColumn("sha", _digest(F.col("body"))).join(_few(shared), "sha", "left_semi")
    own = stage(own.withColumn("row_id", -1 - F.monotonically_increasing_id()), "exact-apart")
    groups = own.groupBy("sha", "body").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    firsts = own.groupBy("sha", "body", F.col("doc_id").alias("tie_id")).agg(F.max("row_id").alias("first_row"))
    firsts = firsts.join(groups, ["sha", "body"]).select(F.col("sha").alias("s"), F.col("body").alias("b"), "tie_id", "first_row", "keep_id", "group_size")
    same = (F.col("sha") == F.col("s")) & (F.col("body") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("tie_id"))
    return own.join(firsts, same).select("doc_id", "sha", "row_id", "keep_id", "group_size", "first_row")


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the rows that exact_duplicates drops, columns and texts unchanged. Of rows that repeat id and text one stays."""
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0null"))
    own = [fresh(df, "key"), fresh(df, "sha")]
    keys = exact_duplicates(df, id_col, text_col).where("kept").select(key("doc_id").alias(own[0]), F.col("text_sha256").alias(own[1]))
    tagged = df.withColumn(own[0], key(id_col)).withColumn(own[1], _digest(text_of(text_col)))
    # the join leaves rows partitioned and sorted by its key, so that taking one of each needs no further shuffle
    return tagged.join(keys, own, "left_semi").dropDuplicates(own).drop(*own)
