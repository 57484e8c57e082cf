"""Group-aware splits, carves and samples."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.sources import sequence

#: The seeded shuffle of the parity split needs the group list on the driver; more groups than this are refused.
SHUFFLE_GROUPS = 5_000_000


def split_sizes(n: int, val: float = 0.05, test: float = 0.05) -> tuple[int, int]:
    """(validation, test) groups of n: half-even rounding, at least one each from three groups on, one left for training."""
    if n < 3:
        return (1 if n == 2 else 0), 0
    n_test = min(max(1, round(n * test)), n - 2)
    return min(max(1, round(n * val)), n - n_test - 1), n_test


def seeded_group_split(df: DataFrame, group: str, seed: int = 42, val: float = 0.05, test: float = 0.05) -> DataFrame:
    """df with `split`: sorted groups, shuffled with a seeded Mersenne twister; the first are test, the next val, the rest train. Rows without a group are train."""
    spark = df.sparkSession
    groups = sorted(r[0] for r in df.where(F.col(group).isNotNull()).select(group).distinct().limit(SHUFFLE_GROUPS + 1).collect())
    if len(groups) > SHUFFLE_GROUPS:
        raise ValueError("too many groups for a shuffle on the driver; use hashed_group_split")
    random.Random(seed).shuffle(groups)
    n_val, n_test = split_sizes(len(groups), val, test)
    if len(groups) == 2:
        named = dict(zip(groups, ("train", "val"), strict=True))
    else:
        named = {g: "test" if k < n_test else "val" if k < n_test + n_val else "train" for k, g in enumerate(groups)}
    table = spark.createDataFrame(list(named.items()), f"{group} {df.schema[group].dataType.simpleString()}, split string")
    return df.join(table, group, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def hashed_group_split(df: DataFrame, group: str, seed: int = 42, val: float = 0.05, test: float = 0.05) -> DataFrame:
    """df with `split` by the hash of seed and group: no list of groups, no sort, the same whatever else the table holds."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(group).cast("string"))), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    return df.withColumn("split", F.when(h < test, "test").when(h < test + val, "val").otherwise("train"))


def first_not_excluded(df: DataFrame, excluded: DataFrame, key: str, order: str, n: int) -> DataFrame:
    return df.join(excluded.select(key).distinct(), key, "left_anti").orderBy(order).limit(n)


def hash_sample(df: DataFrame, key: str, one_in: int, hasher=F.crc32) -> DataFrame:
    """One in so many rows by the hash of their content."""
    return df.where(hasher(F.col(key)) % one_in == 0)


def inject_first_share(df: DataFrame, order: str, messages: str, message, share: int = 4) -> DataFrame:
    """The first 1/share of the rows (one at least) get a message in front."""
    n = max(df.count() // share, 1)
    ranked = sequence(df, order)
    return ranked.withColumn(messages, F.when(F.col("seq") < n, F.concat(F.array(message), F.col(messages))).otherwise(F.col(messages))).drop("seq")


def _shuffled(df: DataFrame, order: str, seed: int) -> DataFrame:
    """df with `seq`, dense in the order of a hash of seed and key; no list of keys on the driver."""
    return sequence(df, F.md5(F.concat(F.lit(f"{seed}:"), F.col(order).cast("string"))), order)


def fallback_carve(df: DataFrame, order: str, n_val: int, n_test: int, seed: int = 42) -> DataFrame:
    """df with `split` where no split files exist: the first n_val of the shuffled rows are val, the next n_test test, each a tenth of all at most (one at least), the rest train."""
    most = max(df.count() // 10, 1)
    val, test = min(n_val, most), min(n_test, most)
    return _shuffled(df, order, seed).withColumn("split", F.when(F.col("seq") < val, "val").when(F.col("seq") < val + test, "test").otherwise("train")).drop("seq")


def seeded_subsample(df: DataFrame, order: str, n: int | None, seed: int = 42) -> DataFrame:
    """n rows of the shuffled ones, in their own order; all for none, 0, or as many as there are."""
    return df.orderBy(order) if not n or n >= df.count() else _shuffled(df, order, seed).where(F.col("seq") < n).drop("seq").orderBy(order)
