"""Order-dependent deduplication in closed, set-based form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def ordered_dedup(df: DataFrame, seq: str, message: str, structural: str, exempt: str, cap: int = 10) -> DataFrame:
    """df with `verdict`: keep, exact or capped, as if rows came in the order of seq.

    A row whose message was kept before is `exact`. Else a row with a structural signature of
    which cap rows were kept is `capped`, and not remembered as seen, unless it is exempt or cap is -1.
    Closed form: the first row of a message is kept if it is uncapped, null-signed or among the
    first cap non-exempt candidates of its signature; if it isn't, the first exempt row of that message is.
    A null signature is never capped. Rows of one message have one signature.
    """
    s, free = F.col(seq), F.col(exempt) | F.col(structural).isNull() | F.lit(cap == -1)
    by_message = Window.partitionBy(message)
    one = df.withColumn("__first", s == F.min(s).over(by_message)).withColumn("__first_free", F.min(F.when(F.col(exempt), s)).over(by_message))
    candidate = F.col("__first") & ~free
    ranked = one.where(candidate).select(seq, (F.row_number().over(Window.partitionBy(structural).orderBy(seq)) <= cap).alias("__fits"))
    out = one.join(ranked, seq, "left")
    own = F.col("__first") & (free | F.coalesce("__fits", F.lit(False)))
    out = out.withColumn("__head_kept", F.max(own).over(by_message))
    kept_at = F.when(F.col("__head_kept"), F.min(F.when(F.col("__first"), s)).over(by_message)).otherwise(F.col("__first_free"))
    out = out.withColumn("__kept_at", kept_at)
    verdict = F.when(s == F.col("__kept_at"), "keep").when(s > F.col("__kept_at"), "exact").otherwise("capped")
    return out.withColumn("verdict", verdict).drop("__first", "__first_free", "__fits", "__head_kept", "__kept_at")


def hashed_key(*parts: Column) -> Column:
    """A compact shuffle key for wide texts."""
    return F.sha2(F.concat_ws("\0", *parts), 256)
