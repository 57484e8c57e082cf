"""Loss histories and other series: jumps, early stops, as-of values, verdicts, budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def jumps(df: DataFrame, run: str, step: str, loss: str, limit: float = 0.25) -> DataFrame:
    """df with previous value and `jumped`: risen by more than limit from a positive one."""
    w = Window.partitionBy(run).orderBy(step)
    prev = F.lag(loss).over(w)
    return df.withColumn("previous", prev).withColumn("jumped", F.coalesce((F.col("previous") > 0) & ((F.col(loss) - F.col("previous")) / F.col("previous") > limit), F.lit(False)))


def early_stop(df: DataFrame, run: str, step: str, loss: str, patience: int = 3, threshold: float = 1e-3) -> DataFrame:
    """(run, stop_step): the first step with more than patience points of which the last patience all exceed the best so far by the threshold."""
    w = Window.partitionBy(run).orderBy(step)
    best = F.min(loss).over(w.rowsBetween(Window.unboundedPreceding, 0))
    recent = F.min(loss).over(w.rowsBetween(1 - patience, 0))
    stops = df.withColumns({"__n": F.row_number().over(w), "__best": best, "__recent": recent}).where((F.col("__n") > patience) & (F.col("__recent") > F.col("__best") + threshold))
    return stops.groupBy(run).agg(F.min(step).alias("stop_step"))


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str) -> DataFrame:
    """left with the value of right's last row at or before left_time, by one sort of both sides instead of a range join.

    Ties of right_time take the greatest value; without such a row the value is null.
    """
    a = left.withColumns({"__t": F.col(left_time), "__side": F.lit(1), "__v": F.lit(None).cast(right.schema[value].dataType)})
    b = right.select(key, F.col(right_time).alias("__t"), F.lit(0).alias("__side"), F.col(value).alias("__v"))
    both = a.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy("__t", "__side", "__v").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value + "_as_of", F.last("__v", ignorenulls=True).over(w)).where("__side = 1").drop("__t", "__side", "__v")


def extremes(df: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """(run, points, first, last, best, best_step): the first of equal bests."""
    return df.groupBy(run).agg(F.count("*").alias("points"), F.min_by(loss, step).alias("first"), F.max_by(loss, step).alias("last"), F.min(loss).alias("best"), F.min_by(step, F.struct(loss, step)).alias("best_step"))


def trend(evals: DataFrame, trains: DataFrame, run: str = "run", step: str = "step", loss: str = "loss") -> DataFrame:
    """(run, verdict): sparse, unstable, overfit, plateau or healthy, by fixed rules.

    unstable: a jump of over 25 %. overfit (outranks it): risen over 5 % from a best before the end while
    the train loss fell below that as of the best step. plateau: so risen without that fall, or a best in the first half.
    """
    e = extremes(evals, run, step, loss)
    jumped = jumps(evals, run, step, loss).groupBy(run).agg(F.max("jumped").alias("jumped"))
    order = Window.partitionBy(run).orderBy(step)
    index = evals.withColumn("__i", F.row_number().over(order) - 1).join(e.select(run, "best_step"), run).where(F.col(step) == F.col("best_step")).groupBy(run).agg(F.min("__i").alias("best_index"))
    last_train = trains.groupBy(run).agg(F.max_by(loss, step).alias("train_last"))
    at_best = trains.join(e.select(run, "best_step"), run).where(F.col(step) <= F.col("best_step")).groupBy(run).agg(F.max_by(loss, step).alias("train_at_best"))
    x = e.join(jumped, run).join(index, run).join(last_train, run, "left").join(at_best, run, "left")
    rose = F.when(F.col("best") > 0, (F.col("last") - F.col("best")) / F.col("best")).otherwise(0.0)
    late = (F.col("best_index") < F.col("points") - 1) & (rose > 0.05)
    early = (F.col("best_index") <= F.floor(F.col("points") / 2)) & (F.col("best_index") < F.col("points") - 1)
    verdict = F.when(F.col("points") < 2, "sparse").when(late & F.coalesce(F.col("train_last") < F.col("train_at_best"), F.lit(False)), "overfit").when(F.col("jumped"), "unstable").when(late | early, "plateau").otherwise("healthy")
    return x.select(run, verdict.alias("verdict"))


def budget_prefix(df: DataFrame, group: str, order: str, size: str, cap: int, budget: int) -> DataFrame:
    """Rows whose predecessors' capped sizes stay below the budget, so the last one may overshoot."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("used", F.coalesce(F.sum(F.least(F.col(size), F.lit(cap))).over(w), F.lit(0))).where(F.col("used") < budget)


def weighted_mean(df: DataFrame, key: str, total: str, weight: str) -> DataFrame:
    """(key, loss, perplexity): sum by sum, null for no weight."""
    loss = F.when(F.sum(weight) > 0, F.sum(total) / F.sum(weight))
    return df.groupBy(key).agg(loss.alias("loss")).withColumn("perplexity", F.bround(F.exp("loss"), 3))


def plan_batches(lengths: DataFrame, max_new: int, max_batch: int, budget: int, group: str = "grp", idx: str = "idx", length: str = "length") -> DataFrame:
    """(group, idx, batch): shortest first; a new batch where the size cap or batch size times width would exceed the budget. A group's plan is one fold."""

    def fold(rows):
        rows = rows.sort_values([length, idx], kind="stable")
        cap = 1 if budget <= 0 else max_batch if max_batch > 0 else len(rows)
        batch, n, out = 0, 0, []
        for size in rows[length]:
            if n and (n + 1 > cap or (n + 1) * (size + max_new) > budget):
                batch, n = batch + 1, 0
            n += 1
            out.append(batch)
        return rows.assign(batch=out)[[group, idx, "batch"]]

    kinds = {f.name: f.dataType.simpleString() for f in lengths.schema}
    return lengths.groupBy(group).applyInPandas(fold, f"{group} {kinds[group]}, {idx} {kinds[idx]}, batch long")
