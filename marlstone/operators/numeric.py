"""Numbers over groups and in order: advantages, partners in a batch, losses, early stops, averages of tensors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import arrays
from marlstone.operators.prefix import numbered
from marlstone.operators.scoring import ROUND

#: A group whose advantages all lie below this teaches nothing.
FLAT = 1e-9


def advantages(rows: DataFrame, group: str, reward: Column) -> DataFrame:
    """``rows`` with reward, advantage (reward less its group's mean) and keep (some advantage of the group isn't 0).

    Means come from a grouped sum that is joined back, so a group of any size is never gathered.
    """
    rows = rows.withColumn("reward", reward)
    per = rows.groupBy(group).agg(F.avg("reward").alias("_mean"), F.max("reward").alias("_hi"), F.min("reward").alias("_lo"))
    both = rows.join(per.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")))
    keep = F.greatest(F.abs(F.col("_hi") - F.col("_mean")), F.abs(F.col("_lo") - F.col("_mean"))) > FLAT
    return both.withColumn("advantage", F.col("reward") - F.col("_mean")).withColumn("keep", keep).drop("_g", "_mean", "_hi", "_lo")


def partners(rows: DataFrame, order: str, size: int) -> DataFrame:
    """``order``, partner: within each batch of ``size`` rows the one before it, the first row's being the last: mismatched pairs."""
    placed = numbered(rows.select(order), [order]).withColumn("batch", F.floor((F.col("number") - 1) / size))
    w = Window.partitionBy("batch").orderBy(order)
    last = F.last(order).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return placed.select(order, F.coalesce(F.lag(order).over(w), last).alias("partner"))


def preference(rows: DataFrame, policy: Column, reference: Column, desirable: Column, batch: str, beta: float = 0.1, w_desirable: float = 1.0, w_undesirable: float = 1.0) -> DataFrame:
    """``batch``, n, kl (the batch's mean log ratio, not below 0), loss, rewards of desirable and undesirable rows (0 without any)."""
    rows = rows.select(batch, (policy - reference).alias("_r"), desirable.alias("_d"))
    kl = rows.groupBy(batch).agg(F.greatest(F.avg("_r"), F.lit(0.0)).alias("kl"))
    both = rows.join(kl.withColumnRenamed(batch, "_b"), F.col(batch).eqNullSafe(F.col("_b")))
    loss = arrays.preference_loss(F.col("_r"), F.col("kl"), F.col("_d"), beta, w_desirable, w_undesirable)
    mean = lambda c: F.coalesce(F.avg(F.when(c, beta * F.col("_r"))), F.lit(0.0))
    r = lambda c: F.round(c, ROUND)
    return both.groupBy(batch).agg(F.count("*").alias("n"), r(F.max("kl")).alias("kl"), r(F.avg(loss)).alias("loss"), r(mean(F.col("_d"))).alias("reward_desirable"), r(mean(~F.col("_d"))).alias("reward_undesirable"))


def early_stops(rows: DataFrame, run: str, order: list[str], loss: str, patience: int) -> DataFrame:
    """``run``, steps, best, best_step, stop_step: where each run would stop after ``patience`` values in a row without a strictly better one (null: never), and the best until then.

    A run is ordered in one task, as its result depends on its order; a run's history is short next to the table.
    """
    w = Window.partitionBy(run).orderBy(*order)
    before = F.min(loss).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("_i", F.row_number().over(w).cast("long")).withColumn("_better", F.coalesce(F.col(loss) < before, F.col(loss).isNotNull() & before.isNull()))
    last = F.max(F.when(F.col("_better"), F.col("_i"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("_since", F.col("_i") - F.coalesce(last, F.lit(0)))
    stop = F.min(F.when(F.col("_since") >= patience, F.col("_i"))).over(Window.partitionBy(run))
    used = marked.withColumn("_stop", stop).filter(F.col("_stop").isNull() | (F.col("_i") <= F.col("_stop")))
    return used.groupBy(run).agg(F.count("*").alias("steps"), F.min(loss).alias("best"), F.max(F.when(F.col("_better"), F.col("_i"))).alias("best_step"), F.max("_stop").alias("stop_step"))


def mean_vectors(rows: DataFrame, by: str, vector: str) -> DataFrame:
    """``by``, i, mean: the elementwise mean of arrays, a row for each place."""
    each = rows.select(by, F.posexplode(vector).alias("i", "x"))
    return each.groupBy(by, F.col("i").cast("long").alias("i")).agg(F.avg(F.col("x").cast("double")).alias("mean"))


def vector_stats(rows: DataFrame, by: str, vector: str) -> DataFrame:
    """``by``, n (elements), largest (absolute), rms, and mean, least and median of the rows' mean squares."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    energy = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    each = rows.select(by, F.size(vector).alias("k"), energy.alias("e"), F.array_max(F.transform(v, F.abs)).alias("m")).filter("k > 0")
    got = each.groupBy(by).agg(F.sum("k").alias("n"), F.max("m").alias("largest"), F.sqrt(F.sum("e") / F.sum("k")).alias("rms"), F.avg(F.col("e") / F.col("k")).alias("mean_energy"), F.min(F.col("e") / F.col("k")).alias("least_energy"), F.percentile(F.col("e") / F.col("k"), 0.5).alias("median_energy"))
    return got.select(by, "n", *[F.round(c, ROUND).alias(c) for c in ("largest", "rms", "mean_energy", "least_energy", "median_energy")])


def averaged_bags(rows: DataFrame, bag: str, key: str, vector: str) -> DataFrame:
    """``key``, i, mean: tensors averaged over all bags that hold them if every bag does, else as the first bag has them; differing sizes raise.

    ``rows`` has one row for each bag and key; bags are few.
    """
    n = F.count_distinct(bag)
    bags = rows.agg(n).first()[0]
    per = rows.groupBy(key).agg(n.alias("_n"), F.min(bag).alias("_first"), F.min(F.size(vector)).alias("_lo"), F.max(F.size(vector)).alias("_hi"))
    per = per.withColumn("_n", F.when(F.col("_lo") == F.col("_hi"), F.col("_n")).otherwise(F.raise_error(F.concat(F.lit("sizes differ: "), F.col(key).cast("string")))))
    both = rows.join(per, key).filter((F.col("_n") == bags) | (F.col(bag) == F.col("_first")))
    each = both.select(key, F.posexplode(vector).alias("i", "x"))
    return each.groupBy(key, F.col("i").cast("long").alias("i")).agg(F.avg(F.col("x").cast("double")).alias("mean"))


def regressions(before: DataFrame, after: DataFrame, key: str, value: str, most: float) -> DataFrame:
    """``key``, before, after, drop: measures that fell by more than ``most``."""
    both = before.select(key, F.col(value).alias("before")).join(after.select(key, F.col(value).alias("after")), key)
    return both.withColumn("drop", F.round(F.col("before") - F.col("after"), ROUND)).filter(F.col("drop") > most)
