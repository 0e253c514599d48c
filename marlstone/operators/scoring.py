"""Scores of predictions against labels: confusions, precision and recall, rates, accuracies and shares.

All are one pass of conditional sums, or counts by pairs of letters (a bounded number of rows) from which the rest follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone import vocab
from marlstone.functions.outputs import group_of

ROUND = 6


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing; to ROUND places, so that engines agree."""
    return F.round(F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0)), ROUND)


def same(a: Column, b: Column) -> Column:
    """Whether both are there and equal."""
    return F.coalesce(a == b, F.lit(False))


def confusions(pairs: DataFrame, axes: dict[str, tuple[Column, Column]], order: str | None = None) -> DataFrame:
    """axis, gt, pred, n, and with ``order`` the first place of each pair of letters, over all axes in one pass."""
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), g.cast("string").alias("gt"), p.cast("string").alias("pred")) for a, (g, p) in axes.items()]))
    kept = pairs.select(each.alias("x"), *([order] if order else []))
    more = [F.min(order).alias("first")] if order else []
    return kept.groupBy("x.axis", "x.gt", "x.pred").agg(F.count("*").alias("n"), *more)


def with_groups(counts: DataFrame) -> DataFrame:
    """The confusions of scenes (axis sk) rolled up to their parent groups (axis ks), beside the given ones.

    Letters without a group become ?; an unknown label with a failed prediction thus counts as right on this axis.
    """
    rolled = counts.filter("axis = 'sk'").select(F.lit("ks").alias("axis"), group_of(F.col("gt"), "?").alias("gt"), group_of(F.col("pred"), "?").alias("pred"), "n")
    return counts.select("axis", "gt", "pred", "n").union(rolled.groupBy("axis", "gt", "pred").agg(F.sum("n").alias("n")))


def per_class(counts: DataFrame, classes: dict[str, list[str]]) -> DataFrame:
    """axis, class, tp, fn, fp, support, precision, recall of every class, also of those that don't occur; ratios without cases are 0."""
    spark = counts.sparkSession
    known = spark.createDataFrame([(a, c) for a, cs in classes.items() for c in cs], "axis string, class string")
    hit = F.coalesce(F.col("gt") == F.col("pred"), F.lit(False))
    sides = counts.select("axis", F.explode(F.array(F.struct(F.col("gt").alias("class"), F.lit(True).alias("own")), F.struct(F.col("pred").alias("class"), F.lit(False).alias("own")))).alias("s"), "n", hit.alias("hit"))
    own = F.col("s.own")
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    got = sides.groupBy("axis", "s.class").agg(n(own & F.col("hit")).alias("tp"), n(own & ~F.col("hit")).alias("fn"), n(~own & ~F.col("hit")).alias("fp"))
    out = F.broadcast(known).join(got, ["axis", "class"], "left").na.fill(0, ["tp", "fn", "fp"])
    tp, fn, fp = F.col("tp"), F.col("fn"), F.col("fp")
    return out.select("axis", "class", "tp", "fn", "fp", (tp + fn).alias("support"), share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"))


def accuracies(counts: DataFrame) -> DataFrame:
    """axis, total, correct, accuracy."""
    right = F.sum(F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0)).cast("long")
    out = counts.groupBy("axis").agg(F.sum("n").cast("long").alias("total"), right.alias("correct"))
    return out.withColumn("accuracy", share(F.col("correct"), F.col("total")))


def rates(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """n, and the share of rows with each flag."""
    return rows.agg(F.count("*").alias("n"), *[share(F.count_if(c), F.count("*")).alias(k) for k, c in flags.items()])


def hotspots(counts: DataFrame, pairs: dict[str, tuple[tuple[str, str], ...]]) -> DataFrame:
    """axis, gt, pred, n of pairs that are often confused, in both directions, 0 where they don't occur."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame([(a, x, y) for a, ps in pairs.items() for p in ps for x, y in (p, p[::-1])], "axis string, gt string, pred string")
    return F.broadcast(wanted).join(counts.select("axis", "gt", "pred", "n"), ["axis", "gt", "pred"], "left").na.fill(0, ["n"])


def suite(rows: DataFrame, rt: Column, sk: Column, true_rt: Column, true_sk: Column, missing: Column, parsed: Column) -> DataFrame:
    """One row of accuracies over every label; a missing prediction is wrong in each, but not in the format rate."""
    n = F.count("*")
    group = same(group_of(sk), group_of(true_sk))
    safe = F.coalesce(true_sk.isin(*vocab.SAFETY_REPORTED), F.lit(False))
    return rows.agg(
        n.alias("n"),
        F.count_if(missing).alias("missing"),
        share(F.count_if(parsed), n - F.count_if(missing)).alias("format"),
        share(F.count_if(same(rt, true_rt)), n).alias("rt"),
        share(F.count_if(same(sk, true_sk)), n).alias("sk"),
        share(F.count_if(same(rt, true_rt) & same(sk, true_sk)), n).alias("both"),
        share(F.count_if(group), n).alias("ks"),
        F.count_if(safe).alias("safety_n"),
        share(F.count_if(safe & same(sk, true_sk)), F.count_if(safe)).alias("safety_recall"),
    )


def class_hits(rows: DataFrame, by: list[str], sk: Column, true_sk: Column) -> DataFrame:
    """``by``, n, hit, recall: labels of each class and how many are right."""
    hit = F.count_if(same(sk, true_sk))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), hit.alias("hit"), share(hit, F.count("*")).alias("recall"))


def top_confusions(counts: DataFrame, totals: DataFrame, k: int) -> DataFrame:
    """Per axis the ``k`` most frequent pairs (ties by first appearance) with their share of the label's rows and whether they map one to one (over half of them, and wrong)."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("axis").orderBy(F.desc("n"), "first"))
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= k)
    part = F.col("n") / F.greatest(F.coalesce("total", F.lit(0)), F.lit(1))
    out = top.join(F.broadcast(totals.select(F.col("axis").alias("_a"), F.col("gt").alias("_g"), "total")), (F.col("axis") == F.col("_a")) & F.col("gt").eqNullSafe(F.col("_g")), "left")
    mapped = (part > 0.5) & ~same(F.col("gt"), F.col("pred"))
    return out.select("axis", "rank", "gt", "pred", "n", F.round(part.cast("double"), ROUND).alias("share"), mapped.alias("one_to_one"))
