"""Health of labelled data sets: repetition, shares, drift between splits, coverage of open keys, texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.texts import word_count, word_list
from marlstone.operators.scoring import ROUND, share


def repetition(rows: DataFrame, by: str, key: Column, group: Column, most: float = 1.5) -> DataFrame:
    """``by``, rows, ids, groups, ratio, copied: rows of a class against its distinct ids and groups; copied where the ratio exceeds ``most``."""
    got = rows.select(by, key.alias("_id"), group.alias("_group")).groupBy(by).agg(F.count("*").alias("rows"), F.count_distinct("_id").alias("ids"), F.count_distinct("_group").alias("groups"))
    ratio = F.col("rows") / F.greatest("ids", F.lit(1))
    return got.select(by, "rows", "ids", "groups", F.round(ratio, ROUND).alias("ratio"), (ratio > most).alias("copied"))


def shares(rows: DataFrame, axes: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """``by``, axis, letter, n, p: the share of each letter (a bounded vocabulary) on its axis; the shares of an axis sum to 1."""
    by = by or []
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), c.cast("string").alias("letter")) for a, c in axes.items()]))
    counts = rows.select(*by, each.alias("x")).groupBy(*by, "x.axis", "x.letter").agg(F.count("*").alias("n"))
    return counts.withColumn("p", share(F.col("n"), F.sum("n").over(Window.partitionBy(*by, "axis"))))


def drift(counts: DataFrame, a: str, b: str, flag: float = 0.05) -> DataFrame:
    """axis, letter, p of either split (columns ``p_<split>``), diff, shifted, only: what of ``shares`` by split differs between splits ``a`` and ``b``; letters of one split alone too."""
    p = lambda s: F.coalesce(F.max(F.when(F.col("split") == s, F.col("p"))), F.lit(0.0))
    both = counts.filter(F.col("split").isin(a, b)).groupBy("axis", "letter").agg(p(a).alias(f"p_{a}"), p(b).alias(f"p_{b}"), F.collect_set("split").alias("_s"))
    diff = F.round(F.col(f"p_{a}") - F.col(f"p_{b}"), ROUND)
    out = both.withColumn("diff", diff).withColumn("shifted", F.abs(diff) > flag)
    return out.withColumn("only", F.when(F.size("_s") == 1, F.col("_s")[0])).drop("_s").orderBy(F.desc(F.abs("diff")), "axis", "letter")


def key_coverage(rows: DataFrame, open_keys: str, by: str) -> DataFrame:
    """``by``, key, n, share: non-null values of each open key among all rows of a split; keys are found, not told.

    A key that a split never holds has no row there.
    """
    totals = rows.groupBy(by).agg(F.count("*").alias("total"))
    held = rows.select(by, F.explode(open_keys).alias("key", "value")).filter("value is not null").groupBy(by, "key").agg(F.count("*").alias("n"))
    return held.join(F.broadcast(totals), by).select(by, "key", "n", share(F.col("n"), F.col("total")).alias("share"))


def word_stats(rows: DataFrame, text: Column, by: str) -> DataFrame:
    """``by``, rows, mean_words, median_words: the upper median, from counts by length, so no split is sorted in one task."""
    counts = rows.select(by, word_count(text).cast("long").alias("w")).groupBy(by, "w").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(by).orderBy("w"))
    total = F.sum("n").over(Window.partitionBy(by))
    placed = counts.withColumn("_upto", upto).withColumn("_total", total)
    median = F.min(F.when(F.col("_upto") > F.floor(F.col("_total") / 2), F.col("w")))
    return placed.groupBy(by).agg(F.sum("n").alias("rows"), F.round(F.sum(F.col("n") * F.col("w")) / F.sum("n"), ROUND).alias("mean_words"), median.alias("median_words"))


def top_words(rows: DataFrame, text: Column, by: str, k: int) -> DataFrame:
    """``by``, word, n: the k most frequent lower-case words of each split, ties by word."""
    words = rows.select(by, F.explode(word_list(F.lower(F.coalesce(text, F.lit(""))))).alias("word")).groupBy(by, "word").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "word"))
    return words.withColumn("_r", rank).filter(F.col("_r") <= k).drop("_r")


def jaccard(members: DataFrame, by: str, a: str, b: str, value: str) -> DataFrame:
    """shared, together, jaccard of the distinct values of two splits."""
    sets = members.filter(F.col(by).isin(a, b)).groupBy(value).agg(F.count_distinct(by).alias("_n"))
    return sets.agg(F.count_if(F.col("_n") == 2).alias("shared"), F.count("*").alias("together")).withColumn("jaccard", share(F.col("shared"), F.col("together")))
