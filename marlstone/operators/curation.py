"""Curation by independent witnesses: agreement with labels, three-way examination, cleaning with a breaker, assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.operators.scoring import same, share

#: Outcomes of a three-way examination, from both witnesses agreeing with the label to neither and no agreement.
BUCKETS = ("A", "B", "C", "D", "E")


def agreement(rows: DataFrame, rt: Column, sk: Column, true_rt: Column, true_sk: Column) -> DataFrame:
    """``rows`` with rt_match, sk_match and bucket: white (both), partial (one) or discard; here null equals null and nothing else."""
    a, b = rt.eqNullSafe(true_rt), sk.eqNullSafe(true_sk)
    bucket = F.when(a & b, "white").when(a | b, "partial").otherwise("discard")
    return rows.withColumn("rt_match", a).withColumn("sk_match", b).withColumn("bucket", bucket)


def agreed_twice(rows: DataFrame, first: tuple[Column, Column], second: tuple[Column, Column]) -> DataFrame:
    """``rows`` with agreed, and pseudo_rt and pseudo_sk where two passes give the same non-empty letters."""
    full = lambda c: F.coalesce(c, F.lit("")) != ""
    ok = same(first[0], second[0]) & same(first[1], second[1]) & full(first[0]) & full(first[1])
    return rows.withColumn("agreed", ok).withColumn("pseudo_rt", F.when(ok, first[0])).withColumn("pseudo_sk", F.when(ok, first[1]))


def asset_fate(inside: Column | None, attributes: Column, chain: Column) -> Column:
    """outside (of a trusted list, where there is one; an empty list trusts nothing), incomplete (no attributes or chain) or asset."""
    whole = attributes.isNotNull() & (F.coalesce(chain, F.lit("")) != "")
    fate = F.when(whole, "asset").otherwise("incomplete")
    return fate if inside is None else F.when(~F.coalesce(inside, F.lit(False)), "outside").otherwise(fate)


def examined(model: Column, labeler: Column, true: Column) -> Column:
    """The bucket of a label given two witnesses: A both agree with it, B only the labeler, C only the model, D neither but with one another, E none. Null equals null."""
    m, z = model.eqNullSafe(true), labeler.eqNullSafe(true)
    return F.when(m & z, "A").when(z, "B").when(m, "C").when(model.eqNullSafe(labeler), "D").otherwise("E")


def bucket_table(rows: DataFrame, by: str, bucket: str, total: str = "__ALL__") -> DataFrame:
    """``by``, n, a count and a share of each bucket by class, with a total row, the classes with the greatest share of D first."""
    counts = [F.count_if(F.col(bucket) == b).alias(b) for b in BUCKETS]
    got = rows.rollup(by).agg(F.grouping(by).alias("_all"), F.count("*").alias("n"), *counts)
    named = F.when(F.col("_all") == 1, total).otherwise(F.col(by))
    return got.select(named.alias(by), "n", *BUCKETS, *[share(F.col(b), F.col("n")).alias(f"{b}_share") for b in BUCKETS], "_all").orderBy("_all", F.desc("D_share"), by).drop("_all")


def cleaned(rows: DataFrame, suspects: DataFrame, key: str, by: str, exempt: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, report) once suspects' rows are dropped, by key: rows of the exempt class condemn no key, but go with a key that another row condemns.

    report: ``by``, before, dropped, after, fraction (of the class that is condemned), change (of the class's share).
    """
    ids = suspects.select(key).distinct().withColumn("_s", F.lit(True))
    marked = rows.join(ids, key, "left").withColumn("_hit", F.coalesce("_s", F.lit(False)) & ~F.coalesce(F.col(by) == exempt, F.lit(False))).drop("_s")
    gone = marked.filter("_hit").select(key).distinct().withColumn("_gone", F.lit(True))
    both = marked.join(gone, key, "left").withColumn("_gone", F.coalesce("_gone", F.lit(False)))
    kept = both.filter(~F.col("_gone")).select(*rows.columns)
    counts = both.groupBy(by).agg(F.count("*").alias("before"), F.count_if("_hit").alias("dropped"), F.count_if(~F.col("_gone")).alias("after"))
    every = Window.partitionBy(F.lit(0))  # over one row a class
    full = counts.withColumn("_b", F.sum("before").over(every)).withColumn("_a", F.sum("after").over(every)).withColumn("fraction", share(F.col("dropped"), F.col("before")))
    change = F.round(F.coalesce(F.try_divide(F.col("after"), F.col("_a")), F.lit(0.0)) - F.coalesce(F.try_divide(F.col("before"), F.col("_b")), F.lit(0.0)), 6)
    return kept, full.select(by, "before", "dropped", "after", "fraction", change.alias("change"))


def breaker(report: DataFrame, by: str, most: float = 0.20) -> None:
    """Raise if a class of a cleaning report would lose more than ``most`` of its rows; the report is one row a class."""
    over = report.filter(F.col("fraction") > most).select(by, "fraction").orderBy(F.desc("fraction")).limit(5).collect()
    if over:
        raise RuntimeError("cleaning stops: " + ", ".join(f"{r[0]} would lose {r[1]:.0%}" for r in over))
