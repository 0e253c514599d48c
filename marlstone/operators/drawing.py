"""Splits, samples, weights and batches with a defined order: md5 of a seed and a key, the same in every run and partitioning.

Ranks within a class are limited before the shuffle (ranked windows with a literal limit); numbers over a whole table come
from running sums by parts. Nothing is ordered in one task but what a quota bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.operators.keyed import first_rows
from marlstone.operators.prefix import numbered, running_sum
from marlstone.operators.scoring import ROUND
from marlstone.stages import stage


def shuffle_key(seed: str, *key: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *[k.cast("string") for k in key]))


def group_split(rows: DataFrame, group: Column, key: str, val_size: int, seed: str = "split") -> DataFrame:
    """``rows`` with side: val, train or dropped. Whole groups, in shuffled order, are taken for val until it has ``val_size`` rows.

    Train is every row whose key isn't in val; a row outside val whose key stands in val is dropped. Null groups are
    one group. At most ``val_size`` groups are taken.
    """
    marked = rows.withColumn("_g", F.coalesce(group.cast("string"), F.lit("")))
    sizes = marked.groupBy("_g").agg(F.count("*").alias("_n")).withColumn("_h", shuffle_key(seed, F.col("_g")))
    taken = running_sum(sizes, ["_h", "_g"], F.col("_n")).filter(F.col("running") - F.col("_n") < val_size).select("_g", F.lit(True).alias("_val"))
    marked = marked.join(taken, "_g", "left").withColumn("_val", F.coalesce("_val", F.lit(False)))
    ids = marked.filter("_val").select(key).distinct().withColumn("_in", F.lit(True))
    side = F.when(F.col("_val"), "val").when(F.col("_in"), "dropped").otherwise("train")
    return marked.join(ids, key, "left").withColumn("side", side).select(*rows.columns, "side")


def ranked(rows: DataFrame, by: str, order: list, most: int, name: str = "rank") -> DataFrame:
    """Of each class the first ``most`` rows, with their rank from 1."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col(name) <= most)


def quota_sample(rows: DataFrame, key: str, first: dict[str, int], extra: dict[str, int], second: dict[str, int], size: int, sk: str = "sk", rt: str = "rt", seed: str = "quota") -> DataFrame:
    """``key``, stratum of a sample of ``rows`` (unique keys) drawn in stages without replacement, in one shuffled order.

    First each class of ``first`` up to its cap, then those of ``extra`` from what is left, then roles of ``second``
    from what is left, then any rows up to ``size``. A class in both maps may give both caps. Strata are named.
    """
    rows = stage(rows.select(key, sk, rt).withColumn("_h", shuffle_key(seed, F.col(key))))
    caps = {c: first.get(c, 0) + extra.get(c, 0) for c in [*first, *extra]}
    upto = lambda c, of: F.coalesce(F.create_map(*[F.lit(x) for kv in of.items() for x in kv])[c], F.lit(0))
    a = ranked(rows.filter(F.col(sk).isin(*caps)), sk, ["_h", key], max(caps.values()))
    a = a.filter(F.col("rank") <= upto(F.col(sk), caps))
    a = a.select(key, F.concat(F.when(F.col("rank") <= upto(F.col(sk), first | {c: 0 for c in extra if c not in first}), "first_").otherwise("extra_"), F.col(sk)).alias("stratum"))
    a = stage(a)
    left = rows.join(a.select(key), key, "left_anti")
    b = stage(ranked(left.filter(F.col(rt).isin(*second)), rt, ["_h", key], max(second.values())).filter(F.col("rank") <= upto(F.col(rt), second)).select(key, F.concat(F.lit("role_"), F.col(rt)).alias("stratum")))
    picked = a.unionByName(b)
    fill = left.join(b.select(key), key, "left_anti").orderBy("_h", key).limit(max(0, size - picked.count()))
    return picked.unionByName(fill.select(key, F.lit("fill").alias("stratum")))


def audit_sample(rows: DataFrame, key: str, stratum: Column, quotas: dict[str, int], seed: str = "audit") -> DataFrame:
    """``rows`` drawn by mutually exclusive strata up to their quotas, with stratum, idx (over strata in the quotas' order) and gt_first (a coin by hash).

    Rows without a stratum aren't drawn. The result has at most the quotas' sum of rows.
    """
    drawn = ranked(rows.withColumn("stratum", stratum).filter(F.col("stratum").isin(*quotas)).withColumn("_h", shuffle_key(seed, F.col(key))), "stratum", ["_h", key], max(quotas.values()))
    place = F.create_map(*[F.lit(x) for i, (k, q) in enumerate(quotas.items()) for x in (k, F.struct(F.lit(i).alias("i"), F.lit(q).alias("q")))])[F.col("stratum")]
    drawn = drawn.withColumn("_p", place).filter(F.col("rank") <= F.col("_p.q"))
    coin = F.substring(shuffle_key(seed + "-coin", F.col(key)), 1, 1) < "8"
    idx = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_p.i", "rank"))
    return drawn.withColumn("idx", idx.cast("long")).withColumn("gt_first", coin).drop("_h", "_p", "rank")


def audit_scores(key: DataFrame, verdicts: DataFrame) -> DataFrame:
    """stratum, n, gt_win, model_win, both, neither, unsure, accepted: verdicts (idx, verdict) against the key (idx, stratum, gt_first); blank and unknown verdicts count in n only, null ones not."""
    v = F.lower(F.trim("verdict"))
    rows = key.join(verdicts.filter(F.coalesce(F.trim("verdict"), F.lit("")) != ""), "idx")
    gt = F.when(F.col("gt_first"), "1").otherwise("2")
    n = lambda c: F.count_if(c)
    got = rows.groupBy("stratum").agg(n(F.lit(True)).alias("n"), n(v.isin("1", "2") & (v == gt)).alias("gt_win"), n(v.isin("1", "2") & (v != gt)).alias("model_win"), *[n(v == k).alias(k) for k in ("both", "neither", "unsure")])
    return got.withColumn("accepted", F.round((F.col("gt_win") + F.col("both")) / F.col("n"), ROUND))


def hard_weights(rows: DataFrame, key: str, by: str, wrong: Column, trusted: Column | None, weight: float = 3.0, cap: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """(``key``, weight of every row; ``by``, n, hard, weight, mass of the classes with hard rows).

    A wrong row is hard if it is trusted (all are where ``trusted`` is None). A class's weight is ``weight``, but its mass
    may grow by ``cap`` at most; a cap of 0 limits nothing.
    """
    hard = F.coalesce(wrong, F.lit(False)) if trusted is None else F.coalesce(wrong & trusted, F.lit(False))
    marked = rows.select(key, by, hard.alias("_hard"))
    per = marked.groupBy(by).agg(F.count("*").alias("n"), F.count_if("_hard").alias("hard")).filter("hard > 0")
    w = F.least(F.lit(float(weight)), 1.0 + (cap - 1.0) * F.col("n") / F.col("hard")) if cap else F.lit(float(weight))
    per = per.withColumn("weight", w).withColumn("mass", (F.col("n") + (F.col("weight") - 1) * F.col("hard")) / F.col("n"))
    small = F.broadcast(per.select(F.col(by).alias("_by"), F.col("weight").alias("_w")))  # one row a class
    each = marked.join(small, F.col(by).eqNullSafe(F.col("_by")), "left")
    return each.select(key, F.when(F.col("_hard"), F.col("_w")).otherwise(1.0).alias("weight")), per


def replicated(rows: DataFrame, order: str, weight: Column, places: int = 3) -> DataFrame:
    """``rows`` with copies: a streaming largest remainder of weights of at least 1, in ``order``; the copies sum to the floor of the weights' sum.

    Weights are decimals of ``places`` digits, so sums are exact; null weights are 1.
    """
    w = F.greatest(F.coalesce(weight, F.lit(1)).cast(f"decimal(18,{places})"), F.lit(1).cast(f"decimal(18,{places})"))
    summed = running_sum(rows.withColumn("_weight", w), [order], F.col("_weight"), "_sum")
    n = F.floor("_sum") - F.floor(F.col("_sum") - F.col("_weight"))
    return summed.withColumn("copies", n.cast("long")).drop("_sum", "_weight")


def mixed_batches(rows: DataFrame, key: list[str], minor: Column, size: int, n_minor: int, seed: str = "batch") -> DataFrame:
    """``key``, minor, batch (from 0): batches of ``size`` rows of which exactly ``n_minor`` are from the minority.

    The majority, shuffled, decides the number of full batches, the rest is left out; the minority is used again, in
    another order, as often as needed. Without a minority all rows are shuffled into full batches.
    """
    marked = stage(rows.select(*key, F.coalesce(minor, F.lit(False)).alias("minor")))
    n, m = marked.agg(F.count("*"), F.count_if("minor")).first()
    take = min(n_minor, size - 1) if m else 0
    each = size - take
    major = marked.filter(~F.col("minor")) if take else marked
    n_batches = (n - m if take else n) // each
    major = numbered(major.withColumn("_h", shuffle_key(seed, *[F.col(k) for k in key])), ["_h", *key])
    out = major.withColumn("batch", F.floor((F.col("number") - 1) / each)).select(*key, "minor", "batch")
    if take and n_batches:
        rounds = -(-n_batches * take // m)
        again = marked.filter("minor").withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
        again = numbered(again.withColumn("_h", shuffle_key(seed, F.col("_c"), *[F.col(k) for k in key])), ["_c", "_h", *key])
        out = out.union(again.select(*key, "minor", F.floor((F.col("number") - 1) / take).alias("batch")))
    return out.filter(F.col("batch") < n_batches)


def epoch_order(rows: DataFrame, key: str, epochs: int, seed: str = "epoch") -> DataFrame:
    """``key``, epoch, place (from 0 in each epoch): every epoch a permutation of the rows (unique keys)."""
    n = rows.count()
    each = rows.select(key).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(epochs - 1).cast("long"))))
    got = numbered(each.withColumn("_h", shuffle_key(seed, F.col("epoch"), F.col(key))), ["epoch", "_h", key])
    return got.select(key, "epoch", (F.col("number") - 1 - F.col("epoch") * n).alias("place"))


def rank_shares(rows: DataFrame, order: str, world: int) -> DataFrame:
    """``rows`` with rank (from 0): as many for each rank, in turn by ``order``; the last few that don't fill a turn are left out."""
    got = numbered(rows, [order])
    whole = rows.count() // world * world
    return got.filter(F.col("number") <= whole).withColumn("rank", F.pmod(F.col("number") - 1, F.lit(world))).drop("number")


def priority_sample(rows: DataFrame, key: str, preferred: Column, n: int, order: str, seed: str = "spot") -> DataFrame:
    """``key``: two thirds of ``n`` from the preferred rows, the rest from any, without repetition, in shuffled order."""
    one = first_rows(rows.withColumn("_p", F.coalesce(preferred, F.lit(False))), key, order).withColumn("_h", shuffle_key(seed, F.col(key)))
    first = one.filter("_p").orderBy("_h", key).limit(n * 2 // 3).withColumn("_turn", F.lit(0))
    rest = one.orderBy("_h", key).limit(n).withColumn("_turn", F.lit(1))  # holds enough, as first gives at most n * 2 // 3 of them
    both = first.unionByName(rest)
    return both.groupBy(key).agg(F.min("_turn").alias("turn"), F.min("_h").alias("_h")).orderBy("turn", "_h", key).limit(n).select(key, "turn")


def rounds(rows: DataFrame, key: str, k: int, n_rounds: int, seed: str = "round") -> DataFrame:
    """round, ``key``: ``k`` different rows for each round (unique keys)."""
    each = rows.select(key).withColumn("round", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_rounds - 1).cast("long"))))
    return ranked(each.withColumn("_h", shuffle_key(seed, F.col("round"), F.col(key))), "round", ["_h", key], k).select("round", key)


def latest(rows: DataFrame, name: str, n: int) -> DataFrame:
    """The ``n`` rows whose name ends in the greatest numbers (before any file ending), ties by name."""
    number = F.regexp_extract(F.col(name), r"([0-9]+)(?:\.[A-Za-z0-9]*)?$", 1).try_cast("decimal(38,0)")
    return rows.withColumn("suffix", number).filter("suffix is not null").orderBy(F.desc("suffix"), F.desc(name)).limit(n)


def micro_batches(rows: DataFrame, order: str, size: int) -> DataFrame:
    """``rows`` with batch (from 0): ``size`` rows each in ``order``, as a service takes them."""
    return numbered(rows, [order]).withColumn("batch", F.floor((F.col("number") - 1) / size)).drop("number")


def align_up(n: int, multiple: int) -> int:
    """``n`` raised to a multiple."""
    return -(-n // multiple) * multiple


def anneal_step(total: int, share: float) -> int:
    """The step from which the last ``share`` of training runs."""
    return int(total * (1 - share))
