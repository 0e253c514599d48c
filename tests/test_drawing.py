from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.functions import arrays
from marlstone.operators import drawing, numeric
from marlstone.operators.prefix import numbered, running_sum


def test_running_sums_over_parts(spark):
    rows = spark.range(500).select((F.col("id") * 7919 % 503).alias("k"), (F.col("id") % 5).alias("w"))
    got = sorted((r.k, r.w, r.running) for r in running_sum(rows, ["k"], F.col("w"), parts=7).collect())
    total = 0
    for k, w, running in got:
        total += w
        assert running == total
    assert sorted(r.number for r in numbered(rows, ["k"], parts=3).collect()) == list(range(1, 501))
    assert running_sum(rows.limit(0), ["k"], F.col("w")).count() == 0


def test_whole_groups_go_to_one_side(spark):
    rows = spark.range(40).select(F.col("id"), F.concat(F.lit("v"), "id").alias("v"), F.concat(F.lit("c"), (F.col("id") % 10).cast("string")).alias("c"))
    got = drawing.group_split(rows, F.col("c"), "v", 8).collect()
    assert Counter(r.side for r in got) == {"val": 8, "train": 32} and {r.c for r in got if r.side == "val"}.isdisjoint(r.c for r in got if r.side == "train")
    again = drawing.group_split(rows.repartition(7), F.col("c"), "v", 8).collect()
    assert {(r.id, r.side) for r in got} == {(r.id, r.side) for r in again}
    ids = rows.withColumn("v", F.lit("same"))  # rows whose key stands in val are dropped from train
    assert Counter(r.side for r in drawing.group_split(ids, F.col("c"), "v", 8).collect()) == {"val": 8, "dropped": 32}


def test_split_then_replicate(spark):
    rows = spark.range(40).select("id", F.concat(F.lit("v"), "id").alias("v"), (F.col("id") % 10).alias("c"))
    split = drawing.group_split(rows, F.col("c"), "v", 8)
    train = drawing.replicated(split.filter("side = 'train'"), "id", F.lit(3)).collect()
    assert sum(r.copies for r in train) == 96 and not {r.v for r in train} & {r.v for r in split.filter("side = 'val'").collect()}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 4000), min_size=1, max_size=30))
def test_replication_keeps_the_mass(spark, weights):
    rows = spark.createDataFrame([(i, w / 1000) for i, w in enumerate(weights)], "pos int, w double")
    got = {r.pos: r.copies for r in drawing.replicated(rows, "pos", F.col("w")).collect()}
    kept = [max(1000, w) for w in weights]
    assert sum(got.values()) == sum(kept) // 1000 and all(got[i] in (w // 1000, w // 1000 + 1) for i, w in enumerate(kept))


def test_fractions_that_doubles_would_lose(spark):
    rows = spark.range(40)
    assert sum(r.copies for r in drawing.replicated(rows, "id", F.lit(1.3)).collect()) == 52
    assert sum(r.copies for r in drawing.replicated(spark.range(4), "id", F.lit(1.5)).collect()) == 6
    assert sum(r.copies for r in drawing.replicated(spark.range(3), "id", F.lit(None).cast("double")).collect()) == 3


def test_hard_weights(spark):
    rows = spark.createDataFrame([(f"s{i}", "s", True, True) for i in range(10)] + [(f"m{i}", "m", i == 0, True) for i in range(10)], "v string, sk string, wrong boolean, trusted boolean")
    each, per = drawing.hard_weights(rows, "v", "sk", F.col("wrong"), None)
    w = {r.v: r.weight for r in each.collect()}
    assert (w["s0"], w["m0"], w["m1"]) == (1.5, 3.0, 1.0) and {r.sk: r.mass for r in per.collect()} == {"s": 1.5, "m": 1.2}
    none = rows.withColumn("trusted", F.col("sk") == "s")
    each, per = drawing.hard_weights(none, "v", "sk", F.col("wrong"), F.col("trusted"), cap=0)
    w = {r.v: r.weight for r in each.collect()}
    assert (w["m0"], w["s0"]) == (1.0, 3.0) and [r.hard for r in per.collect()] == [10]


def test_batches(spark):
    rows = spark.range(100).select("id", (F.col("id") < 12).alias("minor"))
    got = drawing.mixed_batches(rows, ["id"], F.col("minor"), 8, 2).collect()
    per = Counter((r.batch, r.minor) for r in got)
    assert max(r.batch for r in got) == 13 and all(per[b, True] == 2 and per[b, False] == 6 for b in range(14))
    assert max(Counter(r.id for r in got if r.minor).values()) == 3  # 28 places for 12 rows
    plain = drawing.mixed_batches(spark.range(20).withColumn("minor", F.lit(False)), ["id"], F.col("minor"), 8, 2).collect()
    assert Counter(r.batch for r in plain) == {0: 8, 1: 8}


def test_epochs_are_permutations(spark):
    got = drawing.epoch_order(spark.range(50), "id", 3).collect()
    for e in range(3):
        assert sorted(r.place for r in got if r.epoch == e) == list(range(50)) == sorted(r.id for r in got if r.epoch == e)
    orders = [tuple(r.id for r in sorted(got, key=lambda r: r.place) if r.epoch == e) for e in range(3)]
    assert len(set(orders)) == 3
    ranks = drawing.rank_shares(spark.range(50), "id", 8).collect()
    assert Counter(r.rank for r in ranks) == {k: 6 for k in range(8)}


def test_quotas(spark):
    rows = spark.range(300).select(F.concat(F.lit("v"), "id").alias("v"), F.substring(F.lit("qnhma"), (F.col("id") % 5 + 1).cast("int"), F.lit(1)).alias("sk"), F.when(F.col("id") % 2 == 0, "C").otherwise("B").alias("rt"))
    got = drawing.quota_sample(rows, "v", {"q": 10, "n": 10}, {"n": 5, "h": 7}, {"C": 20}, 100).collect()
    n = Counter(r.stratum for r in got)
    assert n == {"first_q": 10, "first_n": 10, "extra_n": 5, "extra_h": 7, "role_C": 20, "fill": 48} and len({r.v for r in got}) == 100


def test_audit(spark):
    rows = spark.range(60).select(F.col("id"), (F.col("id") % 3).cast("string").alias("s"))
    got = drawing.audit_sample(rows, "id", F.when(F.col("s") != "2", F.col("s")), {"1": 4, "0": 2}).collect()
    assert [r.stratum for r in sorted(got, key=lambda r: r.idx)] == ["1"] * 4 + ["0"] * 2 and [r.idx for r in sorted(got, key=lambda r: r.idx)] == [1, 2, 3, 4, 5, 6]
    key = spark.createDataFrame([(1, "m", True), (2, "m", False), (3, "m", True), (4, "c", True)], "idx long, stratum string, gt_first boolean")
    said = spark.createDataFrame([(1, "1"), (2, " 1 "), (3, ""), (4, "BOTH")], "idx long, verdict string")
    assert {r.stratum: (r.n, r.gt_win, r.model_win, r.both, r.accepted) for r in drawing.audit_scores(key, said).collect()} == {"m": (2, 1, 1, 0, 0.5), "c": (1, 0, 0, 1, 1.0)}


def test_small_helpers(spark):
    names = spark.createDataFrame([("a-9.npz",), ("a-10.npz",), ("b",), ("a-100",)], "n string")
    assert [r.n for r in drawing.latest(names, "n", 2).collect()] == ["a-100", "a-10.npz"]
    assert (drawing.align_up(9, 4), drawing.align_up(8, 4), drawing.anneal_step(100, 0.25)) == (12, 8, 75)
    rounds = drawing.rounds(spark.range(9), "id", 4, 2).collect()
    assert Counter(r["round"] for r in rounds) == {0: 4, 1: 4} and len(set(rounds)) == 8


def test_partners_and_advantages(spark):
    got = {r.id: r.partner for r in numeric.partners(spark.range(7), "id", 3).collect()}
    assert got == {0: 2, 1: 0, 2: 1, 3: 5, 4: 3, 5: 4, 6: 6}
    rows = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", 0.5), ("b", 0.5), (None, 1.0)], "g string, r double")
    adv = sorted((r.g or "", r.advantage, r.keep) for r in numeric.advantages(rows, "g", F.col("r")).collect())
    assert adv == [("", 0.0, False), ("a", -0.5, True), ("a", 0.5, True), ("b", 0.0, False), ("b", 0.0, False)]


def test_preference_loss_equals_the_formula(spark):
    r, d = [0.3, -0.2, -0.9], [True, False, False]
    rows = spark.createDataFrame([("x", a, 0.0, b) for a, b in zip(r, d, strict=True)], "b string, p double, q double, d boolean")
    got = numeric.preference(rows, F.col("p"), F.col("q"), F.col("d"), "b", beta=2.0, w_undesirable=0.5).first()
    s = lambda x: 1 / (1 + np.exp(-x))
    want = [1 - s(2 * 0.3), 0.5 * (1 - s(0.4)), 0.5 * (1 - s(1.8))]
    assert got.kl == 0.0 and abs(got.loss - np.mean(want)) < 1e-6  # a negative divergence is 0


def test_early_stop(spark):
    losses = {"a": [5, 4, 4, 4, 1], "b": [3, 2, 1], "c": [1, 1, 1]}
    rows = spark.createDataFrame([(k, i, float(v)) for k, vs in losses.items() for i, v in enumerate(vs)], "run string, i int, loss double")
    got = {r.run: (r.steps, r.best, r.best_step, r.stop_step) for r in numeric.early_stops(rows, "run", ["i"], "loss", 2).collect()}
    assert got == {"a": (4, 4.0, 2, 4), "b": (3, 1.0, 3, None), "c": (3, 1.0, 1, 3)}


def test_averaged_bags_and_regressions(spark):
    rows = spark.createDataFrame([("b1", "w", [1.0, 3.0]), ("b2", "w", [3.0, 5.0]), ("b2", "only", [7.0])], "bag string, key string, v array<double>")
    got = {(r.key, r.i): r.mean for r in numeric.averaged_bags(rows, "bag", "key", "v").collect()}
    assert got == {("w", 0): 2.0, ("w", 1): 4.0, ("only", 0): 7.0}
    a, b = (spark.createDataFrame(list(x.items()), "k string, v double") for x in ({"rt": 89.5, "sk": 81.0}, {"rt": 88.9, "sk": 81.2}))
    assert [(r.k, r["drop"]) for r in numeric.regressions(a, b, "k", "v", 0.5).collect()] == [("rt", 0.6)]


def test_reward(spark):
    one = lambda *v: spark.range(1).select(arrays.reward(*[F.lit(x) for x in v]).alias("x")).first().x
    assert one("A", "a", "A", "a", "N", "N") == 1.6 and one("B", "b", "A", "a", "N", "N") == 0.3 and one(None, None, "A", None, None, None) == 0.0
