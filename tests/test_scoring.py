import pytest
from pyspark.sql import functions as F

from marlstone.functions import outputs
from marlstone.operators import curation, health, scoring

RECORDS = [("q", "C", "C|q|x"), ("q", "C", "C|n|x"), ("a", "A", "a|A|x"), ("h", "A", "broken"), ("zz", "B", "broken")]


def _evaluated(spark):
    rows = spark.createDataFrame([(i, sk, rt, o) for i, (sk, rt, o) in enumerate(RECORDS)], "i int, gsk string, grt string, output string")
    return rows.withColumn("p", outputs.strict(F.col("output")))


def test_metrics_of_a_few_rows(spark):
    rows = _evaluated(spark)
    counts = scoring.with_groups(scoring.confusions(rows, {"rt": (F.col("grt"), F.coalesce("p.rt", F.lit("?"))), "sk": (F.col("gsk"), F.coalesce("p.sk", F.lit("?")))}))
    per = {(r.axis, r["class"]): r for r in scoring.per_class(counts, {"sk": list("aqn"), "ks": ["Normal"]}).collect()}
    assert (per["sk", "q"].recall, per["sk", "q"].precision, per["sk", "q"].support) == (0.5, 1.0, 2) and per["sk", "n"].precision == 0.0
    acc = {r.axis: (r.total, r.correct) for r in scoring.accuracies(counts).collect()}
    assert acc == {"rt": (5, 3), "sk": (5, 2), "ks": (5, 3)}  # the unknown letter that failed to parse counts as right for groups
    rates = scoring.rates(rows, {"fail": ~F.col("p.ok"), "fixed": F.col("p.case_fixed")}).first()
    assert (rates.n, rates.fail, rates.fixed) == (5, 0.4, 0.2)
    hot = {(r.gt, r.pred): r.n for r in scoring.hotspots(counts, {"sk": (("q", "n"),)}).collect()}
    assert hot == {("q", "n"): 1, ("n", "q"): 0}


def test_missing_predictions_are_wrong(spark):
    rows = spark.createDataFrame([("C", "q", "C", "q", True), ("C", "q", None, None, None)], "grt string, gsk string, rt string, sk string, there boolean")
    got = scoring.suite(rows, F.col("rt"), F.col("sk"), F.col("grt"), F.col("gsk"), F.col("there").isNull(), F.col("rt").isNotNull()).first()
    assert (got.n, got.missing, got.format, got.safety_n, got.safety_recall, got.both) == (2, 1, 1.0, 2, 0.5, 0.5)
    empty = scoring.suite(rows.limit(0), F.col("rt"), F.col("sk"), F.col("grt"), F.col("gsk"), F.col("there").isNull(), F.col("rt").isNotNull()).first()
    assert (empty.n, empty.sk) == (0, 0.0)


def test_agreement(spark):
    rows = spark.createDataFrame([("v1", "A", "a", "A", "a"), ("v2", "A", "a", "A", "b"), ("v3", "A", "a", "B", "b"), ("v4", None, "a", None, "a")], "v string, p string, q string, g string, h string")
    got = {r.v: r.bucket for r in curation.agreement(rows, *[F.col(c) for c in "pqgh"]).collect()}
    assert got == {"v1": "white", "v2": "partial", "v3": "discard", "v4": "white"}
    twice = {r.v: (r.agreed, r.pseudo_rt) for r in curation.agreed_twice(rows, (F.col("p"), F.col("q")), (F.col("g"), F.col("h"))).collect()}
    assert twice == {"v1": (True, "A"), "v2": (False, None), "v3": (False, None), "v4": (False, None)}


def test_examination_and_cleaning(spark):
    rows = spark.createDataFrame([("a", "a", "a"), ("b", "a", "a"), ("a", "b", "a"), ("b", "b", "a"), ("b", "c", "a"), (None, None, "a")], "m string, z string, g string")
    got = rows.withColumn("bucket", curation.examined(F.col("m"), F.col("z"), F.col("g")))
    assert [r.bucket for r in got.collect()] == ["A", "B", "C", "D", "E", "D"]
    total = curation.bucket_table(got, "g", "bucket").collect()
    assert [r.g for r in total] == ["a", "__ALL__"] and (total[1].n, total[1].D) == (6, 2)
    labels = spark.createDataFrame([(1, "x", "a"), (2, "x", "m"), (3, "y", "m"), (4, "z", "a"), (5, None, "a")], "pos int, v string, sk string")
    kept, report = curation.cleaned(labels, spark.createDataFrame([("x",), ("y",)], "v string"), "v", "sk", "m")
    assert sorted(r.pos for r in kept.collect()) == [3, 4, 5]  # an exempt row goes with its key, if another row condemns that
    assert {r.sk: (r.before, r.dropped, r.after) for r in report.collect()} == {"a": (3, 1, 2), "m": (2, 0, 1)}
    with pytest.raises(RuntimeError, match="a would lose 33%"):
        curation.breaker(report, "sk")
    curation.breaker(report, "sk", 0.5)


def test_an_empty_trusted_list_trusts_nothing(spark):
    rows = spark.createDataFrame([(None, "x"), (True, "x"), (True, "")], "inside boolean, chain string")
    fate = lambda inside: [r.f for r in rows.select(curation.asset_fate(inside, F.lit(1), F.col("chain")).alias("f")).collect()]
    assert fate(F.col("inside")) == ["outside", "asset", "incomplete"] and fate(None) == ["asset", "asset", "incomplete"] and fate(F.lit(False)) == ["outside"] * 3


def test_upper_median_and_words(spark):
    rows = spark.createDataFrame([("t", "a b"), ("t", "a b c"), ("t", ""), ("t", None), ("u", "A a b")], "s string, d string")
    got = {r.s: (r.rows, r.mean_words, r.median_words) for r in health.word_stats(rows, F.col("d"), "s").collect()}
    assert got == {"t": (4, 1.25, 2), "u": (1, 3.0, 3)}
    top = health.top_words(rows, F.col("d"), "s", 1)
    assert {(r.s, r.word, r.n) for r in top.collect()} == {("t", "a", 2), ("u", "a", 2)} and health.jaccard(top, "s", "t", "u", "word").first().jaccard == 1.0
