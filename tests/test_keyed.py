from pyspark.sql import functions as F

from marlstone.operators import keyed
from marlstone.streaming.clusters import Leaders


def _rows(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, "b", "y"), (4, "a", "z"), (5, None, "n"), (6, None, "m")], "pos int, k string, v string")


def test_policies(spark):
    rows = _rows(spark)
    pick = lambda df: {(r.k, r.pos) for r in df.collect()}
    assert pick(keyed.first_rows(rows, "k")) == {("a", 1), ("b", 3), (None, 5)}
    assert pick(keyed.last_rows(rows, "k")) == {("a", 4), ("b", 3), (None, 6)}
    assert pick(keyed.last_rows(rows.filter("pos < 4"), "k", valid=F.col("v").isNotNull())) == {("a", 1), ("b", 3)}
    assert pick(keyed.first_rows(rows.filter("pos > 1"), "k", complete=F.col("v").isNotNull())) == {("a", 4), ("b", 3), (None, 5)}
    assert pick(keyed.first_rows(rows.limit(0), "k")) == set()


def test_one_key_is_limited_before_the_shuffle(spark):
    plan = keyed.last_rows(_rows(spark), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_resume_scope_and_nulls(spark):
    rows, done = _rows(spark), spark.createDataFrame([("a",), (None,)], "k string")
    pos = lambda df: sorted(r.pos for r in df.collect())
    assert pos(keyed.remaining(rows, done, "k")) == [3, 5, 6] and pos(keyed.scoped(rows, done, "k")) == [1, 2, 4]
    assert pos(keyed.scoped_null_safe(rows, done, "k")) == [1, 2, 4, 5, 6] and pos(keyed.scoped_null_safe(rows, done, "k", False)) == [3]
    assert pos(keyed.remaining(rows, done.limit(0), "k")) == [1, 2, 3, 4, 5, 6]


def test_shards_are_disjoint_and_complete(spark):
    rows = spark.range(100)
    parts = [{r.id for r in keyed.shard(rows, "id", i, 8).collect()} for i in range(8)]
    assert set().union(*parts) == set(range(100)) and sum(map(len, parts)) == 100


def test_retries_keep_the_last_invalid_answer(spark):
    def call(text):
        if text == "down":
            raise OSError("no service")
        return (text, []) if text == "good" else (text, ["bad"])

    rows = spark.createDataFrame([("v2", "good"), ("v3", "bad"), ("v4", "down")], "key string, input string")
    got = {r.key: r for r in rows.mapInPandas(keyed.with_retries(call), "key string, answer string, errors array<string>, attempts int").collect()}
    assert (got["v2"].answer, got["v2"].attempts, got["v2"].errors) == ("good", 1, [])
    assert (got["v3"].answer, got["v3"].attempts, got["v3"].errors) == ("bad", 3, ["bad"])
    assert got["v4"].answer is None and got["v4"].errors == ["OSError: no service"]
    good, dead = keyed.by_errors(spark.createDataFrame([tuple(r) for r in got.values()], "key string, answer string, errors array<string>, attempts int"))
    assert {r.key for r in good.collect()} == {"v2"} and {r.key for r in dead.collect()} == {"v3", "v4"}


def test_chat_and_routes(spark):
    chats = spark.createDataFrame([(1, [("human", "?"), ("gpt", "A|a|x"), ("gpt", "later")]), (2, [("human", "?")]), (3, None)], "i int, conversations array<struct<from:string,value:string>>")
    assert {r.i: r.value for r in keyed.chat_labels(chats).collect()} == {1: "A|a|x", 2: None, 3: None}
    parts = keyed.routed(chats, F.when(F.col("i") < 3, "x").otherwise("y"), ["x", "y"])
    assert (parts["x"].count(), parts["y"].count()) == (2, 1)


def test_leaders_find_two_pure_clusters():
    import numpy as np

    r = np.random.default_rng(0)
    a, b = np.eye(8)[0], np.eye(8)[1]
    noisy = [v + r.normal(0, 0.02, 8) for v in (a, b, a, a, b, a, b, a, b)]
    own = Leaders(0.15)
    got = [own.add(v / np.linalg.norm(v)) for v in noisy]
    assert got == [0, 1, 0, 0, 1, 0, 1, 0, 1]
