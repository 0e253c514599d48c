import random
from collections import Counter

import pytest

from marlstone import stages
from marlstone.llm import groups


def _brute(rows):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for _, cam, vid in rows:
        if cam is not None and vid is not None:
            up[find(("c", cam))] = find(("v", vid))
    of = [find(("c", cam)) if cam is not None else find(("v", vid)) if vid is not None else None for _, cam, vid in rows]
    n = Counter(of)
    least, alone = {}, {}
    for (_, cam, vid), g in zip(rows, of, strict=True):
        if g is not None:
            if cam is not None:
                least[g] = min(cam, least.get(g, cam))
            elif vid is not None:
                alone[g] = vid
    return sorted((k, least.get(g, alone.get(g)) if g else None, n[g] if g else 1) for (k, _, _), g in zip(rows, of, strict=True))


def _rows(seed, n, cams, vids):
    r = random.Random(seed)
    pick = lambda p, m: None if r.random() < 0.1 else f"{p}0" if r.random() < 0.33 and p == "c" else f"{p}{r.randrange(m)}"
    return [(i, pick("c", cams), pick("v", vids)) for i in range(n)] + [(900, None, None), (901, None, None), (5, "c1", "v1")]


@pytest.mark.parametrize("seed,cams,vids", [(1, 40, 300), (2, 60, 120)])
@pytest.mark.parametrize("most", [16 << 20, 0])
def test_groups_equal_union_find(spark, monkeypatch, seed, cams, vids, most):
    monkeypatch.setattr(stages, "BROADCAST_BYTES", most)
    rows = _rows(seed, 200, cams, vids)
    df = spark.createDataFrame(rows, "k int, cam string, vid string")
    got = groups.related_groups(df, "k", "cam", "vid")
    assert got.columns == ["k", "group_id", "n"]
    assert sorted((r.k, r.group_id, r.n) for r in got.collect()) == _brute(rows)


def test_a_star_and_a_chain(spark):
    star = [(i, f"c{i}", "hub") for i in range(150)]
    chain = [(200 + 2 * i + j, f"d{i + j:03d}", f"link{i}") for i in range(80) for j in (0, 1)]
    got = {r.k: (r.group_id, r.n) for r in groups.related_groups(spark.createDataFrame(star + chain, "k int, cam string, vid string"), "k", "cam", "vid").collect()}
    assert {got[k] for k, _, _ in star} == {("c0", 150)} and {got[k] for k, _, _ in chain} == {("d000", 160)}


def test_no_rows(spark):
    assert groups.related_groups(spark.createDataFrame([], "k int, cam string, vid string"), "k", "cam", "vid").count() == 0
    assert groups.components(spark.createDataFrame([("a", "a"), (None, "b")], "a string, b string")).collect()[0].v == "a"


def test_splits_keep_groups_and_shares(spark):
    r = random.Random(3)
    sizes = [(f"g{i}", 400 if i < 3 else r.randrange(1, 6)) for i in range(1500)]
    df = spark.createDataFrame(sizes, "g string, n long")
    shares = {"train": 0.8, "val": 0.1, "test": 0.1}
    rows = groups.group_splits(df, "g", "n", shares).collect()
    assert len(rows) == len({x.g for x in rows}) == 1500
    total, per = sum(n for _, n in sizes), Counter()
    for x in rows:
        per[x.split] += x.n
    assert all(abs(per[k] - total * s) <= 6 for k, s in shares.items())
    assert {(x.g, x.split) for x in rows} == {(x.g, x.split) for x in groups.group_splits(df.repartition(5), "g", "n", shares).collect()}
    assert groups.group_splits(df.limit(0), "g", "n", shares).count() == 0
