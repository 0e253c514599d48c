import random
from collections import Counter

import numpy as np
import pytest

from marlstone.llm import sampling


def _records(n, seed=1, rts="ABC", sks="abcd"):
    r = random.Random(seed)
    return [(f"v{i}", r.choice(rts) if r.random() > 0.05 else None, r.choice(sks) if r.random() > 0.05 else None) for i in range(n)]


def _run(spark, records, targets, **more):
    df = spark.createDataFrame(records, "video_id string, rt string, sk string")
    t = spark.createDataFrame(targets, "axis string, letter string, p double, min_n int")
    sample, report = sampling.matching_sample(df, {"rt": "rt", "sk": "sk"}, t, **more)
    return sample.collect(), {(r.axis, r.letter): r for r in report.collect()}


@pytest.mark.parametrize("part", [100_000, 50])
def test_shares_are_met_in_parts_of_any_size(spark, monkeypatch, part):
    monkeypatch.setattr(sampling, "PART", part)
    targets = [("rt", "A", 0.5, 0), ("rt", "B", 0.3, 0), ("rt", "C", 0.2, 0), ("sk", "a", 0.4, 0), ("sk", "b", 0.3, 0), ("sk", "c", 0.2, 0), ("sk", "d", 0.1, 0)]
    sample, report = _run(spark, _records(1500), targets)
    assert len({r.video_id for r in sample}) == len(sample) and not any(r.missed or r.short for r in report.values())
    drawn = Counter(r.rt for r in sample)
    for (axis, letter), r in report.items():
        assert abs(r.drawn - r.wanted) <= 6 and (axis != "rt" or drawn[letter] == r.drawn) and abs(r.gap - (r.drawn - r.goal)) < 1e-9


def test_short_letters_floors_and_contradictions(spark):
    records = [(f"v{i}", "A" if i < 900 else "B", "a" if i < 900 else "b") for i in range(1000)] + [("w1", "C", "c"), ("w2", "C", "c")]
    sample, report = _run(spark, records, [("rt", "A", 0.5, 0), ("rt", "B", 0.4, 0), ("rt", "C", 0.1, 0)])
    assert report["rt", "C"].short and report["rt", "C"].drawn == 2 and report["rt", "B"].drawn == 88 and report["rt", "B"].short is False
    _, report = _run(spark, records, [("rt", "A", 0.99, 0), ("rt", "B", 0.01, 30), ("rt", "C", 0.0, 3)])
    assert report["rt", "B"].drawn >= 30 and report["rt", "C"].short and report["rt", "C"].drawn == 2
    # a is A and b is B, so both axes can't be met
    _, report = _run(spark, records, [("rt", "A", 0.9, 0), ("rt", "B", 0.1, 0), ("sk", "a", 0.6, 0), ("sk", "b", 0.4, 0)])
    assert any(r.missed for r in report.values())


def test_no_rows_unknown_letters_and_nulls(spark):
    sample, report = _run(spark, [], [("rt", "A", 1.0, 1)])
    assert sample == [] and report["rt", "A"].short and report["rt", "A"].usable == 0
    sample, report = _run(spark, [("v1", None, None), ("v2", "Z", None)], [("rt", "A", None, None), (None, "x", 1.0, 0)])
    assert sample == [] and list(report) == [("rt", "A")] and not report["rt", "A"].short


def test_duels_keep_the_size_and_the_probabilities():
    r = np.random.default_rng(0)
    p = np.array([0.2, 0.7, 0.4, 0.9, 0.05, 0.75])
    got = np.array([sampling.duels(p, r.random(6)) for _ in range(6000)])
    closed = got[:, :].round(9)
    assert np.allclose(closed.sum(axis=1), p.sum()) and np.allclose(closed.mean(axis=0), p, atol=0.025)
    assert sampling.duels(np.array([1.0, 0.0]), np.zeros(2)).tolist() == [1, 0] and len(sampling.duels(np.zeros(0), np.zeros(0))) == 0


def test_usable_records(spark):
    rows = [(1, "v", ("A", "a", "")), (2, "v", (" b", " C ", "")), (3, "w", ("AA", None, "")), (4, None, ("A", "a", "")), (5, "x", None)]
    df = spark.createDataFrame(rows, "pos long, video_id string, labels struct<role_type:string,sub_keyscene:string,description:string>")
    assert {r.video_id: (r.rt, r.sk) for r in sampling.usable_records(df).collect()} == {"v": ("B", "c"), "w": (None, None), "x": (None, None)}
