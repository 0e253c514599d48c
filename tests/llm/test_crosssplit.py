import datetime
import random

import pytest
from pyspark.sql import functions as F

from marlstone import stages
from marlstone.llm import crosssplit

AT = datetime.datetime(2024, 1, 1)


def _report(spark, rows):
    df = spark.createDataFrame([(i, s, f"v{i}", c, AT, d) for i, (s, c, d) in enumerate(rows)], "pos long, split string, video string, cam string, at timestamp_ntz, words string")
    got = crosssplit.cross_split_overlaps(df, "pos", F.col("split"), F.col("cam"), "video", "at", F.col("words"))
    return {r.camera: (r.evals, r.pairs, round(r.coverage, 4)) for r in crosssplit.overlap_report(got).collect()}


def test_spans_are_united_over_training_rows_and_averaged_over_evaluation_rows(spark):
    text = "aaa bbb ccc ddd eee fff"
    rows = [("val", "T8AAAAAA", text), ("train", "T8AAAAAA", "aaa bbb ccc ddd xxx yyy"), ("train", "T8AAAAAA", "xxx yyy ccc ddd eee fff")]
    # one record with three full copies, one whose only copy shares a third (9 of 25 letters and blanks)
    rows += [("val", "T8BBBBBB", text)] + [("train", "T8BBBBBB", text)] * 3
    rows += [("test", "T8CCCCCC", "ggg hhh iii jjj kkk lll"), ("train", "T8CCCCCC", "ggg xxx iii jjj kkk yyy")]
    rows += [("val", "T8DDDDDD", text)] + [("train", "T8DDDDDD", text)] * 3 + [("val", "T8DDDDDD", "ggg hhh iii jjj kkk lll"), ("train", "T8DDDDDD", "ggg xxx iii jjj kkk yyy")]
    assert _report(spark, rows) == {"T8AAAAAA": (1, 2, 1.0), "T8BBBBBB": (1, 3, 1.0), "T8CCCCCC": (1, 1, 0.36), "T8DDDDDD": (2, 4, 0.68)}


def test_short_descriptions_are_covered(spark):
    rows = [("val", "T8AAAAAA", "aaa bbb"), ("train", "T8AAAAAA", "aaa bbb"), ("val", "T8BBBBBB", "aaa"), ("train", "T8BBBBBB", "ccc")]
    assert _report(spark, rows) == {"T8AAAAAA": (1, 1, 1.0), "T8BBBBBB": (1, 1, 0.0)}


def _brute(rows):
    def words(d):
        return None if d is None else "".join(c if c.isalnum() else " " for c in d.lower()).split()

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    out = set()
    for i, s, v, c, at, d in rows:
        for j, t, w, e, bt, f in rows:
            if s == "train" and t in ("val", "test"):
                near = c == e and c is not None and at is not None and bt is not None and abs((at - bt).total_seconds()) <= 2 and words(d) is not None and words(f) is not None and distance(words(d), words(f)) <= 2
                if (v is not None and v == w) or near:
                    out.add((min(i, j), max(i, j)))
    return out


def _many():
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    base = [r.choices(vocabulary, k=n) for n in (0, 1, 2, 3, 8, 12)]
    rows = []
    for i in range(160):
        d = list(r.choice(base))
        for _ in range(r.randrange(4)):
            d[r.randrange(len(d) + 1) :][:1] = [r.choice(vocabulary)] if r.random() < 0.7 else []
            if d and r.random() < 0.5:
                d[r.randrange(len(d))] = r.choice(vocabulary)
        cam = None if r.random() < 0.1 else "T8HOTHOT" if r.random() < 0.5 else f"T8CAMER{r.randrange(3)}"
        at = None if r.random() < 0.1 else AT + datetime.timedelta(milliseconds=r.randrange(9000))
        video = None if r.random() < 0.1 else "hot id" if r.random() < 0.2 else f"id {r.randrange(40)}"
        rows.append((i, r.choice(["train", "train", "val", "test", None]), video, cam, at, None if r.random() < 0.05 else " ".join(d)))
    return rows


def _pairs(spark, rows):
    df = spark.createDataFrame(rows, "pos long, split string, video string, cam string, at timestamp_ntz, words string")
    return {tuple(r) for r in crosssplit.overlap_pairs(crosssplit.cross_split_overlaps(df, "pos", F.col("split"), F.col("cam"), "video", "at", F.col("words"))).collect()}


@pytest.mark.parametrize("hot,most", [(500, 16 << 20), (3, 0)])
def test_pairs_equal_brute_force_with_hot_keys_split(spark, monkeypatch, hot, most):
    monkeypatch.setattr(crosssplit, "HOT_ROWS", hot)
    monkeypatch.setattr(crosssplit, "SHARD_ROWS", 10 * hot)
    monkeypatch.setattr(stages, "BROADCAST_BYTES", most)
    rows = _many()
    assert _pairs(spark, rows) == _brute(rows)


def test_recordings_whatever_the_spelling(spark):
    names = [("train", "a/T8ABCDEF12_20210104000019_3461.mp4"), ("val", "B\\t8abcdef12-20210104000019 3461 (1).mp4"), ("test", "T8ABCDEF12_20210104000019_3462.mp4"), ("val", "xT8ABCDEF12_20210104000019_3461.mp4"), (None, "T8ABCDEF12_20210104000019_3461")]
    rows = [(i, s, v, None, None, None) for i, (s, v) in enumerate(names)]
    assert _pairs(spark, rows) == {(0, 1)} and _pairs(spark, rows[:1]) == set() == _pairs(spark, [])
