import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.functions import arrays


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_uniform_indices_equal_numpy(spark):
    rows = spark.range(1, 700).select("id", arrays.uniform_indices(F.col("id"), 16).alias("x")).collect()
    for r in rows:
        want = np.linspace(0, r.id - 1, 16).round().astype(int).tolist() if r.id >= 16 else [*range(r.id), *[r.id - 1] * (16 - r.id)]
        assert r.x == want
    assert _one(spark, arrays.uniform_indices(F.lit(0), 4)) is None and _one(spark, arrays.uniform_indices(F.lit(5), 1)) == [0]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from([True, False, None]), max_size=12))
def test_islands(spark, mask):
    want, start = [], None
    for i, v in enumerate([*mask, False]):
        if v and start is None:
            start = i
        elif not v and start is not None:
            want.append((start, i - start))
            start = None
    got = spark.createDataFrame([(mask,)], "m array<boolean>").select(arrays.islands(F.col("m")).alias("x")).first().x
    assert [tuple(r) for r in got] == want


def test_held_and_order(spark):
    frames, flags = F.array(*map(F.lit, (0, 3, 5, 9))), F.array(*map(F.lit, (True, False, True, True)))
    assert _one(spark, arrays.held(frames, flags)) == [0, 3, 3, 3]
    assert _one(spark, arrays.ascending(frames)) and not _one(spark, arrays.ascending(F.array(F.lit(2), F.lit(1)))) and _one(spark, arrays.ascending(F.array(F.lit(1))))
    with pytest.raises(Exception, match="order violated"):
        _one(spark, arrays.checked_ascending(F.array(F.lit(2), F.lit(1))))


def test_crop_stays_inside(spark):
    rows = spark.range(1, 60).select("id", arrays.crop(F.col("id"), F.lit(0.7), F.lit(0.999)).alias("w")).collect()
    assert all(0 <= r.w.start < r.w.end <= r.id for r in rows)


def test_hash_below_takes_about_its_share(spark):
    n = spark.range(20_000).filter(arrays.hash_below(F.col("id"), 0.3)).count()
    assert 5600 < n < 6400 and spark.range(10).filter(arrays.hash_below(F.col("id"), 1.0)).count() == 10
    assert _one(spark, arrays.hash_below(F.lit(None).cast("string"), 0.5)) is False


def test_vectors(spark):
    v = _one(spark, arrays.normalised(F.array(*map(F.lit, (1, 2, 4)))))
    x = np.array([1, 2, 4.0]) - 7 / 3
    assert np.allclose(v, x / np.linalg.norm(x)) and _one(spark, arrays.normalised(F.array(F.lit(2), F.lit(2)))) == [0.0, 0.0]
    assert _one(spark, arrays.padded(F.array(F.lit(1), F.lit(2), F.lit(3)), 2, F.lit(0))) == [1, 2]
    assert _one(spark, arrays.padded(F.array(F.lit(1)), 3, F.lit(0))) == [1, 0, 0]


def test_picks_and_losses(spark):
    scores = F.array(*map(F.lit, (0.1, 0.9, 0.9, 0.2, 2.0)))
    assert [_one(spark, arrays.constrained_pick(scores, k, [0, 1], [2, 3], 4)) for k in range(5)] == [1, 4, 2, 4, 4]
    assert _one(spark, arrays.best_of(scores, F.array(F.lit(0), F.lit(1)), F.array(F.lit(5.0), F.lit(0.0)))) == 0
    assert _one(spark, arrays.masked_sum(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(-100), F.lit(3)))) == 2.0
    assert abs(_one(spark, arrays.preference_loss(F.lit(1.0), F.lit(0.5), F.lit(True), 2.0)) - (1 - 1 / (1 + np.exp(-1.0)))) < 1e-12
    assert abs(_one(spark, arrays.smoothed_loss(F.array(F.lit(-1.0), F.lit(-3.0)), F.lit(0), 0.1)) - (0.9 + 0.2)) < 1e-12
    assert _one(spark, arrays.clipped_objective(F.lit(2.0), F.lit(1.0))) == 1.28 and _one(spark, arrays.clipped_objective(F.lit(2.0), F.lit(-1.0))) == -2.0
    assert [_one(spark, arrays.subset_sample(F.array(F.lit(0.0), F.lit(0.0)), F.lit(u))) for u in (0.0, 0.49, 0.51, 0.999)] == [0, 0, 1, 1]
