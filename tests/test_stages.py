import os

import pytest
from pyspark.sql import functions as F

from marlstone import stages


@pytest.mark.parametrize("most", [1 << 30, 0])
def test_dimension_join_is_the_same_at_any_size(spark, most):
    rows = spark.createDataFrame([(i, "hot" if i < 60 else None if i < 70 else f"k{i % 7}", i) for i in range(100)] + [(0, "hot", 0)], "a int, k string, b int")
    dim = spark.createDataFrame([("hot", 60, "H", 1), *[(f"k{i}", 5, f"V{i}", i) for i in range(5)]], "k string, n long, v string, w int")
    got = stages.with_dim(rows, dim, "k", "n", share=4, most_bytes=most)
    assert got.columns == ["a", "k", "b", "v", "w"]
    want = [(r.a, r.k, r.b, {"hot": "H", None: None}.get(r.k, f"V{r.k[1:]}" if r.k and r.k[1] in "01234" else None)) for r in rows.collect()]
    assert sorted(map(repr, want)) == sorted(repr((r.a, r.k, r.b, r.v)) for r in got.collect())


def test_stages_are_deleted(spark):
    a, (n, total) = stages.counted(spark.range(5), F.sum("id"))
    path = a._marlstone_stage.removeprefix("file://")
    assert (n, total) == (5, 10) and os.path.isdir(path)
    stages.drop_stage(a, spark.range(1))
    assert not os.path.exists(path)
    b = stages.stage(spark.range(2))
    stages.clear_stages(spark)
    assert not os.path.exists(b._marlstone_stage.removeprefix("file://"))


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        stages.shared_dir(Session())
