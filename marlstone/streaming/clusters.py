"""Greedy leader clustering: each vector joins the nearest cluster or opens one; centroids move. The result depends on the order.

The state is the centroids alone. Rows stream through in order and are never gathered; clusters, not rows, bound the memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import arrays


class Leaders:
    """Centroids so far; ``add`` gives a vector's cluster. Distance is 1 - dot product of unit vectors."""

    def __init__(self, threshold: float = 0.15, keep: float = 0.9):
        self.threshold, self.keep = threshold, keep
        self.centres = np.zeros((0, 0))
        self.n = 0

    def add(self, v: np.ndarray) -> int:
        if self.n:
            d = 1.0 - self.centres[: self.n] @ v
            best = int(d.argmin())
            if d[best] < self.threshold:
                c = self.centres[best] * self.keep + v * (1 - self.keep)
                self.centres[best] = c / max(float(np.linalg.norm(c)), 1e-6)
                return best
        if self.n == len(self.centres):
            grown = np.zeros((max(16, 2 * self.n), len(v)))
            if self.n:
                grown[: self.n] = self.centres[: self.n]
            self.centres = grown
        self.centres[self.n] = v
        self.n += 1
        return self.n - 1


def leader_clusters(rows: DataFrame, by: str, order: str, vector: str, threshold: float = 0.15) -> DataFrame:
    """``by``, ``order``, cluster (from 0 in each group): groups are clustered apart, in order; null vectors get a null cluster.

    Groups are spread over tasks and stream through; one group is one sequence by definition.
    """
    unit = arrays.bound(F.transform(F.col(vector), lambda x: x.cast("double")), arrays.unit_length)
    placed = rows.select(by, order, unit.alias("_v")).repartition(F.col(by)).sortWithinPartitions(by, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, leaders = object(), None
        for b in batches:
            out = []
            for g, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if g != own:
                    own, leaders = g, Leaders(threshold)
                out.append(None if x is None else leaders.add(np.asarray(x)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int64())], [by, order, "cluster"])

    return placed.mapInArrow(run, T.StructType([placed.schema[by], placed.schema[order], T.StructField("cluster", T.LongType())]))


def cluster_sizes(clusters: DataFrame, by: str, k: int = 10) -> DataFrame:
    """The ``k`` largest clusters."""
    return clusters.groupBy(by, "cluster").agg(F.count("*").alias("n")).orderBy(F.desc("n"), by, "cluster").limit(k)
