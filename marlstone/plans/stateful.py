"""Queries with state or an order: clustering and counts of late records. They have no SQL but the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.stages import table
from marlstone.streaming import clusters, ingest


def leader_cluster(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters of the embeddings of each label, in order of their ids."""
    return clusters.leader_clusters(table(spark, sf, "embeddings"), "label", "vec_id", "embedding", 0.5)


def cluster_top(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.cluster_sizes(leader_cluster(spark, sf), "label")


def hourly_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Records by the hour they were recorded in and their storage."""
    rows = table(spark, sf, "labels").filter("recorded_at is not null").select("recorded_at", F.col("meta")["storage"].alias("storage"))
    got = ingest.late_counts(spark, rows, "recorded_at", ["storage"])
    return got.select(F.unix_timestamp("start").alias("start"), "storage", "n")


QUERIES = {f.__name__: f for f in (leader_cluster, cluster_top, hourly_arrivals)}
ORACLE = {"hourly_arrivals": "SELECT epoch(date_trunc('hour', recorded_at))::BIGINT AS start, meta['storage'] AS storage, count(*) AS n FROM labels WHERE recorded_at IS NOT NULL GROUP BY ALL"}
