"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import crosssplit, encoding, groups, languages, leaks, oracles, sampling, spam
from marlstone.functions.identity import serial_of
from marlstone.stages import stage, table, with_dim


def _sample(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    usable = sampling.usable_records(table(spark, sf, "labels"))
    return sampling.matching_sample(usable, {"rt": "rt", "sk": "sk"}, table(spark, sf, "sample_targets"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf)[1].filter("short").select("axis", "letter")


def p1_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf)[0]


def p1_report(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf)[1]


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels").select("pos", "video_id", serial_of(F.col("meta")["camera_id"], F.col("video_id")).alias("camera"))
    return groups.related_groups(rows, "pos", "camera", "video_id")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _groups(spark, sf).filter("n > 1").select("pos", "group_id")


def p4_splits(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(_groups(spark, sf).withColumn("group_id", F.coalesce("group_id", F.concat(F.lit("row "), F.col("pos").cast("string")))))
    each = stage(rows.groupBy("group_id").agg(F.count("*").alias("n")))
    split = stage(groups.group_splits(each, "group_id", "n", {"train": 0.8, "validation": 0.1, "test": 0.1}))
    return with_dim(rows.select("pos", "group_id"), split.select("group_id", "n", "split"), "group_id", "n")


def _overlaps(spark: SparkSession, sf: str) -> DataFrame:
    split, camera = F.col("meta")["source_split"], F.col("meta")["camera_id"]
    return crosssplit.cross_split_overlaps(table(spark, sf, "labels"), "pos", split, camera, "video_id", "recorded_at", F.col("labels.description"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return crosssplit.overlap_pairs(_overlaps(spark, sf))


def p5_report(spark: SparkSession, sf: str) -> DataFrame:
    return crosssplit.overlap_report(_overlaps(spark, sf))


def _chains(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "asset_c_reasoning").select(F.lit("asset_c_reasoning").alias("src"), "pos", F.col("reasoning_chain").alias("text"), "lang")
    g = table(spark, sf, "gemini_pass2").select(F.lit("gemini_pass2").alias("src"), "pos", F.col("gemini_output.reasoning_chain").alias("text"), "lang")
    return languages.language_segments(a.unionByName(g))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    cases = languages.mislabelled(_chains(spark, sf)).select("src", "pos", F.explode("segments").alias("s"))
    return cases.select("src", "pos", "s.seg", "s.lang")


def p2_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _chains(spark, sf).select("src", "pos", F.explode("segments").alias("s")).select("src", "pos", "s.*")


def p2_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Each chain's language with a confidence, and its number of segments."""
    return _chains(spark, sf).select("src", "pos", "language", "confidence", F.size("segments").alias("segments"))


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, sf, "documents"))


def p7_decoded(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's text after encoding and decoding, and whether it equals the source (null counts as empty)."""
    docs = table(spark, sf, "documents")
    texts = encoding.decode_corpus(stage(encoding.encode_corpus(docs)))
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("source"))
    return texts.join(source, "doc_id", "left").select("doc_id", "text", F.col("text").eqNullSafe(F.col("source")).alias("same"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaked_passages(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return spam.spam_pages(table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_sample, p1_report, p2_found, p2_segments, p2_documents, p4_found, p4_splits, p5_found, p5_report, p7_ids, p7_decoded, p8_found, p9_found)}
ORACLE = oracles.ORACLE
