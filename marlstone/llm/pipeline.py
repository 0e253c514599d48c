"""The pipeline from raw documents to token ids: STAGES of (name, function of session, rows of the stage before, table folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import encoding, leaks, spam
from marlstone.stages import table


def without_spam(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    return docs.join(spam.spam_pages(docs), "doc_id", "left_anti")


def without_leaks(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    return docs.join(leaks.leaked_passages(docs, table(spark, sf, "eval_items")).select("doc_id"), "doc_id", "left_anti")


def encoded(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    return encoding.encode_corpus(docs)


STAGES = [("without_spam", without_spam), ("without_leaks", without_leaks), ("encoded", encoded)]
