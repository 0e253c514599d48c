"""Keyed ingestion: which row of a key counts, what is left to do, and rows apart by their errors.

First and last rows are found by a ranked window with a limit of one, which is applied within each input partition
before the shuffle; so no key, however frequent, gathers in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def first_rows(rows: DataFrame, key: str, order: str = "pos", complete: Column | None = None) -> DataFrame:
    """Of each ``key`` the row with the least ``order``, among the ``complete`` ones. Null keys are one key; null orders come last."""
    kept = rows if complete is None else rows.filter(complete)
    return _one(kept, key, F.col(order).asc_nulls_last())


def last_rows(rows: DataFrame, key: str, order: str = "pos", valid: Column | None = None) -> DataFrame:
    """Of each ``key`` the row with the greatest ``order``, among the ``valid`` ones: an invalid row never replaces one. Null keys are one key."""
    kept = rows if valid is None else rows.filter(valid)
    return _one(kept, key, F.col(order).desc_nulls_last())


def remaining(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in ``done`` yet; rows with a null key always remain."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def scoped(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``wanted``; null keys never are."""
    return rows.join(wanted.select(key).distinct(), key, "left_semi")


def scoped_null_safe(rows: DataFrame, wanted: DataFrame, key: str, inside: bool = True) -> DataFrame:
    """Rows whose key is (or isn't) in ``wanted``, where a null key matches a null key."""
    other = wanted.select(F.col(key).alias("_w")).distinct()
    return rows.join(other, F.col(key).eqNullSafe(F.col("_w")), "left_semi" if inside else "left_anti")


def by_errors(rows: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(good, dead letters) of rows with an array of errors; a null array counts as none."""
    bad = F.coalesce(F.size(errors), F.lit(0)) > 0
    return rows.filter(~bad).drop(errors), rows.filter(bad)


def routed(rows: DataFrame, route: Column, names: list[str]) -> dict[str, DataFrame]:
    """The rows of each route by name; a route that isn't named raises when it is read."""
    known = F.when(route.isin(*names), route).otherwise(F.raise_error(F.concat(F.lit("no such route: "), F.coalesce(route, F.lit("null")))))
    marked = rows.withColumn("_route", known)
    return {n: marked.filter(F.col("_route") == n).drop("_route") for n in names}


def shard(rows: DataFrame, order: str, i: int, n: int) -> DataFrame:
    """The i-th of n interleaved shards by a dense number from 0."""
    return rows.filter(F.pmod(F.col(order), F.lit(n)) == i)


def chat_labels(chats: DataFrame, conversation: str = "conversations", who: str = "gpt") -> DataFrame:
    """``chats`` with ``value``: what the first turn from ``who`` says; null without such a turn."""
    turn = F.get(F.filter(F.col(conversation), lambda t: t["from"] == who), F.lit(0))
    return chats.withColumn("value", turn["value"])


def with_retries(call: Callable[[str], tuple[str | None, list[str]]], most: int = 3, wait: float = 0.0):
    """For mapInPandas over (key, input): key, answer, errors, attempts of a call that may fail; the last invalid answer is kept with its errors.

    ``call`` returns an answer and its errors; an exception is an error too. The wait before a retry grows linearly.
    """

    def run(batches):
        import time

        import pandas as pd

        for b in batches:
            out = []
            for key, text in zip(b["key"], b["input"], strict=True):
                answer, errors, n = None, ["unreachable"], 0
                for n in range(1, most + 1):
                    try:
                        answer, errors = call(text)
                    except Exception as e:  # noqa: BLE001 - whatever the service raises is an error of this record
                        answer, errors = None, [f"{type(e).__name__}: {e}"]
                    if not errors:
                        break
                    if n < most and wait:
                        time.sleep(wait * n)
                out.append((key, answer, errors, n))
            yield pd.DataFrame(out, columns=["key", "answer", "errors", "attempts"])

    return run
