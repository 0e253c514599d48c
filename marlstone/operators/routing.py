"""Calls to a service for the rows that need them, and the state of jobs that build on one another."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a service gets at once, and tries.
TOGETHER, TRIES = 20, 3


def called(rows: DataFrame, key: str, text: str, due: Column, call: Callable[[list[str]], list[str | None]], judge: Callable[[str, str], str | None] | None = None, together: int = TOGETHER, tries: int = TRIES) -> DataFrame:
    """``key``, text, status, issue: texts that aren't ``due`` pass through (status same); the others are answered by ``call`` in lots.

    An answer is judged (None: faithful, else what is wrong); what is missing or unfaithful is asked again, up to
    ``tries`` times, then comes out as failed with the last issue and its own text. Null texts pass through. Work in
    flight is one lot a task.
    """
    marked = rows.select(key, F.col(text).alias("text"), F.coalesce(due, F.lit(False)).alias("_due"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), together):
                lot = b.iloc[at : at + together]
                texts, issues = lot["text"].tolist(), [None] * len(lot)
                answers: list[str | None] = [None] * len(lot)
                open_ = list(range(len(lot)))
                for _ in range(tries):
                    try:
                        got = call([texts[i] for i in open_]) if open_ else []
                    except Exception as e:  # noqa: BLE001 - whatever the service raises is an issue of these rows
                        got = [None] * len(open_)
                        for i in open_:
                            issues[i] = f"{type(e).__name__}: {e}"
                    left = []
                    for i, answer in zip(open_, [*got, *[None] * len(open_)], strict=False):
                        issue = ("no answer" if issues[i] is None else issues[i]) if not answer else judge(texts[i], answer) if judge else None
                        issues[i] = issue
                        if issue is None:
                            answers[i] = answer
                        else:
                            left.append(i)
                    open_ = left
                done = [a if a is not None else t for a, t in zip(answers, texts, strict=True)]
                yield pd.DataFrame({key: lot[key].tolist(), "text": done, "status": ["done" if a is not None else "failed" for a in answers], "issue": pd.Series(issues, dtype=object)})

    todo = marked.filter("_due and text is not null").select(key, "text")
    kind = rows.schema[key].dataType.simpleString()
    answered = todo.mapInPandas(run, f"{key} {kind}, text string, status string, issue string")
    rest = marked.filter(~F.col("_due") | F.col("text").isNull()).select(key, "text", F.lit("same").alias("status"), F.lit(None).cast("string").alias("issue"))
    return answered.unionByName(rest)


def job_states(jobs: list[dict], exists: Callable[[str], bool]) -> list[tuple[str, str]]:
    """Name and state of each job (name, inputs, output) in order: done (its output is there), ready (its inputs are) or blocked."""
    return [(j["name"], "done" if exists(j["output"]) else "ready" if all(map(exists, j.get("inputs", ()))) else "blocked") for j in jobs]


def next_job(jobs: list[dict], exists: Callable[[str], bool]) -> str | None:
    """The first job that isn't done and could run."""
    return next((name for name, state in job_states(jobs, exists) if state == "ready"), None)


def stands_still(gap: float, step: int, after: int = 100, least: float = 1e-7) -> bool:
    """Whether weights have hardly left where they began, long after they should have."""
    return step >= after and gap < least
