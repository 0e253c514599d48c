"""The functions under names of their own in SQL, and table functions for rows out of arrays."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from marlstone import vocab


@udtf(returnType="start: int, length: int")
class IslandRows:
    """The runs of true elements of a mask, a row each."""

    def eval(self, mask):
        start = None
        for i, v in enumerate([*(mask or []), False]):
            if v and start is None:
                start = i
            elif not v and start is not None:
                yield start, i - start
                start = None


@udtf(returnType="place: int, start_at: int, end_at: int")
class TokenRows:
    """The tokens of ``size`` characters of a text, a row each."""

    def eval(self, text: str, size: int):
        for k, i in enumerate(range(0, len(text or ""), size)):
            yield k, i, min(i + size, len(text))


def _cases(of: dict[str, str]) -> str:
    return " ".join(f"WHEN x IN ({', '.join(repr(c) for c in letters)}) THEN '{g}'" for g, letters in of.items())


#: Name, parameters, type and body of each SQL function; the engine puts the bodies into the plans that use them.
FUNCTIONS = {
    "scene_group": ("x STRING", "STRING", f"CASE {_cases(vocab.GROUPS)} END"),
    "pair_is_legal": ("r STRING, s STRING", "BOOLEAN", " AND ".join(f"NOT coalesce(r = '{r}' AND s IN ({', '.join(repr(c) for c in s)}), false)" for r, s in vocab.ILLEGAL.items())),
    "after_thinking": ("x STRING", "STRING", "substring_index(x, '</think>', -1)"),
    "cjk_ratio": ("x STRING", "DOUBLE", r"coalesce(try_divide(length(regexp_replace(coalesce(x, ''), r'[^\x{4E00}-\x{9FFF}]+', '')), length(x)), 0D)"),
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to ``spark.sql``; their names."""
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("island_rows", IslandRows)
    spark.udtf.register("token_rows", TokenRows)
    return [*FUNCTIONS, "island_rows", "token_rows"]
