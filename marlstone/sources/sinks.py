"""Sinks: JSON lines with nulls, id lists, one JSON object, worksheets, dead letters, and folders that are swapped whole."""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators.keyed import by_errors, remaining
from marlstone.stages import drop_stage, stage


def write_json_lines(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines in UTF-8; null members stay."""
    rows.write.option("ignoreNullFields", False).mode(mode).json(path)


def write_ids(rows: DataFrame, key: str, path: str) -> None:
    rows.select(F.col(key).cast("string")).filter(F.col(key).isNotNull()).write.text(path)


def write_lines(rows: DataFrame, path: str, column: str = "value") -> None:
    """Raw lines as they were read."""
    rows.select(column).write.text(path)


def write_json_map(rows: DataFrame, key: str, value: str, path: str, most: int = 1_000_000) -> None:
    """One JSON object of keys and values, for tables of at most ``most`` rows; larger ones raise."""
    n = rows.limit(most + 1).count()
    if n > most:
        raise ValueError(f"more than {most} keys; write JSON lines instead")
    one = rows.coalesce(1).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), value)))).alias("value"))
    one.coalesce(1).write.text(path)


def write_worksheet(rows: DataFrame, path: str, most: int = 10_000) -> None:
    """A table with a byte-order mark for people, of at most ``most`` rows; more raise."""
    got = rows.limit(most + 1).toPandas()
    if len(got) > most:
        raise ValueError(f"more than {most} rows")
    got.to_csv(path, index=False, encoding="utf-8-sig")


def write_with_errors(rows: DataFrame, good: str, bad: str, errors: str = "errors") -> None:
    """Good rows and dead letters (with their errors) to two folders of JSON lines, from one evaluation of ``rows``."""
    once = stage(rows)
    fine, dead = by_errors(once, errors)
    write_json_lines(fine, good, "append")
    write_json_lines(dead, bad, "append")
    drop_stage(once)


def append_remaining(rows: DataFrame, key: str, path: str, schema: str | None = None) -> int:
    """Append the rows whose key ``path`` doesn't hold yet, and tell how many; a run that broke off goes on where it was."""
    spark = rows.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    left = stage(remaining(rows, spark.read.schema(schema or rows.schema).json(path), key) if there else rows)
    n = left.count()
    if n:
        write_json_lines(left, path, "append")
    drop_stage(left)
    return n


def replace_folder(rows: DataFrame, path: str) -> None:
    """Write ``rows`` (which may read ``path``) beside it, then swap the folders; until then the old one stays whole."""
    spark = rows.sparkSession
    new, old = f"{path.rstrip('/')}.new", f"{path.rstrip('/')}.old"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows.write.mode("overwrite").parquet(new)
    files.delete(at(old), True)
    if files.exists(at(path)):
        files.rename(at(path), at(old))
    files.rename(at(new), at(path))
    files.delete(at(old), True)


def merge_report(rows: DataFrame, output: str = "output") -> DataFrame:
    """rows, empty: of merged parts, which a folder's read unites anyway."""
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.coalesce(output, F.lit("")) == "").alias("empty"))


def text_report(rows: DataFrame, most: int = 1_000) -> str:
    """A small result (at most ``most`` rows, more raise) as columns of fixed width."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} rows")
    cells = [[str(c) for c in rows.columns], *[["-" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v) for v in r] for r in got]]
    width = [max(len(r[i]) for r in cells) for i in range(len(rows.columns))]
    return "\n".join("  ".join(v.rjust(w) for v, w in zip(r, width, strict=True)) for r in cells)


def write_nothing(spark: SparkSession, schema: str, path: str) -> None:
    """A table without rows that holds the place of an asset that isn't made yet."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def log_to(path: str, name: str = "marlstone") -> logging.Logger:
    """A logger that writes to the console and to a file."""
    log = logging.getLogger(name)
    log.setLevel(logging.INFO)
    if not any(isinstance(h, logging.FileHandler) and h.baseFilename == os.path.abspath(path) for h in log.handlers):
        log.addHandler(logging.FileHandler(path, encoding="utf-8"))
        log.addHandler(logging.StreamHandler())
    return log
