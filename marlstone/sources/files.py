"""Files of records. Required inputs are read with a fixed schema and fail on a broken line; nothing is inferred."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Schemas of the record files.
LABELS = "video_id string, video_uri string, duration_sec double, resolution string, labels struct<role_type:string,sub_keyscene:string,description:string>, meta map<string,string>"
PREDS = "video_id string, output string, score array<double>"
CHATS = "id string, videos array<string>, conversations array<struct<from:string,value:string>>"
LABELER = "video_id string, gemini_model string, temperature double, gemini_output struct<attributes:struct<clothing:string,held_items:string,posture:string,action:string,view_type:string,sub_role_type:string,dwell:string>,reasoning_chain:string,reasoning_chain_zh:string,predictions:struct<role_type:string,sub_keyscene:string,description:string>>"


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with pos: numbers in the order of files by name and of lines within each, with gaps between a file's blocks."""
    ids = F.dense_rank().over(Window.orderBy("_file"))
    files = rows.select(F.col("_metadata.file_path").alias("_file")).distinct().withColumn("_n", ids)  # one row a file
    marked = rows.withColumn("_file", F.col("_metadata.file_path")).withColumn("_at", F.col("_metadata.file_block_start")).withColumn("_id", F.monotonically_increasing_id())
    part = F.col("_id").bitwiseAND((1 << 33) - 1)
    return marked.join(F.broadcast(files), "_file").withColumn("pos", F.col("_n").cast("decimal(38,0)") * F.lit(1 << 62).cast("decimal(38,0)") + F.col("_at") + part).drop("_file", "_n", "_at", "_id")


def read_json_lines(spark: SparkSession, path: str, schema: str, order: bool = False) -> DataFrame:
    """Records of JSON lines; a broken line raises. With ``order``, pos (a decimal) rises in the order of files and lines.

    A block's lines are fewer than its bytes, so block starts plus line numbers never run into the next block.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return _placed(rows) if order else rows


def flat_labels(rows: DataFrame) -> DataFrame:
    """role_type, sub_keyscene, description beside the other columns, whether they are nested in ``labels`` or not."""
    inner = {f.name for f in rows.schema["labels"].dataType.fields} if "labels" in rows.columns and isinstance(rows.schema["labels"].dataType, T.StructType) else set()
    pick = lambda c: F.coalesce(*[F.col(x) for x in ([f"labels.{c}"] if c in inner else []) + ([c] if c in rows.columns else [])], F.lit(None).cast("string")).alias(c)
    names = ("role_type", "sub_keyscene", "description")
    return rows.select(*[c for c in rows.columns if c != "labels" and c not in names], *[pick(c) for c in names])


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of one JSON array in a whole document."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_json_map(spark: SparkSession, path: str, value: str = "double") -> DataFrame:
    """key, value of one JSON object in a whole document."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{value}>", {"mode": "FAILFAST"})).alias("key", "value"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """id: the words of a text between white space of any kind; repeated ones once."""
    from marlstone.functions.texts import word_list

    return spark.read.text(path).select(F.explode(word_list(F.col("value"))).alias("id")).distinct()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a table with a header, quoted cells over several lines and perhaps a byte-order mark; all cells are texts."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.toDF(*[c.lstrip("﻿") for c in rows.columns])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value: raw lines, bytes kept, for filters that pass lines on."""
    return spark.read.text(path)


def parse_range(spec: str | None, known: list[int]) -> list[int]:
    """The numbers that ``0-3`` or ``0,5,7`` names among the known ones; all of them without a text."""
    if not spec:
        return sorted(known)
    want: set[int] = set()
    for part in spec.split(","):
        a, _, b = part.partition("-")
        want |= set(range(int(a), int(b or a) + 1))
    return sorted(want & set(known))


def read_settings(path: str) -> dict:
    """A small settings document: JSON, or YAML where that library is there."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        return json.loads(text)
    except ValueError:
        import yaml

        return yaml.safe_load(text)
