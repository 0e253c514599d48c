"""Command line: load files of records into tables, list the queries, and run any of them over a folder of tables.

python -m marlstone.cli load --labels labels.jsonl --preds preds.jsonl --labeler pass.jsonl --chains chains.jsonl --out TABLES
python -m marlstone.cli queries
python -m marlstone.cli run prf_per_class --tables TABLES [--out FOLDER | --ids COLUMN --out FOLDER]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from marlstone.plans import registry
from marlstone.shipping import ship
from marlstone.sources import files, sinks

#: Tables by option: their name and schema. pos, the order of arrival, is added.
TABLES = {
    "labels": ("labels", files.LABELS + ", recorded_at timestamp_ntz, ingested_at timestamp_ntz"),
    "preds": ("eval_preds", files.PREDS),
    "labeler": ("gemini_pass2", files.LABELER + ", lang string"),
    "chains": ("asset_c_reasoning", "video_id string, reasoning_chain string, lang string"),
}


def load(spark: SparkSession, paths: dict[str, str], out: str) -> dict[str, int]:
    """Write a table for each file of records, and tell their rows."""
    rows = {}
    for option, path in paths.items():
        name, schema = TABLES[option]
        placed = files.read_json_lines(spark, path, schema, order=True)
        from marlstone.operators.prefix import numbered

        numbered(placed, ["pos"], "number").drop("pos").withColumnRenamed("number", "pos").write.mode("errorifexists").parquet(f"{out}/{name}.parquet")
        rows[name] = spark.read.parquet(f"{out}/{name}.parquet").count()
    return rows


def result(spark: SparkSession, name: str, tables: str) -> DataFrame:
    ship(spark)
    return registry.QUERIES[name](spark, tables)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    top = argparse.ArgumentParser(prog="marlstone")
    sub = top.add_subparsers(dest="what", required=True)
    a = sub.add_parser("load")
    for option in TABLES:
        a.add_argument(f"--{option}")
    a.add_argument("--out", required=True)
    sub.add_parser("queries")
    r = sub.add_parser("run")
    r.add_argument("name", choices=sorted(registry.QUERIES))
    r.add_argument("--tables", required=True)
    r.add_argument("--out")
    r.add_argument("--ids", help="write only this column, as a list of ids")
    got = top.parse_args(args)
    if got.what == "queries":
        print("\n".join(f"{k}: {(q.__doc__ or '').strip().splitlines()[0] if q.__doc__ else ''}" for k, q in sorted(registry.QUERIES.items())))
        return 0
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if got.what == "load":
        print(load(spark, {k: getattr(got, k) for k in TABLES if getattr(got, k)}, got.out))
    elif got.out and got.ids:
        sinks.write_ids(result(spark, got.name, got.tables), got.ids, got.out)
    elif got.out:
        sinks.write_json_lines(result(spark, got.name, got.tables), got.out)
    else:
        print(sinks.text_report(result(spark, got.name, got.tables)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
