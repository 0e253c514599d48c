import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from marlstone.sources import files, sinks
from marlstone.sources.shards import ShardSource
from marlstone.streaming import ingest


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(json.dumps({"video_id": f"v{i}", "labels": {"role_type": "A"}, "meta": {"x": "1"}}) + "\n" for i in range(5)))
    (tmp_path / "b.jsonl").write_text(json.dumps({"video_id": "last"}) + "\n")
    rows = files.read_json_lines(spark, str(tmp_path), files.LABELS, order=True).orderBy("pos").collect()
    assert [r.video_id for r in rows] == ["v0", "v1", "v2", "v3", "v4", "last"] and rows[0].labels.role_type == "A" and rows[0].labels.description is None
    (tmp_path / "b.jsonl").write_text("{broken\n")
    with pytest.raises(Exception, match="FAILFAST|Malformed|MALFORMED"):
        files.read_json_lines(spark, str(tmp_path), files.LABELS).collect()


def test_nested_or_flat(spark):
    flat = spark.createDataFrame([("v", "A", "a", "x")], "video_id string, role_type string, sub_keyscene string, description string")
    nested = flat.select("video_id", F.struct("role_type", "sub_keyscene", "description").alias("labels"))
    assert files.flat_labels(flat).collect() == files.flat_labels(nested).collect()


def test_documents_lists_and_tables(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "videos": ["v"], "conversations": [{"from": "gpt", "value": "x"}]}]))
    assert files.read_json_array(spark, str(tmp_path / "a.json"), files.CHATS).first().conversations[0]["from"] == "gpt"
    (tmp_path / "m.json").write_text('{"a": 1.5,\n "b": 2}')
    assert {r.key: r.value for r in files.read_json_map(spark, str(tmp_path / "m.json")).collect()} == {"a": 1.5, "b": 2.0}
    (tmp_path / "ids.txt").write_text("a b\n\n c　a\n")
    assert sorted(r.id for r in files.read_ids(spark, str(tmp_path / "ids.txt")).collect()) == ["a", "b", "c"]
    (tmp_path / "t.csv").write_text('﻿idx,text\n1,"a ""b"", \nc"\n', encoding="utf-8")
    assert [tuple(r) for r in files.read_table(spark, str(tmp_path / "t.csv")).collect()] == [("1", 'a "b", \nc')]
    assert files.parse_range("0-2,5", [0, 2, 5, 7]) == [0, 2, 5] and files.parse_range(None, [3, 1]) == [1, 3]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("v1", 1.5, None), ("v2", 2.0, "ü")], "id string, w double, t string")
    sinks.write_json_lines(rows, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).filter("value like '%null%'").count() == 1
    sinks.write_json_map(rows, "id", "w", str(tmp_path / "m"))
    assert {r.key: r.value for r in files.read_json_map(spark, str(tmp_path / "m")).collect()} == {"v1": 1.5, "v2": 2.0}
    with pytest.raises(ValueError, match="more than 1"):
        sinks.write_json_map(rows, "id", "w", str(tmp_path / "m2"), 1)
    sinks.write_ids(rows, "id", str(tmp_path / "ids"))
    assert sorted(r.id for r in files.read_ids(spark, str(tmp_path / "ids")).collect()) == ["v1", "v2"]
    sinks.write_worksheet(rows, str(tmp_path / "w.csv"))
    assert (tmp_path / "w.csv").read_bytes().startswith(b"\xef\xbb\xbf") and files.read_table(spark, str(tmp_path / "w.csv")).columns[0] == "id"
    assert sinks.text_report(rows).splitlines()[1].split() == ["v1", "1.5000", "-"]
    assert tuple(sinks.merge_report(rows, "t").first()) == (2, 1)


def test_errors_go_to_their_own_folder(spark, tmp_path):
    rows = spark.createDataFrame([("v1", []), ("v2", ["bad"]), ("v3", None)], "id string, errors array<string>")
    sinks.write_with_errors(rows, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.json(str(tmp_path / "good")).count() == 2 and spark.read.json(str(tmp_path / "bad")).first().errors == ["bad"]


def test_appending_goes_on_where_it_was(spark, tmp_path):
    rows, path = spark.createDataFrame([("v1", "x"), ("v2", "y")], "id string, t string"), str(tmp_path / "out")
    assert sinks.append_remaining(rows.limit(1), "id", path) == 1 and sinks.append_remaining(rows, "id", path) == 1 and sinks.append_remaining(rows, "id", path) == 0
    assert spark.read.json(path).count() == 2


def test_a_folder_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_folder(spark.range(3), path)
    sinks.replace_folder(spark.read.parquet(path).filter("id > 0"), path)  # reads what it replaces
    assert spark.read.parquet(path).count() == 2 and not (tmp_path / "t.old").exists() and not (tmp_path / "t.new").exists()


def test_shards(spark, tmp_path):
    for n in range(3):
        with tarfile.open(tmp_path / f"shard-{n:06d}.tar", "w") as tar:
            for k in range(4):
                data = json.dumps({"frames": n * 10 + k}).encode()
                info = tarfile.TarInfo(f"cam__{n}_{k}.json")
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
    spark.dataSource.register(ShardSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    read = lambda **o: spark.read.format("shards").options(**o).load(str(tmp_path))
    assert read().count() == 12 and read(shards="0-1").count() == 8
    one = read().filter("key = 'cam/2_3'").collect()
    assert [(r.shard, r.kind, json.loads(r.data)["frames"]) for r in one] == [(2, "json", 23)]


def test_a_stream_resumes_and_sorts_out_errors(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    run = lambda: ingest.ingest(spark, str(src), "id string, text string", "id", lambda df: F.array_compact(F.array(F.when(F.coalesce("text", F.lit("")) == "", "empty"))), str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "cp")).awaitTermination()
    (src / "a.json").write_text('{"id": "v1", "text": "x"}\n{"id": "v2", "text": ""}\n')
    run()
    (src / "b.json").write_text('{"id": "v3", "text": "y"}\n{"id": "v1", "text": "again"}\n')
    run()
    run()
    assert sorted((r.id, r.text) for r in spark.read.json(str(tmp_path / "good")).collect()) == [("v1", "x"), ("v3", "y")]
    assert [(r.id, r.errors) for r in spark.read.json(str(tmp_path / "bad")).collect()] == [("v2", ["empty"])]
