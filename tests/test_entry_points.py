import json

import numpy as np
from pyspark.sql import functions as F

from marlstone import cli
from marlstone.functions import sql
from marlstone.operators import routing
from marlstone.sources import frames, sinks


def test_files_become_tables_and_reports(spark, tmp_path, capsys):
    labels = [("q", "C"), ("q", "C"), ("a", "A")]
    (tmp_path / "l.jsonl").write_text("".join(json.dumps({"video_id": f"v{i}", "labels": {"role_type": r, "sub_keyscene": s, "description": "d"}, "meta": {"camera_id": "c"}}) + "\n" for i, (s, r) in enumerate(labels)))
    (tmp_path / "p.jsonl").write_text("".join(json.dumps({"video_id": f"v{i}", "output": o}) + "\n" for i, o in enumerate(["C|q|x", "old", "C|n|x"])) + json.dumps({"video_id": "v1", "output": "C|q|x"}) + "\n")
    out = str(tmp_path / "t")
    assert cli.main(["load", "--labels", str(tmp_path / "l.jsonl"), "--preds", str(tmp_path / "p.jsonl"), "--out", out], spark) == 0
    assert [r.pos for r in spark.read.parquet(f"{out}/eval_preds.parquet").orderBy("pos").collect()] == [1, 2, 3, 4]
    capsys.readouterr()
    cli.main(["run", "accuracy", "--tables", out], spark)
    lines = sorted(x.split() for x in capsys.readouterr().out.strip().splitlines()[1:])
    assert lines == [["ks", "3", "2", "0.6667"], ["rt", "3", "2", "0.6667"], ["sk", "3", "2", "0.6667"]]
    cli.main(["run", "dedup_first", "--tables", out, "--ids", "video_id", "--out", str(tmp_path / "ids")], spark)
    assert spark.read.text(str(tmp_path / "ids")).count() == 3
    cli.main(["queries"])
    assert "prf_per_class" in capsys.readouterr().out


def test_functions_in_sql(spark):
    sql.register(spark)
    got = spark.sql("SELECT scene_group('q') a, scene_group(null) b, pair_is_legal('A', 'n') c, pair_is_legal(null, 'n') d, after_thinking('<think>x</think>y') e, cjk_ratio('一a') f, cjk_ratio('') g").first()
    assert tuple(got) == ("LifeThreat", None, False, True, "y", 0.5, 0.0)
    assert [tuple(r) for r in spark.sql("SELECT * FROM island_rows(array(true, true, false, null, true))").collect()] == [(0, 2), (4, 1)]
    assert [tuple(r) for r in spark.sql("SELECT * FROM token_rows('abcde', 2)").collect()] == [(0, 0, 2), (1, 2, 4), (2, 4, 5)]


def test_calls_are_routed_judged_and_tried_again(spark):
    rows = spark.createDataFrame([(1, "good"), (2, "pass"), (3, "bad"), (4, "down"), (5, None)], "k int, t string")

    def call(texts):
        if "down" in texts:
            raise OSError("no service")
        return [t.upper() for t in texts]

    def judge(text, answer):
        return "unfaithful" if text == "bad" else None

    got = {r.k: tuple(r)[1:] for r in routing.called(rows, "k", "t", F.col("t") != "pass", call, judge, together=1).collect()}
    assert got == {1: ("GOOD", "done", None), 2: ("pass", "same", None), 3: ("bad", "failed", "unfaithful"), 4: ("down", "failed", "OSError: no service"), 5: (None, "same", None)}


def test_jobs():
    jobs = [{"name": "a", "output": "x"}, {"name": "b", "inputs": ["x"], "output": "y"}, {"name": "c", "inputs": ["y"], "output": "z"}]
    assert routing.job_states(jobs, {"x"}.__contains__) == [("a", "done"), ("b", "ready"), ("c", "blocked")] and routing.next_job(jobs, {"x"}.__contains__) == "b"
    assert routing.next_job(jobs, {"x", "y", "z"}.__contains__) is None and routing.stands_still(0.0, 100) and not routing.stands_still(0.1, 100)


def test_tensors_and_images(spark, tmp_path):
    np.savez(tmp_path / "a.npz", w=np.arange(6.0).reshape(2, 3), b=np.ones(1))
    got = {r.key: (r.shape, r.data) for r in frames.read_tensors(spark, str(tmp_path)).collect()}
    assert got == {"w": ([2, 3], [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]), "b": ([1], [1.0])}
    image = np.arange(64.0).reshape(8, 8)
    assert frames.resized(image, 2, 2).tolist() == [[13.5, 17.5], [45.5, 49.5]] and frames.resized(image[:1, :1], 2, 2).shape == (2, 2)
    v = frames.fingerprint(np.repeat(image[:, :, None], 3, axis=2), 4)
    assert abs(v.mean()) < 1e-12 and abs(np.linalg.norm(v) - 1) < 1e-12 and not frames.fingerprint(np.ones((4, 4))).any()
    assert frames.collage([np.ones((2, 2)), np.full((2, 2), 2.0)], 2).tolist() == [[1, 1, 2, 2], [1, 1, 2, 2], [0] * 4, [0] * 4]
    assert frames.augmented(np.array([[100, 200]], np.uint8), brightness=2.0).tolist() == [[200, 255]]
    for clip in ("c1", "c2"):
        (tmp_path / clip).mkdir()
        for n in ("b.png", "a.png"):
            (tmp_path / clip / n).write_bytes(b"x")
    seq = frames.image_sequences(spark, str(tmp_path)).collect()
    assert {(r.clip, r.path.rsplit("/", 1)[1], r.place, r.n) for r in seq} == {(c, n, k, 2) for c in ("c1", "c2") for k, n in enumerate(("a.png", "b.png"))}


def test_stored_frames_and_empty_assets(spark, tmp_path):
    rec = spark.createDataFrame([("a", "wds"), ("b", "mp4"), ("c", None)], "v string, s string")
    shards, other = (spark.createDataFrame([(k, d)], "key string, data string") for k, d in (("a", "from shard"), ("b", "from file")))
    assert {r.v: r.data for r in frames.stored_frames(rec, shards, other, F.col("v"), F.col("s")).collect()} == {"a": "from shard", "b": "from file", "c": None}
    sinks.write_nothing(spark, "a int", str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == 0
    log = sinks.log_to(str(tmp_path / "x.log"))
    log.info("hello")
    assert "hello" in (tmp_path / "x.log").read_text() and len(sinks.log_to(str(tmp_path / "x.log")).handlers) == 2
