from collections import Counter

import duckdb

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"


def _rows(df):
    return Counter(map(tuple, df.collect()))


def test_entry_counts_scene_letters_as_its_sql(spark):
    got = _rows(e.entry(spark))
    db = duckdb.connect()
    for t in ("labels", "eval_preds"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert got and got == Counter(db.execute(e.oracle_sql()["confusion_matrix"]).fetchall())


def test_last_rows_count_and_failures_are_question_marks(spark, tmp_path):
    spark.sql("""SELECT * FROM VALUES (1L, 'a', named_struct('sub_keyscene', 'c')), (2L, 'a', named_struct('sub_keyscene', 'd')), (3L, 'b', named_struct('sub_keyscene', null)),
        (4L, 'c', null), (5L, 'x', named_struct('sub_keyscene', 'e')), (6L, 'd', named_struct('sub_keyscene', 'f')) AS t(pos, video_id, labels)""").write.parquet(f"{tmp_path}/labels.parquet")
    spark.sql("""SELECT * FROM VALUES (1L, 'a', 'A|z|x'), (2L, 'a', '<think>B|b|</think> a | D | x|y'), (3L, 'b', 'A|b'), (4L, 'c', null), (5L, 'd', 'F|f|x'), (6L, 'gone', 'A|a|x')
        AS t(pos, video_id, output)""").write.parquet(f"{tmp_path}/eval_preds.parquet")
    assert _rows(e.queries()["confusion_matrix"](spark, str(tmp_path))) == Counter({("d", "d", 1): 1, (None, "?", 2): 1, ("f", "?", 1): 1})
