from marlstone.llm import pipeline, queries

SF = "/root/testdata/sf0.001"


def test_pipeline_keeps_and_encodes_what_is_neither_spam_nor_leaked(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    gone = {r.doc_id for q in (queries.p8_found, queries.p9_found) for r in q(spark, SF).collect()}
    expected = {r.doc_id: r.ids for r in queries.p7_ids(spark, SF).collect() if r.doc_id not in gone}
    rows = docs
    for name, f in pipeline.STAGES:
        f(spark, rows, SF).write.parquet(f"{tmp_path}/{name}")
        rows = spark.read.parquet(f"{tmp_path}/{name}")
    got = rows.collect()
    assert gone and len(got) == len(expected) and {r.doc_id: r.ids for r in got} == expected
