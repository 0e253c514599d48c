from marlstone.plans import records

SF = "/root/testdata/sf0.001"


def test_every_row_of_both_sources_is_loaded_or_failed(spark):
    found, fields, loaded = (getattr(records, f"p6_{x}")(spark, SF).collect() for x in ("found", "fields", "loaded"))
    rows = {(src, r.pos) for src in ("eval_preds", "labels") for r in spark.read.parquet(f"{SF}/{src}.parquet").select("pos").collect()}
    failed, valid = {(r.src, r.pos) for r in found}, {(r.src, r.pos) for r in loaded}
    assert len(loaded) == len(valid) and not failed & valid and failed | valid == rows
    assert {(r.src, r.pos, r.reason) for r in fields} == {tuple(r) for r in found} and len(fields) == len(found)
    assert all((r.field is None) == (r.reason == "missing") for r in fields)
    assert all(r.description for r in loaded if r.src == "labels")
