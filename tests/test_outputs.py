import pytest
from pyspark.sql import functions as F

from marlstone.functions import outputs, texts


def _each(spark, values, column, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.x for r in rows.select("i", column(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strict_parser(spark):
    texts_ = ["c | C | a man", "<think>x</think>\nC | s | waits", "no pipes here", "f | x | d", "<think>B|i|d", "B|i|a|b", " B | i |x", "B|i", "B|i|", "", "|", None]
    p = _each(spark, texts_, outputs.strict)
    assert [r.ok for r in p] == [True, True, False, False, False, True, True, False, True, False, False, False]
    assert (p[0].rt, p[0].sk, p[0].case_fixed, p[0].think_leak) == ("C", "c", True, False)
    assert (p[1].rt, p[1].sk, p[1].think_leak, p[1].description) == ("C", "s", True, "waits")
    assert p[3].case_fixed and p[4].think_leak and p[5].description == "a|b" and (p[6].rt, p[6].sk) == ("B", "i")
    assert p[8].description == "" and [r.fields for r in p[9:]] == [1, 2, 0]


def test_five_parsers_differ(spark):
    both = ["c | C | x", "B|i", "B | i | x"]
    assert [r.rt for r in _each(spark, both, outputs.strict)] == ["C", None, "B"]
    assert [r.rt for r in _each(spark, both, outputs.by_pattern)] == [None, None, "B"]
    assert [r.rt for r in _each(spark, both, lambda c: outputs.loose(c, 2))] == ["c", "B", "B"]
    assert [r.rt for r in _each(spark, both, lambda c: outputs.loose(c, 3))] == ["c", None, "B"]
    assert [r and r.description for r in _each(spark, ["D|g|desc, with | pipe", "B|i", None], outputs.stored_label)] == ["desc, with | pipe", None, None]


def test_guard_and_legality(spark):
    act = lambda vs: _each(spark, vs, lambda c: outputs.guard(outputs.strict(c)))
    assert act(["A|n|x", "D|q|x", "C|q|x", "E|b|x", "x", "<think></think>C|q|x"]) == ["escalate_to_C_alert", "escalate_to_C_alert", "accept", "flag_low_confidence", "reject", "flag_low_confidence"]
    assert _each(spark, ["A|n|d", "A | u | d", "A|c|d", "D|n|d", "A|n", None], outputs.legalised) == ["C|n|d", "C|u| d", "A|c|d", "D|n|d", "A|n", None]


def test_targets_and_weights(spark):
    rows = spark.createDataFrame([("B", "i", " Hi. ", "a <think>b</think>")], "r string, s string, d string, c string")
    t = outputs.target(F.col("r"), F.col("s"), F.col("d"))
    got = rows.select(t.alias("t"), outputs.target(F.col("r"), F.col("s"), F.col("d"), " | ").alias("w"), outputs.thinking_target(t, F.col("c")).alias("k")).first()
    assert (got.t.text, tuple(got.t.spans[0])) == ("B|i|Hi.", (0, 4, 4.0)) and tuple(got.w.spans[0]) == (0, 8, 4.0)
    assert got.k.text == "<think>a b</think>\nB|i|Hi." and [tuple(s) for s in got.k.spans] == [(0, 19, 0.0), (19, 23, 4.0)]
    offsets = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0, 1), (1, 2), (2, 3), (3, 4), (4, 7), (0, 0), (3, 6))])
    assert rows.select(outputs.token_weights(t["spans"], offsets).alias("w")).first().w == [4.0, 4.0, 4.0, 4.0, 1.0, 0.0, 4.0]
    assert rows.select(outputs.token_weights(outputs.thinking_target(t, F.col("c"))["spans"], F.array(F.struct(F.lit(0).alias("start"), F.lit(19).alias("end")), F.struct(F.lit(10).alias("start"), F.lit(20).alias("end")))).alias("w")).first().w == [0.0, 4.0]
    assert rows.select(outputs.prefix_weights(F.array(F.lit(1), F.lit(3), F.lit(2)), 4).alias("w")).first().w == [4.0, 4.0, 1.0]
    for bad in (("b", "i"), ("F", "i"), ("B", "I"), ("B", "z")):
        broken = outputs.target(F.lit(bad[0]), F.lit(bad[1]), F.lit("x"))
        assert rows.select(broken.alias("t")).first().t is None
        with pytest.raises(Exception, match="invalid letter"):
            rows.select(outputs.checked(broken)).collect()


def test_lookups(spark):
    assert _each(spark, ["1600x2200", "1920x1080", "384x384", "16x0", "", None, "axb"], lambda c: outputs.view_type(c, F.lit("given"))) == ["doorbell", "non_doorbell", *["given"] * 5]
    assert _each(spark, ["casual", "nope", None], lambda c: outputs.value_index("clothing", c)) == [1, -100, -100]
    assert _each(spark, ["a", "q", "z", None], outputs.group_of) == ["Normal", "LifeThreat", None, None]


def test_texts(spark):
    assert _each(spark, ["", None, "一a", "一" + "a" * 9, "一" + "a" * 8], texts.cjk_ratio) == [0.0, 0.0, 0.5, 0.1, 1 / 9]
    assert _each(spark, ["[身份线索]x[结论]y", None], texts.normal_tags) == ["[Identity cues]x[Conclusion]y", None]
    assert _each(spark, [" a b\n", "", None], texts.word_count) == [2, 0, 0]
    good = {"predictions": {"role_type": "A", "sub_keyscene": "a", "description": "w " * 10}, "reasoning_chain": "fine", "attributes": {"clothing": "casual", "held_items": "none", "posture": "sitting", "action": "none", "view_type": "doorbell", "sub_role_type": "Kid", "dwell": "brief_stop"}}
    bad = {"predictions": {"role_type": "F", "sub_keyscene": None, "description": "w"}, "reasoning_chain": "一" * 5, "attributes": None}
    schema = "i int, v struct<attributes:struct<clothing:string,held_items:string,posture:string,action:string,view_type:string,sub_role_type:string,dwell:string>,reasoning_chain:string,predictions:struct<role_type:string,sub_keyscene:string,description:string>>"
    got = [r.e for r in spark.createDataFrame([(0, good), (1, bad), (2, None)], schema).select("i", texts.record_errors(F.col("v")).alias("e")).orderBy("i").collect()]
    assert got[0] == [] and got[1][:4] == ["role_type", "sub_keyscene", "description:1", "reasoning_chain"] and len(got[1]) == 11 and len(got[2]) == 10
