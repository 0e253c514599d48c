from pyspark.sql import functions as F

from marlstone.operators import rowparse


def _rows(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "pos int, t string")


def _reasons(parsed):
    return [(r.reason, getattr(r, "field", None)) for r in parsed.orderBy("pos").collect()]


def test_first_broken_field(spark):
    values = [None, "", " ​ ", "A", "A|b", "A|b|", 'A|b|x|y', '"A"|b|x', '"A|b|x', 'A|"b|x', 'A|b|"x', 'A|b|"x"y"', 'A|b|"x""y"', 'A|b|say "x"', "F|b|x", "A|z|x", " a | B |x", "AA|b|x", '" a "|b|x']
    got = _reasons(rowparse.parsed_rows(_rows(spark, values), "t", rowparse.OUTPUT))
    assert got[:5] == [("missing", None)] * 3 + [("columns", "rt"), ("columns", "sk")]
    assert got[5:8] == [(None, None)] * 3
    assert got[8:12] == [("quoting", "rt"), ("quoting", "sk"), ("quoting", "description"), ("quoting", "description")]
    assert got[12:] == [(None, None)] * 2 + [("value", "rt"), ("value", "sk"), (None, None), ("value", "rt"), (None, None)]


def test_loaded_values(spark):
    values = ['"a"| B |"x ""y"" z"', "C|d|p|q", 'A|a|' + "w" * 300_000]
    valid, failed = rowparse.split_failures(rowparse.parsed_rows(_rows(spark, values), "t", rowparse.OUTPUT))
    rows = [r.loaded for r in valid.orderBy("pos").collect()]
    assert [tuple(r) for r in rows[:2]] == [("A", "b", 'x "y" z'), ("C", "d", "p|q")] and len(rows[2].description) == 300_000 and failed.count() == 0


def test_texts(spark):
    values = [None, "  ", "fine", "first\n A | b | glued", "A|b", '"open', '"done"', 'inner "quote"', "bad�", "bell\x07", "tab\tok\n"]
    got = [r.reason for r in rowparse.parsed_texts(_rows(spark, values), "t", rowparse.OUTPUT).orderBy("pos").collect()]
    assert got == ["missing", "missing", None, "columns", None, "quoting", None, None, "value", "value", None]


def test_other_schemas_and_clashing_names(spark):
    fields = [rowparse.Field("id", "[0-9]+"), rowparse.Field("name"), rowparse.Field("kind", "[xy]", "lower")]
    rows = spark.createDataFrame([(1, "12|n|X", "old"), (2, "z|n|x", "old"), (3, "1|n|q", "old")], "pos int, t string, reason string")
    parsed = rowparse.parsed_rows(rows, "t", fields)
    assert _reasons(parsed) == [(None, None), ("value", "id"), ("value", "kind")] and tuple(parsed.filter("pos = 1").first().loaded) == ("12", "n", "x")
    assert rowparse.parsed_rows(rows.limit(0), "t", fields).count() == 0


def test_thinking(spark):
    got = [r.x for r in _rows(spark, ["<think>A|a|x</think>B|b|y", "no tag", None]).select(rowparse.after_thinking(F.col("t")).alias("x")).collect()]
    assert got == ["B|b|y", "no tag", None]
