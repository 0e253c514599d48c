import json
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.operators import nested


def _leaves(value, path="$"):
    if isinstance(value, dict):
        for k, v in value.items():
            yield from _leaves(v, f"{path}.{k}")
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from _leaves(v, f"{path}[{i}]")
    elif isinstance(value, str):
        yield path, value


def _held(text):
    try:
        v = json.loads(text, parse_constant=lambda _: 1 / 0)
        v = json.loads(v, parse_constant=lambda _: 1 / 0) if isinstance(v, str) else v
    except (ValueError, ZeroDivisionError):
        return None
    return v if isinstance(v, (dict, list)) else None


def _found(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "pos int, t string")
    nodes = nested.nested_nodes(rows, ["pos"], {"a": F.col("t")})
    return Counter((r.pos, r.path, r.value) for r in nodes.filter("kind = 'string'").collect())


def _want(texts):
    return Counter((i, p, v) for i, t in enumerate(texts) if t is not None and (h := _held(t)) is not None for p, v in _leaves(h))


TEXTS = [
    None, "", "  ", "[]", "{}", "null", '"x"', "[", "]", "[1,]", "[,1]", "{1:2}", '{"a"}', '{"a":}', '{"a":1,}', '["a" "b"]', '["a"],', '[1 2]', "[01]", "[1.]", "[+1]", "[NaN]", "[tru]",
    '["a","b"]', ' {"a": ["x", {"b": null, "c": "y"}], "d": true} ', '["\\u0041\\n\\"", "\\\\"]', '["\\x"]', '["\\u12"]', '["a\tb"]', '["unclosed]', '[["a"],["b",["c"]]]', json.dumps(json.dumps({"k": ["v"]})),
    json.dumps("plain"), '"[1"', '{"a":"1","a":"2"}', '["\\ud83d\\ude00"]', "[" * 60 + '"deep"' + "]" * 60, '["' + "x" * 200_000 + '"]', '[{"a":"b"}] x', '{"a":{"b":{"c":["d","e"]}}}', "[}", "{]",
]


def test_leaves_equal_a_parser(spark):
    simple = [t for t in TEXTS if t != '{"a":"1","a":"2"}']
    assert _found(spark, simple) == _want(simple)
    assert _found(spark, ['{"a":"1","a":"2"}']) == Counter([(0, "$.a", "1"), (0, "$.a", "2")])  # a repeated member gives a node each


_names = st.text("abcxyz", min_size=1, max_size=3)
_values = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(_names, x, max_size=3), max_leaves=12)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(_values, st.integers(0, 3)), min_size=1, max_size=40))
def test_any_text(spark, values):
    texts = []
    for v, how in values:
        t = json.dumps(v, ensure_ascii=how == 1, indent=1 if how == 2 else None)
        texts.append(t[: len(t) // 2] if how == 3 else t)
    assert _found(spark, texts) == _want(texts)


def test_links_and_tables(spark):
    rows = spark.createDataFrame([(7, '{"w":[{"item":"a","n":2},{"item":"b","n":"x"},{"n":null},5]}', "kept")], "pos int, t string, node string")
    nodes = nested.nested_nodes(rows, ["pos"], {"f": F.col("t")})
    containers, leaves = nested.nested_tables(nodes)
    assert [(r.node, r.parent, r.kind, r.name, r.nth) for r in containers.orderBy("node").collect()] == [(0, None, "object", None, None), (1, 0, "array", "w", None), (2, 1, "object", None, 0), (5, 1, "object", None, 1), (8, 1, "object", None, 2)]
    by = {(r.parent, r.name, r.nth): r.value for r in leaves.collect()}
    assert by[2, "item", None] == "a" and by[1, None, 3] == "5" and by[8, "n", None] == "null"
    items = nested.child_table(nodes, ["pos"], "w", {"item": "string", "n": "int"}).orderBy("place").collect()
    assert [(r.pos, r.parent, r.place, r.item, r.n) for r in items] == [(7, 1, 0, "a", 2), (7, 1, 1, "b", None), (7, 1, 2, None, None)]
    assert nested.child_table(nodes, ["pos"], "other", {"item": "string"}).count() == 0


def test_equal_and_null_keys_and_no_rows(spark):
    rows = spark.createDataFrame([(None, '["a"]'), (1, '["b"]'), (1, '["b"]')], "pos int, t string")
    nodes = nested.nested_nodes(rows, ["pos"], {"f": F.col("t")})
    assert Counter((r.pos, r.value) for r in nodes.filter("kind = 'string'").collect()) == {(None, "a"): 1, (1, "b"): 2}
    assert nested.nested_nodes(rows.limit(0), ["pos"], {"f": F.col("t")}).count() == 0
