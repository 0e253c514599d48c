import random

import pytest

from marlstone import stages
from marlstone.llm import leaks

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(400)]


def _brute(docs, items):
    out = set()
    for k, t in docs:
        for i, s in items:
            if t and s and leaks.leaked(leaks.words_of(s), leaks.words_of(t)):
                out.add((k, i))
    return out


def _run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return {tuple(r) for r in leaks.leaked_passages(d, i).collect()}


def _edited(words, every):
    out = []
    for k, w in enumerate(words):
        if k % every == every - 1:
            kind = k // every % 3
            out += ["new"] if kind == 0 else [] if kind == 1 else [w, "more"]
        else:
            out.append(w)
    return out


def _cases():
    r = random.Random(5)
    item = r.sample(WORDS, 70)
    rest = lambda n: [f"z{r.randrange(10**6)}" for _ in range(n)]
    docs = [
        None, "", " . ", " ".join(item), " ".join(rest(30) + item[5:17] + rest(30)), " ".join(rest(30) + item[5:16] + rest(30)), " ".join(rest(9) + _edited(item[10:50], 9) + rest(9)),
        " ".join(rest(9) + _edited(item[10:29], 9)), " ".join(rest(9) + _edited(item[0:60], 5)), " ".join(reversed(item)), " ".join(item[:6] + rest(900) + item[64:]), " ".join(item[:6] + rest(900) + item[20:40] + rest(300) + item[60:66]),
        "_".join(w.upper() for w in item[30:42]), " ".join(item[0:5] + rest(5) + item[5:10] + rest(5) + item[10:15]), "­".join(" ".join(item[3:16])), " ".join(item[:12]) + " " + " ".join(rest(5000)),
    ]
    docs += [" ".join(rest(r.randrange(60)) + _edited(item[(a := r.randrange(50)) : a + r.randrange(8, 40)], r.choice([3, 7, 8, 9, 12])) + rest(r.randrange(60))) for _ in range(60)]
    items = [(1, " ".join(item)), (2, None), (3, ""), (4, " ".join(r.sample(WORDS, 12))), (5, " ".join(item[:40])), (5, " ".join(item[40:]))]
    return [(i, d) for i, d in enumerate(docs)] + [(3, docs[3]), (None, docs[3])], items


def test_cases_equal_brute_force(spark):
    docs, items = _cases()
    got = _run(spark, docs, items)
    assert got == _brute(docs, items)
    assert {k for k, i in got if i == 1 and k is not None and k < 16} == {3, 4, 6, 11, 12, 14, 15} and (None, 1) in got


@pytest.mark.parametrize("filtered", [True, False])
def test_sizes_change_nothing(spark, monkeypatch, filtered):
    docs, items = _cases()
    want = _run(spark, docs, items)
    monkeypatch.setattr(stages, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(leaks, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(leaks, "FILTER_FINGERPRINTS", 2_000_000 if filtered else -1)
    assert _run(spark, docs, items) == want


def test_documents_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/eval_items.parquet").collect()]
    assert _run(spark, docs, items) == _brute(docs, items) != set()


def test_a_third_of_copies_and_no_rows(spark):
    docs, items = _cases()
    copies = [(1000 + i, docs[3][1]) for i in range(60)]
    got = _run(spark, docs + copies, items)
    assert {(k, 1) for k, _ in copies} <= got and got - {(k, i) for k, i in got if k and k >= 1000} == _run(spark, docs, items)
    assert _run(spark, docs[:0], items) == set() == _run(spark, docs, items[:0])


def test_other_names_and_columns(spark):
    d = spark.createDataFrame([("a", " ".join(WORDS[:20]), "x", 1)], "name string, body string, fp string, h int")
    i = spark.createDataFrame([("q", " ".join(WORDS[:20]), "y")], "quiz string, body string, item string")
    assert [tuple(r) for r in leaks.leaked_passages(d, i, "name", "quiz", "body").collect()] == [("a", "q")]
