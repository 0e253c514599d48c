"""Every llm query that has SQL against it on the smallest tables; the others give rows."""

import os
from collections import Counter

import duckdb
import pytest

from marlstone.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_and_sql_agree(spark, name):
    db = duckdb.connect()
    for f in os.listdir(SF):
        db.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    df = queries.QUERIES[name](spark, SF)
    cur = db.execute(queries.ORACLE[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(map(repr, (r[c] for c in names))) for r in df.collect()) == Counter(tuple(map(repr, r)) for r in cur.fetchall())


def test_splits_divide_no_group(spark):
    rows = queries.QUERIES["p4_splits"](spark, SF).collect()
    found = {r.pos: r.group_id for r in queries.QUERIES["p4_found"](spark, SF).collect()}
    sides = {}
    for r in rows:
        if r.pos in found:
            sides.setdefault(found[r.pos], set()).add(r.split)
    assert len(rows) == spark.read.parquet(f"{SF}/labels.parquet").count() and all(len(s) == 1 for s in sides.values())
    assert abs(sum(r.split == "train" for r in rows) / len(rows) - 0.8) < 0.05
