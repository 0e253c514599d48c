"""Queries over broken and nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import nested, rowparse
from marlstone.stages import table


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    out = "gemini_output"
    fields = {"clothing": F.col(f"{out}.attributes.clothing"), "held_items": F.col(f"{out}.attributes.held_items"), "role_type": F.col(f"{out}.predictions.role_type")}
    return nested.nested_nodes(table(spark, sf, "gemini_pass2"), ["pos"], fields)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _nodes(spark, sf).filter("kind = 'string'").select("pos", "attr", F.col("path").alias("leaf_path"), F.col("value").alias("leaf"))


def p3_containers(spark: SparkSession, sf: str) -> DataFrame:
    return nested.nested_tables(_nodes(spark, sf))[0]


def p3_leaves(spark: SparkSession, sf: str) -> DataFrame:
    return nested.nested_tables(_nodes(spark, sf))[1]


#: Members of the objects in the three fields' arrays, with their types.
ITEM = {"subject": "int", "item": "string", "clothing": "string", "garment": "string", "hand": "string", "count": "int", "rank": "int", "role_type": "string", "p": "double", "rater": "string", "t": "int"}


def p3_items(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each object in an array of the three fields, with its members and the node and place it leads back to."""
    return nested.child_table(_nodes(spark, sf), ["pos"], None, ITEM)


def _outputs(spark: SparkSession, sf: str) -> DataFrame:
    preds = table(spark, sf, "eval_preds").select("pos", rowparse.after_thinking(F.col("output")).alias("text"))
    return rowparse.parsed_rows(preds, "text", rowparse.OUTPUT)


def _descriptions(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels").select("pos", F.col("labels.description").alias("text"))
    return rowparse.parsed_texts(rows, "text", rowparse.OUTPUT)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    a = rowparse.split_failures(_outputs(spark, sf))[1].select(F.lit("eval_preds").alias("src"), "pos", "reason")
    b = rowparse.split_failures(_descriptions(spark, sf))[1].select(F.lit("labels").alias("src"), "pos", "reason")
    return a.unionByName(b)


def p6_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The broken field of each row of p6_found; null for missing. A description is a single field."""
    a = rowparse.split_failures(_outputs(spark, sf))[1].select(F.lit("eval_preds").alias("src"), "pos", "reason", "field")
    field = F.when(F.col("reason") != "missing", "description").alias("field")
    b = rowparse.split_failures(_descriptions(spark, sf))[1].select(F.lit("labels").alias("src"), "pos", "reason", field)
    return a.unionByName(b)


def p6_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The valid rows beside those of p6_found, loaded; a description of labels has no rt and sk of its own."""
    a = rowparse.split_failures(_outputs(spark, sf))[0].select(F.lit("eval_preds").alias("src"), "pos", "loaded.*")
    b = rowparse.split_failures(_descriptions(spark, sf))[0].select(F.lit("labels").alias("src"), "pos", F.col("loaded").alias("description"))
    return a.unionByName(b, allowMissingColumns=True)


QUERIES = {f.__name__: f for f in (p3_found, p3_containers, p3_leaves, p3_items, p6_found, p6_fields, p6_loaded)}

_BL = r"[\s\p{Z}\x{85}\x{200B}\x{2060}\x{FEFF}]*"
_HB = r"[\t\p{Zs}\x{200B}\x{2060}\x{FEFF}]*"
_PARTS = rf"""
outs AS (SELECT pos, CASE WHEN contains(output, '</think>') THEN string_split(output, '</think>')[-1] ELSE output END AS t FROM eval_preds),
cut AS (SELECT pos, t, string_split(t, '|') AS s FROM outs),
cols AS (SELECT pos, t, len(s) AS n, [regexp_replace(x, '^{_BL}|{_BL}$', '', 'g') FOR x IN [s[1], s[2], array_to_string(s[3:], '|')]] AS c FROM cut),
judged AS (SELECT pos, c, CASE
    WHEN t IS NULL OR regexp_full_match(t, '{_BL}') THEN 'missing'
    WHEN n < 3 THEN 'columns'
    WHEN len([x FOR x IN c IF starts_with(x, '"') AND NOT regexp_full_match(x, '"([^"]|"")*"')]) > 0 THEN 'quoting'
    WHEN NOT regexp_full_match(c[1], '(?i)("{_BL})?[A-E]({_BL}")?') OR NOT regexp_full_match(c[2], '(?i)("{_BL})?[a-u]({_BL}")?') THEN 'value' END AS reason FROM cols)
"""
_UNQUOTED = "CASE WHEN regexp_full_match({0}, '\"([^\"]|\"\")*\"') THEN regexp_replace(replace(substr({0}, 2, length({0}) - 2), '\"\"', '\"'), '^{1}|{1}$', '', 'g') ELSE {0} END"


def _bare(x: str) -> str:
    return _UNQUOTED.format(x, _BL)


_TEXTS = rf"""texts AS (SELECT pos, labels.description AS t, regexp_replace(labels.description, '^{_BL}|{_BL}$', '', 'g') AS c FROM labels),
other AS (SELECT pos, c, CASE
    WHEN t IS NULL OR c = '' THEN 'missing'
    WHEN regexp_matches(t, '(?m)(^|[\r\x{{85}}\x{{2028}}\x{{2029}}]){_HB}[A-E]{_HB}\|{_HB}[a-u]{_HB}\|') THEN 'columns'
    WHEN starts_with(c, '"') AND NOT regexp_full_match(c, '"([^"]|"")*"') THEN 'quoting'
    WHEN regexp_matches(t, '[\x{{0}}-\x{{8}}\x{{B}}\x{{C}}\x{{E}}-\x{{1F}}\x{{7F}}-\x{{84}}\x{{86}}-\x{{9F}}\x{{FFFD}}]') THEN 'value' END AS reason FROM texts)"""
_BAD_QUOTE = "starts_with({0}, '\"') AND NOT regexp_full_match({0}, '\"([^\"]|\"\")*\"')"
_TREE = """f AS MATERIALIZED (SELECT pos, 'clothing' AS attr, gemini_output.attributes.clothing AS t FROM gemini_pass2 UNION ALL SELECT pos, 'held_items', gemini_output.attributes.held_items FROM gemini_pass2 UNION ALL SELECT pos, 'role_type', gemini_output.predictions.role_type FROM gemini_pass2),
g AS MATERIALIZED (SELECT pos, attr, CASE WHEN json_valid(t) THEN CASE WHEN json_type(t) = 'VARCHAR' THEN json_extract_string(t, '$') ELSE t END END AS t FROM f),
h AS MATERIALIZED (SELECT pos, attr, t FROM g WHERE CASE WHEN json_valid(t) THEN json_type(t) IN ('ARRAY', 'OBJECT') ELSE false END),
j AS (SELECT h.pos, h.attr, x.* FROM h, json_tree(h.t) x),
k AS (SELECT *, row_number() OVER (PARTITION BY pos, attr ORDER BY id) - 1 AS node FROM j),
tree AS (SELECT k.pos, k.attr, k.node::INT AS node, p.node::INT AS parent, len(regexp_extract_all(k.fullkey, '\\.("[^"]*"|[^.\\[]+)|\\[[0-9]+\\]'))::INT AS level,
  CASE k.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind,
  CASE WHEN p.type = 'OBJECT' THEN k.key END AS name, CASE WHEN p.type = 'ARRAY' THEN k.key::INT END AS nth, regexp_replace(k.fullkey, '"', '', 'g') AS path, CASE WHEN k.type = 'VARCHAR' THEN json_extract_string(k.atom, '$') WHEN k.type = 'NULL' THEN 'null' WHEN k.type NOT IN ('OBJECT', 'ARRAY') THEN k.atom::VARCHAR END AS value
  FROM k LEFT JOIN k p ON k.pos = p.pos AND k.attr = p.attr AND k.parent = p.id)"""
ORACLE = {
    "p3_found": f"WITH {_TREE} SELECT pos, attr, path AS leaf_path, value AS leaf FROM tree WHERE kind = 'string'",
    "p3_containers": f"WITH {_TREE} SELECT * EXCLUDE (value) FROM tree WHERE kind IN ('object', 'array')",
    "p3_leaves": f"WITH {_TREE} SELECT * FROM tree WHERE kind NOT IN ('object', 'array')",
    "p3_items": f"WITH {_TREE} SELECT o.pos, o.attr, o.node, o.parent, o.nth AS place, {', '.join(f"try_cast(max(m.value) FILTER (m.name = '{k}' AND m.kind NOT IN ('object', 'array', 'null')) AS {'VARCHAR' if t == 'string' else t.upper()}) AS {k}" for k, t in ITEM.items())} FROM tree o LEFT JOIN tree m ON o.pos = m.pos AND o.attr = m.attr AND m.parent = o.node WHERE o.kind = 'object' AND o.nth IS NOT NULL GROUP BY ALL",
    "p6_found": f"WITH {_PARTS}, {_TEXTS} SELECT 'eval_preds' AS src, pos, reason FROM judged WHERE reason IS NOT NULL UNION ALL SELECT 'labels', pos, reason FROM other WHERE reason IS NOT NULL",
    "p6_fields": f"""WITH {_PARTS}, {_TEXTS} SELECT 'eval_preds' AS src, j.pos, reason, CASE reason WHEN 'columns' THEN CASE WHEN n = 1 THEN 'rt' ELSE 'sk' END WHEN 'quoting' THEN CASE WHEN {_BAD_QUOTE.format('j.c[1]')} THEN 'rt' WHEN {_BAD_QUOTE.format('j.c[2]')} THEN 'sk' ELSE 'description' END
WHEN 'value' THEN CASE WHEN NOT regexp_full_match(j.c[1], '(?i)("{_BL})?[A-E]({_BL}")?') THEN 'rt' ELSE 'sk' END END AS field FROM judged j JOIN cols ON j.pos = cols.pos WHERE reason IS NOT NULL UNION ALL SELECT 'labels', pos, reason, CASE WHEN reason <> 'missing' THEN 'description' END FROM other WHERE reason IS NOT NULL""",
    "p6_loaded": f"WITH {_PARTS}, {_TEXTS} SELECT 'eval_preds' AS src, pos, upper({_bare('c[1]')}) AS rt, lower({_bare('c[2]')}) AS sk, {_bare('c[3]')} AS description FROM judged WHERE reason IS NULL UNION ALL SELECT 'labels', pos, NULL, NULL, {_UNQUOTED.format('c', '$^')} FROM other WHERE reason IS NULL",
}
