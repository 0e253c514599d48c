"""Queries about the health of the labelled data set and its drift between splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.identity import group_key, split_of
from marlstone.operators import health, keyed
from marlstone.operators.scoring import share
from marlstone.plans.sqlparts import share as ratio
from marlstone.plans.sqlparts import split, words
from marlstone.stages import table

#: Most frequent words that a split is known by.
TOP_WORDS = 200


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    lab = "labels."
    return table(spark, sf, "labels").select("pos", "video_id", F.col(lab + "role_type").alias("rt"), F.col(lab + "sub_keyscene").alias("sk"), F.col(lab + "description").alias("description"), "meta", F.col("meta")["camera_id"].alias("camera"), split_of(F.col("meta")["source_split"]).alias("split"))


def label_stats(spark: SparkSession, sf: str) -> DataFrame:
    return health.repetition(_rows(spark, sf), "sk", F.col("video_id"), F.coalesce(F.nullif("camera", F.lit("")), F.col("video_id")))


def label_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, distinct videos, repeated rows and distinct devices or single videos of the whole table."""
    rows = _rows(spark, sf)
    return rows.agg(F.count("*").alias("n"), F.count_distinct("video_id").alias("ids"), F.count_distinct(group_key(F.col("camera"), F.col("video_id"))).alias("groups"), F.count_if(F.col("camera") == "unknown").alias("unknown")).withColumn("repeated", F.col("n") - F.col("ids"))


def dedup_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each class before and after the first row of each video is kept."""
    first = keyed.first_rows(_rows(spark, sf).select("pos", "video_id", "sk"), "video_id").groupBy("sk").agg(F.count("*").alias("after"))
    before = _rows(spark, sf).groupBy("sk").agg(F.count("*").alias("before"))
    both = before.join(first.withColumnRenamed("sk", "_sk"), F.col("sk").eqNullSafe(F.col("_sk")), "left").select("sk", "before", F.coalesce("after", F.lit(0)).alias("after"))
    cut = F.col("before") - F.col("after")
    return both.select("sk", "before", "after", cut.alias("cut"), share(cut, F.col("before")).alias("removed"), (cut > F.col("after")).alias("mostly_copies")).orderBy(F.desc("cut"), "sk")


def priors(spark: SparkSession, sf: str) -> DataFrame:
    return health.shares(_rows(spark, sf), {"rt": F.col("rt"), "sk": F.col("sk")})


def dist_diff(spark: SparkSession, sf: str) -> DataFrame:
    rows = _rows(spark, sf).filter("split in ('train', 'test')")
    return health.drift(health.shares(rows, {"rt": F.col("rt"), "sk": F.col("sk")}, ["split"]), "train", "test")


def meta_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return health.key_coverage(_rows(spark, sf).filter("split is not null"), "meta", "split")


def meta_versions(spark: SparkSession, sf: str) -> DataFrame:
    """How often each annotation version stands in each split; null where none is told."""
    return _rows(spark, sf).groupBy("split", F.col("meta")["annotation_version"].alias("version")).agg(F.count("*").alias("n"))


def desc_stats(spark: SparkSession, sf: str) -> DataFrame:
    return health.word_stats(_rows(spark, sf).filter("split is not null"), F.col("description"), "split")


def vocab_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    top = health.top_words(_rows(spark, sf).filter("split in ('train', 'test')"), F.col("description"), "split", TOP_WORDS)
    return health.jaccard(top, "split", "train", "test", "word")


def group_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Cameras of train and of test, shared ones, and the test rows on shared cameras; empty and missing cameras don't count."""
    rows = _rows(spark, sf).filter("split in ('train', 'test')")
    cams = rows.groupBy(F.coalesce("camera", F.lit("")).alias("camera")).agg(F.count_if(F.col("split") == "train").alias("a"), F.count_if(F.col("split") == "test").alias("b"))
    train, test = (F.col("camera") != "") & (F.col("a") > 0), (F.col("camera") != "") & (F.col("b") > 0)
    got = cams.agg(F.count_if(train).alias("train"), F.count_if(test).alias("test"), F.count_if(train & test).alias("shared"), F.coalesce(F.sum(F.when(train & test, F.col("b"))), F.lit(0)).cast("long").alias("test_rows"), F.coalesce(F.sum("b"), F.lit(0)).alias("total"))
    return got.withColumn("share", share(F.col("test_rows"), F.col("total"))).drop("total")


def split_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Videos that stand in two splits, for each pair of splits."""
    each = _rows(spark, sf).filter("split is not null and video_id is not null").groupBy("video_id").agg(*[F.count_if(F.col("split") == s).alias(s) for s in ("train", "val", "test")])
    pairs = (("train", "val"), ("train", "test"), ("val", "test"))
    row = each.agg(*[F.count_if((F.col(a) > 0) & (F.col(b) > 0)).alias(f"{a}_{b}") for a, b in pairs])
    return row.select(F.explode(F.array(*[F.struct(F.lit(f"{a}_{b}").alias("pair"), F.col(f"{a}_{b}").alias("videos")) for a, b in pairs])).alias("x")).select("x.*")


def asset_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct training videos, and how many of them have attributes and a chain."""
    ids = _rows(spark, sf).filter("split = 'train' and video_id is not null").select("video_id").distinct()
    has = lambda df, c: df.filter(c).select("video_id").distinct()
    g = has(table(spark, sf, "gemini_pass2"), F.col("gemini_output.attributes").isNotNull()).withColumn("a", F.lit(1))
    c = has(table(spark, sf, "asset_c_reasoning"), F.coalesce("reasoning_chain", F.lit("")) != "").withColumn("c", F.lit(1))
    both = ids.join(g, "video_id", "left").join(c, "video_id", "left")
    out = both.agg(F.count("*").alias("ids"), F.count("a").alias("attributes"), F.count("c").alias("chains"))
    return out.withColumn("attribute_share", share(F.col("attributes"), F.col("ids"))).withColumn("chain_share", share(F.col("chains"), F.col("ids")))


QUERIES = {f.__name__: f for f in (label_stats, label_totals, dedup_report, priors, dist_diff, meta_coverage, meta_versions, desc_stats, vocab_jaccard, group_overlap, split_checks, asset_coverage)}

_R = f"r AS (SELECT pos, video_id, labels.role_type AS rt, labels.sub_keyscene AS sk, labels.description AS description, meta, meta['camera_id'] AS camera, {split("meta['source_split']")} AS split FROM labels)"
_P = "p AS (SELECT split, axis, letter, n, n::DOUBLE / sum(n) OVER (PARTITION BY split, axis) AS p FROM (SELECT split, 'rt' AS axis, rt AS letter, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT split, 'sk', sk, count(*) FROM r GROUP BY ALL))"
ORACLE = {
    "label_stats": f"WITH {_R} SELECT sk, count(*) AS rows, count(DISTINCT video_id) AS ids, count(DISTINCT coalesce(nullif(camera, ''), video_id)) AS groups, round(count(*)::DOUBLE / greatest(count(DISTINCT video_id), 1), 6) AS ratio, count(*)::DOUBLE / greatest(count(DISTINCT video_id), 1) > 1.5 AS copied FROM r GROUP BY sk",
    "label_totals": f"WITH {_R} SELECT count(*) AS n, count(DISTINCT video_id) AS ids, count(DISTINCT coalesce(nullif(nullif(camera, ''), 'unknown'), video_id)) AS groups, count(*) FILTER (camera = 'unknown') AS unknown, count(*) - count(DISTINCT video_id) AS repeated FROM r",
    "dedup_report": f"WITH {_R}, f AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY pos) = 1 AS first FROM r), c AS (SELECT sk, count(*) AS before, count(*) FILTER (first) AS after FROM f GROUP BY sk) SELECT sk, before, after, before - after AS cut, {ratio('before - after', 'before')} AS removed, before - after > after AS mostly_copies FROM c",
    "priors": f"WITH {_R}, c AS (SELECT 'rt' AS axis, rt AS letter, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT 'sk', sk, count(*) FROM r GROUP BY ALL) SELECT axis, letter, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY axis), 6) AS p FROM c",
    "dist_diff": f"WITH {_R}, {_P}, w AS (SELECT axis, letter, round(coalesce(max(p) FILTER (split = 'train'), 0.0), 6) AS a, round(coalesce(max(p) FILTER (split = 'test'), 0.0), 6) AS b, count(*) AS k, min(split) AS s FROM p WHERE split IN ('train', 'test') GROUP BY axis, letter) SELECT axis, letter, a AS p_train, b AS p_test, round(a - b, 6) AS diff, abs(round(a - b, 6)) > 0.05 AS shifted, CASE WHEN k = 1 THEN s END AS only FROM w",
    "meta_coverage": f"WITH {_R}, e AS (SELECT split, unnest(map_entries(meta)) AS e FROM r WHERE split IS NOT NULL), t AS (SELECT split, count(*) AS total FROM r GROUP BY split) SELECT e.split, e.e.key AS key, count(*) AS n, round(count(*)::DOUBLE / max(total), 6) AS share FROM e JOIN t ON e.split = t.split WHERE e.e.value IS NOT NULL GROUP BY e.split, e.e.key",
    "meta_versions": f"WITH {_R} SELECT split, meta['annotation_version'] AS version, count(*) AS n FROM r GROUP BY ALL",
    "desc_stats": f"WITH {_R}, w AS (SELECT split, len({words('description')}) AS w FROM r WHERE split IS NOT NULL), o AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY w) AS i, count(*) OVER (PARTITION BY split) AS n FROM w) SELECT split, max(n) AS rows, round(sum(w)::DOUBLE / max(n), 6) AS mean_words, max(w) FILTER (i = n // 2 + 1) AS median_words FROM o GROUP BY split",
    "vocab_jaccard": f"WITH {_R}, w AS (SELECT split, unnest({words('lower(description)')}) AS word FROM r WHERE split IN ('train', 'test')), c AS (SELECT split, word, count(*) AS n FROM w GROUP BY ALL), t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY split ORDER BY n DESC, word) <= {TOP_WORDS}), s AS (SELECT word, count(*) AS k FROM t GROUP BY word) SELECT count(*) FILTER (k = 2) AS shared, count(*) AS together, {ratio('count(*) FILTER (k = 2)', 'count(*)')} AS jaccard FROM s",
    "group_overlap": f"WITH {_R}, c AS (SELECT camera, count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'test') AS b FROM r WHERE split IN ('train', 'test') AND coalesce(camera, '') <> '' GROUP BY camera), g AS (SELECT count(*) FILTER (a > 0) AS train, count(*) FILTER (b > 0) AS test, count(*) FILTER (a > 0 AND b > 0) AS shared, coalesce(sum(b) FILTER (a > 0 AND b > 0), 0)::BIGINT AS test_rows FROM c) SELECT g.*, {ratio('test_rows', "(SELECT count(*) FROM r WHERE split = 'test')")} AS share FROM g",
    "split_checks": f"WITH {_R}, v AS (SELECT DISTINCT video_id, split FROM r WHERE split IS NOT NULL AND video_id IS NOT NULL) SELECT p.a || '_' || p.b AS pair, (SELECT count(*) FROM v x JOIN v y ON x.video_id = y.video_id WHERE x.split = p.a AND y.split = p.b) AS videos FROM (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')) p(a, b)",
    "asset_coverage": f"WITH {_R}, i AS (SELECT DISTINCT video_id FROM r WHERE split = 'train' AND video_id IS NOT NULL), g AS (SELECT DISTINCT video_id FROM (SELECT video_id, gemini_output.attributes IS NOT NULL AS has FROM gemini_pass2) WHERE has), c AS (SELECT DISTINCT video_id FROM asset_c_reasoning WHERE coalesce(reasoning_chain, '') <> ''), n AS (SELECT count(*) AS ids, count(g.video_id) AS attributes, count(c.video_id) AS chains FROM i LEFT JOIN g ON i.video_id = g.video_id LEFT JOIN c ON i.video_id = c.video_id) SELECT *, {ratio('attributes', 'ids')} AS attribute_share, {ratio('chains', 'ids')} AS chain_share FROM n",
}
