"""Queries of curation: agreement of labeler and labels, examination by two witnesses, cleaning, assets, preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import outputs
from marlstone.functions.texts import stripped
from marlstone.operators import curation, keyed
from marlstone.plans.evaluation import golds, last_preds
from marlstone.plans.ingest import first_complete
from marlstone.plans.scalars import _VALID
from marlstone.plans.sqlparts import GOLD, LAST, strict, strip
from marlstone.plans.sqlparts import share as ratio
from marlstone.stages import table

#: Share of a class that cleaning may drop, and the class that it leaves alone.
MOST_DROPPED, EXEMPT = 0.20, "m"


def _labeler(spark: SparkSession, sf: str) -> DataFrame:
    p = "gemini_output.predictions."
    rows = table(spark, sf, "gemini_pass2").filter("video_id is not null").select("video_id", "pos", F.col(p + "role_type").alias("prt"), F.col(p + "sub_keyscene").alias("psk"))
    return keyed.last_rows(rows, "video_id").drop("pos")


def _agreement(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labeler(spark, sf).join(golds(spark, sf).select("video_id", "grt", "gsk"), "video_id")
    return curation.agreement(rows, F.col("prt"), F.col("psk"), F.col("grt"), F.col("gsk"))


def consistency_gt(spark: SparkSession, sf: str) -> DataFrame:
    return _agreement(spark, sf).select("video_id", "rt_match", "sk_match", "bucket")


def suspect_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of which the labeler shares neither letter, by their letters."""
    return _agreement(spark, sf).filter("bucket = 'discard'").groupBy("grt", "gsk").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "grt", "gsk")


def consistency_double(spark: SparkSession, sf: str) -> DataFrame:
    """Videos that labeler and model have both seen, and the letters they agree on."""
    second = last_preds(spark, sf).select("video_id", outputs.strict(F.col("output")).alias("p"))
    rows = _labeler(spark, sf).join(second, "video_id")
    out = curation.agreed_twice(rows, (F.col("prt"), F.col("psk")), (F.col("p.rt"), F.col("p.sk")))
    return out.select("video_id", "agreed", "pseudo_rt", "pseudo_sk")


def split_assets(spark: SparkSession, sf: str) -> DataFrame:
    """Labeler rows by what becomes of them, trusted where their video agrees with its label in both letters."""
    white = consistency_gt(spark, sf).filter("bucket = 'white'").select("video_id", F.lit(True).alias("inside"))
    g = "gemini_output."
    rows = table(spark, sf, "gemini_pass2").select("pos", "video_id", F.col(g + "attributes").alias("a"), F.col(g + "reasoning_chain").alias("chain")).join(white, "video_id", "left")
    fate = curation.asset_fate(F.col("inside"), F.col("a"), F.col("chain"))
    return rows.select("pos", "video_id", fate.alias("fate"), F.when(fate == "asset", 1.0).alias("confidence"), F.when(fate == "asset", F.col("chain")).alias("chain"))


def _examined(spark: SparkSession, sf: str) -> DataFrame:
    model = keyed.last_rows(table(spark, sf, "eval_preds").filter("video_id is not null").select("video_id", "pos", outputs.loose(F.col("output"), 2).alias("p")), "video_id", valid=F.col("p.sk").isNotNull())
    labeler = first_complete(spark, sf).filter("video_id is not null").select("video_id", F.col("rt").alias("zrt"), F.col("sk").alias("zsk"))
    rows = golds(spark, sf).select("video_id", "grt", "gsk").join(model.select("video_id", F.col("p.rt").alias("mrt"), F.col("p.sk").alias("msk")), "video_id").join(labeler, "video_id")
    return rows.withColumn("bucket", curation.examined(F.col("msk"), F.col("zsk"), F.col("gsk")))


def cross_examine(spark: SparkSession, sf: str) -> DataFrame:
    return curation.bucket_table(_examined(spark, sf), "gsk", "bucket")


def suspects(spark: SparkSession, sf: str) -> DataFrame:
    """Labels that both witnesses contradict with the same scene, with all three answers and the video's first description."""
    first = keyed.first_rows(table(spark, sf, "labels").filter("video_id is not null").select("video_id", "pos", F.col("labels.description").alias("description")), "video_id").drop("pos")
    return _examined(spark, sf).filter("bucket = 'D'").drop("bucket").join(first, "video_id")


def _cleaned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    bad = _examined(spark, sf).filter((F.col("bucket") == "D") & ~F.coalesce(F.col("gsk") == EXEMPT, F.lit(False)))
    rows = table(spark, sf, "labels").select("pos", "video_id", F.col("labels.sub_keyscene").alias("sk"))
    return curation.cleaned(rows, bad, "video_id", "sk", EXEMPT)


def clean_drop(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf)[0]


def clean_report(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf)[1]


def breaker(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of which cleaning would drop too much; curation.breaker raises on them."""
    return _cleaned(spark, sf)[1].filter(F.col("fraction") > MOST_DROPPED).select("sk", "fraction")


def kto_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Preference rows: each video's own target as desirable, and its prediction, if wrong, as undesirable; labels with invalid letters give none."""
    rows = golds(spark, sf).join(last_preds(spark, sf).select("video_id", "output"), "video_id", "left")
    rows = rows.withColumn("t", outputs.target(F.col("grt"), F.col("gsk"), F.col("gdesc"))["text"]).filter("t is not null").withColumn("p", outputs.strict(F.col("output")))
    wrong = F.col("output").isNotNull() & ~(F.col("p.ok") & F.coalesce((F.col("p.rt") == F.col("grt")) & (F.col("p.sk") == F.col("gsk")), F.lit(False)))
    pair = F.array(F.struct(F.col("t").alias("completion"), F.lit(True).alias("label")), F.when(wrong, F.struct(stripped(F.col("output")).alias("completion"), F.lit(False).alias("label"))))
    return rows.select("video_id", F.explode(F.array_compact(pair)).alias("x")).select("video_id", "x.completion", "x.label")


def whitelisted(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled rows of videos on which the labeler agrees."""
    white = consistency_gt(spark, sf).filter("bucket = 'white'")
    return keyed.scoped(table(spark, sf, "labels").select("pos", "video_id"), white, "video_id")


def kto_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Preference rows of videos that are labelled, with where their frames lie."""
    last = golds(spark, sf).select("video_id", F.col("meta")["storage"].alias("storage"))
    return kto_pairs(spark, sf).join(last, "video_id").select("video_id", "label", "storage")


QUERIES = {f.__name__: f for f in (consistency_gt, suspect_stats, consistency_double, split_assets, cross_examine, suspects, clean_drop, clean_report, breaker, kto_pairs, whitelisted, kto_rows)}

_LAB = "g0 AS MATERIALIZED (SELECT video_id, pos, gemini_output.predictions.role_type AS prt, gemini_output.predictions.sub_keyscene AS psk, gemini_output.attributes IS NOT NULL AS a, gemini_output.reasoning_chain AS chain FROM gemini_pass2), lab AS (SELECT * FROM g0 WHERE video_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1)"
_AGREE = f"{_LAB}, {GOLD}, ag AS (SELECT l.video_id, grt, gsk, prt IS NOT DISTINCT FROM grt AS rt_match, psk IS NOT DISTINCT FROM gsk AS sk_match FROM lab l JOIN gold g ON l.video_id = g.video_id), bk AS (SELECT *, CASE WHEN rt_match AND sk_match THEN 'white' WHEN rt_match OR sk_match THEN 'partial' ELSE 'discard' END AS bucket FROM ag)"
_EXAM = f"""{_LAB}, {GOLD}, m0 AS (SELECT video_id, pos, string_split(output, '|') AS s FROM eval_preds WHERE video_id IS NOT NULL), m AS (SELECT video_id, {strip('s[1]')} AS mrt, {strip('s[2]')} AS msk FROM m0 WHERE len(s) >= 2 QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1),
zf AS MATERIALIZED (SELECT *, coalesce(prt, '') <> '' AND coalesce(psk, '') <> '' AS whole FROM g0), z AS (SELECT video_id, prt AS zrt, psk AS zsk FROM zf WHERE whole AND video_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos) = 1),
ex AS (SELECT g.video_id, grt, gsk, mrt, msk, zrt, zsk, CASE WHEN msk IS NOT DISTINCT FROM gsk AND zsk IS NOT DISTINCT FROM gsk THEN 'A' WHEN zsk IS NOT DISTINCT FROM gsk THEN 'B' WHEN msk IS NOT DISTINCT FROM gsk THEN 'C' WHEN msk = zsk THEN 'D' ELSE 'E' END AS bucket FROM gold g JOIN m ON g.video_id = m.video_id JOIN z ON g.video_id = z.video_id)"""
_CLEAN = f"""{_EXAM}, bad AS (SELECT DISTINCT video_id FROM ex WHERE bucket = 'D' AND gsk IS DISTINCT FROM '{EXEMPT}'), rws AS (SELECT pos, video_id, labels.sub_keyscene AS sk, coalesce(video_id IN (SELECT video_id FROM bad), false) AND labels.sub_keyscene IS DISTINCT FROM '{EXEMPT}' AS hit FROM labels),
gone AS (SELECT *, coalesce(video_id IN (SELECT video_id FROM rws WHERE hit), false) AS gone FROM rws), rep AS (SELECT sk, count(*) AS before, count(*) FILTER (hit) AS dropped, count(*) FILTER (NOT gone) AS after FROM gone GROUP BY sk)"""
_SUMS = ", ".join(f"count(*) FILTER (bucket = '{b}') AS {b}, {ratio(f"count(*) FILTER (bucket = '{b}')", 'count(*)')} AS {b}_share" for b in curation.BUCKETS)
ORACLE = {
    "consistency_gt": f"WITH {_AGREE} SELECT video_id, rt_match, sk_match, bucket FROM bk",
    "suspect_stats": f"WITH {_AGREE} SELECT grt, gsk, count(*) AS n FROM bk WHERE bucket = 'discard' GROUP BY grt, gsk",
    "consistency_double": f"WITH {_LAB}, {LAST}, {strict('last')}, j AS (SELECT l.video_id, prt, psk, coalesce(ok AND r = prt AND k = psk, false) AS agreed FROM lab l JOIN strict s ON l.video_id = s.video_id) SELECT video_id, agreed, CASE WHEN agreed THEN prt END AS pseudo_rt, CASE WHEN agreed THEN psk END AS pseudo_sk FROM j",
    "split_assets": f"WITH {_AGREE}, f AS (SELECT pos, video_id, chain, CASE WHEN video_id IS NULL OR video_id NOT IN (SELECT video_id FROM bk WHERE bucket = 'white') THEN 'outside' WHEN a AND coalesce(chain, '') <> '' THEN 'asset' ELSE 'incomplete' END AS fate FROM g0) SELECT pos, video_id, fate, CASE WHEN fate = 'asset' THEN 1.0::DOUBLE END AS confidence, CASE WHEN fate = 'asset' THEN chain END AS chain FROM f",
    "cross_examine": f"WITH {_EXAM} SELECT gsk, count(*) AS n, {_SUMS} FROM ex GROUP BY gsk UNION ALL SELECT '__ALL__', count(*), {_SUMS} FROM ex",
    "suspects": f"WITH {_EXAM}, fl AS (SELECT video_id, labels.description AS description FROM labels WHERE video_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos) = 1) SELECT ex.video_id, grt, gsk, mrt, msk, zrt, zsk, description FROM ex JOIN fl ON ex.video_id = fl.video_id WHERE bucket = 'D'",
    "clean_drop": f"WITH {_CLEAN} SELECT pos, video_id, sk FROM gone WHERE NOT gone",
    "clean_report": f"WITH {_CLEAN} SELECT sk, before, dropped, after, {ratio('dropped', 'before')} AS fraction, round(after::DOUBLE / (SELECT sum(after) FROM rep) - before::DOUBLE / (SELECT sum(before) FROM rep), 6) AS change FROM rep",
    "breaker": f"WITH {_CLEAN} SELECT sk, {ratio('dropped', 'before')} AS fraction FROM rep WHERE {ratio('dropped', 'before')} > {MOST_DROPPED}",
    "kto_pairs": f"""WITH {GOLD}, {LAST}, {strict('last')}, v AS (SELECT g.*, s.output, s.ok, s.r, s.k, grt || '|' || gsk || '|' || {strip("coalesce(gdesc, '')")} AS t FROM gold g LEFT JOIN strict s ON g.video_id = s.video_id WHERE g.video_id IS NOT NULL AND {_VALID.replace('labels.role_type', 'grt').replace('labels.sub_keyscene', 'gsk')})
SELECT video_id, t AS completion, true AS label FROM v UNION ALL SELECT video_id, {strip('output')}, false FROM v WHERE output IS NOT NULL AND NOT (ok AND coalesce(r = grt AND k = gsk, false))""",
}
ORACLE["whitelisted"] = f"WITH {_AGREE} SELECT pos, video_id FROM labels WHERE video_id IN (SELECT video_id FROM bk WHERE bucket = 'white')"
ORACLE["kto_rows"] = f"WITH {GOLD}, p AS ({ORACLE['kto_pairs']}) SELECT p.video_id, p.label, g.meta['storage'] AS storage FROM p JOIN gold g ON p.video_id = g.video_id"
