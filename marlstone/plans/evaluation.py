"""Queries that compare predictions with labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone import vocab
from marlstone.functions import outputs
from marlstone.functions.identity import split_of
from marlstone.operators import keyed, scoring
from marlstone.operators.scoring import same, share
from marlstone.plans.sqlparts import GOLD, LAST, WS, group, letters, split, strict, strip
from marlstone.plans.sqlparts import share as ratio
from marlstone.stages import table

#: Classes of each axis whose scores are reported.
CLASSES = {"rt": list(vocab.ROLES), "sk": list(vocab.SCENES), "ks": sorted(vocab.GROUPS)}
#: Rows of a class from which its recall is reported.
LEAST_SUPPORT = 30


def parsed_scene(output: Column) -> Column:
    """The scene letter of an output by position, case corrected; ``?`` where it hasn't three fields or a valid role and scene letter."""
    return F.coalesce(outputs.strict(output)["sk"], F.lit("?"))


def confusion_counts(golds: DataFrame, preds: DataFrame, key: str, order: str) -> DataFrame:
    """gt, pred, n: of each ``key`` in both the rows with the greatest ``order``, by golds.gt (as it stands, null too) and preds.pred."""
    last = lambda df, c: df.groupBy(key).agg(F.max_by(F.struct(c), order)[c].alias(c))
    a, b = last(golds, "gt").withColumnRenamed(key, "_g"), last(preds, "pred").withColumnRenamed(key, "_p")
    return a.join(b, F.col("_g").eqNullSafe(F.col("_p"))).groupBy("gt", "pred").agg(F.count("*").alias("n"))


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    golds = table(spark, sf, "labels").select("video_id", "pos", F.col("labels.sub_keyscene").alias("gt"))
    preds = table(spark, sf, "eval_preds").select("video_id", "pos", parsed_scene(F.col("output")).alias("pred"))
    return confusion_counts(golds, preds, "video_id", "pos")


def golds(spark: SparkSession, sf: str) -> DataFrame:
    """video_id, pos, grt, gsk, gdesc, meta: the last row of each video with an id."""
    rows = table(spark, sf, "labels").filter("video_id is not null")
    return keyed.last_rows(rows.select("video_id", "pos", F.col("labels.role_type").alias("grt"), F.col("labels.sub_keyscene").alias("gsk"), F.col("labels.description").alias("gdesc"), "meta"), "video_id")


def last_preds(spark: SparkSession, sf: str) -> DataFrame:
    """video_id, output, score: the last prediction of each video with an id."""
    rows = table(spark, sf, "eval_preds").filter("video_id is not null").select("video_id", "pos", "output", "score")
    return keyed.last_rows(rows, "video_id").select("video_id", "output", "score")


def evaluated(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with a prediction (inner), the prediction strictly parsed as ``p``."""
    return golds(spark, sf).join(last_preds(spark, sf), "video_id").withColumn("p", outputs.strict(F.col("output")))


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    """Confusions on all axes in one pass; letters without a group are ? there, so an unknown label that failed to parse counts as right."""
    rt, sk = F.coalesce("p.rt", F.lit("?")), F.coalesce("p.sk", F.lit("?"))
    axes = {"rt": (F.col("grt"), rt), "sk": (F.col("gsk"), sk), "ks": (outputs.group_of(F.col("gsk"), "?"), outputs.group_of(sk, "?"))}
    return scoring.confusions(evaluated(spark, sf), axes)


def prf_per_class(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.per_class(_counts(spark, sf), CLASSES)


def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.accuracies(_counts(spark, sf))


def ks_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf).filter("axis = 'ks'").select("gt", "pred", F.col("n").cast("long").alias("n"))


def rates(spark: SparkSession, sf: str) -> DataFrame:
    p = "p."
    return scoring.rates(evaluated(spark, sf), {"format_fail": ~F.col(p + "ok"), "illegal": F.col(p + "ok") & ~F.col(p + "legal"), "case_fixed": F.col(p + "case_fixed"), "think_leak": F.col(p + "think_leak")})


def safety_recall(spark: SparkSession, sf: str) -> DataFrame:
    wanted = F.col("class").isin(*vocab.SAFETY_REPORTED)
    return prf_per_class(spark, sf).filter((F.col("axis") == "sk") & wanted).select("class", "support", "recall")


def hotspots(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.hotspots(_counts(spark, sf).withColumn("n", F.col("n").cast("long")), {"sk": vocab.HOT_SCENES, "rt": vocab.HOT_ROLES})


def _left(spark: SparkSession, sf: str) -> DataFrame:
    """Every labelled row, also repeated ones, with the last prediction of its video by pattern."""
    preds = last_preds(spark, sf).select("video_id", F.lit(True).alias("there"), outputs.by_pattern(F.col("output")).alias("p"))
    rows = table(spark, sf, "labels").select("video_id", "pos", F.col("labels.role_type").alias("grt"), F.col("labels.sub_keyscene").alias("gsk"), F.col("meta")["camera_id"].alias("camera"), split_of(F.col("meta")["source_split"]).alias("split"))
    return rows.join(preds, "video_id", "left")


def suite_left(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.suite(_left(spark, sf), F.col("p.rt"), F.col("p.sk"), F.col("grt"), F.col("gsk"), F.col("there").isNull(), F.col("p.rt").isNotNull())


def per_class_hits(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.class_hits(_left(spark, sf), ["gsk"], F.col("p.sk"), F.col("gsk"))


def _tested(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows with the loosely parsed last prediction, and whether their camera also stands in train; no camera is a camera here."""
    preds = last_preds(spark, sf).select("video_id", outputs.loose(F.col("output"), 2).alias("p"))
    rows = _left(spark, sf).drop("p", "there")
    seen = rows.filter("split = 'train'").select(F.col("camera").alias("_c")).distinct().withColumn("seen", F.lit(True))
    test = rows.filter("split = 'test'").join(preds, "video_id", "left")
    return test.join(seen, F.col("camera").eqNullSafe(F.col("_c")), "left").withColumn("subset", F.when(F.col("seen"), "overlap").otherwise("fresh"))


def overlap_eval(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the test rows whose camera is or isn't known from training, and of all."""
    n = F.count("*")
    g = same(outputs.group_of(F.col("p.sk")), outputs.group_of(F.col("gsk")))
    rows = _tested(spark, sf).withColumn("subset", F.explode(F.array("subset", F.lit("all"))))
    return rows.groupBy("subset").agg(n.alias("n"), *[share(F.count_if(c), n).alias(k) for k, c in (("rt", same(F.col("p.rt"), F.col("grt"))), ("sk", same(F.col("p.sk"), F.col("gsk"))), ("ks", g))])


def fresh_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Recall by class on cameras that training hasn't seen, for classes with enough rows, the worst first."""
    rows = scoring.class_hits(_tested(spark, sf).filter("subset = 'fresh'"), ["gsk"], F.col("p.sk"), F.col("gsk"))
    return rows.filter(F.col("n") >= LEAST_SUPPORT).orderBy("recall", "gsk")


def _loosely(spark: SparkSession, sf: str) -> DataFrame:
    """Every labelled row with a prediction, its last one loosely parsed with at least three fields."""
    preds = last_preds(spark, sf).select("video_id", outputs.loose(F.col("output"), 3).alias("p"))
    return _left(spark, sf).drop("p", "there").join(preds, "video_id")


def class_hist(spark: SparkSession, sf: str) -> DataFrame:
    """axis, side, letter, n, share: letters of labels (of all rows) and of predictions (of matched rows)."""
    true = table(spark, sf, "labels").select(F.explode(F.array(F.struct(F.lit("rt").alias("axis"), F.lit("gt").alias("side"), F.col("labels.role_type").alias("letter")), F.struct(F.lit("sk").alias("axis"), F.lit("gt").alias("side"), F.col("labels.sub_keyscene").alias("letter")))).alias("x"))
    pred = _loosely(spark, sf).select(F.explode(F.array(F.struct(F.lit("rt").alias("axis"), F.lit("pred").alias("side"), F.col("p.rt").alias("letter")), F.struct(F.lit("sk").alias("axis"), F.lit("pred").alias("side"), F.col("p.sk").alias("letter")))).alias("x"))
    counts = true.union(pred).groupBy("x.axis", "x.side", "x.letter").agg(F.count("*").alias("n"))
    # a few hundred rows at most: letters by axis and side; unparsed predictions count in the total only
    total = F.sum("n").over(Window.partitionBy("axis", "side"))
    out = counts.withColumn("share", share(F.col("n"), total))
    return out.filter("side = 'gt' or letter is not null")


def top_confusions(spark: SparkSession, sf: str) -> DataFrame:
    """The 15 most frequent pairs of letters on either axis."""
    rows = _loosely(spark, sf).filter("p.sk is not null")
    counts = scoring.confusions(rows, {"rt": (F.col("grt"), F.col("p.rt")), "sk": (F.col("gsk"), F.col("p.sk"))}, "pos")
    true = table(spark, sf, "labels").select("pos", F.col("labels.role_type").alias("rt"), F.col("labels.sub_keyscene").alias("sk"))
    totals = scoring.confusions(true, {"rt": (F.col("rt"), F.lit("")), "sk": (F.col("sk"), F.lit(""))}).select("axis", "gt", F.col("n").alias("total"))
    return scoring.top_confusions(counts, totals, 15).withColumn("rank", F.col("rank").cast("long"))


def never_predicted(spark: SparkSession, sf: str) -> DataFrame:
    """Scene letters of labels that no parsed prediction has."""
    true = table(spark, sf, "labels").select(F.col("labels.sub_keyscene").alias("letter")).filter("letter is not null")
    return true.distinct().subtract(_loosely(spark, sf).select(F.col("p.sk").alias("letter")))


QUERIES = {f.__name__: f for f in (confusion_matrix, prf_per_class, accuracy, ks_rollup, rates, safety_recall, hotspots, suite_left, per_class_hits, overlap_eval, fresh_recall, class_hist, top_confusions, never_predicted)}

_EVAL = f"""{GOLD}, {LAST}, joined AS (SELECT g.video_id, g.pos, grt, gsk, output FROM gold g JOIN last p ON g.video_id = p.video_id), {strict('joined')},
c2 AS (SELECT 'rt' AS axis, grt AS gt, CASE WHEN ok THEN r ELSE '?' END AS pred, count(*) AS n FROM strict GROUP BY ALL UNION ALL SELECT 'sk', gsk, CASE WHEN ok THEN k ELSE '?' END, count(*) FROM strict GROUP BY ALL),
c AS (FROM c2 UNION ALL SELECT 'ks', {group('gt', "'?'")}, {group('pred', "'?'")}, sum(n)::BIGINT FROM c2 WHERE axis = 'sk' GROUP BY ALL)"""
_CLASSES = "classes AS (" + " UNION ALL ".join(f"SELECT '{a}' AS axis, unnest([{letters(cs) if a != 'ks' else ', '.join(repr(c) for c in cs)}]) AS class" for a, cs in CLASSES.items()) + ")"
_SCORED = f"""scored AS (SELECT k.axis, k.class, coalesce(sum(n) FILTER (gt = k.class AND pred = k.class), 0)::BIGINT AS tp, coalesce(sum(n) FILTER (gt = k.class AND pred <> k.class), 0)::BIGINT AS fn,
 coalesce(sum(n) FILTER (pred = k.class AND gt IS DISTINCT FROM k.class), 0)::BIGINT AS fp FROM classes k LEFT JOIN c ON c.axis = k.axis AND (c.gt = k.class OR c.pred = k.class) GROUP BY k.axis, k.class)"""
_LEFT = rf"""{LAST}, lab AS (SELECT l.video_id, l.pos, labels.role_type AS grt, labels.sub_keyscene AS gsk, meta['camera_id'] AS camera, {split("meta['source_split']")} AS split FROM labels l),
pat AS (SELECT video_id, output, nullif(regexp_extract(output, '^{WS}*([A-E]){WS}*\|{WS}*([a-u]){WS}*\|', 1), '') AS prt, nullif(regexp_extract(output, '^{WS}*([A-E]){WS}*\|{WS}*([a-u]){WS}*\|', 2), '') AS psk FROM last),
full_ AS (SELECT lab.*, pat.video_id IS NOT NULL AS there, prt, psk, string_split(output, '|') AS s FROM lab LEFT JOIN pat ON lab.video_id = pat.video_id)"""
_TEST = f"""{_LEFT}, t AS (SELECT *, CASE WHEN EXISTS (SELECT 1 FROM lab tr WHERE tr.split = 'train' AND tr.camera IS NOT DISTINCT FROM f.camera) THEN 'overlap' ELSE 'fresh' END AS subset, CASE WHEN len(s) >= 2 THEN {strip('s[1]')} END AS rt2, CASE WHEN len(s) >= 2 THEN {strip('s[2]')} END AS sk2 FROM full_ f WHERE split = 'test')"""
_LOOSE = f"{_LEFT}, lo AS (SELECT pos, grt, gsk, CASE WHEN len(s) >= 3 THEN {strip('s[1]')} END AS rt3, CASE WHEN len(s) >= 3 THEN {strip('s[2]')} END AS sk3 FROM full_ WHERE there)"
_KS = "(" + group("psk") + " = " + group("gsk") + ")"
_SAFE = f"gsk IN ({letters(vocab.SAFETY_REPORTED)})"
ORACLE = {
    "confusion_matrix": f"WITH {GOLD}, {LAST}, {strict('last')} SELECT g.gsk AS gt, CASE WHEN s.ok THEN s.k ELSE '?' END AS pred, count(*) AS n FROM gold g JOIN strict s ON g.video_id IS NOT DISTINCT FROM s.video_id GROUP BY ALL",
    "prf_per_class": f"WITH {_EVAL}, {_CLASSES}, {_SCORED} SELECT axis, class, tp, fn, fp, tp + fn AS support, {ratio('tp', 'tp + fp')} AS precision, {ratio('tp', 'tp + fn')} AS recall FROM scored",
    "accuracy": f"WITH {_EVAL} SELECT axis, sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (gt = pred), 0)::BIGINT AS correct, {ratio('coalesce(sum(n) FILTER (gt = pred), 0)', 'sum(n)')} AS accuracy FROM c GROUP BY axis",
    "ks_rollup": f"WITH {_EVAL} SELECT gt, pred, n FROM c WHERE axis = 'ks'",
    "rates": f"WITH {_EVAL} SELECT count(*) AS n, {ratio('count(*) FILTER (NOT ok)', 'count(*)')} AS format_fail, {ratio('count(*) FILTER (ok AND NOT legal)', 'count(*)')} AS illegal, {ratio('count(*) FILTER (fixed)', 'count(*)')} AS case_fixed, {ratio('count(*) FILTER (leak)', 'count(*)')} AS think_leak FROM strict",
    "safety_recall": f"WITH {_EVAL}, {_CLASSES}, {_SCORED} SELECT class, tp + fn AS support, {ratio('tp', 'tp + fn')} AS recall FROM scored WHERE axis = 'sk' AND class IN ({letters(vocab.SAFETY_REPORTED)})",
    "hotspots": f"WITH {_EVAL}, w AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{x}', '{y}')" for a, ps in (('sk', vocab.HOT_SCENES), ('rt', vocab.HOT_ROLES)) for p in ps for x, y in (p, p[::-1]))}) v(axis, gt, pred)) SELECT w.axis, w.gt, w.pred, coalesce(c.n, 0) AS n FROM w LEFT JOIN c ON w.axis = c.axis AND w.gt = c.gt AND w.pred = c.pred",
    "suite_left": f"""WITH {_LEFT} SELECT count(*) AS n, count(*) FILTER (NOT there) AS missing, {ratio('count(*) FILTER (prt IS NOT NULL)', 'count(*) FILTER (there)')} AS format, {ratio('count(*) FILTER (prt = grt)', 'count(*)')} AS rt, {ratio('count(*) FILTER (psk = gsk)', 'count(*)')} AS sk,
{ratio('count(*) FILTER (prt = grt AND psk = gsk)', 'count(*)')} AS both, {ratio(f'count(*) FILTER {_KS}', 'count(*)')} AS ks, count(*) FILTER ({_SAFE}) AS safety_n, {ratio(f'count(*) FILTER ({_SAFE} AND psk = gsk)', f'count(*) FILTER ({_SAFE})')} AS safety_recall FROM full_""",
    "per_class_hits": f"WITH {_LEFT} SELECT gsk, count(*) AS n, count(*) FILTER (psk = gsk) AS hit, {ratio('count(*) FILTER (psk = gsk)', 'count(*)')} AS recall FROM full_ GROUP BY gsk",
    "overlap_eval": f"WITH {_TEST}, u AS (SELECT subset, * EXCLUDE (subset) FROM t UNION ALL SELECT 'all', * EXCLUDE (subset) FROM t) SELECT subset, count(*) AS n, {ratio('count(*) FILTER (rt2 = grt)', 'count(*)')} AS rt, {ratio('count(*) FILTER (sk2 = gsk)', 'count(*)')} AS sk, {ratio(f'count(*) FILTER {_KS.replace("psk", "sk2")}', 'count(*)')} AS ks FROM u GROUP BY subset",
    "fresh_recall": f"WITH {_TEST} SELECT gsk, count(*) AS n, count(*) FILTER (sk2 = gsk) AS hit, {ratio('count(*) FILTER (sk2 = gsk)', 'count(*)')} AS recall FROM t WHERE subset = 'fresh' GROUP BY gsk HAVING count(*) >= {LEAST_SUPPORT}",
    "class_hist": f"""WITH {_LOOSE}, x AS (SELECT 'rt' AS axis, 'gt' AS side, grt AS letter FROM lab UNION ALL SELECT 'sk', 'gt', gsk FROM lab UNION ALL SELECT 'rt', 'pred', rt3 FROM lo UNION ALL SELECT 'sk', 'pred', sk3 FROM lo),
k AS (SELECT axis, side, letter, count(*) AS n FROM x GROUP BY ALL), s AS (SELECT *, sum(n) OVER (PARTITION BY axis, side) AS total FROM k)
SELECT axis, side, letter, n, {ratio('n', 'total')} AS share FROM s WHERE side = 'gt' OR letter IS NOT NULL""",
    "top_confusions": f"""WITH {_LOOSE}, x AS (SELECT 'rt' AS axis, grt AS gt, rt3 AS pred, pos FROM lo WHERE sk3 IS NOT NULL UNION ALL SELECT 'sk', gsk, sk3, pos FROM lo WHERE sk3 IS NOT NULL),
k0 AS (SELECT axis, gt, pred, count(*) AS n, min(pos) AS first FROM x GROUP BY ALL), k AS (SELECT * FROM k0 QUALIFY row_number() OVER (PARTITION BY axis ORDER BY n DESC, first) <= 15),
tot AS (SELECT 'rt' AS axis, grt AS gt, count(*) AS total FROM lab GROUP BY ALL UNION ALL SELECT 'sk', gsk, count(*) FROM lab GROUP BY ALL)
SELECT k.axis, row_number() OVER (PARTITION BY k.axis ORDER BY n DESC, first) AS rank, k.gt, k.pred, n, round(n::DOUBLE / greatest(coalesce(total, 0), 1), 6) AS share, n::DOUBLE / greatest(coalesce(total, 0), 1) > 0.5 AND NOT coalesce(k.gt = k.pred, false) AS one_to_one FROM k LEFT JOIN tot ON k.axis = tot.axis AND k.gt IS NOT DISTINCT FROM tot.gt""",
    "never_predicted": f"WITH {_LOOSE} SELECT DISTINCT gsk AS letter FROM lab WHERE gsk IS NOT NULL AND gsk NOT IN (SELECT sk3 FROM lo WHERE sk3 IS NOT NULL)",
}
