"""Queries of splits, samples, weights, replication and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone import vocab
from marlstone.functions import outputs
from marlstone.functions.identity import group_key
from marlstone.operators import drawing
from marlstone.operators.scoring import same
from marlstone.plans.curation import _AGREE, _EXAM, consistency_gt, kto_pairs, suspects
from marlstone.plans.curation import ORACLE as _CURATION
from marlstone.plans.evaluation import golds, last_preds
from marlstone.plans.scalars import _SHOWN
from marlstone.plans.sqlparts import GOLD, LAST, letters, strict, strip
from marlstone.stages import table

#: Rows of a validation split; caps of a quota sample, its size; quotas of an audit.
VAL_SIZE, QUOTA_SIZE = 500, 5000
SAFETY_CAPS, PAIR_CAPS, ROLE_CAPS = {c: 300 for c in vocab.SAFETY_REPORTED}, {c: 500 for c in "hnkl"}, {c: 500 for c in "CD"}
QUOTAS = {"m_disputed": 30, "s_boundary": 20, "rt_AD": 20, "control": 10}
VERDICTS = ("1", "2", "both", "neither", "unsure", "")
WEIGHT, CAP = 3.0, 1.5
BATCH, MINOR, EPOCHS, WORLD = 8, 2, 2, 8


def group_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels").select("pos", "video_id", F.col("meta")["camera_id"].alias("camera"))
    return drawing.group_split(rows, group_key(F.col("camera"), F.col("video_id")), "video_id", VAL_SIZE).select("pos", "side")


def quota_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = golds(spark, sf).select("video_id", F.col("grt").alias("rt"), F.col("gsk").alias("sk"))
    return drawing.quota_sample(rows, "video_id", SAFETY_CAPS, PAIR_CAPS, ROLE_CAPS, QUOTA_SIZE)


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    preds = last_preds(spark, sf).select("video_id", outputs.loose(F.col("output"), 3).alias("p")).filter("p.sk is not null")
    rows = golds(spark, sf).select("video_id", "grt", "gsk", "gdesc").join(preds, "video_id")
    g, p = F.col("gsk"), F.col("p.sk")
    s = lambda c, v: F.coalesce(c == v, F.lit(False))
    ad = (s(F.col("grt"), "A") & s(F.col("p.rt"), "D")) | (s(F.col("grt"), "D") & s(F.col("p.rt"), "A"))
    stratum = F.when(s(g, "m") & ~s(p, "m"), "m_disputed").when(s(g, "s") != s(p, "s"), "s_boundary").when(ad & same(g, p), "rt_AD").when(same(F.col("grt"), F.col("p.rt")) & same(g, p), "control")
    return drawing.audit_sample(rows, "video_id", stratum, QUOTAS)


def audit_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A blinded worksheet: two candidates in an order by coin, with the key beside them."""
    rows = _audit(spark, sf)
    a, b = outputs.shown(F.col("grt"), F.col("gsk"), F.col("gdesc")), outputs.shown(F.col("p.rt"), F.col("p.sk"), F.col("p.description"))
    first = F.col("gt_first")
    return rows.select("idx", "video_id", "stratum", F.when(first, 1).otherwise(2).cast("long").alias("gt_is"), F.when(first, a).otherwise(b).alias("cand1"), F.when(first, b).otherwise(a).alias("cand2"))


def audit_score(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of verdicts that a hash of the video gives, as nobody has filled in the worksheet."""
    key = _audit(spark, sf).select("idx", "stratum", "gt_first", "video_id")
    one = F.conv(F.substring(drawing.shuffle_key("verdict", F.col("video_id")), 1, 6), 16, 10).cast("long") % len(VERDICTS)
    verdicts = key.select("idx", F.element_at(F.array(*[F.lit(v) for v in VERDICTS]), (one + 1).cast("int")).alias("verdict"))
    return drawing.audit_scores(key.drop("video_id"), verdicts)


def _weighed(spark: SparkSession, sf: str, pattern: bool) -> tuple[DataFrame, DataFrame]:
    parse = outputs.by_pattern if pattern else outputs.strict
    preds = last_preds(spark, sf).select("video_id", F.lit(True).alias("there"), parse(F.col("output")).alias("p"))
    rows = golds(spark, sf).select("video_id", "pos", "grt", "gsk").join(preds, "video_id", "left")
    wrong = F.col("there") & ~(same(F.col("p.rt"), F.col("grt")) & same(F.col("p.sk"), F.col("gsk")))
    if pattern:
        return drawing.hard_weights(rows, "video_id", "gsk", wrong, None, WEIGHT, CAP)
    white = consistency_gt(spark, sf).filter("bucket = 'white'").select("video_id", F.lit(True).alias("white"))
    return drawing.hard_weights(rows.join(white, "video_id", "left"), "video_id", "gsk", wrong, F.coalesce("white", F.lit(False)), WEIGHT, CAP)


def hard_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Weights by the strict parser, of wrong predictions whose label the labeler confirms."""
    return _weighed(spark, sf, False)[0].select("video_id", F.round("weight", 6).alias("weight"))


def class_inflation(spark: SparkSession, sf: str) -> DataFrame:
    r = lambda c: F.round(c, 6).alias(c)
    return _weighed(spark, sf, False)[1].select("gsk", "n", "hard", r("weight"), r("mass"))


def hard_weights_pattern(spark: SparkSession, sf: str) -> DataFrame:
    """Weights by the pattern parser, of all wrong predictions, to three places."""
    return _weighed(spark, sf, True)[0].select("video_id", F.bround("weight", 3).alias("weight"))


def replicate(spark: SparkSession, sf: str) -> DataFrame:
    """How often each video's last row is repeated by these weights."""
    rows = golds(spark, sf).select("pos", "video_id").join(hard_weights_pattern(spark, sf), "video_id", "left")
    return drawing.replicated(rows, "pos", F.col("weight")).select("pos", "copies")


def stratified_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of preference rows, each with two undesirable ones."""
    rows = kto_pairs(spark, sf).select("video_id", "label")
    return drawing.mixed_batches(rows, ["video_id"], ~F.col("label"), BATCH, MINOR)


def epoch_order(spark: SparkSession, sf: str) -> DataFrame:
    return drawing.epoch_order(table(spark, sf, "labels"), "pos", EPOCHS)


def rank_shares(spark: SparkSession, sf: str) -> DataFrame:
    return drawing.rank_shares(table(spark, sf, "eval_preds").select("pos"), "pos", WORLD)


def spot_check(spark: SparkSession, sf: str) -> DataFrame:
    """A dozen suspects, most of them of the classes that are looked at first."""
    rows = suspects(spark, sf).withColumn("one", F.lit(1))
    return drawing.priority_sample(rows, "video_id", F.col("gsk").isin("e", "l", "g"), 12, "one").withColumn("turn", F.col("turn").cast("long"))


def sample_rounds(spark: SparkSession, sf: str) -> DataFrame:
    return drawing.rounds(table(spark, sf, "labels"), "pos", 20, 3)


def latest_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """The five names with the greatest number at their end."""
    return drawing.latest(table(spark, sf, "labels").select("video_id").distinct(), "video_id", 5).select("video_id", F.col("suffix").cast("string").alias("suffix"))


def quota_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that each stratum of the quota sample gave."""
    return quota_sample(spark, sf).groupBy("stratum").agg(F.count("*").alias("n"))


def micro_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Chains in lots of twenty."""
    return drawing.micro_batches(table(spark, sf, "asset_c_reasoning").select("pos"), "pos", 20)


QUERIES = {f.__name__: f for f in (group_split, quota_sample, audit_sample, audit_score, hard_weights, class_inflation, hard_weights_pattern, replicate, stratified_batches, epoch_order, rank_shares, spot_check, sample_rounds, latest_numbers, quota_stats, micro_batches)}

_CAPS = " ".join(f"WHEN '{c}' THEN {SAFETY_CAPS.get(c, 0) + PAIR_CAPS.get(c, 0)}" for c in [*SAFETY_CAPS, *[c for c in PAIR_CAPS if c not in SAFETY_CAPS]])
_AUDIT = f"""{GOLD}, {LAST}, pr AS (SELECT video_id, string_split(output, '|') AS s FROM last), au AS (SELECT g.video_id, grt, gsk, gdesc, {strip('s[1]')} AS prt, {strip('s[2]')} AS psk, {strip("array_to_string(s[3:], '|')")} AS pd FROM gold g JOIN pr ON g.video_id = pr.video_id WHERE len(s) >= 3),
st AS (SELECT *, CASE WHEN coalesce(gsk = 'm', false) AND psk <> 'm' THEN 'm_disputed' WHEN coalesce(gsk = 's', false) <> (psk = 's') THEN 's_boundary' WHEN coalesce((grt = 'A' AND prt = 'D') OR (grt = 'D' AND prt = 'A'), false) AND coalesce(gsk = psk, false) THEN 'rt_AD' WHEN coalesce(grt = prt AND gsk = psk, false) THEN 'control' END AS stratum, md5('audit:' || video_id) AS h FROM au),
dr AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, video_id) AS rk FROM st WHERE stratum IS NOT NULL),
ax AS (SELECT *, row_number() OVER (ORDER BY CASE stratum {' '.join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(QUOTAS))} END, rk) AS idx, substr(md5('audit-coin:' || video_id), 1, 1) < '8' AS gf FROM dr WHERE rk <= CASE stratum {' '.join(f"WHEN '{k}' THEN {q}" for k, q in QUOTAS.items())} END)"""


def _show(rt: str, sk: str, d: str) -> str:
    return _SHOWN.replace("labels.role_type", rt).replace("labels.sub_keyscene", sk) + f"coalesce({d}, 'None')"


_HARD = f"""{_AGREE}, {LAST}, {strict('last')}, wr AS (SELECT g.video_id, g.gsk, coalesce(s.video_id IS NOT NULL AND NOT (ok AND coalesce(r = g.grt AND k = g.gsk, false)) AND g.video_id IN (SELECT video_id FROM bk WHERE bucket = 'white'), false) AS hard FROM gold g LEFT JOIN strict s ON g.video_id = s.video_id WHERE g.video_id IS NOT NULL)"""
_PATTERN = rf"""{GOLD}, {LAST}, pt AS (SELECT video_id, nullif(regexp_extract(output, '^[{vocab.WHITE}]*([A-E])[{vocab.WHITE}]*\|[{vocab.WHITE}]*([a-u])[{vocab.WHITE}]*\|', 1), '') AS prt, nullif(regexp_extract(output, '^[{vocab.WHITE}]*([A-E])[{vocab.WHITE}]*\|[{vocab.WHITE}]*([a-u])[{vocab.WHITE}]*\|', 2), '') AS psk FROM last),
wr AS (SELECT g.video_id, g.pos, g.gsk, pt.video_id IS NOT NULL AND NOT coalesce(prt = g.grt AND psk = g.gsk, false) AS hard FROM gold g LEFT JOIN pt ON g.video_id = pt.video_id WHERE g.video_id IS NOT NULL)"""
_CLASS = f"cl AS (SELECT gsk, count(*) AS n, count(*) FILTER (hard) AS hard, least({WEIGHT}::DOUBLE, 1.0::DOUBLE + {CAP - 1}::DOUBLE * count(*) / nullif(count(*) FILTER (hard), 0)) AS weight FROM wr GROUP BY gsk HAVING count(*) FILTER (hard) > 0), we AS (SELECT wr.*, CASE WHEN wr.hard THEN cl.weight ELSE 1.0 END::DOUBLE AS weight FROM wr LEFT JOIN cl ON wr.gsk IS NOT DISTINCT FROM cl.gsk)"
_PAIRS = f"pairs AS ({_CURATION['kto_pairs']})"
ORACLE = {
    "micro_batches": "SELECT pos, (row_number() OVER (ORDER BY pos) - 1) // 20 AS batch FROM asset_c_reasoning",
    "group_split": f"""WITH r AS (SELECT pos, video_id, coalesce(coalesce(nullif(nullif(meta['camera_id'], ''), 'unknown'), video_id), '') AS g FROM labels), z AS (SELECT g, count(*) AS n, md5('split:' || g) AS h FROM r GROUP BY g),
c AS (SELECT g, sum(n) OVER (ORDER BY h, g ROWS UNBOUNDED PRECEDING) - n < {VAL_SIZE} AS val FROM z), v AS (SELECT r.*, c.val FROM r JOIN c ON r.g = c.g)
SELECT pos, CASE WHEN val THEN 'val' WHEN video_id IN (SELECT video_id FROM v WHERE val) THEN 'dropped' ELSE 'train' END AS side FROM v""",
    "quota_sample": f"""WITH {GOLD}, o AS (SELECT video_id, gsk AS sk, grt AS rt, md5('quota:' || video_id) AS h FROM gold WHERE video_id IS NOT NULL), a0 AS (SELECT *, row_number() OVER (PARTITION BY sk ORDER BY h, video_id) AS rk FROM o),
a AS (SELECT video_id, CASE WHEN rk <= 300 AND sk IN ({letters(SAFETY_CAPS)}) THEN 'first_' ELSE 'extra_' END || sk AS stratum FROM a0 WHERE rk <= coalesce(CASE sk {_CAPS} END, 0)),
b0 AS (SELECT *, row_number() OVER (PARTITION BY rt ORDER BY h, video_id) AS rk FROM o WHERE video_id NOT IN (SELECT video_id FROM a)), b AS (SELECT video_id, 'role_' || rt AS stratum FROM b0 WHERE rk <= 500 AND rt IN ('C', 'D')),
p AS (FROM a UNION ALL FROM b), f0 AS (SELECT video_id, row_number() OVER (ORDER BY h, video_id) AS rk FROM o WHERE video_id NOT IN (SELECT video_id FROM p))
FROM p UNION ALL SELECT video_id, 'fill' FROM f0 WHERE rk <= greatest(0, {QUOTA_SIZE} - (SELECT count(*) FROM p))""",
    "audit_sample": f"WITH {_AUDIT} SELECT idx, video_id, stratum, CASE WHEN gf THEN 1 ELSE 2 END::BIGINT AS gt_is, CASE WHEN gf THEN {_show('grt', 'gsk', 'gdesc')} ELSE {_show('prt', 'psk', 'pd')} END AS cand1, CASE WHEN gf THEN {_show('prt', 'psk', 'pd')} ELSE {_show('grt', 'gsk', 'gdesc')} END AS cand2 FROM ax",
    "audit_score": f"""WITH {_AUDIT}, ve AS (SELECT *, [{', '.join(f"'{v}'" for v in VERDICTS)}][('0x' || substr(md5('verdict:' || video_id), 1, 6))::BIGINT % {len(VERDICTS)} + 1] AS v, CASE WHEN gf THEN '1' ELSE '2' END AS g FROM ax)
SELECT stratum, count(*) AS n, count(*) FILTER (v = g) AS gt_win, count(*) FILTER (v IN ('1', '2') AND v <> g) AS model_win, count(*) FILTER (v = 'both') AS both, count(*) FILTER (v = 'neither') AS neither, count(*) FILTER (v = 'unsure') AS unsure, round((count(*) FILTER (v = g) + count(*) FILTER (v = 'both'))::DOUBLE / count(*), 6) AS accepted FROM ve WHERE v <> '' GROUP BY stratum""",
    "hard_weights": f"WITH {_HARD}, {_CLASS} SELECT video_id, round(weight, 6) AS weight FROM we",
    "class_inflation": f"WITH {_HARD}, {_CLASS} SELECT gsk, n, hard, round(weight, 6) AS weight, round((n + (weight - 1) * hard) / n, 6) AS mass FROM cl",
    "hard_weights_pattern": f"WITH {_PATTERN}, {_CLASS} SELECT video_id, round_even(weight, 3) AS weight FROM we",
    "replicate": f"WITH {_PATTERN}, {_CLASS}, d AS (SELECT pos, greatest(1, round_even(weight, 3)::DECIMAL(18,3)) AS w FROM we), s AS (SELECT pos, w, sum(w) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) AS c FROM d) SELECT pos, (floor(c) - floor(c - w))::BIGINT AS copies FROM s",
    "stratified_batches": f"""WITH {_PAIRS}, d AS (SELECT video_id, (row_number() OVER (ORDER BY md5('batch:' || video_id), video_id) - 1) // {BATCH - MINOR} AS batch FROM pairs WHERE label), nb AS (SELECT count(*) // {BATCH - MINOR} AS n FROM pairs WHERE label),
u0 AS (SELECT video_id FROM pairs WHERE NOT label), u AS (SELECT video_id, (row_number() OVER (ORDER BY c, md5('batch:' || c || ':' || video_id), video_id) - 1) // {MINOR} AS batch FROM u0, range(0, (SELECT ceil(n * {MINOR} / (SELECT count(*) FROM u0)::DOUBLE)::BIGINT FROM nb)) x(c))
SELECT video_id, false AS minor, batch FROM d WHERE batch < (SELECT n FROM nb) UNION ALL SELECT video_id, true, batch FROM u WHERE batch < (SELECT n FROM nb)""",
    "epoch_order": f"SELECT pos, e.e AS epoch, row_number() OVER (PARTITION BY e.e ORDER BY md5('epoch:' || e.e || ':' || pos), pos) - 1 AS place FROM labels, range(0, {EPOCHS}) e(e)",
    "rank_shares": f"WITH n AS (SELECT pos, row_number() OVER (ORDER BY pos) - 1 AS i, count(*) OVER () AS n FROM eval_preds) SELECT pos, i % {WORLD} AS rank FROM n WHERE i < n // {WORLD} * {WORLD}",
    "spot_check": f"""WITH {_EXAM}, s AS (SELECT video_id, gsk IN ('e', 'l', 'g') AS p, md5('spot:' || video_id) AS h FROM ex WHERE bucket = 'D'), a AS (SELECT video_id, h FROM s WHERE p ORDER BY h, video_id LIMIT 8),
b AS (SELECT video_id, h FROM s WHERE video_id NOT IN (SELECT video_id FROM a) ORDER BY h, video_id LIMIT 12), u AS (SELECT video_id, h, 0 AS turn FROM a UNION ALL SELECT video_id, h, 1 FROM b) SELECT video_id, turn::BIGINT AS turn FROM (SELECT * FROM u ORDER BY turn, h, video_id LIMIT 12)""",
    "sample_rounds": "SELECT e.e AS round, pos FROM labels, range(0, 3) e(e) QUALIFY row_number() OVER (PARTITION BY e.e ORDER BY md5('round:' || e.e || ':' || pos), pos) <= 20",
    "latest_numbers": r"WITH d AS (SELECT DISTINCT video_id, try_cast(nullif(regexp_extract(video_id, '([0-9]+)(?:\.[A-Za-z0-9]*)?$', 1), '') AS DECIMAL(38,0)) AS s FROM labels) SELECT video_id, s::VARCHAR AS suffix FROM d WHERE s IS NOT NULL ORDER BY s DESC, video_id DESC LIMIT 5",
}
ORACLE["quota_stats"] = f"SELECT stratum, count(*) AS n FROM ({ORACLE['quota_sample']}) GROUP BY stratum"
