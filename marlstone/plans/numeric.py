"""Queries of rewards, losses, priors, early stops and tensors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone import vocab
from marlstone.functions import arrays, outputs
from marlstone.operators import drawing, numeric, scoring
from marlstone.operators.scoring import same
from marlstone.plans.evaluation import _TEST, _tested, golds
from marlstone.plans.sqlparts import GOLD, group, letters, strict
from marlstone.plans.sqlparts import share as ratio
from marlstone.stages import table

#: Values without a better one after which a run stops; temperature of draws; points by which a measure may fall.
PATIENCE, TEMPERATURE, MOST_DROP = 5, 0.5, 0.005


def _rewarded(spark: SparkSession, sf: str) -> DataFrame:
    """Every prediction of a labelled video with its strictly parsed letters and the label's."""
    preds = table(spark, sf, "eval_preds").filter("video_id is not null").select("pos", "video_id", "score", outputs.strict(F.col("output")).alias("p"))
    return preds.join(golds(spark, sf).select("video_id", "grt", "gsk"), "video_id")


def _reward() -> F.Column:
    g = outputs.group_of
    return arrays.reward(F.col("p.rt"), F.col("p.sk"), F.col("grt"), F.col("gsk"), g(F.col("p.sk")), g(F.col("gsk")))


def shaped_reward(spark: SparkSession, sf: str) -> DataFrame:
    return _rewarded(spark, sf).select("pos", F.round(_reward(), 6).alias("reward"))


def group_advantage(spark: SparkSession, sf: str) -> DataFrame:
    """Advantage of each prediction among those of its video; videos whose rewards are all equal don't keep theirs."""
    rows = numeric.advantages(_rewarded(spark, sf).select("pos", "video_id", "p", "grt", "gsk"), "video_id", _reward())
    return rows.select("pos", F.round("advantage", 6).alias("advantage"), "keep")


def roll_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return numeric.partners(table(spark, sf, "eval_preds"), "pos", 8)


def kto_loss(spark: SparkSession, sf: str) -> DataFrame:
    """Losses by true role, with the logs of a prediction's two scores as policy and reference; rows without two scores in (0, 1] are left out."""
    a, b = F.get("score", F.lit(0)), F.get("score", F.lit(1))
    rows = _rewarded(spark, sf).filter((F.size("score") == 2) & (a > 0) & (a <= 1) & (b > 0) & (b <= 1))
    right = F.col("p.ok") & same(F.col("p.rt"), F.col("grt")) & same(F.col("p.sk"), F.col("gsk"))
    return numeric.preference(rows, F.ln(a), F.ln(b), right, "grt")


def prior_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Score corrections from the labels' priors to the target shares; none for scenes whose recall is watched."""
    own = golds(spark, sf).select(F.explode(F.array(F.struct(F.lit("rt").alias("axis"), F.col("grt").alias("letter")), F.struct(F.lit("sk").alias("axis"), F.col("gsk").alias("letter")))).alias("x")).groupBy("x.axis", "x.letter").agg(F.count("*").alias("n"))
    totals = own.groupBy("axis").agg(F.sum("n").alias("total"))
    own = own.join(F.broadcast(totals), "axis").withColumn("s", F.col("n") / F.col("total"))
    rows = table(spark, sf, "sample_targets").join(F.broadcast(own.select("axis", "letter", "s")), ["axis", "letter"], "left")
    exempt = (F.col("axis") == "sk") & F.col("letter").isin(*vocab.SAFETY_REPORTED)
    return rows.select("axis", "letter", F.round(F.when(exempt, 0.0).otherwise(arrays.prior_delta(F.col("p"), F.col("s"))), 6).alias("delta"))


def early_stop(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's events as the history of a run."""
    return numeric.early_stops(table(spark, sf, "events").select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], "value", PATIENCE)


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").withColumn("label", F.col("label").cast("long"))


def tensor_mean(spark: SparkSession, sf: str) -> DataFrame:
    return numeric.mean_vectors(_vectors(spark, sf), "label", "embedding").withColumn("mean", F.round("mean", 6))


def tensor_stats(spark: SparkSession, sf: str) -> DataFrame:
    return numeric.vector_stats(_vectors(spark, sf), "label", "embedding")


def tensor_swa(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as bags: of each, the first vector by the number of fifty that its id leaves."""
    from marlstone.operators.keyed import first_rows

    rows = _vectors(spark, sf).withColumn("key", F.pmod("vec_id", F.lit(50))).withColumn("both", F.concat_ws(":", "label", "key"))
    return numeric.averaged_bags(first_rows(rows, "both", "vec_id"), "label", "key", "embedding").withColumn("mean", F.round("mean", 6))


def cosine_to_ref(spark: SparkSession, sf: str) -> DataFrame:
    """Correlation of each vector, centred and of unit length, with the first one of its label."""
    rows = _vectors(spark, sf).select("vec_id", "label", arrays.normalised(F.col("embedding")).alias("v"))
    ref = rows.groupBy("label").agg(F.min_by("v", "vec_id").alias("ref"))
    return rows.join(F.broadcast(ref), "label").select("vec_id", F.round(arrays.dot(F.col("v"), F.col("ref")), 6).alias("cosine"))


def subset_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The place among the first five numbers of each vector that a softmax draws, by hash."""
    u = F.conv(F.substring(drawing.shuffle_key("draw", F.col("vec_id")), 1, 7), 16, 10).cast("double") / float(1 << 28)
    scores = F.transform(F.slice("embedding", 1, 5), lambda x: x.cast("double"))
    return _vectors(spark, sf).select("vec_id", arrays.subset_sample(scores, u, TEMPERATURE).cast("long").alias("place"))


def regression_brake(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracies that are lower on cameras training hasn't seen, by more than half a point."""
    n = F.count("*")
    per = lambda s: _tested(spark, sf).filter(F.col("subset") == s).agg(*[scoring.share(F.count_if(c), n).alias(k) for k, c in (("rt", same(F.col("p.rt"), F.col("grt"))), ("sk", same(F.col("p.sk"), F.col("gsk"))))]).select(F.explode(F.create_map(F.lit("rt"), F.col("rt"), F.lit("sk"), F.col("sk"))).alias("axis", "value"))
    return numeric.regressions(per("overlap"), per("fresh"), "axis", "value", MOST_DROP)


QUERIES = {f.__name__: f for f in (shaped_reward, group_advantage, roll_pairs, kto_loss, prior_deltas, early_stop, tensor_mean, tensor_stats, tensor_swa, cosine_to_ref, subset_sample, regression_brake)}

_REW = f"""{GOLD}, src AS (SELECT pos, video_id, score, output FROM eval_preds WHERE video_id IS NOT NULL), {strict('src')}, rw AS (SELECT s.pos, s.video_id, s.score, g.grt, g.gsk, ok AND coalesce(r = grt AND k = gsk, false) AS right_,
 CASE WHEN ok AND coalesce(k = gsk, false) THEN 1.0 ELSE 0.0 END::DOUBLE + CASE WHEN ok AND coalesce({group('k')} = {group('gsk')}, false) THEN 0.3 ELSE 0.0 END::DOUBLE + CASE WHEN ok AND coalesce(r = grt, false) THEN 0.3 ELSE 0.0 END::DOUBLE AS reward FROM strict s JOIN gold g ON s.video_id = g.video_id)"""
_V = "v AS (SELECT vec_id, label::BIGINT AS label, embedding::DOUBLE[] AS e FROM embeddings)"
ORACLE = {
    "shaped_reward": f"WITH {_REW} SELECT pos, round(reward, 6) AS reward FROM rw",
    "group_advantage": f"WITH {_REW}, a AS (SELECT pos, video_id, reward - avg(reward) OVER (PARTITION BY video_id) AS a FROM rw) SELECT pos, round(a, 6) AS advantage, max(abs(a)) OVER (PARTITION BY video_id) > 1e-9 AS keep FROM a",
    "roll_pairs": "WITH n AS (SELECT pos, (row_number() OVER (ORDER BY pos) - 1) // 8 AS b FROM eval_preds) SELECT pos, coalesce(lag(pos) OVER (PARTITION BY b ORDER BY pos), last_value(pos) OVER (PARTITION BY b ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS partner FROM n",
    "kto_loss": f"""WITH {_REW}, l AS (SELECT grt, right_, ln(score[1]) - ln(score[2]) AS r FROM rw WHERE len(score) = 2 AND score[1] > 0 AND score[1] <= 1 AND score[2] > 0 AND score[2] <= 1), k AS (SELECT grt, greatest(avg(r), 0.0) AS kl FROM l GROUP BY grt)
SELECT l.grt, count(*) AS n, round(max(kl), 6) AS kl, round(avg(1 - 1 / (1 + exp(-CASE WHEN right_ THEN 0.1 * (r - kl) ELSE 0.1 * (kl - r) END))), 6) AS loss, round(coalesce(avg(0.1 * r) FILTER (right_), 0.0), 6) AS reward_desirable, round(coalesce(avg(0.1 * r) FILTER (NOT right_), 0.0), 6) AS reward_undesirable FROM l JOIN k ON l.grt IS NOT DISTINCT FROM k.grt GROUP BY l.grt""",
    "prior_deltas": f"WITH {GOLD}, o AS (SELECT 'rt' AS axis, grt AS letter, count(*) AS n FROM gold WHERE video_id IS NOT NULL GROUP BY ALL UNION ALL SELECT 'sk', gsk, count(*) FROM gold WHERE video_id IS NOT NULL GROUP BY ALL), s AS (SELECT axis, letter, n::DOUBLE / sum(n) OVER (PARTITION BY axis) AS s FROM o) SELECT t.axis, t.letter, round(CASE WHEN t.axis = 'sk' AND t.letter IN ({letters(vocab.SAFETY_REPORTED)}) THEN 0.0 ELSE ln((coalesce(t.p, 1e-6) + 1e-6) / (coalesce(s.s, 1e-6) + 1e-6)) END, 6)::DOUBLE AS delta FROM sample_targets t LEFT JOIN s ON t.axis = s.axis AND t.letter = s.letter",
    "early_stop": f"""WITH a AS (SELECT user_id, value, row_number() OVER w AS i, min(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), m AS (SELECT *, coalesce(value < b, value IS NOT NULL AND b IS NULL) AS better FROM a),
s AS (SELECT *, i - coalesce(max(i) FILTER (better) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING), 0) AS since FROM m), z AS (SELECT *, min(i) FILTER (since >= {PATIENCE}) OVER (PARTITION BY user_id) AS stop FROM s)
SELECT user_id, count(*) AS steps, min(value) AS best, max(i) FILTER (better) AS best_step, max(stop) AS stop_step FROM z WHERE stop IS NULL OR i <= stop GROUP BY user_id""",
    "tensor_mean": f"WITH {_V}, x AS (SELECT label, unnest(e) AS x, unnest(range(len(e))) AS i FROM v) SELECT label, i, round(avg(x), 6) AS mean FROM x GROUP BY label, i",
    "tensor_stats": f"WITH {_V}, q AS (SELECT label, len(e) AS k, list_sum([x * x FOR x IN e]) AS q, list_max([abs(x) FOR x IN e]) AS m FROM v WHERE len(e) > 0) SELECT label, sum(k)::BIGINT AS n, round(max(m), 6) AS largest, round(sqrt(sum(q) / sum(k)), 6) AS rms, round(avg(q / k), 6) AS mean_energy, round(min(q / k), 6) AS least_energy, round(median(q / k), 6) AS median_energy FROM q GROUP BY label",
    "tensor_swa": f"WITH {_V}, b AS (SELECT label, vec_id % 50 AS key, e FROM v QUALIFY row_number() OVER (PARTITION BY label, vec_id % 50 ORDER BY vec_id) = 1), k AS (SELECT key, count(*) AS n, min(label) AS f FROM b GROUP BY key), u AS (SELECT b.key, unnest(e) AS x, unnest(range(len(e))) AS i FROM b JOIN k ON b.key = k.key WHERE n = (SELECT count(DISTINCT label) FROM v) OR label = f) SELECT key, i, round(avg(x), 6) AS mean FROM u GROUP BY key, i",
    "cosine_to_ref": f"WITH {_V}, c AS (SELECT vec_id, label, [x - list_sum(e) / len(e) FOR x IN e] AS c FROM v), n AS (SELECT vec_id, label, c, sqrt(list_sum([x * x FOR x IN c])) AS s FROM c), u AS (SELECT vec_id, label, CASE WHEN s > 1e-6 THEN [x / s FOR x IN c] ELSE c END AS u FROM n), r AS (SELECT label, arg_min(u, vec_id) AS r FROM u GROUP BY label) SELECT u.vec_id, round(list_dot_product(u.u, r.r), 6) AS cosine FROM u JOIN r ON u.label = r.label",
    "subset_sample": f"WITH {_V}, z AS (SELECT vec_id, [x / {TEMPERATURE} FOR x IN e[1:5]] AS z, ('0x' || substr(md5('draw:' || vec_id), 1, 7))::BIGINT / 268435456.0::DOUBLE AS u FROM v), p AS (SELECT vec_id, u, [exp(x - list_max(z)) FOR x IN z] AS p FROM z) SELECT vec_id, least(len([k FOR k IN range(1, 6) IF list_sum(p[1:k]) <= u * list_sum(p)]), 4)::BIGINT AS place FROM p",
    "regression_brake": f"WITH {_TEST}, s AS (SELECT subset, {ratio('count(*) FILTER (rt2 = grt)', 'count(*)')} AS rt, {ratio('count(*) FILTER (sk2 = gsk)', 'count(*)')} AS sk FROM t GROUP BY subset), l AS (SELECT subset, 'rt' AS axis, rt AS v FROM s UNION ALL SELECT subset, 'sk', sk FROM s) SELECT a.axis, a.v AS before, b.v AS after, round(a.v - b.v, 6) AS drop FROM l a JOIN l b ON a.axis = b.axis AND a.subset = 'overlap' AND b.subset = 'fresh' WHERE round(a.v - b.v, 6) > {MOST_DROP}",
}
