"""Queries of keyed ingestion: duplicate policies, resumption, scope, dead letters, conversion of chat annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import identity, outputs, texts
from marlstone.operators import keyed
from marlstone.plans.scalars import _ERRORS
from marlstone.plans.sqlparts import strict, strip, words
from marlstone.stages import table


def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.first_rows(table(spark, sf, "labels"), "video_id").select("pos", "video_id", F.col("labels.sub_keyscene").alias("sk"))


def keyed_last(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.last_rows(table(spark, sf, "eval_preds").select("video_id", "pos", "output"), "video_id")


def keyed_last_valid(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "eval_preds").select("video_id", "pos", outputs.loose(F.col("output"), 2).alias("p"))
    return keyed.last_rows(rows, "video_id", valid=F.col("p.sk").isNotNull()).select("video_id", "pos", "p.rt", "p.sk")


def first_complete(spark: SparkSession, sf: str) -> DataFrame:
    p = "gemini_output.predictions."
    rows = table(spark, sf, "gemini_pass2").select("video_id", "pos", F.col(p + "role_type").alias("rt"), F.col(p + "sub_keyscene").alias("sk"))
    return keyed.first_rows(rows, "video_id", complete=(F.coalesce("rt", F.lit("")) != "") & (F.coalesce("sk", F.lit("")) != ""))


def resume_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled rows whose video has no prediction yet."""
    return keyed.remaining(table(spark, sf, "labels").select("pos", "video_id"), table(spark, sf, "eval_preds"), "video_id")


def scope_semi(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of videos that are labelled."""
    return keyed.scoped(table(spark, sf, "eval_preds").select("pos", "video_id"), table(spark, sf, "labels"), "video_id")


def dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Labeler records with errors, with these and their number, beside the partial record."""
    rows = table(spark, sf, "gemini_pass2").select("pos", "video_id", texts.record_errors(F.col("gemini_output")).alias("errors"), F.col("gemini_output.predictions.description").alias("partial"))
    bad = rows.filter(F.size("errors") > 0)
    return bad.select("pos", "video_id", F.size("errors").cast("long").alias("n"), F.array_join("errors", ",").alias("errors"), "partial")


def dead_letter_split(spark: SparkSession, sf: str) -> DataFrame:
    """Good and bad labeler records, counted."""
    rows = table(spark, sf, "gemini_pass2").select("pos", texts.record_errors(F.col("gemini_output")).alias("errors"))
    good, bad = keyed.by_errors(rows)
    return good.agg(F.lit("good").alias("side"), F.count("*").alias("n")).union(bad.agg(F.lit("bad"), F.count("*")))


def _chats(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as chat annotations: a turn that asks and, where there is a label, one that answers."""
    turn = lambda who, text: F.struct(F.lit(who).alias("from"), text.alias("value"))
    label = F.concat_ws("|", *[F.col(f"labels.{c}") for c in ("role_type", "sub_keyscene", "description")])
    turns = F.when(F.col("labels").isNotNull(), F.array(turn("human", F.lit("?")), turn("gpt", label))).otherwise(F.array(turn("human", F.lit("?"))))
    return table(spark, sf, "labels").select("pos", "video_id", "meta", turns.alias("conversations"))


def chat_first_assistant(spark: SparkSession, sf: str) -> DataFrame:
    """What the first answering turn says, cut into three parts; without such a turn or part the row isn't ok."""
    rows = keyed.chat_labels(_chats(spark, sf)).withColumn("p", outputs.stored_label(F.col("value")))
    return rows.select("pos", F.col("p").isNotNull().alias("ok"), "p.rt", "p.sk", "p.description")


def gt_conversion(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a conversion of chat annotations: kept rows, malformed labels, rows without a shard, devices and rows of an unknown one.

    The shard index is what the rows' meta data say of each video, the last one for a video.
    """
    rows = keyed.chat_labels(_chats(spark, sf)).withColumn("p", outputs.stored_label(F.col("value")))
    index = keyed.last_rows(rows.filter(F.col("meta")["shard"].isNotNull() & F.col("video_id").isNotNull()).select("video_id", "pos", F.col("meta")["shard"].alias("shard")), "video_id")
    both = rows.join(index.select("video_id", "shard"), "video_id", "left")
    fate = F.when(F.col("p").isNull(), "bad").when(F.col("shard").isNull(), "no_shard").otherwise("kept")
    device = identity.device_of(F.col("video_id"))
    kept = fate == "kept"
    return both.agg(*[F.count_if(fate == k).alias(k) for k in ("kept", "bad", "no_shard")], F.count_distinct(F.when(kept, device)).alias("devices"), F.count_if(kept & (device == "unknown")).alias("unknown"))


def modulo_shard(spark: SparkSession, sf: str) -> DataFrame:
    """The shard, one of eight, of each row: shards are disjoint and complete."""
    rows = table(spark, sf, "labels").select("pos")
    parts = [keyed.shard(rows, "pos", i, 8).withColumn("shard", F.lit(i).cast("long")) for i in range(8)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def id_list(spark: SparkSession, sf: str) -> DataFrame:
    """Ids between white space of any kind, as in a list that holds several a line."""
    lines = table(spark, sf, "labels").select(F.concat_ws("  \t", "video_id", "video_uri").alias("value"))
    return lines.select(F.explode(texts.word_list(F.col("value"))).alias("id")).groupBy("id").agg(F.count("*").alias("n"))


def routed_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions by where they go: loaded, unsupported (a class of its own) or errors."""
    rows = table(spark, sf, "eval_preds").select("pos", outputs.strict(F.col("output")).alias("p"))
    route = F.when(~F.col("p.ok"), "error").when(F.col("p.sk") == "m", "unsupported").otherwise("ok")
    parts = keyed.routed(rows.withColumn("r", route), F.col("r"), ["ok", "unsupported", "error"])
    out = None
    for name, part in parts.items():
        got = part.select("pos", F.lit(name).alias("sink"))
        out = got if out is None else out.unionByName(got)
    return out


QUERIES = {f.__name__: f for f in (dedup_first, keyed_last, keyed_last_valid, first_complete, resume_anti, scope_semi, dead_letters, dead_letter_split, chat_first_assistant, gt_conversion, modulo_shard, id_list, routed_outputs)}

_LABEL = "array_to_string([labels.role_type, labels.sub_keyscene, labels.description], '|')"
_CHAT = f"chat AS (SELECT pos, video_id, meta, CASE WHEN labels IS NOT NULL THEN string_split({_LABEL}, '|') END AS s FROM labels)"
ORACLE = {
    "dedup_first": "SELECT pos, video_id, labels.sub_keyscene AS sk FROM labels QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos) = 1",
    "keyed_last": "SELECT video_id, pos, output FROM eval_preds QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1",
    "keyed_last_valid": f"SELECT video_id, pos, {strip('s[1]')} AS rt, {strip('s[2]')} AS sk FROM (SELECT video_id, pos, string_split(output, '|') AS s FROM eval_preds) WHERE len(s) >= 2 QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1",
    "first_complete": "WITH g AS MATERIALIZED (SELECT video_id, pos, gemini_output.predictions.role_type AS rt, gemini_output.predictions.sub_keyscene AS sk FROM gemini_pass2), k AS MATERIALIZED (SELECT *, coalesce(rt, '') <> '' AND coalesce(sk, '') <> '' AS whole FROM g) SELECT video_id, pos, rt, sk FROM k WHERE whole QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos) = 1",
    "resume_anti": "SELECT pos, video_id FROM labels l WHERE NOT EXISTS (SELECT 1 FROM eval_preds p WHERE p.video_id = l.video_id)",
    "scope_semi": "SELECT pos, video_id FROM eval_preds p WHERE EXISTS (SELECT 1 FROM labels l WHERE p.video_id = l.video_id)",
    "dead_letters": f"WITH e AS MATERIALIZED (SELECT pos, video_id, {_ERRORS} AS e, gemini_output.predictions.description AS partial FROM gemini_pass2) SELECT pos, video_id, len(e) AS n, array_to_string(e, ',') AS errors, partial FROM e WHERE len(e) > 0",
    "dead_letter_split": f"WITH e AS MATERIALIZED (SELECT len({_ERRORS}) AS n FROM gemini_pass2) SELECT 'good' AS side, count(*) FILTER (n = 0) AS n FROM e UNION ALL SELECT 'bad', count(*) FILTER (n > 0) FROM e",
    "chat_first_assistant": f"WITH {_CHAT} SELECT pos, coalesce(len(s) >= 3, false) AS ok, CASE WHEN len(s) >= 3 THEN {strip('s[1]')} END AS rt, CASE WHEN len(s) >= 3 THEN {strip('s[2]')} END AS sk, CASE WHEN len(s) >= 3 THEN {strip("array_to_string(s[3:], '|')")} END AS description FROM chat",
    "gt_conversion": f"""WITH {_CHAT}, idx AS (SELECT video_id, meta['shard'] AS shard FROM labels WHERE meta['shard'] IS NOT NULL AND video_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1),
f AS (SELECT CASE WHEN coalesce(len(s), 0) < 3 THEN 'bad' WHEN idx.shard IS NULL THEN 'no_shard' ELSE 'kept' END AS fate, coalesce(nullif(regexp_extract(string_split(chat.video_id, '/')[-1], '(T8[A-Za-z0-9]{{6,}})', 1), ''), 'unknown') AS device FROM chat LEFT JOIN idx ON chat.video_id = idx.video_id)
SELECT count(*) FILTER (fate = 'kept') AS kept, count(*) FILTER (fate = 'bad') AS bad, count(*) FILTER (fate = 'no_shard') AS no_shard, count(DISTINCT device) FILTER (fate = 'kept') AS devices, count(*) FILTER (fate = 'kept' AND device = 'unknown') AS unknown FROM f""",
    "modulo_shard": "SELECT pos, pos % 8 AS shard FROM labels",
    "id_list": f"SELECT id, count(*) AS n FROM (SELECT unnest({words("concat_ws(' ', video_id, video_uri)")}) AS id FROM labels) GROUP BY id",
    "routed_outputs": f"WITH {strict('eval_preds')} SELECT pos, CASE WHEN NOT ok THEN 'error' WHEN k = 'm' THEN 'unsupported' ELSE 'ok' END AS sink FROM strict",
}
