"""Queries of one row in, one row out: parsers, legality, targets, validators and frame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone import vocab
from marlstone.functions import arrays, identity, outputs, texts
from marlstone.operators import keyed
from marlstone.plans.sqlparts import group, letters, split, strict, strip, words
from marlstone.stages import table

RT, SK, DESC = "labels.role_type", "labels.sub_keyscene", "labels.description"


def _preds(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "eval_preds").select("pos", "output")


def parse_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _preds(spark, sf).select("pos", outputs.strict(F.col("output")).alias("p")).select("pos", "p.ok", "p.rt", "p.sk", "p.description", "p.legal", "p.case_fixed", "p.think_leak", F.col("p.fields").cast("long").alias("fields"))


def parse_regex(spark: SparkSession, sf: str) -> DataFrame:
    return _preds(spark, sf).select("pos", outputs.by_pattern(F.col("output")).alias("p")).select("pos", "p.rt", "p.sk")


def parse_loose2(spark: SparkSession, sf: str) -> DataFrame:
    return _preds(spark, sf).select("pos", outputs.loose(F.col("output"), 2).alias("p")).select("pos", "p.rt", "p.sk")


def parse_loose3(spark: SparkSession, sf: str) -> DataFrame:
    return _preds(spark, sf).select("pos", outputs.loose(F.col("output"), 3).alias("p")).select("pos", "p.rt", "p.sk", "p.description")


def gt_split3(spark: SparkSession, sf: str) -> DataFrame:
    return _preds(spark, sf).select("pos", outputs.stored_label(F.col("output")).alias("p")).select("pos", F.col("p").isNotNull().alias("ok"), "p.rt", "p.sk", "p.description")


def legality(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select("pos", outputs.is_legal(F.col(RT), F.col(SK)).alias("legal"))


def guard_action(spark: SparkSession, sf: str) -> DataFrame:
    return _preds(spark, sf).select("pos", outputs.strict(F.col("output")).alias("p")).select("pos", outputs.guard(F.col("p")).alias("action"))


def legalize(spark: SparkSession, sf: str) -> DataFrame:
    return _preds(spark, sf).select("pos", outputs.legalised(F.col("output")).alias("output"))


def parent_group(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select("pos", outputs.group_of(F.col(SK), "?").alias("ks"))


def vocab_index(spark: SparkSession, sf: str) -> DataFrame:
    """The index of each attribute's value, seven rows a record."""
    heads = [F.struct(F.lit(h).alias("head"), outputs.value_index(h, F.col(f"gemini_output.attributes.{h}")).cast("long").alias("idx")) for h in vocab.ATTRIBUTES]
    return table(spark, sf, "gemini_pass2").select("pos", F.explode(F.array(*heads)).alias("x")).select("pos", "x.*")


def view_type(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select("pos", outputs.view_type(F.col("resolution"), F.lit(None).cast("string")).alias("view_type"))


def aux_vector(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute indices of each labelled row from the last labeler record of its video; all ignored below a confidence of 0.5.

    A record with errors has confidence 0.3, a valid one 1; a resolution's view overrides the record's.
    """
    last = keyed.last_rows(table(spark, sf, "gemini_pass2"), "video_id")
    sure = F.when(F.size(texts.record_errors(F.col("gemini_output"))) == 0, 1.0).otherwise(0.3)
    last = last.filter("video_id is not null").select("video_id", F.col("gemini_output.attributes").alias("a"), sure.alias("confidence"))
    rows = table(spark, sf, "labels").select("pos", "video_id", "resolution").join(last, "video_id", "left")
    value = lambda h: outputs.view_type(F.col("resolution"), F.col("a.view_type")) if h == "view_type" else F.col(f"a.{h}")
    gated = lambda h: F.when(F.coalesce(F.col("confidence") >= 0.5, F.lit(False)), outputs.value_index(h, value(h))).otherwise(F.lit(vocab.IGNORED)).cast("long")
    return rows.select("pos", *[gated(h).alias(h) for h in vocab.ATTRIBUTES])


def serial_extract(spark: SparkSession, sf: str) -> DataFrame:
    device, key = identity.device_of(F.col("video_id")), identity.group_key(F.col("meta")["camera_id"], F.col("video_id"))
    return table(spark, sf, "labels").select("pos", device.alias("device"), key.alias("group_key"))


def shard_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Where a record's frames lie: the folder of its meta data, or ``wds``, then its shard and member; null unless stored in shards."""
    meta = F.col("meta")
    path = F.concat_ws("/", F.coalesce(meta["wds_dir"], F.lit("wds")), identity.shard_file(meta["shard"]))
    kept = (meta["storage"] == "wds") & meta["shard"].try_cast("bigint").isNotNull()
    return table(spark, sf, "labels").select("pos", F.when(kept, path).alias("path"), identity.member_name(F.col("video_id")).alias("member"))


def build_target(spark: SparkSession, sf: str) -> DataFrame:
    """Training targets of labels with valid letters: text, and end and weight of the letters' span."""
    rows = table(spark, sf, "labels").select("pos", outputs.target(F.col(RT), F.col(SK), F.col(DESC)).alias("t")).filter("t is not null")
    return rows.select("pos", "t.text", F.col("t.spans")[0]["end"].cast("long").alias("end_at"), F.col("t.spans")[0]["weight"].alias("weight"))


def cot_target(spark: SparkSession, sf: str) -> DataFrame:
    """Targets behind the last reasoning chain of their video: text, and the end of the prefix without weight and of the letters' span."""
    chains = keyed.last_rows(table(spark, sf, "asset_c_reasoning"), "video_id").filter("video_id is not null").select("video_id", "reasoning_chain")
    rows = table(spark, sf, "labels").select("pos", "video_id", outputs.target(F.col(RT), F.col(SK), F.col(DESC)).alias("t")).filter("t is not null")
    both = rows.join(chains.filter("reasoning_chain is not null"), "video_id").select("pos", outputs.thinking_target(F.col("t"), F.col("reasoning_chain")).alias("t"))
    return both.select("pos", "t.text", F.col("t.spans")[0]["end"].cast("long").alias("prefix_end"), F.col("t.spans")[1]["end"].cast("long").alias("letters_end"))


def _ints(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")), ",")


def token_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of tokens of three characters over each target, by its spans and by the rule of its prefix."""

    def weights(t: Column, n: Column) -> Column:
        starts = F.sequence(F.lit(0), n - 1, F.lit(3))
        tokens = F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(s + 3, n).alias("end")))
        sizes = F.transform(starts, lambda s: F.least(F.lit(3), n - s))
        return F.struct(_ints(outputs.token_weights(t["spans"], tokens)).alias("by_span"), _ints(outputs.prefix_weights(sizes, 4)).alias("by_prefix"))

    # bound, or the optimizer would build the target again for each token
    rows = table(spark, sf, "labels").filter(outputs.is_role(F.col(RT)) & outputs.is_scene(F.col(SK)))
    return rows.select("pos", arrays.bound(outputs.target(F.col(RT), F.col(SK), F.col(DESC)), lambda t: arrays.bound(F.length(t["text"]), lambda n: weights(t, n))).alias("w")).select("pos", "w.*")


def char_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Share of CJK characters of each chain, and whether a translation is due (over a tenth)."""
    r = texts.cjk_ratio(F.col("reasoning_chain"))
    return table(spark, sf, "asset_c_reasoning").select("pos", F.round(r, 6).alias("ratio"), (r > 0.10).alias("due"))


def tag_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "asset_c_reasoning").select("pos", texts.normal_tags(F.col("reasoning_chain")).alias("chain"))


def chain_text(spark: SparkSession, sf: str) -> DataFrame:
    """The chain of a record, or its other one where it is missing; empty without any."""
    g = "gemini_output."
    return table(spark, sf, "gemini_pass2").select("pos", texts.first_text(F.col(g + "reasoning_chain"), F.col(g + "reasoning_chain_zh")).alias("chain"))


def reasoning_text(spark: SparkSession, sf: str) -> DataFrame:
    g = "gemini_output."
    text = texts.reasoning_text(F.col(g + "attributes.clothing"), F.col(g + "attributes.action"), F.col(g + "predictions.description"))
    return table(spark, sf, "gemini_pass2").select("pos", text.alias("text"))


def validate_errors(spark: SparkSession, sf: str) -> DataFrame:
    errors = texts.record_errors(F.col("gemini_output"))
    return table(spark, sf, "gemini_pass2").select("pos", F.array_join(errors, ",").alias("errors"))


def validate_rationale(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of each record as a rationale: its role says whether it is supported, its attributes are the evidence."""
    g, rt = "gemini_output.", F.col("gemini_output.predictions.role_type")
    verdict = F.when(outputs.is_role(rt), "supported").when(rt == "", "unsupported")
    evidence = F.array_compact(F.array(F.col(g + "attributes.posture"), F.col(g + "attributes.action")))
    return table(spark, sf, "gemini_pass2").select("pos", F.array_join(texts.rationale_errors(verdict, evidence, F.col(g + "reasoning_chain")), ",").alias("errors"))


def roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Whether an output is rebuilt byte for byte from its parts; rejected where it doesn't parse without correction."""
    rows = _preds(spark, sf).select("pos", "output", outputs.strict(F.col("output")).alias("p"))
    again = outputs.target(F.col("p.rt"), F.col("p.sk"), F.col("p.description"))["text"]
    same = F.when(~F.col("p.ok") | F.col("p.case_fixed"), "rejected").when(again.eqNullSafe(F.col("output")), "same").otherwise("mismatch")
    return rows.select("pos", same.alias("status"))


def fallback_output(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs, rebuilt from nothing where they are null or empty."""
    none = F.lit(None).cast("string")
    return _preds(spark, sf).select("pos", F.coalesce(F.nullif("output", F.lit("")), outputs.rebuilt(none, none, none)).alias("output"))


def display(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select("pos", outputs.shown(F.col(RT), F.col(SK), F.col(DESC)).alias("text"))


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    """A prompt for each valid label, with the vocabulary that its answer may use."""
    choice = "; ".join(f"{k}: {'/'.join(v)}" for k, v in vocab.ATTRIBUTES.items())
    rows = table(spark, sf, "labels").filter(outputs.is_role(F.col(RT)) & outputs.is_scene(F.col(SK)))
    return rows.select("pos", F.concat(F.lit("Label "), outputs.shown(F.col(RT), F.col(SK), F.lit("-")), F.lit(f". Choose {choice}.")).alias("prompt"))


#: Frames a second that stand for a clip's frames, and frames that are sampled.
FPS, FRAMES = 15, 16


def _clips(spark: SparkSession, sf: str) -> DataFrame:
    n = F.floor(F.col("duration_sec") * FPS).cast("int")
    return table(spark, sf, "labels").select("pos", n.alias("n")).filter("n > 0")


def uniform_indices(spark: SparkSession, sf: str) -> DataFrame:
    return _clips(spark, sf).select("pos", _ints(arrays.uniform_indices(F.col("n"), FRAMES)).alias("frames"))


def _dropped(p: float) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(FRAMES - 1)), lambda i: arrays.hash_below(F.concat_ws(":", F.col("pos").cast("string"), i.cast("string")), p))


def ffill_dropout(spark: SparkSession, sf: str) -> DataFrame:
    """Frame places of which a quarter, by hash, repeat the last one that is kept."""
    frames = arrays.held(F.sequence(F.lit(0), F.lit(FRAMES - 1)), _dropped(0.25))
    return _clips(spark, sf).select("pos", _ints(frames).alias("frames"))


def augmented_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of a window of half to nine tenths of the clip, evenly, some dropped; in ascending order or an error."""
    part = lambda name: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(name), F.col("pos").cast("string"))), 1, 7), 16, 10).cast("double") / float(1 << 28)

    def plan(w: Column) -> Column:
        even = F.transform(arrays.uniform_indices(w["end"] - w["start"], FRAMES), lambda i: i + w["start"])
        frames = arrays.bound(arrays.held(even, _dropped(0.1)), arrays.checked_ascending)
        return F.struct(w["start"].cast("long").alias("start_at"), w["end"].cast("long").alias("end_at"), _ints(frames).alias("frames"))

    rows = _clips(spark, sf).select("pos", arrays.bound(arrays.crop(F.col("n"), 0.5 + 0.4 * part("ratio"), part("place")), plan).alias("p"))
    return rows.select("pos", "p.*")


def islands(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of words of over four letters in each description."""
    mask = F.transform(texts.word_list(F.coalesce(F.col(DESC), F.lit(""))), lambda w: F.length(w) > 4)
    runs = F.transform(arrays.islands(mask), lambda r: F.concat_ws(":", r["start"].cast("string"), r["length"].cast("string")))
    return table(spark, sf, "labels").select("pos", F.array_join(runs, ",").alias("runs"))


def pad_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """Word lengths of each description, 2 replaced by -1, filled or cut to 24."""
    n = F.transform(texts.word_list(F.coalesce(F.col(DESC), F.lit(""))), F.length)
    return table(spark, sf, "labels").select("pos", _ints(arrays.padded(arrays.masked(n, n, 2, -1), 24, F.lit(0))).alias("lengths"))


def cot_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a row is trained with its chain: six tenths of the training rows that have one, by hash."""
    chains = table(spark, sf, "asset_c_reasoning").filter(F.col("video_id").isNotNull() & (F.coalesce("reasoning_chain", F.lit("")) != "")).select("video_id").distinct().withColumn("has", F.lit(True))
    rows = table(spark, sf, "labels").select("pos", "video_id", identity.split_of(F.col("meta")["source_split"]).alias("split")).join(chains, "video_id", "left")
    on = F.coalesce((F.col("split") == "train") & F.col("has") & arrays.hash_below(F.concat(F.lit("cot:"), F.col("pos").cast("string")), 0.6), F.lit(False))
    return rows.select("pos", on.alias("with_chain"))


def meta_renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Open keys under their new names, by the part they belong to."""
    rows = table(spark, sf, "labels").select("pos", F.explode("meta").alias("key", "value"))
    part = F.when(F.startswith(F.col("key"), F.lit("camera_")), "camera").otherwise("other")
    return rows.select("pos", F.replace(F.col("key"), F.lit("camera_"), F.lit("device_")).alias("key"), part.alias("part"), "value")


def unmarked(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without either of two markers."""
    return table(spark, sf, "documents").filter(~texts.marked(F.col("text"), "https://", "@")).select("doc_id")


def constrained_pick(spark: SparkSession, sf: str) -> DataFrame:
    """Picks of decoding steps 0 to 4 with each embedding as scores: roles are places 0-4, scenes 5-25, the pipe is 26."""
    steps = [arrays.constrained_pick(F.col("embedding"), k, list(range(5)), list(range(5, 26)), 26).cast("long").alias(f"step{k}") for k in range(5)]
    return table(spark, sf, "embeddings").select("vec_id", *steps)


QUERIES = {
    f.__name__: f
    for f in (
        parse_strict, parse_regex, parse_loose2, parse_loose3, gt_split3, legality, guard_action, legalize, parent_group, vocab_index, view_type, aux_vector, serial_extract, shard_paths, build_target, cot_target,
        token_weights, char_ratio, tag_normalize, chain_text, reasoning_text, validate_errors, validate_rationale, roundtrip, fallback_output, display, prompts, uniform_indices, ffill_dropout, augmented_plan,
        islands, pad_fixed, cot_mode, meta_renamed, unmarked, constrained_pick,
    )
}

_W = f"[{vocab.WHITE}]*"
_BAD = " OR ".join(f"(labels.role_type = '{r}' AND labels.sub_keyscene IN ({letters(s)}))" for r, s in vocab.ILLEGAL.items())
_VALID = f"labels.role_type IN ({letters(vocab.ROLES)}) AND labels.sub_keyscene IN ({letters(vocab.SCENES)})"
_TEXT = f"labels.role_type || '|' || labels.sub_keyscene || '|' || {strip("coalesce(labels.description, '')")}"
_LISTS = {h: "[" + ", ".join(f"'{v}'" for v in vs) + "]" for h, vs in vocab.ATTRIBUTES.items()}
_VIEW = """CASE WHEN try_cast(string_split(resolution, 'x')[1] AS BIGINT) = 1600 AND try_cast(string_split(resolution, 'x')[2] AS BIGINT) = 2200 THEN 'doorbell'
WHEN coalesce(try_cast(string_split(resolution, 'x')[2] AS BIGINT), 0) <> 0 AND coalesce(abs(try_cast(string_split(resolution, 'x')[1] AS DOUBLE) / try_cast(string_split(resolution, 'x')[2] AS DOUBLE) - 16.0/9) < 0.05, false) THEN 'non_doorbell' ELSE {0} END"""


def _index(head: str, value: str) -> str:
    return f"(CASE WHEN list_contains({_LISTS[head]}, {value}) THEN list_position({_LISTS[head]}, {value}) - 1 ELSE {vocab.IGNORED} END)::BIGINT"


def _named(names: dict[str, str], x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in names.items()) + " ELSE '?' END"


_CJK = "length(regexp_replace(coalesce({0}, ''), '[^\\x{{4E00}}-\\x{{9FFF}}]+', '', 'g'))"
_MOSTLY = "(" + _CJK + " > greatest(4.0, length(coalesce({0}, '')) * 0.1))"
_G = "gemini_output"
_NWORDS = f"len({words(_G + '.predictions.description')})"
_ERRORS = f"""list_filter([CASE WHEN NOT coalesce({_G}.predictions.role_type IN ({letters(vocab.ROLES)}), false) THEN 'role_type' END,
 CASE WHEN NOT coalesce({_G}.predictions.sub_keyscene IN ({letters(vocab.SCENES)}), false) THEN 'sub_keyscene' END,
 CASE WHEN NOT {_NWORDS} BETWEEN 10 AND 40 THEN 'description:' || {_NWORDS} END,
 CASE WHEN {_MOSTLY.format(_G + '.reasoning_chain')} THEN 'reasoning_chain' END,
 {', '.join(f"CASE WHEN NOT coalesce(list_contains({_LISTS[h]}, {_G}.attributes.{h}), false) THEN '{h}' END" for h in vocab.ATTRIBUTES)}], lambda x: x IS NOT NULL)"""
_SHOWN = f"coalesce(labels.role_type, 'None') || '|' || coalesce(labels.sub_keyscene, 'None') || '  [' || {_named(vocab.ROLE_NAMES, 'labels.role_type')} || ' / ' || {_named(vocab.SCENE_NAMES, 'labels.sub_keyscene')} || ']  desc: ' || "
_CLIPS = f"clips AS (SELECT pos, floor(duration_sec * {FPS})::INT AS n FROM labels WHERE floor(duration_sec * {FPS}) > 0)"
_EVEN = "CASE WHEN {n} >= 16 THEN [round_even(i * (({n} - 1) / 15.0::DOUBLE), 0)::INT FOR i IN range(16)] ELSE [least(i, {n} - 1)::INT FOR i IN range(16)] END"


def _join(x: str) -> str:
    return f"array_to_string([y::VARCHAR FOR y IN {x}], ',')"


def _kept(p: str, at: str) -> str:
    return f"list_max([j FOR j IN range(0, {at} + 1) IF j = 0 OR NOT substr(md5(pos || ':' || j), 1, 8) < '{p}'])"


ORACLE = {
    "parse_strict": f"WITH {strict('eval_preds')} SELECT pos, ok, CASE WHEN ok THEN r END AS rt, CASE WHEN ok THEN k END AS sk, CASE WHEN ok THEN d END AS description, legal, fixed AS case_fixed, leak AS think_leak, n::BIGINT AS fields FROM strict",
    "parse_regex": rf"SELECT pos, nullif(regexp_extract(output, '^{_W}([A-E]){_W}\|{_W}([a-u]){_W}\|', 1), '') AS rt, nullif(regexp_extract(output, '^{_W}([A-E]){_W}\|{_W}([a-u]){_W}\|', 2), '') AS sk FROM eval_preds",
    "parse_loose2": f"SELECT pos, CASE WHEN len(s) >= 2 THEN {strip('s[1]')} END AS rt, CASE WHEN len(s) >= 2 THEN {strip('s[2]')} END AS sk FROM (SELECT pos, string_split(output, '|') AS s FROM eval_preds)",
    "parse_loose3": f"SELECT pos, CASE WHEN len(s) >= 3 THEN {strip('s[1]')} END AS rt, CASE WHEN len(s) >= 3 THEN {strip('s[2]')} END AS sk, CASE WHEN len(s) >= 3 THEN {strip("array_to_string(s[3:], '|')")} END AS description FROM (SELECT pos, string_split(output, '|') AS s FROM eval_preds)",
    "gt_split3": f"SELECT pos, coalesce(len(s) >= 3, false) AS ok, CASE WHEN len(s) >= 3 THEN {strip('s[1]')} END AS rt, CASE WHEN len(s) >= 3 THEN {strip('s[2]')} END AS sk, CASE WHEN len(s) >= 3 THEN {strip("array_to_string(s[3:], '|')")} END AS description FROM (SELECT pos, string_split(output, '|') AS s FROM eval_preds)",
    "legality": f"SELECT pos, NOT coalesce({_BAD}, false) AS legal FROM labels",
    "guard_action": f"WITH {strict('eval_preds')} SELECT pos, CASE WHEN NOT ok THEN 'reject' WHEN leak THEN 'flag_low_confidence' WHEN NOT legal THEN CASE WHEN k IN ({letters(vocab.SAFETY_GUARDED)}) THEN 'escalate_to_C_alert' ELSE 'flag_low_confidence' END ELSE 'accept' END AS action FROM strict",
    "legalize": f"SELECT pos, {strip(f"CASE WHEN len(s) >= 3 THEN array_to_string(list_concat([CASE WHEN {strip('s[1]')} = 'A' AND {strip('s[2]')} IN ('n', 'u') THEN 'C' ELSE {strip('s[1]')} END, {strip('s[2]')}], s[3:]), '|') ELSE output END")} AS output FROM (SELECT pos, output, string_split(output, '|') AS s FROM eval_preds)",
    "parent_group": f"SELECT pos, {group('labels.sub_keyscene', "'?'")} AS ks FROM labels",
    "vocab_index": " UNION ALL ".join(f"SELECT pos, '{h}' AS head, {_index(h, f'gemini_output.attributes.{h}')} AS idx FROM gemini_pass2" for h in vocab.ATTRIBUTES),
    "view_type": f"SELECT pos, {_VIEW.format('NULL')} AS view_type FROM labels",
    "aux_vector": f"""WITH rec AS (SELECT video_id, gemini_output.attributes AS a, CASE WHEN len({_ERRORS}) = 0 THEN 1.0 ELSE 0.3 END AS confidence FROM gemini_pass2 WHERE video_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1),
both_ AS (SELECT l.pos, l.resolution, r.a, r.confidence FROM labels l LEFT JOIN rec r ON l.video_id = r.video_id)
SELECT pos, {', '.join(f"CASE WHEN coalesce(confidence >= 0.5, false) THEN {_index(h, '(' + _VIEW.format('a.view_type') + ')' if h == 'view_type' else f'a.{h}')} ELSE {vocab.IGNORED} END::BIGINT AS {h}" for h in vocab.ATTRIBUTES)} FROM both_""",
    "serial_extract": "SELECT pos, coalesce(nullif(regexp_extract(string_split(video_id, '/')[-1], '(T8[A-Za-z0-9]{6,})', 1), ''), 'unknown') AS device, coalesce(nullif(nullif(meta['camera_id'], ''), 'unknown'), video_id) AS group_key FROM labels",
    "shard_paths": "SELECT pos, CASE WHEN meta['storage'] = 'wds' AND try_cast(meta['shard'] AS BIGINT) IS NOT NULL THEN coalesce(meta['wds_dir'], 'wds') || '/shard-' || lpad(try_cast(meta['shard'] AS BIGINT)::VARCHAR, 6, '0') || '.tar' END AS path, replace(video_id, '/', '__') || '.json' AS member FROM labels",
    "build_target": f"SELECT pos, {_TEXT} AS text, 4::BIGINT AS end_at, 4.0::DOUBLE AS weight FROM labels WHERE {_VALID}",
    "cot_target": f"""WITH c AS (SELECT video_id, reasoning_chain FROM asset_c_reasoning WHERE video_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY pos DESC) = 1),
t AS (SELECT l.pos, '<think>' || replace(replace({strip('c.reasoning_chain')}, '<think>', ''), '</think>', '') || '</think>' || chr(10) AS p, {_TEXT.replace('labels.', 'l.labels.')} AS a FROM labels l JOIN c ON l.video_id = c.video_id WHERE c.reasoning_chain IS NOT NULL AND {_VALID.replace('labels.', 'l.labels.')})
SELECT pos, p || a AS text, length(p) AS prefix_end, length(p) + 4 AS letters_end FROM t""",
    "token_weights": f"WITH t AS (SELECT pos, length({_TEXT}) AS n FROM labels WHERE {_VALID}) SELECT pos, {_join('[list_max([CASE WHEN p < 4 THEN 4 ELSE 1 END FOR p IN range(s, least(s + 3, n))]) FOR s IN range(0, n, 3)]')} AS by_span, {_join('[CASE WHEN s < 4 THEN 4 ELSE 1 END FOR s IN range(0, n, 3)]')} AS by_prefix FROM t",
    "char_ratio": f"WITH r AS (SELECT pos, CASE WHEN length(coalesce(reasoning_chain, '')) = 0 THEN 0.0 ELSE {_CJK.format('reasoning_chain')}::DOUBLE / length(reasoning_chain) END AS r FROM asset_c_reasoning) SELECT pos, round(r, 6)::DOUBLE AS ratio, r > 0.10 AS due FROM r",
    "tag_normalize": "SELECT pos, " + "replace(" * len(vocab.TAGS) + "reasoning_chain" + "".join(f", '{a}', '{b}')" for a, b in vocab.TAGS.items()) + " AS chain FROM asset_c_reasoning",
    "chain_text": f"SELECT pos, coalesce(nullif({_G}.reasoning_chain, ''), nullif({_G}.reasoning_chain_zh, ''), '') AS chain FROM gemini_pass2",
    "reasoning_text": "SELECT pos, " + " || ' ' || ".join(f"'{tag} ' || {strip(f"coalesce({_G}.{c}, '')")}" for tag, c in zip(vocab.TAGS.values(), ("attributes.clothing", "attributes.action", "predictions.description"), strict=True)) + " AS text FROM gemini_pass2",
    "validate_errors": f"SELECT pos, array_to_string({_ERRORS}, ',') AS errors FROM gemini_pass2",
    "validate_rationale": f"""WITH v AS (SELECT pos, CASE WHEN {_G}.predictions.role_type IN ({letters(vocab.ROLES)}) THEN 'supported' WHEN {_G}.predictions.role_type = '' THEN 'unsupported' END AS v, {_G}.attributes.posture AS p, {_G}.attributes.action AS a, {_G}.reasoning_chain AS c, len({words(_G + '.reasoning_chain')}) AS n FROM gemini_pass2)
SELECT pos, array_to_string(list_filter([CASE WHEN v IS NULL THEN 'verdict' END, CASE WHEN p IS NULL AND a IS NULL THEN 'evidence' END, CASE WHEN v = 'supported' AND NOT n BETWEEN 15 AND 60 THEN 'chain:' || n END, CASE WHEN v = 'supported' AND {_MOSTLY.format('c')} THEN 'reasoning_chain' END], lambda x: x IS NOT NULL), ',') AS errors FROM v""",
    "roundtrip": f"WITH {strict('eval_preds')} SELECT pos, CASE WHEN NOT ok OR fixed THEN 'rejected' WHEN r || '|' || k || '|' || d = output THEN 'same' ELSE 'mismatch' END AS status FROM strict",
    "fallback_output": "SELECT pos, coalesce(nullif(output, ''), 'None | None | ') AS output FROM eval_preds",
    "display": f"SELECT pos, {_SHOWN} coalesce(labels.description, 'None') AS text FROM labels",
    "prompts": f"SELECT pos, 'Label ' || {_SHOWN} '-' || '. Choose {'; '.join(f'{k}: {"/".join(v)}' for k, v in vocab.ATTRIBUTES.items())}.' AS prompt FROM labels WHERE {_VALID}",
    "uniform_indices": f"WITH {_CLIPS} SELECT pos, {_join(_EVEN.format(n='n'))} AS frames FROM clips",
    "ffill_dropout": f"WITH {_CLIPS} SELECT pos, {_join(f'[{_kept("40000000", "i")} FOR i IN range(16)]')} AS frames FROM clips",
    "augmented_plan": f"""WITH {_CLIPS}, u AS (SELECT pos, n, ('0x' || substr(md5('ratio:' || pos), 1, 7))::BIGINT / 268435456.0::DOUBLE AS a, ('0x' || substr(md5('place:' || pos), 1, 7))::BIGINT / 268435456.0::DOUBLE AS b FROM clips),
l AS (SELECT pos, n, b, greatest(1, round_even(n * (0.5::DOUBLE + 0.4::DOUBLE * a), 0)::INT) AS len_ FROM u), w AS (SELECT pos, least(floor(b * (n - len_ + 1))::INT, n - len_) AS f, len_ FROM l),
e AS (SELECT pos, f, len_, {_EVEN.format(n='len_')} AS e FROM w)
SELECT pos, f::BIGINT AS start_at, (f + len_)::BIGINT AS end_at, {_join(f'[e[{_kept("19999999", "i")} + 1] + f FOR i IN range(16)]')} AS frames FROM e""",
    "islands": f"""WITH m AS (SELECT pos, [length(w) > 4 FOR w IN {words('labels.description')}] AS m FROM labels),
se AS (SELECT pos, [i FOR i IN range(len(m)) IF m[i + 1] AND (i = 0 OR NOT m[greatest(i, 1)])] AS s, [i + 1 FOR i IN range(len(m)) IF m[i + 1] AND (i = len(m) - 1 OR NOT m[least(i + 2, len(m))])] AS e FROM m)
SELECT pos, array_to_string([s[k] || ':' || (e[k] - s[k]) FOR k IN range(1, len(s) + 1)], ',') AS runs FROM se""",
    "pad_fixed": f"WITH w AS (SELECT pos, [CASE WHEN length(w) = 2 THEN -1 ELSE length(w) END FOR w IN {words('labels.description')}] AS v FROM labels) SELECT pos, {_join('[coalesce(v[i], 0) FOR i IN range(1, 25)]')} AS lengths FROM w",
    "cot_mode": f"WITH c AS (SELECT DISTINCT video_id FROM asset_c_reasoning WHERE video_id IS NOT NULL AND coalesce(reasoning_chain, '') <> '') SELECT l.pos, coalesce({split("l.meta['source_split']")} = 'train' AND c.video_id IS NOT NULL AND substr(md5('cot:' || l.pos), 1, 8) < '99999999', false) AS with_chain FROM labels l LEFT JOIN c ON l.video_id = c.video_id",
    "meta_renamed": "SELECT pos, replace(e.key, 'camera_', 'device_') AS key, CASE WHEN starts_with(e.key, 'camera_') THEN 'camera' ELSE 'other' END AS part, e.value AS value FROM (SELECT pos, unnest(map_entries(meta)) AS e FROM labels)",
    "unmarked": "SELECT doc_id FROM documents WHERE NOT coalesce(contains(text, 'https://') OR contains(text, '@'), false)",
    "constrained_pick": "SELECT vec_id, (list_position(embedding[1:5], list_max(embedding[1:5])) - 1)::BIGINT AS step0, 26::BIGINT AS step1, (list_position(embedding[6:26], list_max(embedding[6:26])) + 4)::BIGINT AS step2, 26::BIGINT AS step3, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS step4 FROM embeddings",
}
