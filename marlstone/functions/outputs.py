"""Delimited outputs ``role|scene|description``: five parsers that differ on purpose, legality, targets and their weights.

The parsers answer differently for one text and mustn't be unified: a strict one by position that corrects case, one by
pattern, two loose ones, and one for stored labels.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marlstone import vocab
from marlstone.functions.texts import stripped

_W = f"[{vocab.WHITE}]*"


def after_thinking(c: Column) -> Column:
    """What follows the last closing think tag; the whole text without one."""
    return F.substring_index(c, "</think>", -1)


def is_role(c: Column) -> Column:
    return F.coalesce(c.isin(*vocab.ROLES), F.lit(False))


def is_scene(c: Column) -> Column:
    return F.coalesce(c.isin(*vocab.SCENES), F.lit(False))


def is_legal(rt: Column, sk: Column, illegal: dict[str, str] = vocab.ILLEGAL) -> Column:
    """Whether a role and a scene may go together; unknown and null letters may."""
    bad = F.lit(False)
    for r, scenes in illegal.items():
        bad = bad | ((rt == r) & sk.isin(*scenes))
    return ~F.coalesce(bad, F.lit(False))


def strict(output: Column) -> Column:
    """ok, rt, sk, description, legal, case_fixed, think_leak, fields of an output by position.

    Text after the last closing think tag counts; a tag is a leak even without an end. Three fields at least, further
    pipes belong to the description; letters are cut, and a single one gets its case. case_fixed is set before the
    letters are checked, so a failed output may have it. Letters and description are null where the output isn't ok;
    a null output has no field.
    """
    parts = F.split(stripped(after_thinking(output)), "[|]", -1)
    n = F.coalesce(F.size(parts), F.lit(0))
    a, b = (stripped(F.get(parts, F.lit(k))) for k in (0, 1))
    rt = F.when(F.length(a) == 1, F.upper(a)).otherwise(a)
    sk = F.when(F.length(b) == 1, F.lower(b)).otherwise(b)
    rest = stripped(F.array_join(F.transform(F.slice(parts, 3, F.greatest(n - 2, F.lit(0))), stripped), "|"))
    full = (n >= 3) & output.isNotNull()
    ok = full & is_role(rt) & is_scene(sk)
    return F.struct(
        ok.alias("ok"),
        F.when(ok, rt).alias("rt"),
        F.when(ok, sk).alias("sk"),
        F.when(ok, rest).alias("description"),
        (~ok | is_legal(rt, sk)).alias("legal"),
        (full & ((rt != a) | (sk != b))).alias("case_fixed"),
        F.coalesce(F.contains(output, F.lit("<think>")) | F.contains(output, F.lit("</think>")), F.lit(False)).alias("think_leak"),
        F.when(output.isNull(), F.lit(0)).otherwise(n).alias("fields"),
    )


def by_pattern(output: Column) -> Column:
    """rt, sk of an output that begins with both letters in their case, each with a pipe behind it; else nulls."""
    p = rf"^{_W}([A-E]){_W}\|{_W}([a-u]){_W}\|"
    return F.struct(*[F.nullif(F.regexp_extract(output, p, k), F.lit("")).alias(n) for k, n in ((1, "rt"), (2, "sk"))])


def loose(output: Column, least: int = 2) -> Column:
    """rt, sk as they stand, cut, of an output with at least ``least`` fields (2 or 3); else nulls. Nothing is checked."""
    parts = F.split(output, "[|]", -1)
    got = lambda k: F.when(F.size(parts) >= least, stripped(F.get(parts, F.lit(k))))
    return F.struct(got(0).alias("rt"), got(1).alias("sk"), F.when(F.size(parts) >= 3, stripped(F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))), "|"))).alias("description"))


def stored_label(value: Column) -> Column:
    """rt, sk, description of a stored label, cut at its first two pipes; null where it has fewer."""
    parts = F.split(value, "[|]", 3)
    return F.when(F.size(parts) == 3, F.struct(*[stripped(F.get(parts, F.lit(k))).alias(n) for k, n in enumerate(("rt", "sk", "description"))]))


def guard(parsed: Column) -> Column:
    """The disposition of a strict() result: reject, then a leak, then an illegal pair (escalated on a guarded scene), else accept."""
    illegal = F.when(parsed["sk"].isin(*vocab.SAFETY_GUARDED), "escalate_to_C_alert").otherwise("flag_low_confidence")
    return F.when(~parsed["ok"], "reject").when(parsed["think_leak"], "flag_low_confidence").when(~parsed["legal"], illegal).otherwise("accept")


def legalised(output: Column) -> Column:
    """An output with at least two pipes: letters cut, and role A with scene n or u made C; others as they are. Cut at both ends."""
    parts = F.split(output, "[|]", -1)
    rt, sk = stripped(F.get(parts, F.lit(0))), stripped(F.get(parts, F.lit(1)))
    role = F.when((rt == "A") & sk.isin("n", "u"), "C").otherwise(rt)
    mended = F.array_join(F.concat(F.array(role, sk), F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))), "|")
    return stripped(F.when(F.size(parts) >= 3, mended).otherwise(output))


def group_of(sk: Column, unknown: str | None = None) -> Column:
    """The parent group of a scene; ``unknown`` (null by default) for other and null letters."""
    out = None
    for g, letters in vocab.GROUPS.items():
        hit = sk.isin(*letters)
        out = F.when(hit, g) if out is None else out.when(hit, g)
    return out.otherwise(F.lit(unknown).cast("string"))


def value_index(head: str, value: Column) -> Column:
    """The place of a value in an attribute's vocabulary, from 0; IGNORED for others and null."""
    at = F.array_position(F.array(*[F.lit(v) for v in vocab.ATTRIBUTES.get(head, [""])]), value)
    return F.when(F.coalesce(at, F.lit(0)) > 0, at - 1).otherwise(F.lit(vocab.IGNORED)).cast("int")


def view_type(resolution: Column, given: Column) -> Column:
    """The view that a resolution "WxH" implies (1600x2200, or about 16:9), else the one ``given``."""
    part = F.split(resolution, "x", -1)
    w, h = (F.get(part, F.lit(k)).try_cast("bigint") for k in (0, 1))
    wide = F.abs(F.try_divide(w.cast("double"), h.cast("double")) - 16 / 9) < 0.05
    return F.when((w == 1600) & (h == 2200), "doorbell").when(F.coalesce(wide, F.lit(False)), "non_doorbell").otherwise(given)


def shown(rt: Column, sk: Column, description: Column) -> Column:
    """A label with the names of its letters, ? for unknown ones."""
    name = lambda c, names: F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[c], F.lit("?"))
    return F.format_string("%s|%s  [%s / %s]  desc: %s", F.coalesce(rt, F.lit("None")), F.coalesce(sk, F.lit("None")), name(rt, vocab.ROLE_NAMES), name(sk, vocab.SCENE_NAMES), F.coalesce(description, F.lit("None")))


def rebuilt(rt: Column, sk: Column, description: Column) -> Column:
    """An output in place of one that is missing, with the names that missing parts have there."""
    return F.concat_ws(" | ", F.coalesce(rt, F.lit("None")), F.coalesce(sk, F.lit("None")), F.coalesce(description, F.lit("")))


_SPAN = "array<struct<start:int,end:int,weight:double>>"


def target(rt: Column, sk: Column, description: Column, sep: str = "|", weight: float = 4.0) -> Column:
    """text and spans (start, end, weight) of a training target; null for invalid letters (``checked`` raises instead)."""
    text = F.concat(rt, F.lit(sep), sk, F.lit(sep), stripped(F.coalesce(description, F.lit(""))))
    spans = F.array(F.struct(F.lit(0).alias("start"), F.lit(2 + 2 * len(sep)).alias("end"), F.lit(float(weight)).alias("weight"))).cast(_SPAN)
    return F.when(is_role(rt) & is_scene(sk), F.struct(text.alias("text"), spans.alias("spans")))


def checked(built: Column) -> Column:
    """``built``, or an error where it is null because of an invalid letter."""
    return F.when(built.isNull(), F.raise_error(F.lit("invalid letter"))).otherwise(built)


def thinking_target(built: Column, reasoning: Column, opening: str = "<think>", closing: str = "</think>") -> Column:
    """A target behind its reasoning (without tags of its own): the prefix has weight 0, the spans move by its length."""
    clean = F.replace(F.replace(stripped(F.coalesce(reasoning, F.lit(""))), F.lit(opening), F.lit("")), F.lit(closing), F.lit(""))
    prefix = F.concat(F.lit(opening), clean, F.lit(closing + "\n"))
    n = F.length(prefix)
    first = F.array(F.struct(F.lit(0).alias("start"), n.alias("end"), F.lit(0.0).alias("weight"))).cast(_SPAN)
    moved = F.transform(built["spans"], lambda s: F.struct((s["start"] + n).alias("start"), (s["end"] + n).alias("end"), s["weight"].alias("weight")))
    return F.when(built.isNotNull(), F.struct(F.concat(prefix, built["text"]).alias("text"), F.concat(first, moved).alias("spans")))


def weight_at(spans: Column, at: Column) -> Column:
    """The weight at a character: of the first span that covers it, else 1."""
    return F.coalesce(F.get(F.filter(spans, lambda s: (s["start"] <= at) & (at < s["end"])), F.lit(0))["weight"], F.lit(1.0))


def token_weights(spans: Column, offsets: Column) -> Column:
    """Of each token (start, end) the greatest weight of its characters; 0 for an empty one.

    The first span that covers a character decides; what decides changes only where a span begins or ends, so only a
    token's first character and such places within it are looked at, and none of them where no span meets the token.
    """
    within = lambda t, p: (p >= t["start"]) & (p < t["end"])
    places = lambda t: F.concat(F.array(t["start"]), F.filter(F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["end"]))), lambda p: within(t, p)))
    met = lambda t: F.exists(spans, lambda s: (s["start"] < t["end"]) & (s["end"] > t["start"]))
    return F.transform(offsets, lambda t: F.when(t["end"] <= t["start"], 0.0).when(~met(t), 1.0).otherwise(F.array_max(F.transform(places(t), lambda p: weight_at(spans, p)))))


def prefix_weights(lengths: Column, prefix: int, weight: float = 4.0) -> Column:
    """Of each token the weight, if it starts before character ``prefix``, else 1; ``lengths`` are the tokens' lengths. Starts never fall, so these are the first tokens."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("k"))
    step = lambda acc, n: F.struct((acc["at"] + n).cast("int").alias("at"), (acc["k"] + F.when(acc["at"] < prefix, 1).otherwise(0)).alias("k"))
    k = F.aggregate(lengths, zero, step, lambda acc: acc["k"])
    return F.concat(F.array_repeat(F.lit(float(weight)), k), F.array_repeat(F.lit(1.0), F.size(lengths) - k))
