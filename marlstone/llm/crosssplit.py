"""Records that stand, the same or nearly so, in the training split and in an evaluation split.

Each record gives up to three normalised passages: its video id, the recording that its file name states, and its
description. Passages are sharded by hash: of the id, the recording, or camera and time slot; passages that no record
of the other side can share a shard with are left out first. A shard builds one Aho-Corasick automaton over all its
evaluation passages (a description as MOST_EDITS + 1 pieces, of which an edited copy keeps at least one) and scans all
its training texts; an id or recording counts where the automaton matches the whole text. Matched intervals are merged into
the coverage of each evaluation record over all its training records, and near copies are confirmed by an exact word edit distance.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.identity import recording_of, serial_of, split_of
from marlstone.stages import stage, with_dim

#: Words that near copies may differ in, seconds that they may lie apart.
MOST_EDITS, SECONDS = 2, 2
#: Rows and pairs of a shard, and rows of a key on either side from which it is spread over several shards.
SHARD_ROWS, SHARD_PAIRS, HOT_ROWS = 5_000, 200_000, 500


def within_edits(a: list[str], b: list[str], most: int = MOST_EDITS) -> bool:
    """Whether ``a`` becomes ``b`` by at most ``most`` replaced, added or dropped words (a band of the edit table)."""
    if abs(len(a) - len(b)) > most:
        return False
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            c = [row[j] + 1] if j in row else []
            if j:
                c += [row[j - 1] + (x != b[j - 1])] if j - 1 in row else []
                c += [new[j - 1] + 1] if j - 1 in new else []
            new[j] = min(c) if c else most + 1
        if min(new.values()) > most:
            return False
        row = new
    return row.get(len(b), most + 1) <= most


def _pieces(words: str) -> list[tuple[int, str]]:
    """Begin and text of the pieces into which a normalised description is cut, none empty; fewer where words are few."""
    w = words.split(" ")
    n = min(MOST_EDITS + 1, len(w))
    cut = [round(i * len(w) / n) for i in range(n + 1)]
    return [(sum(map(len, w[:s])) + s, " " + " ".join(w[s:e]) + " ") for s, e in zip(cut, cut[1:], strict=False)]


def scan_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """kind, train, eval, coverage, spans, size, split and camera of the overlaps in one shard (columns kind, at, text, pos, us, split, cam, is_train)."""
    import ahocorasick

    trains, evals = rows[rows["is_train"]], rows[~rows["is_train"]]
    found: list[tuple[str, int, int, float, list[dict], int]] = []
    origin = {pos: (split, cam) for pos, split, cam in zip(evals["pos"], evals["split"], evals["cam"], strict=True)}
    automaton = ahocorasick.Automaton()
    patterns: dict[str, dict] = {}
    short: dict[tuple[str, str], list] = defaultdict(list)
    for kind, at, text, pos, us in zip(evals["kind"], evals["at"], evals["text"], evals["pos"], evals["us"], strict=True):
        if kind == "near" and len(text.split()) <= MOST_EDITS:  # no piece need survive in its near copies
            short[kind, at].append((text, pos, us))
            continue
        for begin, part in _pieces(text) if kind == "near" else [(0, f" {text} ")]:
            patterns.setdefault(part, defaultdict(list))[kind, at].append((begin, len(part), text, pos, us))
    for part, where in patterns.items():
        automaton.add_word(part, where)
    if patterns:
        automaton.make_automaton()
    for kind, at, text, pos, us in zip(trains["kind"], trains["at"], trains["text"], trains["pos"], trains["us"], strict=True):
        hits: dict[int, tuple[str, int, list]] = {other: (own, time, [(b, b + len(part)) for b, part in _pieces(own) if part in f" {text} "]) for own, other, time in short.get((kind, at), ())}
        for _, where in automaton.iter(f" {text} ") if patterns else ():
            for begin, size, own, other, time in where.get((kind, at), ()):
                if kind != "near" and size != len(text) + 2:  # an id within a longer one
                    continue
                hits.setdefault(other, (own, time, []))[2].append((begin, begin + size))
        words = text.split()
        for other, (own, time, spans) in hits.items():
            if kind == "near" and (abs(time - us) > SECONDS * 1_000_000 or not within_edits(own.split(), words)):
                continue
            merged: list[dict] = []
            for begin, end in sorted(spans):
                if merged and begin <= merged[-1]["e"]:
                    merged[-1]["e"] = max(end, merged[-1]["e"])
                else:
                    merged.append({"s": begin, "e": end})
            size = len(own) + 2
            found.append((kind, pos, other, min(1.0, sum(x["e"] - x["s"] for x in merged) / size), merged, size))
    cols = list(zip(*found, strict=True)) if found else [[], [], [], [], [], []]
    return pd.DataFrame({"kind": pd.Series(cols[0], dtype=object), "train": pd.Series(cols[1], dtype="int64"), "eval": pd.Series(cols[2], dtype="int64"), "coverage": pd.Series(cols[3], dtype="float64"), "spans": pd.Series(cols[4], dtype=object), "size": pd.Series(cols[5], dtype="int32"), "split": pd.Series([origin[x][0] for x in cols[2]], dtype=object), "camera": pd.Series([origin[x][1] for x in cols[2]], dtype=object)})


def cross_split_overlaps(records: DataFrame, key: str, split: Column, camera: Column, video: str, recorded: str, description: Column) -> DataFrame:
    """kind (video, recording or near), train, eval (keys), coverage, spans, size, split and camera of the evaluation record: each overlap of a training and an evaluation record.

    spans are the matched intervals of the evaluation record's passage of that kind, size is its length, coverage their share of it.
    A pair may come with several kinds. Null video ids, recordings, cameras, times and descriptions match nothing;
    descriptions without a word match one another. ``key`` must be a unique integer. No pair is capped or dropped.
    """
    cam = serial_of(camera, F.col(video))
    words = F.trim(F.regexp_replace(F.lower(description), r"(?U)[^\p{L}\p{M}\p{N}]+", " "))
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(recorded).cast("timestamp_ntz"))
    base = records.select(F.col(key).cast("long").alias("pos"), split_of(split).alias("split"), F.col(video).alias("video"), recording_of(F.col(video)).alias("recording"), cam.alias("cam"), us.alias("us"), words.alias("words")).filter("split is not null and pos is not null")
    span = SECONDS * 1_000_000
    slot = F.floor(F.col("us") / span)
    # a training record stands in its own slot, an evaluation record in its own and both neighbours
    near = F.when(F.col("split") == "train", F.array(slot)).otherwise(F.array(slot - 1, slot, slot + 1))
    zero = F.lit(0).cast("long")
    one = lambda kind, c: F.array(F.struct(F.lit(kind).alias("kind"), F.col(c).alias("at"), F.col(c).alias("text")))
    slots = F.transform(near, lambda s: F.struct(F.lit("near").alias("kind"), F.concat_ws("@", "cam", s.cast("string")).alias("at"), F.col("words").alias("text")))
    none = F.array().cast("array<struct<kind:string,at:string,text:string>>")
    passages = F.concat(
        F.when(F.col("video").isNotNull(), one("video", "video")).otherwise(none),
        F.when(F.col("recording").isNotNull(), one("recording", "recording")).otherwise(none),
        F.when(F.col("cam").isNotNull() & F.col("us").isNotNull() & F.col("words").isNotNull(), slots).otherwise(none),
    )
    flat = base.select("pos", "split", "cam", F.coalesce("us", zero).alias("us"), F.explode(passages).alias("p")).select("pos", "split", "cam", "us", "p.*")
    flat = flat.withColumn("is_train", F.col("split") == "train")
    keyed = stage(flat.withColumn("k", F.concat_ws(":", "kind", "at")))
    counts = keyed.groupBy("k").agg(F.count_if("is_train").alias("t"), F.count_if(~F.col("is_train")).alias("e"), F.count("*").alias("n"))
    both = stage(counts.filter("t > 0 and e > 0").select("k", F.ceil(F.col("t") / HOT_ROWS).alias("tb"), F.ceil(F.col("e") / HOT_ROWS).alias("eb"), (F.col("t") * F.col("e")).alias("pairs"), "n"))
    sums = both.agg(F.count("*").alias("keys"), F.sum("n").alias("n"), F.sum("pairs").alias("pairs")).first()
    shards = max(1, (sums.n or 0) // SHARD_ROWS, (sums.pairs or 0) // SHARD_PAIRS)
    # of a large key each block of evaluation rows meets each block of training rows, in a cell of its own
    placed = with_dim(keyed, both.drop("pairs"), "k", "n").filter("tb is not null")
    mine = F.pmod(F.xxhash64("pos"), F.when(F.col("is_train"), F.col("tb")).otherwise(F.col("eb")))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("is_train"), F.col("eb")).otherwise(F.col("tb")) - 1)
    placed = placed.withColumn("_m", mine).withColumn("_o", F.explode(others))
    cell = F.when(F.col("is_train"), F.concat_ws(".", "_m", "_o")).otherwise(F.concat_ws(".", "_o", "_m"))
    placed = placed.select("pos", "us", "kind", "at", "text", "split", "cam", "is_train", cell.alias("cell"), F.pmod(F.xxhash64("k", cell), F.lit(shards)).alias("shard"))
    # within a shard only the block, and for descriptions camera and slot, keep passages apart; the automaton does the rest
    placed = placed.withColumn("at", F.when(F.col("kind") == "near", F.concat_ws("#", "at", "cell")).otherwise(F.col("cell"))).drop("cell")
    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # shards are work, not bytes: they aren't to be merged into few tasks
    pairs = placed.repartition(min(shards, tasks), "shard").groupBy("shard").applyInPandas(scan_shard, "kind string, train long, eval long, coverage double, spans array<struct<s:int,e:int>>, size int, split string, camera string")
    return pairs.groupBy("kind", "train", "eval").agg(F.max("coverage").alias("coverage"), F.max("spans").alias("spans"), F.max("size").alias("size"), F.min("split").alias("split"), F.min("camera").alias("camera"))


def overlap_report(overlaps: DataFrame) -> DataFrame:
    """split, camera, kind, evals, pairs, coverage: evaluation records of a split and camera that overlap with training.

    coverage is the mean over evaluation records of the share that their spans, united over all training records, cover.
    """
    # of a passage, cut into at most MOST_EDITS + 1 pieces, only a few different lists of spans can come
    each = overlaps.groupBy("split", "camera", "kind", "eval").agg(F.count("*").alias("pairs"), F.collect_set("spans").alias("spans"), F.max("size").alias("size"))
    zero = F.struct(F.lit(0).alias("last"), F.lit(0).alias("n"))
    step = lambda a, x: F.struct(F.greatest(a["last"], x["e"]).alias("last"), (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["last"]))).alias("n"))
    united = F.aggregate(F.array_sort(F.flatten("spans")), zero, step, lambda a: a["n"])
    each = each.withColumn("coverage", F.least(F.lit(1.0), united / F.col("size")))
    return each.groupBy("split", "camera", "kind").agg(F.count("*").alias("evals"), F.sum("pairs").alias("pairs"), F.avg("coverage").alias("coverage"))


def overlap_pairs(overlaps: DataFrame) -> DataFrame:
    """pos_a, pos_b: each pair once, the smaller first."""
    return overlaps.select(F.least("train", "eval").alias("pos_a"), F.greatest("train", "eval").alias("pos_b")).distinct()
