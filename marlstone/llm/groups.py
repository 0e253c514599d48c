"""Splits that keep related records together: connected components by random-mate contraction, then whole groups.

Records with the same camera or the same video belong together. The cameras of a video that has several are first linked
in a star, so the graph has cameras as vertices only and no record's links are listed in full. In a round every vertex tosses a
coin (a hash of vertex and round); a tail with a head as neighbour joins the least such head; edges are rewritten
and deduplicated, until none is left. The rounds' moves, a forest, are then unwound by pointer doubling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.stages import bytes_of, counted, drop_stage, stage, with_dim

#: Rounds after which contraction gives up; each removes a quarter of the vertices with edges on average.
MOST_ROUNDS = 200
#: Buckets of the prefix sum over groups, and the share of all records from which a group is placed on its own.
BUCKETS, LARGE = 1024, 0.01


def components(edges: DataFrame) -> DataFrame:
    """v, root: for each vertex of ``edges`` (a, b) one vertex that stands for its component. Staged.

    Self-loops count as vertices without links; null ends are ignored. An empty table gives an empty one.
    """
    edges = edges.filter("a is not null and b is not null")
    left, (n,) = counted(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    vertices = stage(edges.select(F.explode(F.array("a", "b")).alias("v")).distinct())
    moves: list[DataFrame] = []
    for round_ in range(MOST_ROUNDS):
        if not n:
            break
        head = lambda c, r=round_: F.pmod(F.xxhash64(c, F.lit(r)), F.lit(2)) == 1
        both = left.union(left.select("b", "a")).filter(~head("a"))
        move = both.groupBy("a").agg(F.min(F.when(head("b"), F.col("b"))).alias("mate"), F.count("*").alias("edges")).filter("mate is not null")
        move, sizes = counted(move, bytes_of(move), F.coalesce(F.sum("edges"), F.lit(0).cast("long")))
        if not sizes[0]:
            drop_stage(move)
            continue
        moves.append(move)
        # a star's centre may stand in many edges: such keys are looked up without a shuffle
        side = lambda df, c, m=move, z=sizes: with_dim(df, m.select(F.col("a").alias(c), F.col("mate").alias(f"_{c}_to"), "edges"), c, "edges", sizes=z)
        new = side(side(left, "a"), "b")
        a, b = F.coalesce("_a_to", "a"), F.coalesce("_b_to", "b")
        before = left
        left, (n,) = counted(new.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b").distinct())
        drop_stage(before)
    else:
        if n:
            raise RuntimeError(f"edges are left after {MOST_ROUNDS} rounds")
    if not moves:
        return vertices.select("v", F.col("v").alias("root"))
    # a vertex moves once, to one that may move in a later round: a forest, unwound by doubling the way that each jump goes
    ends = moves[0].select(F.col("a").alias("v"), F.col("mate").alias("root"))
    for move in moves[1:]:
        ends = ends.union(move.select("a", "mate"))
    ends, depth = stage(ends), len(moves)
    drop_stage(*moves)
    while depth > 1:
        onward = ends.select(F.col("v").alias("_v"), F.col("root").alias("_root"))
        before, ends = ends, stage(ends.join(onward, F.col("root") == F.col("_v"), "left").select("v", F.coalesce("_root", "root").alias("root")))
        drop_stage(before)
        depth = -(-depth // 2)
    known = ends.select(F.col("v").alias("_v"), F.col("root").alias("_root"))
    return stage(vertices.join(known, F.col("v") == F.col("_v"), "left").select("v", F.coalesce("_root", "v").alias("root")))


def related_groups(records: DataFrame, key: str, camera: str, video: str) -> DataFrame:
    """``key``, group_id, n: the group of each record and its size.

    Records with the same non-null camera or the same non-null video are related, directly or through others. The
    group's id is the least of its cameras, or its video if it has none. A record with neither is alone: its group
    is null and n is 1. Repeated keys stay apart. No camera, video or group is gathered in one task.
    """
    rows = records.select(F.col(key).alias("_k"), F.col(camera).cast("string").alias("cam"), F.col(video).cast("string").alias("vid"))
    pairs = stage(rows.groupBy("vid", "cam").agg(F.count("*").alias("n")))
    # only videos of several cameras link them, and only videos of rows without camera need to know their camera
    several = pairs.filter("vid is not null").groupBy("vid").agg(F.min("cam").alias("least"), F.count("cam").alias("cams"), F.count("*").alias("places"))
    several = stage(several.filter("places > 1 and least is not null"))
    linked = with_dim(pairs.filter("cam is not null"), several.filter("cams > 1").drop("places"), "vid", "cams")
    roots = components(linked.filter("least is not null").select(F.col("least").alias("a"), F.col("cam").alias("b")))
    cams = pairs.filter("cam is not null").groupBy("cam").agg(F.sum("n").alias("n"))
    cams = stage(cams.join(roots.withColumnRenamed("v", "cam"), "cam", "left").select("cam", "n", F.coalesce("root", "cam").alias("root")))
    lone = with_dim(pairs.filter("cam is null and vid is not null").select("vid", "n"), several.select("vid", "least", "places"), "vid", "places")
    known = stage(with_dim(lone.withColumnRenamed("least", "cam"), cams, "cam", "n").select("vid", "n", "root"))
    # a place of rows: their camera, or their video; its group: the component of cameras, or the video alone
    placed = cams.select(F.concat(F.lit("c"), "cam").alias("at"), "n", F.concat(F.lit("c"), "root").alias("g"), "cam")
    lone = known.filter("root is not null or n > 1")  # a video of one row and no camera is a group of its own, as rows without an entry are
    placed = stage(placed.union(lone.select(F.concat(F.lit("v"), "vid"), "n", F.coalesce(F.concat(F.lit("c"), "root"), F.concat(F.lit("v"), "vid")), F.lit(None))))
    groups = stage(placed.groupBy("g").agg(F.coalesce(F.min("cam"), F.min(F.expr("substring(g, 2)"))).alias("group_id"), F.sum("n").alias("size"), F.count("*").alias("places")))
    dim = stage(with_dim(placed.select("at", "n", "g"), groups, "g", "places").filter("size > 1").select("at", "group_id", "size", "n"))
    drop_stage(pairs, several, cams, known, placed, groups)
    at = F.coalesce(F.concat(F.lit("c"), "cam"), F.concat(F.lit("v"), "vid"))
    out = with_dim(rows.select("_k", at.alias("at")), dim, "at", "n")
    return out.select(F.col("_k").alias(key), F.coalesce("group_id", F.expr("substring(at, 2)")).alias("group_id"), F.coalesce("size", F.lit(1)).alias("n"))


def group_splits(groups: DataFrame, group: str, size: str, shares: dict[str, float], seed: int = 7) -> DataFrame:
    """``group``, ``size``, split: whole groups in splits of the given shares of all records.

    ``groups`` has one row per group. Groups above LARGE of all records (fewer than 1/LARGE of them) are placed one by
    one, largest first, where the most room is left; the others follow in hash order by cumulative weight, over the
    room that remains. Shares need not sum to 1. A split can only be off by what the large groups force, plus one
    small group. An empty table gives an empty one.
    """
    names, total = list(shares), groups.agg(F.sum(size)).first()[0] or 0
    whole = sum(shares.values())
    room = {k: total * shares[k] / whole for k in names}
    large = groups.filter(F.col(size) > LARGE * total).select(group, size).collect()  # fewer than 1 / LARGE rows
    placed = []
    for r in sorted(large, key=lambda r: (-r[size], str(r[group]))):
        best = max(names, key=lambda k: room[k])
        room[best] -= r[size]
        placed.append((r[group], best))
    spare = {k: max(0.0, v) for k, v in room.items()}
    small = groups.filter(F.col(size) <= LARGE * total)
    h = F.xxhash64(F.col(group), F.lit(seed))
    small = small.withColumn("_h", h).withColumn("_b", F.pmod(F.shiftrightunsigned(F.col("_h"), 40), F.lit(BUCKETS)))
    sums = small.groupBy("_b").agg(F.sum(size).alias("w"))  # at most BUCKETS rows
    before = sums.select("_b", (F.sum("w").over(Window.orderBy("_b")) - F.col("w")).alias("_before"))
    within = Window.partitionBy("_b").orderBy("_h", group).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = small.join(F.broadcast(before), "_b").withColumn("_mid", F.col("_before") + F.sum(size).over(within) - F.col(size) / 2)
    scale = sum(spare.values()) or 1.0
    left = max(1, total - sum(r[size] for r in large))
    choice, edge = None, 0.0
    for k in names[:-1]:
        edge += spare[k] / scale * left
        choice = F.when(F.col("_mid") < edge, k) if choice is None else choice.when(F.col("_mid") < edge, k)
    small = at.select(group, size, (choice.otherwise(names[-1]) if choice is not None else F.lit(names[-1])).alias("split"))
    if not placed:
        return small
    fixed = groups.sparkSession.createDataFrame(placed, f"_g {groups.schema[group].dataType.simpleString()}, split string")
    return small.union(groups.join(F.broadcast(fixed), F.col(group) == F.col("_g")).select(group, size, "split"))
