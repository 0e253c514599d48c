"""Samples with given category shares: calibration by exponential tilting, drawing by the pivotal method.

The records' cells (combinations of categories, a bounded vocabulary) are counted once; these counts are all moments
that the dual of the calibration needs, so its Newton iterations touch no record. Every record of a cell then has the
cell's probability, and pivotal duels make a sample of fixed size: within parts of a cell, then between what the
parts, and at last the cells, have left over. No task or driver gets more than a bounded part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.stages import stage, strip_blanks

#: Records of a part that one task draws from, and Newton iterations at most.
PART, ITERATIONS = 100_000, 200
#: Share of a goal, and records, by which a draw may be off before it counts as missed.
MISSED, MISSED_ROWS = 0.01, 2
#: Weight of the ridge that keeps the dual finite where targets contradict each other.
RIDGE = 1e-6


def usable_records(labels: DataFrame) -> DataFrame:
    """video_id, rt, sk: of each non-null video the row with the greatest pos, with its letters where they are valid.

    Blanks of any kind around a letter are cut and its case is corrected; an invalid letter is null, and no older row
    replaces it.
    """
    rt = F.upper(strip_blanks(F.col("labels.role_type")))
    sk = F.lower(strip_blanks(F.col("labels.sub_keyscene")))
    rows = labels.filter("video_id is not null").select("video_id", "pos", F.when(rt.rlike("^[A-E]$"), rt).alias("rt"), F.when(sk.rlike("^[a-u]$"), sk).alias("sk"))
    last = rows.groupBy("video_id").agg(F.max_by(F.struct("rt", "sk"), F.struct(F.col("pos").isNotNull(), "pos", "rt", "sk")).alias("r"))
    return last.select("video_id", "r.rt", "r.sk")


def axis_targets(have: dict[str, int], shares: dict[str, float], floors: dict[str, int], size: float) -> dict[str, float]:
    """Wanted counts of an axis: shares of ``size``, at least the floor, at most what there is; what some letters lack goes to the others by share."""
    low = {k: min(have.get(k, 0), floors[k]) for k in shares}
    fixed: dict[str, float] = {}
    while True:
        free = [k for k in shares if k not in fixed]
        scale = max(0.0, size - sum(fixed.values())) / (sum(shares[k] for k in free) or 1.0)
        over = {k: float(have.get(k, 0)) for k in free if shares[k] * scale > have.get(k, 0)}
        under = {k: float(low[k]) for k in free if shares[k] * scale < low[k]}
        if not (over or under):
            return fixed | {k: shares[k] * scale for k in free}
        fixed |= over or under


def calibrate(counts: np.ndarray, design: np.ndarray, target: np.ndarray, rate: float) -> np.ndarray:
    """Inclusion probability of each cell: min(1, rate * exp(design @ dual)), its sums over the design near ``target``.

    Newton steps with halving on the convex dual of exponential tilting, probabilities capped at 1.
    """
    dual = np.zeros(design.shape[1])
    scale = max(1.0, counts.sum())
    start = np.log(max(rate, 1e-12))

    def at(d: np.ndarray) -> tuple[float, np.ndarray]:
        u = np.clip(design @ d + start, -700, 700)
        p = np.exp(np.minimum(u, 0))
        return float((counts * np.where(u > 0, 1 + u, p)).sum() - target @ d) + RIDGE * scale / 2 * float(d @ d), p

    value, p = at(dual)
    for _ in range(ITERATIONS):
        slope = design.T @ (counts * p) - target + RIDGE * scale * dual
        if np.abs(slope).max() <= 1e-9 * scale:
            break
        bend = (design.T * (counts * np.where(p < 1, p, 0))) @ design + RIDGE * scale * np.eye(len(dual))
        step, length = np.linalg.solve(bend, slope), 1.0
        while length > 1e-6:
            new, q = at(dual - length * step)
            if new <= value - 1e-4 * length * float(step @ slope):
                break
            length /= 2
        else:
            break
        dual, value, p = dual - length * step, new, q
    return p


def duels(p: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Probabilities after pivotal duels in order: all 0 or 1 but perhaps the last one that was open."""
    out = p.astype(float).copy()
    open_ = np.flatnonzero((out > 1e-9) & (out < 1 - 1e-9))
    if not len(open_):
        return np.round(out)
    out[(p <= 1e-9)], out[(p >= 1 - 1e-9)] = 0, 1
    champion, x = int(open_[0]), float(out[open_[0]])
    for i, u in zip(open_[1:].tolist(), draws[open_[1:]].tolist(), strict=True):
        y = float(p[i])
        if not 1e-9 < x < 1 - 1e-9:
            out[champion] = round(x)
            champion, x = i, y
        elif x + y <= 1:
            loser, champion = (i, champion) if u * (x + y) < x else (champion, i)
            out[loser], x = 0.0, x + y
        else:
            winner, champion = (champion, i) if u * (2 - x - y) < 1 - y else (i, champion)
            out[winner], x = 1.0, x + y - 1
    out[champion] = x if 1e-9 < x < 1 - 1e-9 else round(x)
    return out


def _draw(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["cell", "h", "id"], kind="stable").reset_index(drop=True)
    draws = (pdf["h"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)).astype(float) / 2.0**53
    return pdf.assign(p=duels(pdf["p"].to_numpy(), draws))


def pivotal(units: DataFrame, n: int, seed: int) -> DataFrame:
    """id, cell, chosen of ``units`` (unique id, cell, p): a fixed-size sample with probabilities p.

    Parts of at most about PART records are drawn separately. Each leaves one open record at most, with the rest of
    its probability; these are drawn again in larger areas, cells kept apart as long as possible.
    """
    schema = "id string, cell int, p double, h long, area long"
    rows = units.select("id", "cell", "p", F.xxhash64("id", F.lit(seed)).alias("h"))
    parts, done, cells_apart = max(1, -(-n // PART)), None, True
    while True:
        area = F.xxhash64("cell", F.pmod("h", F.lit(parts))) if cells_apart else F.pmod("h", F.lit(parts)).cast("long")
        drawn = stage(rows.withColumn("area", area).groupBy("area").applyInPandas(_draw, schema))
        closed = drawn.filter("p in (0.0, 1.0)").select("id", "cell", (F.col("p") == 1.0).alias("chosen"))
        done = closed if done is None else done.union(closed)
        rows = drawn.filter("p not in (0.0, 1.0)").select("id", "cell", "p", F.xxhash64("id", F.lit(seed), F.lit(parts)).alias("h"))
        if parts == 1 and not cells_apart:
            # one record at most is open; it is chosen with the probability it has
            return done.union(rows.select("id", "cell", (F.pmod("h", F.lit(1 << 30)) < F.col("p") * (1 << 30)).alias("chosen")))
        cells_apart = cells_apart and parts > 1
        parts = max(1, parts // PART)


def matching_sample(records: DataFrame, axes: dict[str, str], targets: DataFrame, fraction: float = 0.2, id_: str = "video_id", seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """(sample, report) of records with a unique ``id_`` and a letter column per axis (null: not usable on it).

    ``targets`` has axis, letter, p and min_n, a bounded table. A record usable on some axis may be drawn. The size
    of an axis is ``fraction`` of its usable records. sample: the records drawn, with ``probability``. report: axis,
    letter, p, min_n, usable, wanted (p times the size), goal (what remains to be wanted once minimums are kept and
    what short letters lack is given to the others), drawn, gap (drawn less goal), short (too few usable records for
    the share or the minimum), missed (drawn is off its goal by more than MISSED of it and more than MISSED_ROWS:
    the axes contradict each other). Null p counts as 0, null min_n as 0; letters without target aren't drawn on purpose; where a draw
    leaves a letter under its floor by rounding, the missing records are added. An empty table gives an empty sample.
    """
    names = list(axes.values())
    records = stage(records.select(F.col(id_), *names).filter(F.coalesce(*names).isNotNull()))
    cells = [r.asDict() for r in records.groupBy(*names).count().collect()]  # at most the product of the vocabularies
    rows = targets.filter("axis is not null and letter is not null").groupBy("axis", "letter").agg(F.coalesce(F.max("p"), F.lit(0.0)).alias("p"), F.coalesce(F.max("min_n"), F.lit(0)).alias("min_n")).collect()
    counts = np.array([c["count"] for c in cells], float)
    have = {(a, c[col]): 0 for a, col in axes.items() for c in cells}
    for a, col in axes.items():
        for c in cells:
            have[a, c[col]] += c["count"]
    keys, want = [], []
    for a in axes:
        mine = [r for r in rows if r.axis == a]
        size = fraction * sum(n for (b, k), n in have.items() if b == a and k is not None)
        goal = axis_targets({k: n for (b, k), n in have.items() if b == a}, {r.letter: r.p for r in mine}, {r.letter: r.min_n for r in mine}, size)
        keys += [(a, k) for k in goal]
        want += list(goal.values())
    design = np.array([[float(c[axes[a]] == k) for a, k in keys] for c in cells]).reshape(len(cells), len(keys))
    p = calibrate(counts, design, np.array(want), fraction) if len(cells) else counts
    p = np.where(design.sum(axis=1) > 0, p, 0.0) if len(cells) else p
    spark = records.sparkSession
    table = pd.DataFrame({**{n: pd.Series([c[n] for c in cells], dtype=object) for n in names}, "cell": np.arange(len(cells)), "p": p})
    dim = spark.createDataFrame(table, ", ".join([*(f"{n} string" for n in names), "cell int", "p double"]))
    same = [F.col(f"r.{n}").eqNullSafe(F.col(f"d.{n}")) for n in names]
    units = records.alias("r").join(F.broadcast(dim.alias("d")), same).select(F.col(f"r.{id_}").cast("string").alias("id"), "cell", "p")
    chosen = stage(pivotal(units, int(counts.sum()), seed).filter("chosen").select("id", "cell"))
    drawn = np.zeros(len(cells))
    for r in chosen.groupBy("cell").count().collect():
        drawn[r["cell"]] = r["count"]
    for (a, k), goal in zip(keys, want, strict=True):  # floors that rounding broke: at most one record a cell
        floor = next(r.min_n for r in rows if (r.axis, r.letter) == (a, k))
        own = [i for i, c in enumerate(cells) if c[axes[a]] == k]
        gap = int(min(floor, have.get((a, k), 0)) - sum(drawn[i] for i in own))
        if gap > 0:
            spare = units.filter(F.col("cell").isin(own)).join(chosen, "id", "left_anti").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(gap)
            more = stage(spare.select("id", "cell"))
            for r in more.groupBy("cell").count().collect():
                drawn[r["cell"]] += r["count"]
            chosen = chosen.union(more)
    sample = chosen.join(F.broadcast(dim.select("cell", "p", *names)), "cell").select(F.col("id").alias(id_), *names, F.col("p").alias("probability"))
    goals = dict(zip(keys, want, strict=True))
    sizes = {a: fraction * sum(n for (b, k), n in have.items() if b == a and k is not None) for a in axes}
    out = []
    for r in rows:
        if r.axis in axes:
            n = have.get((r.axis, r.letter), 0)
            got = sum(drawn[i] for i, c in enumerate(cells) if c[axes[r.axis]] == r.letter)
            goal = goals[r.axis, r.letter]
            short = n < r.p * sizes[r.axis] - 1e-6 or n < r.min_n
            missed = abs(got - goal) > max(MISSED_ROWS, MISSED * goal)
            out.append((r.axis, r.letter, float(r.p), int(r.min_n), int(n), float(r.p * sizes[r.axis]), float(goal), int(got), float(got - goal), bool(short), bool(missed)))
    report = spark.createDataFrame(out, "axis string, letter string, p double, min_n int, usable long, wanted double, goal double, drawn long, gap double, short boolean, missed boolean")
    return sample, report
