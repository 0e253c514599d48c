"""Arrays and numbers by rows: frame plans, islands, padding, picks, priors, rewards and losses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_below(key: Column, p: float) -> Column:
    """True for about a share ``p`` of the keys, by their md5: the same in every run and partitioning; null keys give false."""
    if p >= 1:
        return key.isNotNull()
    return F.coalesce(F.substring(F.md5(key.cast("string")), 1, 8) < f"{int(max(0.0, p) * 2**32):08x}", F.lit(False))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, though a lambda within evaluates it for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def uniform_indices(n: Column, k: int) -> Column:
    """``k`` places from 0 to n - 1 in even steps, halves rounded to even; the last one repeated where n < k; null for n <= 0 or null."""
    step = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * ((n - 1) / F.lit(float(max(k - 1, 1))))).cast("int"))
    short = F.concat(F.sequence(F.lit(0), (n - 1).cast("int")), F.array_repeat((n - 1).cast("int"), (F.lit(k) - n).cast("int")))
    return F.when(n >= k, step).when(n > 0, short)


def crop(n: Column, ratio: Column, place: Column) -> Column:
    """start, end of a window of about ``ratio`` of n, at ``place`` (0 to 1) of where it may begin; one frame at least."""
    length = F.greatest(F.lit(1), F.bround(n * ratio).cast("int"))
    start = F.least(F.floor(place * (n - length + 1)).cast("int"), (n - length).cast("int"))
    return F.struct(start.alias("start"), (start + length).alias("end"))


def held(indices: Column, dropped: Column) -> Column:
    """``indices`` with those that are ``dropped`` (an array of flags) replaced by the last kept one; the first is always kept."""
    pairs = F.arrays_zip(indices.alias("i"), dropped.alias("d"))
    step = lambda out, x: F.concat(out, F.array(F.when(x["d"] & (F.size(out) > 0), F.try_element_at(out, F.lit(-1))).otherwise(x["i"])))
    return F.aggregate(pairs, F.array().cast("array<int>"), step)


def ascending(indices: Column) -> Column:
    """Whether no element is less than the one before it."""
    return F.forall(F.zip_with(indices, F.slice(indices, 2, F.greatest(F.size(indices) - 1, F.lit(0))), lambda a, b: b.isNull() | (a <= b)), lambda x: x)


def checked_ascending(indices: Column) -> Column:
    return F.when(ascending(indices), indices).otherwise(F.raise_error(F.lit("order violated")))


def islands(mask: Column) -> Column:
    """start and length of each run of true elements; nulls are false."""
    none = F.array().cast("array<struct<start:int,length:int>>")
    zero = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("from"), none.alias("out"))
    one = lambda acc: F.array(F.struct(acc["from"].alias("start"), (acc["at"] - acc["from"]).alias("length")))

    def step(acc: Column, v: Column) -> Column:
        on = F.coalesce(v, F.lit(False))
        began = F.when(on & (acc["from"] < 0), acc["at"]).when(on, acc["from"]).otherwise(F.lit(-1))
        return F.struct((acc["at"] + 1).alias("at"), began.alias("from"), F.when(~on & (acc["from"] >= 0), F.concat(acc["out"], one(acc))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(mask, zero, step, lambda acc: F.when(acc["from"] >= 0, F.concat(acc["out"], one(acc))).otherwise(acc["out"]))


def padded(values: Column, size: int, fill: Column) -> Column:
    """``values`` cut or filled up to ``size``."""
    return F.slice(F.concat(values, F.array_repeat(fill, size)), 1, size)


def masked(values: Column, kinds: Column, kind: int, instead: int) -> Column:
    """``values`` with ``instead`` where the parallel ``kinds`` is ``kind``."""
    return F.zip_with(values, kinds, lambda v, k: F.when(k == kind, F.lit(instead)).otherwise(v))


def normalised(values: Column) -> Column:
    """``values`` with mean 0 and length 1; all 0 where they hardly differ. Elements become doubles."""
    total = lambda v, f: F.aggregate(v, F.lit(0.0), f)
    centred = lambda v: bound(total(v, lambda a, x: a + x) / F.size(v), lambda m: F.transform(v, lambda x: x - m))
    return bound(F.transform(values, lambda x: x.cast("double")), lambda v: bound(centred(v), unit_length))


def unit_length(v: Column) -> Column:
    """Doubles divided by the length of the array; as they are where it is hardly above 0."""
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return bound(length, lambda n: F.when(n > 1e-6, F.transform(v, lambda x: x / n)).otherwise(v))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def best_of(scores: Column, allowed: Column, delta: Column | None = None) -> Column:
    """Of the ``allowed`` places (from 0) the first with the greatest score, with ``delta`` added by place in ``allowed``."""
    own = F.transform(allowed, lambda i: F.get(scores, i))
    own = F.zip_with(own, delta, lambda s, d: s + d) if delta is not None else own
    return F.get(allowed, (F.array_position(own, F.array_max(own)) - 1).cast("int"))


def constrained_pick(scores: Column, step: int, roles: list[int], scenes: list[int], pipe: int) -> Column:
    """The token of a decoding step: best role, pipe, best scene, pipe, then the best of all."""
    ids = lambda xs: F.array(*[F.lit(x) for x in xs])
    if step in (1, 3):
        return F.lit(pipe)
    if step in (0, 2):
        return best_of(scores, ids(roles if step == 0 else scenes))
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def prior_delta(target: Column, source: Column, tau: float = 1.0, eps: float = 1e-6) -> Column:
    """Correction of a letter's score from one prior to another; a missing prior counts as ``eps``."""
    t, s = (F.coalesce(c, F.lit(eps)) for c in (target, source))
    return tau * F.log((t + eps) / (s + eps))


def reward(rt: Column, sk: Column, true_rt: Column, true_sk: Column, group: Column, true_group: Column, weight: Column | None = None, w_scene: float = 1.0, w_group: float = 0.3, w_role: float = 0.3) -> Column:
    """Scene, group and role each add their weight where they are right; all times the weight of the true scene. Nulls are wrong."""
    right = lambda a, b, w: F.when(F.coalesce(a == b, F.lit(False)), float(w)).otherwise(0.0)
    total = right(sk, true_sk, w_scene) + right(group, true_group, w_group) + right(rt, true_rt, w_role)
    return total * F.coalesce(weight, F.lit(1.0)) if weight is not None else total


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def preference_loss(log_ratio: Column, kl: Column, desirable: Column, beta: float = 0.1, w_desirable: float = 1.0, w_undesirable: float = 1.0) -> Column:
    """The loss of one preference row, given its log ratio to the reference and the batch's divergence (not below 0)."""
    return F.when(desirable, w_desirable * (1 - sigmoid(beta * (log_ratio - kl)))).otherwise(w_undesirable * (1 - sigmoid(beta * (kl - log_ratio))))


def clipped_objective(ratio: Column, advantage: Column, low: float = 0.2, high: float = 0.28) -> Column:
    """The policy objective with a ratio clipped to 1 - low .. 1 + high."""
    return F.least(ratio * advantage, F.greatest(F.lit(1 - low), F.least(F.lit(1 + high), ratio)) * advantage)


def masked_sum(values: Column, labels: Column, ignored: int = -100) -> Column:
    """Sum of the values whose parallel label isn't ``ignored``."""
    kept = F.zip_with(values, labels, lambda v, g: F.when(g == ignored, F.lit(0.0)).otherwise(v))
    return F.aggregate(kept, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))


def smoothed_loss(log_probs: Column, label: Column, smoothing: float = 0.1) -> Column:
    """Cross entropy of a row of log probabilities against label (from 0), smoothed over all classes."""
    mean = F.aggregate(log_probs, F.lit(0.0), lambda a, x: a + x) / F.size(log_probs)
    return -((1 - smoothing) * F.get(log_probs, label) + smoothing * mean)


def subset_sample(scores: Column, uniform: Column, temperature: float = 1.0) -> Column:
    """The place (from 0) that a softmax of ``scores`` draws for ``uniform`` in [0, 1)."""
    def drawn(e: Column, total: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"))
        step = lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.when(acc["sum"] + x <= uniform * total, acc["n"] + 1).otherwise(acc["n"]).alias("n"))
        return F.aggregate(e, zero, step, lambda acc: F.least(acc["n"], F.size(scores) - 1))

    z = F.transform(scores, lambda x: x / max(temperature, 1e-6))
    exps = bound(F.array_max(z), lambda m: F.transform(z, lambda x: F.exp(x - m)))
    return bound(exps, lambda e: bound(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda t: drawn(e, t)))
