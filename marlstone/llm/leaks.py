"""Evaluation passages inside a training corpus, by winnowed word k-grams and extension of the hits.

Of every window of WINDOW successive k-gram hashes the least is kept, on both sides by the same rule; so any run
of K + WINDOW - 1 = 6 shared words shares a kept hash. Six is what the definition needs: twelve successive words
contain such a run, and so do twenty words with at most one edit in eight, wherever the edits fall. Hits are
joined by hash with their places on both sides, and each is extended by an exact alignment of the words around it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.stages import BROADCAST_BYTES, drop_stage, size_of, stage, with_dim

K, WINDOW = 5, 2
#: Successive words of an exact passage; least words of an edited one and words per allowed edit.
EXACT, EDITED, PER_EDIT = 12, 20, 8
#: Test fingerprints up to which they filter the corpus where it is read (16 MB); beyond, all fingerprints are joined.
FILTER_FINGERPRINTS = 2_000_000
#: Words of a cell, by which hits are gathered. Words before and after a hit within which any passage that holds it lies: a passage that is no longer than it must be has fewer than 2 * EDITED words, and an edit shifts by one.
CELL, REACH = 96, 2 * EDITED + 2 * EDITED // PER_EDIT
#: Tasks over which each fingerprint is spread where the fingerprints are too large for a broadcast.
SALTS = 16
#: Words that a worker remembers with their hashes.
KNOWN_WORDS = 1_000_000

_WORD = re.compile(r"[^\W_]+")
_BASE, _TOP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFFFFFFFFFF)
_HASHES: dict[str, int] = {}


def words_of(text: str) -> list[str]:
    """Words without letter case, punctuation, spacing, and characters that don't show."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        odd = {ord(c): None for c in set(text) if ord(c) > 127 and unicodedata.category(c) in ("Cf", "Mn", "Me")}
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFD", text).translate(odd)) if odd else text
    return _WORD.findall(text.casefold())


def word_hashes(words: list[str]) -> np.ndarray:
    if len(_HASHES) > KNOWN_WORDS:
        _HASHES.clear()
    out = np.empty(len(words), np.uint64)
    get = _HASHES.get
    for i, w in enumerate(words):
        h = get(w)
        if h is None:
            h = _HASHES[w] = xxhash.xxh64_intdigest(w)
        out[i] = h
    return out


def winnow(hashes: np.ndarray, ends: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept positions and their k-gram hashes of several texts laid end to end (``ends``: their ends)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = np.zeros(n, np.uint64)
    for j in range(k):
        gram = gram * _BASE + hashes[j : j + n]
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    gram ^= gram >> np.uint64(32)
    gram = np.minimum(gram, _TOP - np.uint64(1))
    for j in range(1, k):  # grams that run over a text's end
        at = ends - j
        gram[at[(at >= 0) & (at < n)]] = _TOP
    padded = np.concatenate([np.full(window - 1, _TOP), gram, np.full(window - 1, _TOP)])
    views = np.lib.stride_tricks.sliding_window_view(padded, window)[:, ::-1]
    kept = np.unique(np.arange(len(views)) - views.argmin(axis=1))
    kept = kept[(kept >= 0) & (kept < n)]
    kept = kept[gram[kept] != _TOP]
    return kept, gram[kept]


def _fingerprints(batch: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, word position and fingerprint of each kept k-gram of a batch of texts."""
    per = [words_of(t) if t else [] for t in batch]
    ends = np.cumsum([len(p) for p in per], dtype=np.int64) if per else np.zeros(0, np.int64)
    kept, gram = winnow(word_hashes([w for p in per for w in p]), ends)
    text = np.searchsorted(ends, kept, side="right")
    return text, kept - np.where(text > 0, ends[np.maximum(text - 1, 0)], 0) if len(kept) else kept, gram.view(np.int64)


def leaked(a: list[str], b: list[str]) -> bool:
    """Whether ``b`` holds a passage of ``a``: EXACT successive words, or EDITED words with at most one edit in PER_EDIT.

    A longer passage within the rate has a part of EDITED to 2 * EDITED - 1 words within it, so few edits are tracked.
    """
    most = (2 * EDITED - 1) // PER_EDIT
    known = {w: i for i, w in enumerate(dict.fromkeys(a))}
    y = np.fromiter((known.get(w, -1) for w in b), np.int64, len(b))
    need = [min(EXACT, EDITED), *[max(EDITED, PER_EDIT * e) for e in range(1, most + 1)]]
    rows = np.zeros((most + 1, len(b) + 1), np.int32)  # longest stretch of a that ends here, by edits
    for w in a:
        same = y == known[w]
        new = np.zeros_like(rows)
        new[:, 1:] = np.where(same, rows[:, :-1] + 1, 0)
        for e in range(1, most + 1):
            np.maximum(new[e, 1:], rows[e - 1, :-1] + 1, out=new[e, 1:])  # replaced
            np.maximum(new[e], rows[e - 1] + 1, out=new[e])  # dropped
            np.maximum(new[e, 1:], new[e - 1, :-1], out=new[e, 1:])  # added
        if any(new[e].max() >= need[e] for e in range(most + 1)):
            return True
        rows = new
    return False


def extended(a: list[str], b: list[str], i: int, j: int) -> int:
    """Length of the run of equal words of ``a`` and ``b`` around ``a[i]`` and ``b[j]``."""
    lo = 0
    while lo < min(i, j) and a[i - lo - 1] == b[j - lo - 1]:
        lo += 1
    hi = 0
    while hi < min(len(a) - i, len(b) - j) and a[i + hi] == b[j + hi]:
        hi += 1
    return lo + hi


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (h, text, cells) to one row per cell with the words of the text around its hits, and where these begin."""
    for b in batches:
        h, texts, cells = b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist()
        of, rows = [], []
        for k, (text, own) in enumerate(zip(texts, cells, strict=True)):
            words = words_of(text)
            for c in own:
                begin = max(0, c["lo"] - REACH)
                of.append(k)
                rows.append((c["item"], " ".join(words[begin : c["hi"] + K + REACH]), c["first"]["p"] - begin, c["first"]["ip"], c["last"]["p"] - begin, c["last"]["ip"], c["ilo"], c["ihi"]))
        cols = list(zip(*rows, strict=True)) or [()] * 8
        kinds = [b.schema.field(2).type.value_type.field("item").type, pa.string(), *[pa.int32()] * 6]
        yield pa.RecordBatch.from_arrays([h.take(pa.array(of, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], ["h", "_i", "window", "j0", "i0", "j1", "i1", "ilo", "ihi"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _windows with the item's words to the pairs (h, _i) that are leaks: hits are extended word by word, then by edits."""
    for b in batches:
        good = []
        for window, j0, i0, j1, i1, ilo, ihi, item in zip(*(b.column(k).to_pylist() for k in range(2, 10)), strict=True):
            x, y = item.split(" "), window.split(" ")
            exact = max(extended(x, y, i0, j0), extended(x, y, i1, j1)) >= EXACT
            good.append(exact or leaked(x[max(0, ilo - REACH) : ihi + K + REACH], y))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["h", "_i"]).filter(pa.array(good, pa.bool_()))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([" ".join(words_of(t)) for t in b.column(1).to_pylist()], pa.string())], ["_i", "item"])


def leaked_passages(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text") -> DataFrame:
    """``key``, ``item_key``: each document with each item of which it holds a passage.

    Null, empty and blank texts hold nothing. Equal keys are merged: a pair comes out once; null keys too. Texts of any
    length are processed whole; no number of items, hits or documents is capped, and copies of a text are verified once.
    Hits of a text and an item are gathered by cells of CELL words on either side, so that a chance hit far away
    widens no other's window; each cell is extended by REACH words, which holds every passage around its hits.
    """
    rows = docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t")).withColumn("h", F.md5("_t"))
    named = items.select(F.col(item_key).alias("_name"), F.md5(F.col(text).cast("string")).alias("_i"), F.col(text).cast("string").alias("_s")).filter("_s is not null")
    # an item is its text: places in one text mean nothing in another of the same id
    items, names = named.select("_i", "_s").dropDuplicates(["_i"]), named.select("_i", "_name").distinct()
    kind = items.schema["_i"]

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t, pos, gram = _fingerprints(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(t)), pa.array(gram), pa.array(pos.astype(np.int32))], ["_i", "fp", "ip"])

    prints = stage(items.mapInArrow(of_items, T.StructType([kind, *T.StructType.fromDDL("fp long, ip int").fields])).distinct())
    n, size = size_of(prints)
    wanted = None
    if n <= FILTER_FINGERPRINTS:
        wanted = docs.sparkSession.sparkContext.broadcast(np.unique(prints.select("fp").toArrow().column(0).to_numpy()) if n else np.zeros(0, np.int64))

    def of_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                t, pos, gram = _fingerprints(part.column(1).to_pylist())
                if wanted is not None and len(gram):
                    w = wanted.value
                    i = np.minimum(np.searchsorted(w, gram), max(0, len(w) - 1))
                    hit = w[i] == gram if len(w) else np.zeros(len(gram), bool)
                    t, pos, gram = t[hit], pos[hit], gram[hit]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(t)), pa.array(gram), pa.array(pos.astype(np.int32))], ["h", "fp", "p"])

    each = rows.filter("_t is not null").select("h", "_t").mapInArrow(of_docs, "h string, fp long, p int")
    if size <= BROADCAST_BYTES:
        hits = each.join(F.broadcast(prints), "fp")
    else:  # a passage that many documents hold is spread over SALTS tasks
        spread = prints.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = each.withColumn("salt", F.pmod(F.xxhash64("h", "p"), F.lit(SALTS)).cast("int")).join(spread, ["fp", "salt"])
    place = F.struct("p", "ip")
    cells = hits.groupBy("h", "_i", F.floor(F.col("p") / CELL).alias("pc"), F.floor(F.col("ip") / CELL).alias("ic")).agg(
        F.min("p").alias("lo"), F.max("p").alias("hi"), F.min("ip").alias("ilo"), F.max("ip").alias("ihi"), F.min(place).alias("first"), F.max(place).alias("last")
    )
    # a text's cells are at most its hits; they are small numbers beside the text itself
    cells = stage(cells.groupBy("h").agg(F.collect_list(F.struct(F.col("_i").alias("item"), "lo", "hi", "ilo", "ihi", "first", "last")).alias("cells"), F.lit(1).alias("one")))
    found = with_dim(rows.filter("_t is not null").select("h", "_t"), cells, "h", "one").filter("cells is not null")
    found = found.groupBy("h").agg(F.first("_t").alias("_t"), F.first("cells").alias("cells"))
    out = T.StructType([T.StructField("h", T.StringType()), kind, *T.StructType.fromDDL("window string, j0 int, i0 int, j1 int, i1 int, ilo int, ihi int").fields])
    # windows are short; from here on the work is spread evenly, whatever document or item they come from
    windows = stage(found.select("h", "_t", "cells").mapInArrow(_windows, out))
    words = items.mapInArrow(_word_rows, T.StructType([kind, T.StructField("item", T.StringType())]))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = windows.repartition(tasks, F.xxhash64("h", "_i", "j0", "i0", "ilo")).join(words, "_i").select(*windows.columns, "item")
    leaks = pairs.mapInArrow(_verify, T.StructType([T.StructField("h", T.StringType()), kind]))
    leaks = leaks.distinct().join(names, "_i")
    leaks = stage(leaks.groupBy("h").agg(F.collect_set("_name").alias("found"), F.count_if(F.col("_name").isNull()).alias("unnamed"), F.lit(1).alias("one")))
    all_ = with_dim(rows.filter("_t is not null").select("_k", "h"), leaks, "h", "one").filter("found is not null")
    drop_stage(prints, cells, windows)
    every = F.concat("found", F.when(F.col("unnamed") > 0, F.array(F.lit(None))).otherwise(F.array()).cast(leaks.schema["found"].dataType))
    return all_.select("_k", F.explode(every).alias("_i")).distinct().select(F.col("_k").alias(key), F.col("_i").alias(item_key))
