"""Keyword-stuffed and link-list pages, by block-wise compression against what is usual for the length and language.

A text's ratio is the mean compressed size of its blocks over their size. It is divided by the median of the corpus's
different texts in sentences of about the same length and language, so neither copies nor spam move what is usual;
masses of keywords, links or tags lie clearly below 1, at least with each figure taken as 0 (random prices and numbers
hide that the words repeat), and no other text is suspect. The suspicion is confirmed by sentence punctuation: the share of
the text that stands in units closed by a full stop, question or exclamation mark, which consist of enough different
words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.stages import stage

#: Bytes of a block, bytes of the shortest text that is judged, different texts that a group's median needs.
BLOCK, LEAST_BYTES, LEAST_GROUP = 2048, 200, 30
#: Bins of length, two for each doubling: enough for any text.
BINS = 128
#: Usual ratio where the corpus holds no text in sentences at all.
USUAL = 0.5
#: A text is suspect if its relative ratio, as it is or without figures, is less than MOST_RELATIVE. It is spam if the ratio as it is and its share of sentences sum to less than SPAM_SCORE, and the share alone is less than MOST_SENTENCES.
MOST_RELATIVE, SPAM_SCORE, MOST_SENTENCES = 0.9, 1.08, 0.5
#: Share of digits up to which a text counts as one of words; beyond it is a table of figures, whose figures are its content.
MOST_DIGITS = 1 / 3
#: Share of repeated words from which a unit is no sentence; least words, or CJK letters, of a sentence.
REPEATED, LEAST_WORDS, LEAST_CJK = 0.2, 5, 8

_LINK = re.compile(r"<[^>]*>|\]\([^)\s]*\)|(?:https?://|www\.)[^\s<>\"']*[^\s<>\"'.,;:!?。，！？)\]]")
_WRAP = re.compile(r"\r?\n(?=[>\s|]*[a-zß-öø-ÿ])")
_SPLIT = re.compile(r"(?<=[.!?])(?=[\s\"'”’)\]]|$)|(?<=[。！？])|[\r\n]+")
_WORD = re.compile(r"[^\W_]+")
_FIGURE = re.compile(r"\d+")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
_ENDS = tuple(".!?。！？")


def sentence_share(text: str) -> float:
    """Share of ``text`` in units that end like a sentence and don't repeat their words."""
    good = 0
    for unit in _SPLIT.split(_WRAP.sub(" ", _LINK.sub(" ", text))):
        unit = unit.strip(" \t>|\"'”’)]")
        if not unit.endswith(_ENDS):
            continue
        words = _WORD.findall(unit.lower())
        cjk = len(_CJK.findall(unit))
        content = [w for w in words if len(w) > 3 or _CJK.match(w)]
        if (len(words) >= LEAST_WORDS or cjk >= LEAST_CJK) and len(content) - len(set(content)) < REPEATED * len(words):
            good += len(unit)
    return good / max(1, len(text))


def block_ratio(data: bytes) -> float:
    """Compressed over plain size, in blocks (without each block's 11 bytes of frame)."""
    return sum(len(zlib.compress(data[i : i + BLOCK], 6)) - 11 for i in range(0, len(data), BLOCK)) / max(1, len(data))


def words_of(text: str) -> bytes:
    """``text`` with each run of digits as 0, or as it is where digits make up more than MOST_DIGITS of it."""
    masked, digits = _FIGURE.sub("0", text), sum(map(len, _FIGURE.findall(text)))
    return (masked if digits <= MOST_DIGITS * len(text) else text).encode()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for text, lang in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            data = (text or "").encode()
            if not text or text.isspace():
                rows.append((None, None, None, 0, None, None))
                continue
            cjk = len(_CJK.findall(text)) > 0.3 * len(text)
            code = re.match(r"[a-z]{2}", (lang or "").strip().lower())
            ratio, words = block_ratio(data), words_of(text)
            rows.append((ratio, ratio if words == data else block_ratio(words), sentence_share(text), len(data), "zh" if cjk else code[0] if code else "", int(2 * math.log2(len(data)))))
        cols = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.string(), pa.int32()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], ["_k", "hash", "ratio", "words", "sentences", "n_bytes", "tongue", "bin"])


def spam_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``key``, ratio, relative (to the median of length and language), relative_words (the same without figures), sentences, score, is_spam for every row.

    Null and blank texts have null figures and are no spam, nor are texts under LEAST_BYTES. ``lang`` only chooses
    the group of comparison; a wrong or null one is harmless, None means one group. Groups of under LEAST_GROUP
    different texts in sentences are compared with all such texts of their length, or of the nearest length that has
    any. Rows with equal or null keys stay apart.
    """
    tongue = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    rows = docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"), tongue.alias("_l")).withColumn("_h", F.xxhash64("_t"))
    schema = T.StructType([rows.schema["_k"], *T.StructType.fromDDL("hash long, ratio double, words double, sentences double, n_bytes long, tongue string, bin int").fields])
    got = stage(rows.mapInArrow(_features, schema))
    # a copy counts once, and a text that may be spam not at all, however many rows they hold
    plain = got.filter(F.col("sentences") >= MOST_SENTENCES).select("tongue", "bin", "hash", "ratio", "words")
    medians = F.struct(F.percentile_approx("ratio", 0.5).alias("ratio"), F.percentile_approx("words", 0.5).alias("words"))
    # at most 676 two-letter codes and BINS bins, so both medians are broadcast
    usual = plain.distinct().groupBy("tongue", "bin").agg(medians.alias("usual"), F.count("*").alias("n")).filter(F.col("n") >= LEAST_GROUP).drop("n")
    by_length = plain.drop("tongue").distinct().groupBy(F.col("bin").alias("other")).agg(medians.alias("m"))
    pooled = by_length.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1)))).groupBy("bin").agg(F.min_by("m", F.struct(F.abs(F.col("bin") - F.col("other")), "other")).alias("pooled"))
    all_ = got.join(F.broadcast(usual), ["tongue", "bin"], "left").join(F.broadcast(pooled), "bin", "left")
    known = F.coalesce("usual", "pooled")
    relative, relative_words = (F.col(c) / F.greatest(F.coalesce(known[c], F.lit(USUAL)), F.lit(1e-6)) for c in ("ratio", "words"))
    all_ = all_.select(F.col("_k").alias(key), "n_bytes", "ratio", relative.alias("relative"), relative_words.alias("relative_words"), "sentences", (relative + F.col("sentences")).alias("score"))
    spam = (F.col("n_bytes") >= LEAST_BYTES) & (F.least("relative", "relative_words") < MOST_RELATIVE) & (F.col("score") < SPAM_SCORE) & (F.col("sentences") < MOST_SENTENCES)
    return all_.withColumn("is_spam", F.coalesce(spam, F.lit(False)))


def spam_pages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang") -> DataFrame:
    """The ``key`` of each spam row of spam_scores."""
    return spam_scores(docs, key, text, lang).filter("is_spam").select(key)
