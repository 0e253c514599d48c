"""Encoding of a corpus with a public byte-level BPE tokenizer, by a global shuffle of distinct words.

Texts are cut into pre-tokens in chunks of bounded size. A chunk is one row: its keys, and for every pre-token in order
the number of its word among the chunk's distinct words. These words are exploded with their numbers (a word once per
chunk, so no word has more rows than there are chunks), each distinct word of the corpus is encoded exactly once, the
ids are joined back, gathered by chunk, and every document is put together by position. Decoding looks the ids up in the
token-byte table.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.stages import stage

#: Folder of the public tokenizers' files; a setting of the environment may name another.
TOKENIZERS = os.environ.get("MARLSTONE_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the pre-token pattern of the vocabulary's own pre-tokenizer.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text after which a chunk ends, and documents after which it ends. A longer text is a chunk of its own.
CHUNK_CHARS, CHUNK_DOCS = 1 << 20, 10_000
#: Distinct words that are encoded at once.
BATCH = 20_000


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@lru_cache(maxsize=1)
def splitter():
    return regex.compile(PRETOKEN)


def _chunks():
    """Batches of (key, text) to rows of keys, sizes (pre-tokens of each text), at (word number of each pre-token) and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = splitter().findall
        keys: list[pa.Array] = []
        number: dict[str, int] = {}
        at: list[np.ndarray] = []
        sizes: list[int] = []
        n_chars = 0

        def row() -> pa.RecordBatch:
            every = pa.concat_arrays(keys)
            flat = np.concatenate(at) if at else np.zeros(0, np.int32)
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays([one(every), one(pa.array(sizes, pa.int32())), one(pa.array(flat, pa.int32())), one(pa.array(list(number), pa.string()))], ["keys", "sizes", "at", "words"])

        for b in batches:
            begin = 0
            for i, text in enumerate(b.column(1).to_pylist()):
                found = find(text) if text else ()
                at.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found)))
                sizes.append(len(found))
                n_chars += len(text) if text else 0
                if n_chars >= CHUNK_CHARS or len(sizes) >= CHUNK_DOCS:
                    keys.append(b.column(0).slice(begin, i + 1 - begin))
                    yield row()
                    begin, n_chars = i + 1, 0
                    keys, number, at, sizes = [], {}, [], []
            if begin < b.num_rows:
                keys.append(b.column(0).slice(begin))
        if sizes:
            yield row()

    return run


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for b in batches:
            for begin in range(0, b.num_rows, BATCH):
                part = b.column(0).slice(begin, BATCH)
                ids = [e.ids for e in tok.encode_batch_fast(part.to_pylist(), add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([part, pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    return run


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """``word``, ids: each distinct word of the corpus once. Staged."""
    return stage(words.select("word").distinct().mapInArrow(_encode(path), "word string, ids array<int>"))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 and values of a list array, however it is sliced."""
    off = lists.offsets.to_numpy()
    return off - off[0], lists.values.slice(off[0], off[-1] - off[0])


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (keys, sizes, at, coded: the words' numbers and ids) to (key, ids) of each document."""
    for b in batches:
        for i in range(b.num_rows):
            keys, sizes, at, coded = (b.column(k).slice(i, 1) for k in range(4))
            keys, sizes, at = keys.flatten(), sizes.flatten().to_numpy(), at.flatten().to_numpy()
            got = coded.flatten()
            number = got.field("number").to_numpy()
            off, ids = _flat(got.field("ids"))
            ids, order = ids.to_numpy(), np.empty(len(number), np.int64)
            order[number] = np.arange(len(number))
            slot = order[at] if len(at) else np.zeros(0, np.int64)
            lens = np.diff(off)[slot]
            ends = np.concatenate([[0], np.cumsum(lens)])
            take = np.arange(ends[-1]) - np.repeat(ends[:-1], lens) + np.repeat(off[slot], lens)
            bounds = ends[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids[take] if len(take) else np.zeros(0, np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays([keys, lists], ["_k", "ids"])


def encode_corpus(docs: DataFrame, key: str = "doc_id", col: str = "text", path: str | None = None) -> DataFrame:
    """``key``, ids array<int>: each row's ``col`` in token ids, without special tokens.

    Null and empty texts give an empty list; strings of special tokens are ordinary text. Rows with equal or null
    keys stay apart: each input row gives one output row. Other columns are ignored. A text of any length is
    processed whole; an empty table gives an empty one. There is one path at every size: chunks, distinct words, join.
    """
    path = path or f"{TOKENIZERS}/byte_bpe_50k.json"
    rows = docs.select(F.col(key).alias("_k"), F.col(col).cast("string").alias("_t"))
    kind = rows.schema["_k"].dataType
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("keys", T.ArrayType(kind)), T.StructField("sizes", ints), T.StructField("at", ints), T.StructField("words", T.ArrayType(T.StringType()))])
    chunks = stage(rows.mapInArrow(_chunks(), schema).withColumn("chunk", F.monotonically_increasing_id()))
    pieces = chunks.select("chunk", F.posexplode("words").alias("number", "word"))
    coded = pieces.join(encode_words(pieces, path), "word").groupBy("chunk").agg(F.collect_list(F.struct("number", "ids")).alias("coded"))
    none = F.array().cast("array<struct<number:int,ids:array<int>>>")
    whole = chunks.drop("words").join(coded, "chunk", "left").select("keys", "sizes", "at", F.coalesce("coded", none).alias("coded"))
    out = T.StructType([T.StructField("_k", kind), T.StructField("ids", ints)])
    return whole.mapInArrow(_assemble, out).select(F.col("_k").alias(key), "ids")


@lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: where each id's bytes begin, how many they are (-1: no such id), and all bytes end to end."""
    tok = tokenizer(path)
    # the printable stand-ins of bytes in byte-level vocabularies: printable bytes stand for themselves, others follow from 256 in order
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    vocab = {i: bytes(byte_of[ch] for ch in w) for w, i in tok.get_vocab(with_added_tokens=False).items() if all(ch in byte_of for ch in w)}
    size = np.full(max(vocab) + 1, -1, np.int64)
    for i, w in vocab.items():
        size[i] = len(w)
    begin = np.concatenate([[0], np.cumsum(np.maximum(size, 0))[:-1]])
    return begin, size, np.frombuffer(b"".join(vocab.get(i, b"") for i in range(len(size))), np.uint8)


def decode_corpus(encoded: DataFrame, key: str = "doc_id", col: str = "ids", path: str | None = None) -> DataFrame:
    """``key``, text: the texts of token ids, by a broadcast token-byte table looked up in place (no row per id is shuffled).

    Null lists give null, empty ones an empty text; a null or unknown id raises. Bytes that aren't valid UTF-8 become U+FFFD.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(token_bytes(path or f"{TOKENIZERS}/byte_bpe_50k.json"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, size, table = shared.value
        for b in batches:
            lists = b.column(1)
            off, values = _flat(lists)
            if values.null_count:
                raise ValueError("unknown token id")
            ids = values.to_numpy(zero_copy_only=False)
            if len(ids) and (ids.min() < 0 or ids.max() >= len(size) or (size[ids] < 0).any()):
                raise ValueError("unknown token id")
            lens = size[ids] if len(ids) else np.zeros(0, np.int64)
            ends = np.concatenate([[0], np.cumsum(lens)])
            data = table[np.arange(ends[-1]) - np.repeat(ends[:-1], lens) + np.repeat(begin[ids] if len(ids) else lens, lens)].tobytes()
            bounds = ends[off].tolist()
            texts = [data[s:e].decode("utf-8", "replace") for s, e in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))], [key, "text"])

    rows = encoded.select(key, F.col(col).alias("_ids"))
    return rows.mapInArrow(run, T.StructType([rows.schema[key], T.StructField("text", T.StringType())]))
