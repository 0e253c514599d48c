"""Languages of texts and of the segments of mixed texts, by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's likelihood is the sum over
all its segmentations into pieces (a forward pass); a sentence's is the product over its words. The probabilities
are fitted by expectation-maximisation on a bounded sample of labelled texts, which is relabelled sentence by
sentence between rounds, so that wrong labels wash out. Every text is then scored whole.
"""

from __future__ import annotations

import math
import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: File of the public vocabulary of pieces; its folder may be set in the environment.
PIECES = os.path.join(os.environ.get("MARLSTONE_TOKENIZERS", "/opt/tokenizers"), "piece_bpe_32k.model")
#: The languages, with the codes and names by which labels may call them.
NAMES = {
    "en": "en eng english",
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语",
    "de": "de deu ger german deutsch",
    "fr": "fr fra fre french français francais",
    "es": "es spa spanish castilian español espanol",
    "it": "it ita italian italiano",
}
#: Labels that name no language.
NO_LANGUAGE = "und unknown mul mis zxx none null nan na n/a other undefined undetermined mixed multiple"
LANGS = tuple(NAMES)
#: Different labelled texts in the sample that is fitted (a documented bound: those whose hash is below a share of the range); rounds of relabelling and of EM in each.
SAMPLE, ROUNDS, EM_STEPS = 20_000, 3, 3
#: One text in HELD of the sample is kept from the fit and calibrates the confidence, with at most so many sentences; steps of that fit and its ridge.
HELD, HELD_SENTENCES, NEWTON, RIDGE = 10, 5_000, 30, 1e-3
#: Letters after which a word is cut; added to each piece's expected count; sentences a worker remembers.
LONGEST, FLOOR, KNOWN = 32, 0.01, 200_000
#: Posterior under which a short sentence takes the language of its neighbour.
UNSURE = 0.9

_NOT_TEXT = re.compile(r"\[[^\]\n]{0,80}\]|【[^】\n]{0,80}】|\(\s*[A-Ea-e]\s*[/|,-]\s*[A-Ua-u]\s*\)")
_SENTENCE = re.compile(r"[^.!?。！？…\n\r\x00]*(?:[.](?=\d)[^.!?。！？…\n\r\x00]*)*[.!?。！？…]*")
_UNIT = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]+|[^\W\d_぀-ヿ㐀-鿿豈-﫿]+")


def label_code(label: str | None) -> str | None:
    """The code that a label names (with or without region); None if it names no language; ``other`` if another."""
    base = re.split(r"[-_\s(,;]", (label or "").strip().lower(), maxsplit=1)[0]
    if not base or base in NO_LANGUAGE.split():
        return None
    return next((code for code, names in NAMES.items() if base in names.split()), "other")


def sentences(text: str) -> list[tuple[int, int, tuple[str, ...]]]:
    """Start, end and words of each sentence; tags in square brackets and letter codes are no text, but part sentences."""
    plain = _NOT_TEXT.sub(lambda m: "\x00" * len(m[0]), text)
    out = []
    for m in _SENTENCE.finditer(plain):
        if m.end() > m.start():
            words = _UNIT.findall(unicodedata.normalize("NFC", m[0]).lower())
            if words:
                out.append((m.start() + len(m[0]) - len(m[0].lstrip()), m.end(), tuple(words)))
        # the part's own end is skipped by the next match
    return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[dict[str, int], int]:
    """Pieces by id, byte pieces as <0xNN>, and the length of the longest."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = {model.id_to_piece(i): i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i))}
    return ids, max(len(p) for p in ids if not p.startswith("<0x"))


class Unigrams:
    """Piece probabilities by language: ``table`` has a row for each piece and a column for each language; ``weights`` calibrate the confidence."""

    def __init__(self, ids: dict[str, int], longest: int, table: np.ndarray, weights: np.ndarray | None = None):
        self.ids, self.longest, self.table, self.weights = ids, longest, table, weights
        self.words: dict[str, np.ndarray] = {}

    def edges(self, word: str) -> list[tuple[int, int, list[int]]]:
        """Where each piece of ``word`` begins and ends; a letter without piece is its bytes."""
        shown = word if re.match(r"[぀-ヿ㐀-鿿豈-﫿]", word) else "▁" + word
        out = []
        for i in range(len(shown)):
            for j in range(i + 1, min(len(shown), i + self.longest) + 1):
                if (k := self.ids.get(shown[i:j])) is not None:
                    out.append((i, j, [k]))
                elif j == i + 1:
                    out.append((i, j, [self.ids[f"<0x{b:02X}>"] for b in shown[i].encode()]))
        return out

    def forward(self, word: str) -> tuple[np.ndarray, list, np.ndarray]:
        edges = self.edges(word)
        p = np.array([self.table[k].prod(axis=0) for _, _, k in edges])
        alpha = np.zeros((edges[-1][1] + 1, self.table.shape[1]))
        alpha[0] = 1
        for (i, j, _), q in zip(edges, p, strict=True):
            alpha[j] += alpha[i] * q
        return alpha, edges, p

    def log_likelihood(self, words: tuple[str, ...]) -> np.ndarray:
        total = np.zeros(self.table.shape[1])
        for whole in words:
            if (got := self.words.get(whole)) is None:
                got = sum(np.log(np.maximum(self.forward(whole[i : i + LONGEST])[0][-1], 1e-300)) for i in range(0, len(whole), LONGEST))
                if len(self.words) < KNOWN:
                    self.words[whole] = got
            total = total + got
        return total

    def fitted(self, counts: dict[str, np.ndarray]) -> Unigrams:
        """One step of expectation-maximisation on words with their counts by language."""
        expected = np.full_like(self.table, FLOOR)
        for whole, n in counts.items():
            for at in range(0, len(whole), LONGEST):
                alpha, edges, p = self.forward(whole[at : at + LONGEST])
                beta = np.zeros_like(alpha)
                beta[-1] = 1
                for (i, j, _), q in zip(reversed(edges), p[::-1], strict=True):
                    beta[i] += q * beta[j]
                share = n / np.maximum(alpha[-1], 1e-300)
                for (i, j, ks), q in zip(edges, p, strict=True):
                    gain = alpha[i] * q * beta[j] * share
                    for k in ks:
                        expected[k] += gain
        return Unigrams(self.ids, self.longest, expected / expected.sum(axis=0))


def evidence(ll: np.ndarray, letters: int) -> np.ndarray:
    """What the confidence is judged by: per letter the likelihood of the best language and its lead over the next, and the length."""
    first, second = np.sort(ll)[-1], np.sort(ll)[-2]
    n = max(1, letters)
    return np.array([1.0, first / n, min(5.0, (first - second) / n), math.log(n), min(50.0, first - second) / 10])


def calibrated(model: Unigrams, held: dict[tuple[str, ...], int]) -> np.ndarray:
    """Weights of a logistic confidence, fitted on sentences (with their language) that the model hasn't seen.

    A sentence gives one right case, and one wrong case: its own language left out, as if it were in none that is known.
    """
    x, y = [], []
    for words, own in sorted(held.items())[:HELD_SENTENCES]:
        ll, letters = model.log_likelihood(words), sum(map(len, words))
        if int(ll.argmax()) == own:
            x += [evidence(ll, letters), evidence(np.delete(ll, own), letters)]
            y += [1.0, 0.0]
    if not x:
        return np.array([0.0, 0.0, 0.0, 0.0, 1.0])
    X, Y = np.array(x), np.array(y)
    scale = np.maximum(np.abs(X).max(axis=0), 1e-9)
    X = X / scale
    w = np.zeros(X.shape[1])
    for _ in range(NEWTON):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        w = w + np.linalg.solve((X.T * (p * (1 - p))) @ X + RIDGE * len(Y) * np.eye(len(w)), X.T @ (Y - p) - RIDGE * len(Y) * w)
    return w / scale


def fit(texts: list[str], codes: list[str], path: str = PIECES, weights: list[int] | None = None) -> Unigrams:
    """Unigrams of texts with noisy language codes, each counted as often as ``weights`` says; of every HELD texts one only calibrates."""
    ids, longest = vocabulary(path)
    split = [[s for _, _, s in sentences(t)] for t in texts]
    given = [LANGS.index(c) for c in codes]
    apart = [len(texts) >= 2 * HELD and k % HELD == 0 for k in range(len(texts))]
    held = {s: g for ss, g, out in zip(split, given, apart, strict=True) if out for s in ss}
    split = [[] if out else ss for ss, out in zip(split, apart, strict=True)]
    pool: Counter = Counter()
    for ss, g, n in zip(split, given, weights or [1] * len(split), strict=True):
        for s in ss:
            pool[s, g] += n
    of: dict[tuple[str, ...], np.ndarray] = {}
    for (s, g), n in pool.items():
        of.setdefault(s, np.zeros(len(LANGS)))[g] += n
    model = Unigrams(ids, longest, np.full((max(ids.values()) + 1, len(LANGS)), 1.0 / len(ids)))
    share = {s: n for s, n in of.items()}
    for _ in range(ROUNDS):
        counts: dict[str, np.ndarray] = {}
        for s, n in share.items():
            for w in s:
                counts[w] = counts.get(w, 0) + n
        for _ in range(EM_STEPS):
            model = model.fitted(counts)
        share = {}
        for s, n in of.items():  # a sentence's votes go to the language that explains it best
            new = np.zeros(len(LANGS))
            new[model.log_likelihood(s).argmax()] = n.sum()
            share[s] = new
    model.weights = calibrated(model, {s: g for s, g in held.items() if s not in of} or held)
    return model


def confidence(ll: np.ndarray, best: int, letters: int, weights: np.ndarray) -> float:
    """Calibrated probability that ``best`` is the language: low for short texts and for languages that aren't known."""
    if best != int(ll.argmax()):
        return float(np.exp(ll[best] - ll.max()) / (1 + np.exp(ll[best] - ll.max())))
    return float(1 / (1 + np.exp(-np.clip(evidence(ll, letters) @ weights, -30, 30))))


def segments(text: str, model: Unigrams, known: dict) -> list[tuple[int, int, str, float, int]]:
    """Start, end, language, confidence and letters of each segment: the longest stretches of sentences in one language."""
    out: list[list] = []
    for start, end, words in sentences(text):
        if (ll := known.get(words)) is None:
            ll = model.log_likelihood(words)
            if len(known) < KNOWN:
                known[words] = ll
        best, letters = int(ll.argmax()), sum(map(len, words))
        if out and letters < 12 and 1 / np.exp(ll - ll.max()).sum() < UNSURE:
            best = out[-1][2]
        if out and out[-1][2] == best:
            out[-1][1] = end
            out[-1][3] = out[-1][3] + ll
            out[-1][4] += letters
        else:
            out.append([start, end, best, ll, letters])
    return [(s, e, LANGS[b], confidence(ll, b, n, model.weights), n) for s, e, b, ll, n in out]


def main_language(parts: list[tuple[int, int, str, float, int]]) -> tuple[str | None, float | None]:
    """The language of most letters (the first of equals), and its confidence times its share of the letters; nothing for no segments."""
    by: dict[str, list[float]] = {}
    for _, _, lang, p, n in parts:
        of = by.setdefault(lang, [0, 0.0])
        of[0] += n
        of[1] += n * p
    if not by:
        return None, None
    lang = max(by, key=lambda k: by[k][0])
    return lang, by[lang][1] / max(1, sum(n for n, _ in by.values()))


def language_segments(texts: DataFrame, text: str = "text", label: str = "lang", path: str = PIECES, sample: int = SAMPLE) -> DataFrame:
    """``texts`` with ``named`` (the code that the label names), ``segments`` (array of seg, lang, confidence, start, end), ``language`` and ``confidence``.

    seg counts from 1 in order of the text; start and end are character offsets from 0. language is that of most
    letters; its confidence falls with the share of other languages. Null and blank texts, and texts without a letter,
    have no segments and a null language. Models are fitted on about ``sample`` different texts with a label at most, those
    with the least hashes, counted as often as they stand; where no row is labelled, there are no segments. Every
    text is scored whole. Columns of ``texts`` named alike are replaced.
    """
    lower = F.lower(F.trim(F.regexp_extract(F.trim(F.col(label)), r"^[^-_\s(,;]*", 0)))
    names = F.create_map(*[F.lit(x) for code, ns in NAMES.items() for n in ns.split() for x in (n, code)])
    named = F.when(lower.isin(*NO_LANGUAGE.split(), ""), None).when(F.col(label).isNotNull(), F.coalesce(names[lower], F.lit("other")))
    texts = texts.drop("named", "segments", "language", "confidence").withColumn("named", named)
    usable = texts.filter(F.col("named").isin(*LANGS) & (F.length(F.trim(text)) > 0)).select(F.col(text).cast("string").alias("t"), "named")
    # copies take one place of the sample, so no text can fill it; the filter by hash leaves about ``sample`` texts of any number
    hashed = usable.withColumn("h", F.xxhash64("t"))
    different = hashed.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    if different > 0.9 * sample:
        hashed = hashed.filter(F.col("h") < int(-(2**63) + 2**64 * 0.9 * sample / different))
    rows = hashed.groupBy("h", "t", "named").agg(F.count("*").alias("n")).orderBy("h", "t", "named").limit(sample).collect()
    model = fit([r.t for r in rows], [r.named for r in rows], path, [r.n for r in rows]) if rows else None
    shared = texts.sparkSession.sparkContext.broadcast((model.ids, model.longest, model.table.astype(np.float64), model.weights) if model else None)
    kinds = pa.list_(pa.struct([("seg", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
    at = texts.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Unigrams(*shared.value) if shared.value else None
        known: dict = {}
        for b in batches:
            found = [segments(t, own, known) if t and own else [] for t in b.column(at).cast(pa.string()).to_pylist()]
            out = [[{"seg": k + 1, "lang": g, "confidence": p, "start": s, "end": e} for k, (s, e, g, p, _) in enumerate(parts)] for parts in found]
            whole = [main_language(parts) for parts in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, kinds), pa.array([g for g, _ in whole], pa.string()), pa.array([p for _, p in whole], pa.float64())], names=[*b.schema.names, "segments", "language", "confidence"])

    part = T.StructType.fromDDL("segments array<struct<seg:int,lang:string,confidence:double,start:int,end:int>>, language string, confidence double")
    return texts.mapInArrow(run, T.StructType([*texts.schema.fields, *part.fields]))


def mislabelled(found: DataFrame) -> DataFrame:
    """Rows of language_segments with a missing or wrong label or several languages."""
    wrong = F.col("named").isNull() | (F.size("segments") > 1) | (F.col("named") != F.col("segments")[0]["lang"])
    return found.filter((F.size("segments") > 0) & wrong)
