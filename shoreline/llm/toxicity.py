"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Two models, of toxic and of ordinary text, give every word's letters a likelihood from
the four before them.  Orders 5 to 3 discount and back off within the class; orders 2
and 1 are continuation counts shared by both classes, so a rare expression gets its
mass from what both have seen.  A word's evidence is the difference of the two
log-likelihoods over its length; a text's features are the difference over the whole
text's length and its strongest words, which logistic calibration on another fold turns
into a probability.

What is gathered: every labelled text outside the held-out fold, whole, is counted
into words per class in the tasks that read it, merged by word over the cluster, and
turned into letter-sequence counts that are merged likewise; it grows with the labelled
rows.  What is broadcast is bounded by the alphabet: letters are folded to 32 codes, so
there are at most 32^5 sequences of 12 bytes each, and the counts of a text collection of
any size fill a small part of them.  The fold keeps a-z apart; letters of other scripts
share five codes, so texts in Cyrillic, Greek or CJK are told apart by little more than
word lengths and their Latin parts.  Calibration reads the features (numbers) of at most
``CALIBRATION_DOCS`` texts of fold 1, in the order of the ids' hash; the models count
the other folds.

Defined cases: a null text counts as empty; a text without words has features 0 and is
scored like any other; without labels of both classes every score is the smoothed base
rate; repeated rows are scored each; repeated labels count once, with the larger one;
other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Logistic, Shipped, labelled, materialise, sample_ids, worker_cache

ORDER = 5
SHARED = 2
CODES = 32
DISCOUNT = 0.75
CALIBRATION_DOCS = 12_000
#: Words whose evidence one worker remembers; beyond it the memory starts anew.
CACHE_WORDS = 400_000
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def letter_codes(word: str) -> list[int]:
    """1-26 for a-z with or without marks, 27-31 for all others."""
    out = []
    for c in word:
        if not "a" <= c <= "z":
            c = unicodedata.normalize("NFD", c)[0]
        out.append(ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 5)
    return out


def sequences(ws: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, word) of every ``order`` letters, word ends marked by 0."""
    flat, sizes = [], []
    pad = [0] * (order - 1)
    for w in ws:
        flat += pad
        flat += letter_codes(w)
        flat.append(0)
        sizes.append(len(w) + order)
    if not ws:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat, sizes = np.array(flat, np.int64), np.array(sizes)
    start = np.cumsum(sizes) - sizes
    n = len(flat) - order + 1
    g = np.zeros(n, np.int64)
    for k in range(order):
        g = g * CODES + flat[k:n + k]
    word = np.repeat(np.arange(len(ws)), sizes)[:n]
    ok = np.arange(n) - start[word] <= sizes[word] - order
    return g[ok], word[ok]


class _Lookup:
    def __init__(self, keys, values):
        self.keys, self.values = keys, np.asarray(values, float)

    def __call__(self, x):
        if not len(self.keys):
            return np.zeros(len(x))
        i = np.minimum(np.searchsorted(self.keys, x), len(self.keys) - 1)
        return np.where(self.keys[i] == x, self.values[i], 0.0)


class KneserNey:
    """``evidence(words)``: log-likelihood of toxic minus ordinary, and length."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """``keys``: the sequences seen, sorted; ``counts``: ordinary and toxic (2 x n)."""
        self.models = [self._orders(keys, counts[c]) for c in (0, 1)]

    @staticmethod
    def _orders(keys, counts):
        seen = counts > 0
        k, v = keys[seen], counts[seen].astype(float)
        orders = {}
        for n in range(ORDER, 0, -1):
            if n == SHARED:  # from here on both classes share the continuation counts
                longer = keys
                for m in range(ORDER - 1, n, -1):
                    longer = np.unique(longer % CODES ** m)
                k, v = np.unique(longer % CODES ** n, return_counts=True)
            context, at = np.unique(k // CODES, return_inverse=True)
            total = np.bincount(at, weights=v, minlength=len(context))
            kinds = np.bincount(at, minlength=len(context))
            orders[n] = (_Lookup(k, v), _Lookup(context, total), _Lookup(context, kinds))
            k, v = np.unique(k % CODES ** (n - 1), return_counts=True)
        return orders

    @staticmethod
    def _log(orders, g):
        p = np.full(len(g), 1.0 / CODES)
        for n in range(1, ORDER + 1):
            x = g % CODES ** n
            count, total, kinds = (f(y) for f, y in zip(orders[n], (x, x // CODES, x // CODES), strict=True))
            more = np.maximum(count - DISCOUNT, 0) + DISCOUNT * kinds * p
            p = np.where(total > 0, more / np.maximum(total, 1e-9), p)
        return np.log(p)

    def evidence(self, ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
        g, word = sequences(ws)
        diff = self._log(self.models[1], g) - self._log(self.models[0], g)
        return (np.bincount(word, weights=diff, minlength=len(ws)),
                np.bincount(word, minlength=len(ws)).astype(float))


class Scorer:
    """Features of texts, remembering the evidence of words."""

    def __init__(self, model: KneserNey):
        self.model = model
        self.memory: dict[str, int] = {}
        self.sums = np.zeros(0)
        self.sizes = np.zeros(0)

    def features(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), 4))
        for at in range(0, len(texts), 500):
            split = [words(t) for t in texts[at:at + 500]]
            every = set().union(*split)
            if len(self.memory) + len(every.difference(self.memory)) > CACHE_WORDS:
                self.memory.clear()
                self.sums, self.sizes = np.zeros(0), np.zeros(0)
            new = list(every.difference(self.memory))
            if new:
                s, n = self.model.evidence(new)
                self.memory.update(zip(new, range(len(self.sums), len(self.sums) + len(new)), strict=True))
                self.sums = np.concatenate([self.sums, s])
                self.sizes = np.concatenate([self.sizes, n])
            get = self.memory.__getitem__
            for i, ws in enumerate(split):
                if ws:
                    idx = np.fromiter(map(get, ws), np.int64, len(ws))
                    s, n = self.sums[idx], self.sizes[idx]
                    top = np.sort((s / n))[-3:]
                    out[at + i] = (s.sum() / n.sum(), top[-1], top.mean(), s.max() / 10)
        return out


class Counts:
    """The sequences seen and their counts by class, as small as they are: what is sent to
    the workers, which build the models from them."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys = keys.astype(np.int32)         # below CODES ** ORDER = 2^25
        whole = counts.astype(np.int64)
        self.counts = whole.astype(np.uint32) if whole.max(initial=0) < 1 << 32 else whole

    def scorer(self) -> Scorer:
        return Scorer(KneserNey(self.keys.astype(np.int64), self.counts))


class Model:
    def __init__(self, counts: Counts, calibration: Logistic, key):
        self.counts, self.calibration, self.key = counts, calibration, key

    def score_column(self, spark, text: Column) -> Column:
        shipped, key, calibration = Shipped(spark, self.counts), self.key, self.calibration

        def run(parts):
            scorer = worker_cache(key, lambda: shipped.value.scorer())
            for s in parts:
                yield pd.Series(calibration.predict(scorer.features(list(s))), dtype="float64")

        run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(run, "double").asNondeterministic()(text)


def _count_words(batches):
    """(label, text) -> the words of each class with their counts, merged per task."""
    total = (Counter(), Counter())

    def flush():
        for k in (0, 1):
            ws = list(total[k])
            for at in range(0, len(ws), 50_000):
                part = ws[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array([k] * len(part), pa.int32()), pa.array([total[k][w] for w in part], pa.int64())],
                    ["word", "label", "n"])
            total[k].clear()

    for b in batches:
        for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            total[label].update(words(text))
        if len(total[0]) + len(total[1]) > 500_000:
            yield from flush()
    yield from flush()


def _count_sequences(batches):
    """(word, ordinary, toxic) -> the letter sequences with their counts, merged per task."""
    held, size = [], 0

    def merge():
        g = np.concatenate([h[0] for h in held])
        keys, at = np.unique(g, return_inverse=True)
        return keys, *[np.bincount(at, weights=np.concatenate([h[c] for h in held]), minlength=len(keys)) for c in (1, 2)]

    for b in batches:
        ws = b.column(0).to_pylist()
        g, word = sequences(ws)
        held.append((g, *[b.column(c).to_numpy(zero_copy_only=False)[word].astype(float) for c in (1, 2)]))
        size += len(g)
        if size > 4_000_000:
            held = [merge()]
            size = len(held[0][0])
    if held:
        keys, ordinary, toxic = merge()
        for at in range(0, len(keys), 50_000):
            part = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[part]), pa.array(ordinary[part].astype(np.int64)), pa.array(toxic[part].astype(np.int64))],
                ["g", "ordinary", "toxic"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 2) -> Model:
    spark = docs.sparkSession
    known = materialise(labelled(labels, "toxic"), "labels")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    counted = (texts.join(known.where("fold <> 1").select("doc_id", "label").hint("shuffle_hash"), "doc_id")
               if known.count() > BROADCAST_LABELS else
               texts.join(F.broadcast(known.where("fold <> 1").select("doc_id", "label")), "doc_id"))
    per_word = (counted.select("label", "t").mapInArrow(_count_words, "word string, label int, n long")
                .groupBy("word").agg(F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("ordinary"),
                                     F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic")))
    grams = (per_word.mapInArrow(_count_sequences, "g long, ordinary long, toxic long")
             .groupBy("g").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
             .toPandas().sort_values("g"))
    keys = grams.g.to_numpy(np.int64)
    counts = np.array([grams.ordinary.to_numpy(float), grams.toxic.to_numpy(float)]).reshape(2, len(keys))
    key = ("kneser-ney", zlib.crc32(keys.tobytes()), zlib.crc32(counts.tobytes()))
    model = Counts(keys, counts)
    shipped = Shipped(spark, model)

    def measure(parts):
        scorer = worker_cache(key, lambda: shipped.value.scorer())
        for s in parts:
            yield pd.Series(scorer.features(list(s)).tolist())

    measure.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    ids = sample_ids(known.where("fold = 1"), CALIBRATION_DOCS, seed)
    rows = (texts.join(F.broadcast(ids.select("doc_id", "label")), "doc_id")
            .select("doc_id", "label", F.pandas_udf(measure, "array<double>")("t").alias("x")).collect())
    rows.sort(key=lambda r: r.doc_id)
    if counts.size == 0 or not counts.any(axis=1).all():
        rows = [r for r in rows if r.label == 0] or rows  # nothing learnt of one class: base rate
    return Model(model, Logistic([r.x for r in rows], [r.label for r in rows]), key)


#: Up to so many labelled ids (16 bytes each) are sent to the documents; beyond it the
#: documents are dealt by id instead.
BROADCAST_LABELS = 2_000_000
