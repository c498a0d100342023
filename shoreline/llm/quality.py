"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

Two dictionaries are trained on fragments of labelled texts, one per class.  A text is
compressed in blocks of ``BLOCK`` bytes with each dictionary; the difference of the two
sizes over the text's size, and the size with the good dictionary, are calibrated into
the probability that ``labels.quality`` is 1.  Scoring reads the whole text.

Bounds of the fit: dictionaries use at most ``DICT_DOCS`` documents a class and
``FRAGMENTS`` fragments of ``FRAGMENT`` bytes of each; calibration uses the whole texts
of at most ``CALIBRATION_DOCS`` documents of another fold.  Both samples are taken in
the order of the ids' hash.  Held-out rows (fold 0) are never read for the fit.

Defined cases: a null text counts as empty; an empty text has features 0 and is scored
like any other; without labels of both classes every score is the smoothed base rate;
repeated rows are scored each; repeated labels count once, with the larger one; other
columns are not read and come through ``keep_good`` as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Logistic, fresh, labelled, sample_ids, worker_cache

BLOCK = 1024
LEVEL = 3
DICT_BYTES = 112_640
DICT_DOCS = 4_000
FRAGMENT = 512
FRAGMENTS = 4
CALIBRATION_DOCS = 6_000
#: Scores from here on count as good.
THRESHOLD = 0.3


def _compressor(data: bytes, raw: bool):
    form = dict(compression_level=LEVEL, write_content_size=False, write_checksum=False,
                write_dict_id=False, format=zs.FORMAT_ZSTD1_MAGICLESS)
    if not data:
        return zs.ZstdCompressor(compression_params=zs.ZstdCompressionParameters.from_level(
            LEVEL, **{k: v for k, v in form.items() if k != "compression_level"}))
    kind = zs.DICT_TYPE_RAWCONTENT if raw else zs.DICT_TYPE_FULLDICT
    d = zs.ZstdCompressionDict(data, dict_type=kind)
    d.precompute_compress(level=LEVEL)
    params = zs.ZstdCompressionParameters.from_level(
        LEVEL, **{k: v for k, v in form.items() if k != "compression_level"})
    return zs.ZstdCompressor(dict_data=d, compression_params=params)


def train_dictionary(fragments: list[bytes]) -> tuple[bytes, bool]:
    """(dictionary, whether it is raw content): trained, or the fragments themselves
    where they are too few to train on."""
    try:
        return zs.train_dictionary(DICT_BYTES, fragments).as_bytes(), False
    except zs.ZstdError:
        return b"".join(fragments)[:DICT_BYTES], True


class Sizes:
    """Features of a text from its compressed sizes under both dictionaries."""

    def __init__(self, good: tuple[bytes, bool], bad: tuple[bytes, bool]):
        self.codecs = [_compressor(*good), _compressor(*bad)]
        self.empty = [len(c.compress(b"")) for c in self.codecs]

    def features(self, text: str | None) -> list[float]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw:
            return [0.0] * 5
        size = [0, 0]
        for at in range(0, len(raw), BLOCK):
            part = raw[at:at + BLOCK]
            for k, c in enumerate(self.codecs):
                size[k] += len(c.compress(part)) - self.empty[k]
        diff, good = (size[1] - size[0]) / len(raw), min(size[0] / len(raw), 1.2)
        return [diff, good, diff * diff, good * good, diff * good]


class Model:
    """A fitted classifier; ``score_column`` gives the calibrated score of a text."""

    def __init__(self, good: tuple[bytes, bool], bad: tuple[bytes, bool], calibration: Logistic):
        self.good, self.bad, self.calibration = good, bad, calibration

    def score_column(self, text: Column) -> Column:
        good, bad, calibration = self.good, self.bad, self.calibration

        def run(parts):
            sizes = worker_cache(("sizes", zlib.crc32(good[0]), zlib.crc32(bad[0])), lambda: Sizes(good, bad))
            for s in parts:
                x = np.array([sizes.features(t) for t in s], float).reshape(-1, 5)
                yield pd.Series(calibration.predict(x), dtype="float64")

        run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(run, "double").asNondeterministic()(text)


def _cut(parts):
    """Evenly spaced fragments of each text, as one binary value with fixed cuts."""
    for s in parts:
        out = []
        for t in s:
            raw = (t or "").encode("utf-8", "surrogatepass")
            step = max(FRAGMENT, len(raw) // FRAGMENTS)
            out.append([raw[i:i + FRAGMENT] for i in range(0, len(raw), step)][:FRAGMENTS])
        yield pd.Series(out)


_cut.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        seed: int = 5) -> Model:
    known = labelled(labels, "quality").cache()
    try:
        texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
        found = []
        for k in (1, 0):
            ids = sample_ids(known.where(f"label = {k} AND fold > 1"), DICT_DOCS, seed)
            rows = (texts.join(F.broadcast(ids.select("doc_id")), "doc_id")
                    .select("doc_id", F.pandas_udf(_cut, "array<binary>")("t").alias("f")).collect())
            rows.sort(key=lambda r: r.doc_id)
            found.append(train_dictionary([bytes(f) for r in rows for f in r.f if len(f) >= 8]))
        good, bad = found
        ids = sample_ids(known.where("fold = 1"), CALIBRATION_DOCS, seed)
    finally:
        known.unpersist()

    def measure(parts):
        sizes = worker_cache(("sizes", zlib.crc32(good[0]), zlib.crc32(bad[0])), lambda: Sizes(good, bad))
        for s in parts:
            yield pd.Series([sizes.features(t) for t in s])

    measure.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    rows = (texts.join(F.broadcast(ids.select("doc_id", "label")), "doc_id")
            .select("doc_id", "label", F.pandas_udf(measure, "array<double>")("t").alias("x")).collect())
    rows.sort(key=lambda r: r.doc_id)
    return Model(good, bad, Logistic([r.x for r in rows], [r.label for r in rows]))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs``; rows that score below the threshold go."""
    name = fresh(docs, "score")
    return (docs.withColumn(name, model.score_column(F.col(text_col)))
            .where(F.col(name) >= threshold).drop(name))
