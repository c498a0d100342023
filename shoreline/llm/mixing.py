"""Mixing documents to target domain weights, with soft domain membership.

Domains are the combinations of the labels table (quality, toxic).  A classifier over
token ids, fitted on labelled rows, gives every document a posterior over the domains.
Rates per document, between 0 and ``MAX_RATE``, are then fitted by projected gradient: the
objective is half the squared distance of the expected domain token totals from the
targets, in the metric of the totals' Gram matrix, plus ``KEEP`` / 2 times the
token-weighted mean square distance of the rates from 1.  The second part keeps the corpus:
among rates that serve the targets as well it wants those near 1, and where targets are out
of reach it holds the rates back from a few documents with extreme posteriors.

All rates start at 1.  A step needs one number per domain from the whole table (the
residual), and a document's rate follows from its posterior and the steps so far, so a task
replays the steps on its rows and hands on sums; nothing per document is kept between
steps.  Steps are extrapolated (momentum, dropped where the objective rises) and end where
the projected gradient's norm is under ``OPTIMAL``, or after ``ITERATIONS``.  A target
missed by more than ``TOLERANCE`` is reported by name; the effective number of documents,
the share of documents without a rate and the totals by domain are logged.
The total is set so that the first domain keeps its tokens.

A document's rate becomes copies: its whole part, and one more where a uniform number
made of the id's hash falls below the rest, so expected totals match the targets.

Bounds of the fit: at most ``FIT_DOCS`` labelled documents outside the held-out fold,
in the order of the ids' hash, a fourth of them for calibration.  The model has one
weight per domain and token id of the vocabulary.

Defined cases: a null text counts as empty, has no tokens and gets the prior posterior;
a domain without labelled rows is left out and the others' targets are scaled up;
without labels all documents are of one domain and keep rate 1; repeated rows get the
same rate; a null id draws the number of an empty id; an empty table gives no rows;
other columns are not read and come through ``mix`` as they are.
"""

from __future__ import annotations

import logging
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Logistic, Shipped, fold, fresh, materialise, sample_ids, worker_cache
from .tokens import ChunkEncoder, tokenizer_path

#: (quality, toxic) -> share of the tokens; the first one is the domain that is kept.
TARGETS = {(1, 0): 0.93, (1, 1): 0.05, (0, 0): 0.018, (0, 1): 0.002}
FIT_DOCS = 8_000
#: No document comes more often than this.
MAX_RATE = 8.0
#: Weight of the rates' distance from 1 against the targets.
KEEP = 5e-4
ITERATIONS = 200
#: Norm of the projected gradient, a token-weighted mean over documents, that ends the fit.
OPTIMAL = 3e-5
#: Part of its target by which a domain's total may be off without being reported.
TOLERANCE = 0.02
SEED = 7
_LOG = logging.getLogger("shoreline.mixing")


def _weights(counts: np.ndarray) -> np.ndarray:
    """Log odds of each token and domain against all domains, smoothed (v x k)."""
    total = counts.sum(axis=1)
    base = (total + 0.5) / (total.sum() + 0.5 * len(total))
    prior = 50.0
    p = (counts + prior * base[:, None] * 10) / (counts.sum(axis=0) + prior * 10)
    return np.log(p / base[:, None]).astype(np.float32)


def _features(ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    k = weights.shape[1]
    if not len(ids):
        return np.zeros(2 * k)
    total, best = np.zeros(k), np.full(k, -np.inf, np.float32)
    for at in range(0, len(ids), 1 << 16):
        w = weights[ids[at:at + (1 << 16)]]
        total += w.sum(axis=0)
        best = np.maximum(best, w.max(axis=0))
    return np.concatenate([total / len(ids), best])


class Posterior:
    """Domain posteriors of a document from its token ids."""

    def __init__(self, weights: np.ndarray, models: list[Logistic]):
        self.weights, self.models = weights, models

    def predict(self, codes: list[bytes]) -> np.ndarray:
        x = np.array([_features(np.frombuffer(c, "<u4"), self.weights) for c in codes]).reshape(-1, 2 * self.weights.shape[1])
        p = np.array([m.predict(x) for m in self.models]).T.reshape(-1, len(self.models))
        return p / p.sum(axis=1, keepdims=True)


def _encoder(vocab):
    return worker_cache(("encoder", zlib.crc32(vocab.value.encode())), lambda: ChunkEncoder(vocab.value))


def _vocabulary(spark, path):
    with open(path or tokenizer_path(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, domains: list[tuple[int, int]],
        vocab) -> tuple[Posterior, list[int]]:
    """(posterior model, the domains that have labelled rows)."""
    number = F.lit(None).cast("int")
    for k, (q, t) in enumerate(domains):
        number = F.when((F.col("quality") == q) & (F.col("toxic") == t), k).otherwise(number)
    known = (labels.select(F.col("doc_id"), number.alias("label"))
             .where("doc_id IS NOT NULL AND label IS NOT NULL")
             .groupBy("doc_id").agg(F.min("label").alias("label"))
             .withColumn("fold", fold(F.col("doc_id"))).where("fold <> 0"))
    ids = sample_ids(known, FIT_DOCS, SEED)
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
            .join(F.broadcast(ids), "doc_id"))
    k = len(domains)

    def count(batches):
        encoder, total = _encoder(vocab), None
        for b in batches:
            codes = encoder.encode_many(b.column(1).to_pylist())
            flat = np.concatenate([np.frombuffer(c, "<u4").astype(np.int64) * k + lab
                                   for c, lab in zip(codes, b.column(0).to_pylist(), strict=True)] or [np.zeros(0, int)])
            part = np.bincount(flat, minlength=0)
            if total is None or len(part) > len(total):
                part, total = total, part
            if part is not None:
                total[:len(part)] += part
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    cells = (rows.where("fold <> 1").select("label", "t").mapInArrow(count, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    size = int(cells.cell.max()) // k + 1 if len(cells) else 1
    size = max(size, _encoder(vocab).slow.get_vocab_size())
    counts = np.zeros(size * k)
    counts[cells.cell.to_numpy(np.int64)] = cells.n.to_numpy(float)
    counts = counts.reshape(size, k)
    present = [i for i in range(k) if counts[:, i].any()]
    if not present:
        return Posterior(np.zeros((size, 1), np.float32), [Logistic(np.zeros((1, 2)), [1])]), [0]
    weights = _weights(counts[:, present])

    def measure(batches):
        encoder = _encoder(vocab)
        for b in batches:
            x = [_features(np.frombuffer(c, "<u4"), weights).tolist()
                 for c in encoder.encode_many(b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    id_type = docs.schema[id_col].dataType.simpleString()
    got = (rows.where("fold = 1").select("doc_id", "label", "t")
           .mapInArrow(measure, f"doc_id {id_type}, label int, x array<double>").collect())
    got.sort(key=lambda r: r.doc_id)
    x = np.array([r.x for r in got], float)
    models = [Logistic(x, [r.label == i for r in got]) if len(got) else Logistic(np.zeros((1, 2 * len(present))), [1])
              for i in present]
    return Posterior(weights, models), present


def memberships(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                domains: list[tuple[int, int]] | None = None,
                vocabulary: str | None = None, train: DataFrame | None = None) -> tuple[DataFrame, list[tuple[int, int]]]:
    """((id, h, n_tokens, p array<double>) of every row, the domains of ``p``)."""
    domains = domains or list(TARGETS)
    vocab = _vocabulary(docs.sparkSession, vocabulary)
    model, present = fit(docs if train is None else train, labels, id_col, text_col, domains, vocab)
    shipped = Shipped(docs.sparkSession, model)

    def run(batches):
        encoder, posterior = _encoder(vocab), shipped.value
        for b in batches:
            codes = encoder.encode_many(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(c) // 4 for c in codes], pa.int64()),
                 pa.array(posterior.predict(codes).tolist(), pa.list_(pa.float64()))],
                ["id", "h", "n_tokens", "p"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = (docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, h long, n_tokens long, p array<double>"))
    return materialise(rows, "memberships"), [domains[i] for i in present]


class Steps:
    """The projected-gradient steps so far; replays them on any documents."""

    def __init__(self, keep: float = KEEP, max_rate: float = MAX_RATE):
        self.keep, self.max_rate = keep, max_rate
        self.steps: list[tuple[float, np.ndarray]] = []

    def add(self, momentum: float, slope: np.ndarray) -> None:
        """A step: how far to extrapolate, and the totals' gradient there by domain."""
        self.steps.append((momentum, slope))

    def rates(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rates, rates one step before) of documents with posteriors ``p``."""
        now = before = np.ones(len(p))
        for momentum, slope in self.steps:
            at = now + momentum * (now - before)
            step = (p @ slope + self.keep * (at - 1)) / (1 + self.keep)
            before, now = now, np.clip(at - step, 0.0, self.max_rate)
        return now, before

    def violation(self, p: np.ndarray, rate: np.ndarray, slope: np.ndarray) -> np.ndarray:
        """The projected gradient of the objective at ``rate``, where ``slope`` is that of
        the totals."""
        step = p @ slope + self.keep * (rate - 1)
        return rate - np.clip(rate - step, 0.0, self.max_rate)


class Fit:
    """Targets, what the rates reach, and how much of the corpus they keep."""

    def __init__(self, target, reached, documents, dropped, effective, effective_before, steps, optimal):
        self.target, self.reached = np.asarray(target), np.asarray(reached)
        self.documents, self.dropped = documents, dropped
        self.effective, self.effective_before = effective, effective_before
        self.steps, self.optimal = steps, optimal

    def missed(self, tolerance: float = TOLERANCE) -> list[int]:
        """The domains whose total is off its target by more than ``tolerance``."""
        off = np.abs(self.reached - self.target) > tolerance * np.maximum(self.target, 1e-9 * self.target.sum())
        return [int(i) for i in np.flatnonzero(off)]


def _posteriors(column, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _sums(rows: DataFrame, k: int, steps: Steps, slope: np.ndarray | None = None) -> np.ndarray:
    """Over all documents, at the rates of ``steps``: domain totals, sum of tokens x (rate - 1)^2,
    of tokens x violation^2 (with ``slope``, for the rates one step before), of tokens x rate
    and of its square, documents, those without a rate, and tokens and their squares."""
    def run(batches):
        total = np.zeros(k + 8)
        for b in batches:
            n, p = b.column(0).to_numpy(zero_copy_only=False).astype(float), _posteriors(b.column(1), k)
            rate, before = steps.rates(p)
            off = steps.violation(p, before, slope) if slope is not None else np.zeros(len(n))
            mass = n * rate
            total[:k] += mass @ p
            total[k:] += [n @ (rate - 1) ** 2, n @ off ** 2, mass.sum(), mass @ mass, len(n), (rate == 0).sum(),
                          n.sum(), n @ n]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], [f"s{i}" for i in range(k + 8)])

    names = [f"s{i}" for i in range(k + 8)]
    got = (rows.select("n_tokens", "p").mapInArrow(run, ", ".join(f"{c} double" for c in names))
           .agg(*[F.sum(c) for c in names]).first())
    return np.array([x or 0.0 for x in got])


def fit_rates(rows: DataFrame, weights: list[float], iterations: int = ITERATIONS, optimal: float = OPTIMAL,
              keep: float = KEEP, max_rate: float = MAX_RATE) -> tuple[DataFrame, Fit]:
    """``memberships`` -> (the rows with their rate, what the fit reached)."""
    k = len(weights)
    share = np.array(weights, float) / sum(weights)
    steps = Steps(keep, max_rate)
    first = _sums(rows, k, steps)
    tokens = first[k + 6]
    target = share * (first[0] / share[0] if share[0] else tokens)
    if not tokens:
        return _rated(rows, k, steps), Fit(target, first[:k], int(first[k + 4]), 0, 0.0, 0.0, 0, True)
    gram = _gram(rows, k) / tokens
    gram += np.eye(k) * (1e-9 * np.trace(gram) + 1e-12)
    want = target / tokens

    def slope(totals):
        return np.linalg.solve(gram, totals - want)

    now = before = first[:k] / tokens
    sums, value, pace, momentum, done = first, np.inf, 1.0, 0.0, False
    for _ in range(iterations):
        at = now + momentum * (now - before)
        here = slope(now)
        steps.add(momentum, slope(at))
        new = _sums(rows, k, steps, here)
        # the violation is that of the rates before this step
        if np.sqrt(new[k + 1] / tokens) <= optimal:
            steps.steps.pop()
            done = True
            break
        before, now, sums = now, new[:k] / tokens, new
        rise = 0.5 * (now - want) @ slope(now) + 0.5 * keep * sums[k] / tokens
        if rise > value:
            pace, momentum = 1.0, 0.0
        else:
            faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            pace, momentum = faster, (pace - 1) / faster
        value = rise
    return _rated(rows, k, steps), Fit(target, sums[:k], int(sums[k + 4]), int(sums[k + 5]), sums[k + 2] ** 2 / sums[k + 3]
                                       if sums[k + 3] else 0.0, tokens ** 2 / sums[k + 7], len(steps.steps), done)


def _gram(rows: DataFrame, k: int) -> np.ndarray:
    """Token-weighted second moments of the posteriors."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = rows.agg(*[F.sum(F.col("n_tokens") * F.col("p")[i] * F.col("p")[j]) for i, j in pairs]).first()
    gram = np.zeros((k, k))
    for (i, j), x in zip(pairs, got, strict=True):
        gram[i, j] = gram[j, i] = x or 0.0
    return gram


def _rated(rows: DataFrame, k: int, steps: Steps) -> DataFrame:
    """``rows`` with the rate that the steps lead to."""
    def run(batches):
        for b in batches:
            rate = steps.rates(_posteriors(b.column(b.schema.get_field_index("p")), k))[0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rate)], [*b.schema.names, "rate"])

    return rows.mapInArrow(run, rows.schema.simpleString()[len("struct<"):-1] + ",rate:double")


def copies(rate: Column, doc_id: Column, seed: int = SEED) -> Column:
    """The rate as a whole number of copies that has the rate as its mean over ids."""
    u = (F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed)), F.lit(1 << 30)) + 0.5) / (1 << 30)
    return F.floor(rate + u).cast("long")


def rates(docs: DataFrame, labels: DataFrame, targets: dict[tuple[int, int], float] | None = None,
          id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
          train: DataFrame | None = None) -> DataFrame:
    """One row per document: id, h, n_tokens, p (map domain -> posterior), rate, copies.  The
    posterior is learnt from the labelled rows of ``train`` (``docs`` unless given)."""
    targets = targets or TARGETS
    rows, domains = memberships(docs, labels, id_col, text_col, list(targets), vocabulary, train)
    rows, fit = fit_rates(rows, [targets[d] for d in domains])
    report(fit, domains)
    names = F.array(*[F.lit(f"quality{q}_toxic{t}") for q, t in domains])
    return rows.select("id", "h", "n_tokens", F.map_from_arrays(names, "p").alias("p"), "rate",
                       copies(F.col("rate"), F.col("id")).alias("copies"))


def report(fit: Fit, domains: list[tuple[int, int]]) -> None:
    """Log what a fit reached, with a warning for every target it missed."""
    missed = set(fit.missed())
    for i, ((q, t), want, got) in enumerate(zip(domains, fit.target, fit.reached, strict=True)):
        _LOG.log(logging.WARNING if i in missed else logging.INFO, "quality %s, toxic %s: %.1f of %.1f tokens (%.4f)%s",
                 q, t, got, want, got / want if want else 1, ": target missed" if i in missed else "")
    _LOG.info("%d documents, %d without a rate; effective number %.1f, %.1f before; %d steps%s", fit.documents, fit.dropped,
              fit.effective, fit.effective_before, fit.steps, "" if fit.optimal else ", not at the optimum")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[tuple[int, int], float] | None = None,
        id_col: str = "doc_id", text_col: str = "text", train: DataFrame | None = None) -> DataFrame:
    """The columns of ``docs``, each row as often as its copies say."""
    other = rates(docs, labels, targets, id_col, text_col, train=train).where("copies <> 1").select("id", "h", "copies").distinct()
    other = materialise(other, "copies")
    names = {c: fresh(docs, f"mix_{c}") for c in other.columns}
    other = other.select(*[F.col(c).alias(n) for c, n in names.items()]).hint("shuffle_hash")
    same = F.col(id_col).eqNullSafe(F.col(names["id"])) & (F.xxhash64(F.col(text_col)) == F.col(names["h"]))
    n = F.coalesce(F.col(names["copies"]), F.lit(1)).cast("int")
    times = fresh(docs, "mix_times")
    return (docs.join(other, same, "left").where(n > 0)
            .withColumn(times, F.explode(F.sequence(F.lit(1), n)))
            .drop(times, *names.values()))
