"""Mixing to target weights by soft membership.

A softmax classifier, trained on a bounded sample of a labelled table, gives every document posteriors over domains.
Projected-gradient least squares then finds document rates w >= least whose expected domain totals
T_d = sum_i w_i n_i p_id (n: tokens) match the targets, staying close to 1 where that is free. The gradient of a
document depends on its posteriors and on the residual per domain only, so a step is one aggregation of as many
numbers as there are domains. Rates are written every few steps, and steps since are taken again when rows are read:
the work of a solve grows with its steps, and few tables are written.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapework.llm.features import Encoder, describe, sample_labelled
from tapework.llm.packing import n_words
from tapework.llm.words import slices
from tapework.session import stage_table, unstage

#: Labelled rows that a fit may use.
TRAIN_ROWS = 8_000
#: Weight of staying near rate 1 against the residual; small, so that targets within reach are met.
NEARNESS = 1e-4
STEPS = 80
#: Largest relative residual at which the steps end.
CLOSE = 1e-4
#: Steps after which the rates of all documents are written.
KEEP = 10


class DomainClassifier:
    """Softmax over the features of ``Encoder``; ``domains`` are the label values seen, ascending."""

    def __init__(self, described, labels, *, epochs=40, batch=256, rate=0.05, decay=1e-5, seed=5, least_steps=300):
        epochs = max(epochs, -(-least_steps * batch // max(1, len(labels))))  # small samples get more
        self.domains, y = np.unique(labels, return_inverse=True)
        self.encoder = Encoder(described)
        n = max(1, len(self.domains))
        self.w = np.zeros((self.encoder.size, n))
        share = (np.bincount(y, minlength=n) + 1) / (len(y) + n)
        self.bias = np.log(share)
        random = np.random.default_rng(seed)
        index, value, per = self.encoder.training_rows(described)
        ends = np.cumsum(per)
        first, second, step = np.zeros_like(self.w), np.zeros_like(self.w), 0
        for epoch in range(epochs if len(self.domains) > 1 else 0):
            order = random.permutation(len(y))
            for k in range(0, len(y), batch):
                pick = order[k:k + batch]
                at = np.concatenate([np.arange(ends[i] - per[i], ends[i]) for i in pick])
                wrong = self._softmax(index[at], value[at], per[pick])
                wrong[np.arange(len(pick)), y[pick]] -= 1
                own = np.repeat(wrong / len(pick), per[pick], axis=0) * value[at][:, None]
                grad = np.stack([np.bincount(index[at], own[:, d], len(self.w)) for d in range(n)], 1) + decay * self.w
                step += 1
                first += 0.1 * (grad - first)
                second += 0.001 * (grad * grad - second)
                speed = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                self.w -= speed * first / (np.sqrt(second) + 1e-8)
                self.bias -= 0.2 * rate * wrong.mean(0)

    def _softmax(self, index, value, per):
        margin = np.add.reduceat(self.w[index] * value[:, None], np.cumsum(per) - per, axis=0) + self.bias
        e = np.exp(margin - margin.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def posteriors(self, described):
        if not len(described):
            return np.empty((0, self.w.shape[1]))
        return self._softmax(*self.encoder.rows(described))


def train(docs, labelled, label, rows=TRAIN_ROWS):
    """Classifier of the integer column ``label`` of ``labelled(doc_id, label)``; None if no document is labelled."""
    y, described = sample_labelled(docs, labelled, label, rows)
    if not len(y):
        return None
    return DomainClassifier(described, y)


def _of(model, batch, at):
    return np.concatenate([model.posteriors(describe(part.column(at))) for part in slices(batch, at)] or [np.empty((0, len(model.domains)))])


def posteriors(docs, model):
    """``doc_id``, ``n_tokens`` (words) and the array ``posterior`` over ``model.domains`` of every row."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n_words(text).alias("n_tokens"), text.alias("text"))

    def run(batches):
        for batch in batches:
            p = _of(model, batch, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(p), pa.list_(pa.float64()))],
                                             ["doc_id", "n_tokens", "posterior"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, posterior array<double>")


class Rates:
    """Rates after the steps taken so far, as a function of posteriors: steps of accelerated projected gradient."""

    def __init__(self, scale, step, least, most):
        self.scale, self.step, self.least, self.most, self.residuals = scale, step, least, most, []
        self.pulls, self.t = [], 1.0

    def add(self, residual):
        self.residuals.append(residual)
        t, self.t = self.t, (1 + np.sqrt(1 + 4 * self.t**2)) / 2
        self.pulls.append((t - 1) / self.t)

    def start(self):
        return float(np.clip(1.0, self.least, self.most))

    def advance(self, p, w, ahead, since):
        """Rates ``w`` and the points ``ahead`` of them, both after ``since`` steps, taken through all later steps."""
        for r, pull in zip(self.residuals[since:], self.pulls[since:], strict=True):
            new = np.clip(ahead - self.step * (p @ (r / self.scale) + NEARNESS * (ahead - 1)), self.least, self.most)
            w, ahead = new, new + pull * (new - w)
        return w, ahead

    def final(self, p):
        w = np.full(len(p), self.start())
        return self.advance(p, w, w, 0)[0]


def _matrix(column, domains):
    return column.flatten().to_numpy().reshape(-1, domains)


def _totals(table, columns, weigh, domains):
    """Sum over rows of weigh(p, columns) n p as one array per row kind; ``weigh`` gives several columns.

    Each task sends its own sum, a handful of numbers, and the driver adds these exactly, in whatever order they come. A step is
    then one stage without exchange: no plan to adapt, no threads that wait for exchanges to be written."""
    def run(batches):
        total = None
        for batch in batches:
            n = batch.column(0).to_numpy().astype(float)
            p = _matrix(batch.column(1), domains)
            part = (weigh(p, *[c.to_numpy() for c in batch.columns[2:]]) * n[:, None]).T @ p
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["x"])

    parts = [r.x for r in table.select("n_tokens", "posterior", *columns).mapInArrow(run, "x array<double>").collect()]
    return np.array([math.fsum(x) for x in zip(*parts, strict=True)] or [0.0] * domains).reshape(-1, domains)


def _advanced(state, rates, since, domains):
    """The written table ``state`` with the rates taken through the steps since."""
    def run(batches):
        for batch in batches:
            w, ahead = rates.advance(_matrix(batch.column(1), domains), batch.column(2).to_numpy(), batch.column(3).to_numpy(), since)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(w), pa.array(ahead)],
                                             ["n_tokens", "posterior", "rate", "ahead"])

    return stage_table(state.mapInArrow(run, "n_tokens long, posterior array<double>, rate double, ahead double"), "rates")


def fit_rates(table, domains, targets, *, total=1.0, least=0.0, most=float("inf")):
    """``Rates`` under which the expected domain totals of ``table(n_tokens, posterior)`` match the targets.

    ``targets`` maps a domain to its weight; domains left out weigh 0 and the weights are scaled to sum 1. ``total``
    is the wanted number of tokens as a multiple of the table's. A target out of reach is met as nearly as least
    squares has it. Each domain's residual is scaled by the root of its present total, which makes steps even.
    """
    k = len(domains)
    weights = np.array([float(targets.get(int(d), 0)) for d in domains])
    gram = _totals(table, [], lambda p: p, k)  # sum n p p'; its row sums are the present totals
    now = gram.sum(1) if gram.shape[0] == k else np.zeros(k)
    tokens = now.sum()
    if tokens <= 0 or weights.sum() <= 0:
        return Rates(np.ones(k), 0.0, least, most)
    gram, share = gram / tokens, np.maximum(now / tokens, 1e-9)
    wanted = total * weights / weights.sum()
    root = np.sqrt(share)
    step = 1 / (np.linalg.eigvalsh(gram / np.outer(root, root)).max() + NEARNESS)
    rates = Rates(share, step, least, most)
    state = table.select("n_tokens", "posterior", F.lit(rates.start()).alias("rate"), F.lit(rates.start()).alias("ahead"))
    since, written = 0, None
    for taken in range(STEPS):
        if taken - since == KEEP:
            state, spent = _advanced(state, rates, since, k), written
            since, written = taken, state
            if spent is not None:
                unstage(spent)
        got = _totals(state, ["rate", "ahead"], lambda p, w, ahead: rates.advance(p, w, ahead, since)[1][:, None], k)[0] / tokens
        residual = got - wanted
        if np.abs(residual).max() <= CLOSE * total:
            break
        rates.add(residual)
    if written is not None:
        unstage(written)
    return rates


def mix(docs, model, targets, *, total=1.0, least=0.0, most=float("inf")):
    """``doc_id``, ``n_tokens``, ``posterior`` and ``rate`` of every row of ``docs``, repeated rows each.

    Null and empty texts have no tokens and the posteriors of a text without words; an empty table gives no rows.
    """
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), n_words(F.col("text").cast("string")).alias("n_tokens"),
                           F.lit(None).cast("array<double>").alias("posterior"), F.lit(1.0).alias("rate"))
    k = len(model.domains)
    table = stage_table(posteriors(docs, model), "posteriors")
    rates = fit_rates(table, model.domains, targets, total=total, least=least, most=most)

    def run(batches):
        for batch in batches:
            p = _matrix(batch.column(2), k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates.final(p))], ["doc_id", "n_tokens", "posterior", "rate"])

    return table.mapInArrow(run, "doc_id long, n_tokens long, posterior array<double>, rate double")


def resample(docs, model, targets, **options):
    """Rows of ``docs`` with all their columns, each as often as its rate says: the whole part of the rate, and once
    more if a hash of id and text falls below the rest. Expected totals are those of the rates."""
    if model is None:
        return docs
    table = stage_table(posteriors(docs, model), "posteriors")
    rates = fit_rates(table, model.domains, targets, **options)
    at = docs.columns.index("text")
    draw = (F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).cast("double") / 2.0**64 + 0.5)
    names = docs.columns

    def run(batches):
        for batch in batches:
            times = np.floor(rates.final(_of(model, batch, at)) + batch.column(len(names)).to_numpy()).astype(np.int64)
            yield batch.take(pa.array(np.repeat(np.arange(len(times)), times))).select(list(range(len(names))))

    extra = "_draw"
    while extra in names:
        extra += "_"
    return docs.withColumn(extra, draw).mapInArrow(run, docs.schema)
