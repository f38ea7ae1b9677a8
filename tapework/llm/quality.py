"""Quality classifier: a factorisation machine over hashed words, structure statistics and lengths.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): all pairwise interactions in
time linear in the features. It is trained in numpy on a bounded sample of labelled texts and applied to whole texts
by the executors. Labels, language, source and id are no features.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapework.llm.features import Encoder, describe, sample_labelled
from tapework.llm.words import slices

#: Labelled rows that a fit may use.
TRAIN_ROWS = 8_000
RANK = 8
KEEP = 0.7


def held_out(doc_id="doc_id"):
    """Rows whose labels no fit sees: crc32 of the id's text modulo 4 is 2 (never for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class FactorisationMachine:
    """Weights and factors over an ``Encoder``'s features; ``describe`` output in, scores out."""

    def __init__(self, encoder, rank=RANK, seed=7):
        random = np.random.default_rng(seed)
        self.encoder = encoder
        self.bias = 0.0
        self.w = np.zeros(encoder.size)
        self.v = random.normal(0, 0.05, (encoder.size, rank))

    def _margin(self, index, value, lengths):
        starts = np.cumsum(lengths) - lengths
        vx = self.v[index] * value[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx**2).sum(1), starts)
        linear = np.add.reduceat(self.w[index] * value, starts)
        return self.bias + linear + 0.5 * ((sums**2).sum(1) - squares), sums

    def score(self, described):
        if not len(described):
            return np.empty(0)
        margin, _ = self._margin(*self.encoder.rows(described))
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))

    def fit(self, described, y, epochs=12, batch=256, rate=0.05, decay=1e-4, seed=11, least_steps=300):
        """Logistic loss, Adam over shuffled batches; small samples get more epochs. One class only, or no rows: the
        prior is the score."""
        epochs = max(epochs, -(-least_steps * batch // max(1, len(y))))
        share = (y.sum() + 1) / (len(y) + 2)
        self.bias = float(np.log(share / (1 - share)))
        if len(np.unique(y)) < 2:
            self.v[:] = 0
            return self
        random = np.random.default_rng(seed)
        params = [self.w, self.v]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        features, values, per_row = self.encoder.training_rows(described)
        ends = np.cumsum(per_row)
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(y))
            for k in range(0, len(y), batch):
                pick = order[k:k + batch]
                lengths = per_row[pick]
                at = np.concatenate([np.arange(ends[i] - per_row[i], ends[i]) for i in pick])
                index, value = features[at], values[at]
                margin, sums = self._margin(index, value, lengths)
                wrong = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y[pick]) / len(pick)
                own = np.repeat(wrong, lengths) * value
                grads = [np.bincount(index, own, len(self.w)) + decay * self.w]
                pull = own[:, None] * (np.repeat(sums, lengths, axis=0) - self.v[index] * value[:, None])
                grads.append(np.stack([np.bincount(index, pull[:, f], len(self.w)) for f in range(self.v.shape[1])], 1) + decay * self.v)
                step += 1
                speed = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for p, g, m, s in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= speed * m / (np.sqrt(s) + 1e-8)
                self.bias -= 0.2 * rate * wrong.sum()
        return self


def train(docs, labels, *, label="quality", rows=TRAIN_ROWS, usable=None):
    """Fit on at most ``rows`` labelled documents, by default none of the held-out ones."""
    known = labels.where(~held_out() if usable is None else usable)
    y, described = sample_labelled(docs, known, label, rows)
    return FactorisationMachine(Encoder(described)).fit(described, (y > 0).astype(float))


def _scores(model, batch, at):
    return np.concatenate([model.score(describe(part.column(at))) for part in slices(batch, at)] or [np.empty(0)])


def score(docs, model):
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (score of at least 0.7) of every row; a null text counts
    as empty, and empty texts are scored as texts without words."""
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            s = _scores(model, batch, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= KEEP).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return columns.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs, model, least=KEEP):
    """Rows of ``docs`` that score at least ``least``, with all their columns as they are."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch, at) >= least))

    return docs.mapInArrow(run, docs.schema)
