"""Passages that repeat across documents, by a sparse suffix array.

Suffixes are kept at minimisers only: a position is kept if the hash of the ten words there is the least of some run
of 41 positions, so every passage of 50 words holds a kept position and equal passages hold the same ones. Kept
suffixes whose ten words occur in one document only are dropped by their hash. The others are range partitioned and
sorted by their next 50 words (a key in more than one partition is no problem), compared with their neighbours there,
and extended to the right and to the left. Rows that share words to the right beyond these neighbours or beyond a batch
are settled by the hashes of the windows of 50 words that hold the suffix and reach no further to the right than that.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.llm.words import _INVERSE, _P, _powers, mix, slices, word_hashes
from tapework.session import stage_table

MIN_WORDS = 50
SEED_WORDS = 10
#: Sorted neighbours on each side that a suffix is compared with; windows that more rows could share are hashed.
NEIGHBOURS = 8
#: Kept positions inside a run of up to ten words over and over are about this far apart.
RUN_STEP = 20
PERIODS = 10
#: Sorted suffixes that a task holds, about.
ROWS_PER_PART = 200_000
#: Suffixes whose windows are hashed at once.
ROWS_PER_HASH = 4_000


def _slide(values, width, of):
    """Running ``of`` over ``width`` neighbours to the right by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = of(out[:len(out) - step], out[step:])
        have += step
    return out


def minimisers(words, counts, seed=SEED_WORDS, least=MIN_WORDS):
    """(text number, position) of the kept suffixes; texts of fewer than ``least`` words have none."""
    window = least - seed + 1
    n = len(words)
    if n < least:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    h = np.zeros(n - seed + 1, np.uint64)
    for k in range(seed):
        h = mix(h + words[k:n - seed + 1 + k] + np.uint64(k + 1))
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    low = _slide(h, window, np.minimum)
    starts = np.arange(len(low))
    whole = starts + least <= (first + counts)[owner[:len(low)]]
    low = np.where(whole, low, np.uint64(0))
    pad = np.zeros(window - 1, np.uint64)
    seen = _slide(np.concatenate([pad, low, pad]), window, np.maximum)  # at p: the largest minimum of the windows over p
    kept = (seen[:len(h)] == h) & (h > 0)
    place, thinned = np.arange(len(h)), np.zeros(len(h), bool)
    for period in range(1, PERIODS + 1):
        inside = np.zeros(len(h), bool)
        again = h[period:] == h[:-period]
        inside[period:-period] = again[period:] & again[:-period]
        inside &= ~thinned  # a run of one word is one of two words, too
        thinned |= inside
        if inside.any():
            run = place - np.maximum.accumulate(np.where(inside, 0, place))
            kept &= ~inside | (run // period % -(-RUN_STEP // period) == 0)
    at = np.flatnonzero(kept)
    return owner[at], at - first[owner[at]], h[at]


def _anchors(batches):
    for batch in batches:
        for part in slices(batch, 1):
            words, counts = word_hashes(part.column(1))
            owner, at, h = minimisers(words, counts)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), pa.array(at.astype(np.int32)), pa.array(h.view(np.int64))],
                                             ["doc", "at", "seed"])


def _contexts(left, right):
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                words, counts = word_hashes(part.column(2))
                short = np.maximum((words >> np.uint64(32)).astype(np.uint32), 1)  # 0 is beyond the text
                first = np.cumsum(counts) - counts
                places = part.column(3)
                owner = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
                at = places.flatten().to_numpy().astype(np.int64)
                padded = np.concatenate([short, np.zeros(1, np.uint32)])

                def around(steps, at=at, owner=owner, counts=counts, first=first, padded=padded):
                    to = at[:, None] + steps
                    inside = (to >= 0) & (to < counts[owner][:, None])
                    return padded[np.where(inside, to + first[owner][:, None], len(padded) - 1)]

                rows = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(rows), part.column(1).take(rows), pa.array(at.astype(np.int32)),
                     pa.array([x.tobytes() for x in around(np.arange(right))], pa.binary()),
                     pa.array([x.tobytes() for x in around(-1 - np.arange(left))], pa.binary())], ["doc", "doc_id", "at", "right", "left"])
    return run


def _shared(a, b):
    """Words from the start on that rows of a and b share; 0 marks the end of a text."""
    same = (a == b) & (a != 0)
    return np.where(same.all(1), a.shape[1], same.argmin(1))


class _Suffixes:
    """Columns of sorted suffixes as arrays."""

    def __init__(self, batch, width_right, width_left):
        words = lambda c, width: np.frombuffer(b"".join(c.to_pylist()), np.uint32).reshape(-1, width)
        self.doc, self.at = batch.column(0).to_numpy(), batch.column(2).to_numpy().astype(np.int64)
        self.right, self.left = words(batch.column(3), width_right), words(batch.column(4), width_left)
        n = len(self.doc)
        same = (self.right[1:] == self.right[:-1]).all(1) & (self.left[1:] == self.left[:-1]).all(1)
        #: Of each row the first and the last row with the same contexts; rows of a run are in the order of their documents.
        start = np.flatnonzero(np.append(True, ~same)) if n else np.empty(0, np.int64)
        run = np.repeat(np.arange(len(start)), np.diff(np.append(start, n)))
        self.first, self.last = start[run], (np.append(start[1:], n) - 1)[run] if n else start
        self.copied = self.doc[self.first] != self.doc[self.last]

    def extents(self, least, neighbours):
        """Longest (left, right) extension of each row by matches of at least ``least`` words with other documents.

        A row meets its ``neighbours`` on either side, and all rows with the same contexts.
        """
        n = len(self.doc)
        left, right = np.full(n, -1), np.full(n, -1)
        rows = np.arange(n)
        for k in range(1, min(neighbours, n - 1) + 1):
            i, j = rows[k:], rows[k:] - k
            near = (self.doc[i] != self.doc[j]) & (self.right[i, 0] == self.right[j, 0])
            i, j = i[near], j[near]
            r, m = _shared(self.right[i], self.right[j]), _shared(self.left[i], self.left[j])
            good = (r > 0) & (r + m >= least)
            for x in (i[good], j[good]):
                np.maximum.at(left, x, m[good])
                np.maximum.at(right, x, r[good])
        i = rows[self.copied]
        r, m = _shared(self.right[i], self.right[i]), _shared(self.left[i], self.left[i])
        good = r + m >= least
        left[i[good]], right[i[good]] = np.maximum(left[i[good]], m[good]), np.maximum(right[i[good]], r[good])
        return left, right

    def open_windows(self, least, neighbours):
        """(row, start, hash) of the windows of ``least`` words that rows beyond the neighbours could share.

        Such rows share no more words to the right than the last neighbour does, and none are known beyond the first
        and last row; windows that reach further to the right are settled. Of rows with the same contexts in several
        documents, which are spans already, the first and the last stand for all.
        """
        n = len(self.doc)
        rows = np.arange(n)
        rows = rows[~self.copied | (rows == self.first) | (rows == self.last)]
        reach = np.maximum(_shared(self.right[rows], self.right[np.maximum(rows - neighbours, 0)]),
                           _shared(self.right[rows], self.right[np.minimum(rows + neighbours, n - 1)]))
        rows, reach = rows[reach >= SEED_WORDS], reach[reach >= SEED_WORDS]
        before = least - SEED_WORDS
        for lo in range(0, len(rows), ROWS_PER_HASH):
            i = rows[lo:lo + ROWS_PER_HASH]
            near = np.concatenate([self.left[i, :before][:, ::-1], self.right[i, :least]], axis=1).astype(np.uint64)
            powers = _powers(_P, near.shape[1] + 1)
            total = np.zeros((len(i), near.shape[1] + 1), np.uint64)
            np.cumsum(mix(near) * powers[:-1], axis=1, out=total[:, 1:])
            gaps = np.zeros(total.shape, np.int64)
            np.cumsum(near == 0, axis=1, out=gaps[:, 1:])
            hashes = mix((total[:, least:] - total[:, :-least]) * _powers(_INVERSE, before + 1))
            k, j = np.nonzero((gaps[:, least:] == gaps[:, :-least]) & (np.arange(before + 1) + SEED_WORDS <= reach[lo:lo + ROWS_PER_HASH, None]))
            yield i[k], self.at[i[k]] - before + j, hashes[k, j]


_SPANS = "doc long, doc_id long, start int, end int, window long"


def _rows(batch, rows, start, end, window=None):
    window = pa.nulls(len(rows), pa.int64()) if window is None else pa.array(window.view(np.int64))
    take = pa.array(rows)
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(take), batch.column(1).take(take), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), window],
        ["doc", "doc_id", "start", "end", "window"])


def _compare(least, neighbours, width_right, width_left):
    """Spans found among the sorted suffixes of a batch (no ``window``), and windows that other batches or rows beyond
    the neighbours could share, by hash."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            suffixes = _Suffixes(batch, width_right, width_left)
            left, right = suffixes.extents(least, neighbours)
            rows = np.flatnonzero(right >= 0)
            yield _rows(batch, rows, suffixes.at[rows] - left[rows], suffixes.at[rows] + right[rows])
            for rows, start, window in suffixes.open_windows(least, neighbours):
                yield _rows(batch, rows, start, start + least, window)
    return run


def repeated_passages(docs, *, least=MIN_WORDS, neighbours=NEIGHBOURS):
    """Word spans of passages of at least ``least`` words that another document has too.

    One row per maximal covered span: ``doc_id``, ``start_word``, ``end_word`` (exclusive) and ``n_words``; words are
    runs without white space. Documents are told apart by id and text, so rows that repeat both are one document, and
    copies under other ids are repeats. Null and short texts have no spans; documents without a repeat have no row.
    Words are compared by 32-bit hashes, 50 and more in a row, or by a 64-bit hash of these.
    """
    left_words, right_words = least - SEED_WORDS + 1, least
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    base = base.withColumn("doc", F.xxhash64("doc_id", "text"))
    anchors = stage_table(base.select("doc", "text").mapInArrow(_anchors, "doc long, at int, seed long"), "anchors")
    # written, so that both sides of the join are plain shuffles and a frequent seed is split
    shared = stage_table(anchors.groupBy("seed").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo <> hi").select("seed"), "seeds")
    places = anchors.join(shared, "seed", "left_semi").groupBy("doc").agg(F.collect_set("at").alias("places"))
    rows = base.join(places, "doc").select("doc", "doc_id", "text", "places").mapInArrow(
        _contexts(left_words, right_words), "doc long, doc_id long, at int, right binary, left binary")
    parts = max(1, -(-anchors.count() // ROWS_PER_PART))
    found = stage_table(
        rows.repartitionByRange(parts, "right", "left", "doc", "at").sortWithinPartitions("right", "left", "doc", "at")
        .mapInArrow(_compare(least, neighbours, right_words, left_words), _SPANS), "spans")
    windows = found.where("window is not null")
    # written like the seeds
    common = stage_table(windows.groupBy("window").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo <> hi").select("window"), "windows")
    spans = found.where("window is null").drop("window").unionByName(windows.join(common, "window", "left_semi").drop("window"))
    order = Window.partitionBy("doc", "doc_id").orderBy("start", "end")
    islands = (
        spans.groupBy("doc", "doc_id", "start").agg(F.max("end").alias("end"))
        .withColumn("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("island", F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(order))
        .groupBy("doc", "doc_id", "island").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"))
    )
    return islands.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))
