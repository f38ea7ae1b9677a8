"""Hashed words and structure statistics of whole texts, for the linear-time classifiers of this package."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tapework.llm.words import slices, string_bytes, string_hashes, word_lists

WORD_BITS = 18
STATS = ("log_chars", "log_words", "mean_word", "distinct_share", "top_share", "line_words", "repeated_lines",
         "upper", "digit", "stop", "symbol", "high_byte", "spaces")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?!", b"#$%&*|<>=+^~@_\\/{}[]", b" \t\r\n"), 1):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 6


class Described:
    """Distinct hashed words (bucket, count) of several texts, one after the other, and their statistics."""

    def __init__(self, buckets, counts, lengths, stats):
        self.buckets, self.counts, self.lengths, self.stats = buckets, counts, lengths, stats

    def __len__(self):
        return len(self.lengths)

    def part(self, first, last):
        """Texts ``first`` to ``last`` (exclusive)."""
        ends = np.concatenate([[0], np.cumsum(self.lengths)])
        words = slice(ends[first], ends[min(last, len(self))])
        return Described(self.buckets[words], self.counts[words], self.lengths[first:last], self.stats[first:last])


def _per_text(values, lengths, of=np.add):
    """Sum (or maximum) of each text's values; 0 for texts without any."""
    out = np.zeros(len(lengths))
    full = lengths > 0
    if full.any():
        out[full] = of.reduceat(values, (np.cumsum(lengths) - lengths)[full], dtype=np.int64 if of is np.add else None)
    return out


def describe(texts):
    """``Described`` of an Arrow column of texts. Words count without case and outer punctuation; a text without
    words (empty or null) has none, and all its statistics are 0."""
    texts = texts.cast(pa.large_string()).fill_null("")
    flat, n_words = word_lists(texts)
    core = pc.utf8_trim(pc.utf8_lower(flat), _EDGE)
    bucket = (string_hashes(core) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    named = pc.greater(pc.binary_length(core), 0).to_numpy(zero_copy_only=False)
    key, counts = np.unique((owner[named] << WORD_BITS) | bucket[named], return_counts=True)
    lengths = np.bincount(key >> WORD_BITS, minlength=len(n_words))
    raw, offsets = string_bytes(texts)
    size = np.diff(offsets)
    kinds = _CLASS[raw]
    shares = [_per_text(kinds == k, size) / np.maximum(size, 1) for k in (1, 2, 3, 4, 6, 5)]
    lists = pc.split_pattern(texts, "\n")
    line = string_hashes(lists.flatten())
    line_owner = np.repeat(np.arange(len(size)), np.diff(lists.offsets.to_numpy()))
    lines = np.bincount(line_owner, minlength=len(size))
    order = np.lexsort((line, line_owner))
    fresh = np.ones(len(line), bool)
    fresh[1:] = (np.diff(line[order]) != 0) | (np.diff(line_owner[order]) != 0)
    distinct_lines = np.bincount(line_owner[order][fresh], minlength=len(size))
    n = np.maximum(n_words, 1)
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    stats = np.stack([
        np.log1p(chars), np.log1p(n_words), chars / n, lengths / n, _per_text(counts, lengths, np.maximum) / n,
        np.log1p(n / np.maximum(lines, 1)), 1 - distinct_lines / np.maximum(lines, 1), *shares], 1)
    return Described(key & ((1 << WORD_BITS) - 1), counts, lengths, stats * (n_words > 0)[:, None])


def join_described(parts):
    return Described(*(np.concatenate([getattr(p, x) for p in parts]) for x in ("buckets", "counts", "lengths", "stats")))


def sample_labelled(docs, labelled, label, bound):
    """At most ``bound`` labelled documents, the first by a hash of ``doc_id``: (labels, ``Described``).

    ``labelled`` has ``doc_id`` and the column ``label``; rows without either are out, and of conflicting labels of a
    document the least counts, as does the text of the least hash of those that share an id. The executors describe the
    texts; the driver gets bounded numbers in a fixed order.
    """
    chosen = (
        labelled.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("_label")).dropna()
        .groupBy("_id").agg(F.min("_label").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(bound)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text")).join(
        F.broadcast(chosen), "_id")  # `bound` pairs of numbers at most
    rows = rows.groupBy("_id", "_label").agg(F.min(F.struct(F.xxhash64("_text").alias("_hash"), "_text")).alias("_least")).select("_id", "_label", "_least.*")

    def extract(batches):
        for batch in batches:
            for part in slices(batch, 3):
                d = describe(part.column(3))
                ends = pa.array(np.concatenate([[0], np.cumsum(d.lengths)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.ListArray.from_arrays(ends, pa.array(d.buckets.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(d.counts.astype(np.int32))), pa.array(list(d.stats), pa.list_(pa.float64()))],
                    ["id", "label", "hash", "buckets", "counts", "stats"])

    found = rows.mapInArrow(extract, "id long, label int, hash long, buckets array<int>, counts array<int>, stats array<double>").toArrow()
    found = found.sort_by([("id", "ascending"), ("hash", "ascending")]).combine_chunks()
    if not found.num_rows:
        empty = np.empty(0, np.int64)
        return empty, Described(empty, empty, empty, np.empty((0, len(STATS))))
    words, counts, stats = (found[x].combine_chunks() for x in ("buckets", "counts", "stats"))
    labels, described = found["label"].to_numpy().astype(np.int64), Described(
        words.flatten().to_numpy().copy(), counts.flatten().to_numpy().copy(), np.diff(words.offsets.to_numpy()).astype(np.int64),
        stats.flatten().to_numpy().reshape(-1, len(STATS)).copy())
    # the numbers are copied, so that Arrow can give back what the collected batches and their sorting took
    del found, words, counts, stats
    pa.default_memory_pool().release_unused()
    return labels, described


class Encoder:
    """Sparse features: a value per word bucket seen in enough training texts, and a one-hot bin per statistic.

    Each row ends with its bins, so texts without words have features too.
    """

    def __init__(self, sample, least_texts=4, bins=12):
        seen = np.bincount(sample.buckets, minlength=1 << WORD_BITS)
        active = np.flatnonzero(seen >= least_texts)
        self.slot = np.full(1 << WORD_BITS, -1, np.int32)
        self.slot[active] = np.arange(len(active))
        self.n_words, self.bins = len(active), bins
        grid = np.linspace(0, 1, bins + 1)[1:-1]
        self.edges = np.quantile(sample.stats, grid, axis=0) if len(sample) else np.zeros((bins - 1, len(STATS)))
        self.size = self.n_words + bins * len(STATS)

    def rows(self, d):
        """(feature, value, features of each row) of all texts of ``d``."""
        owner = np.repeat(np.arange(len(d)), d.lengths)
        slot = self.slot[d.buckets]
        known = slot >= 0
        owner, slot = owner[known], slot[known].astype(np.int64)
        value = 1 + np.log(d.counts[known])
        norm = np.sqrt(np.bincount(owner, value**2, len(d)))
        value = 4 * value / np.maximum(norm, 8)[owner]
        bins = (self.edges[None] < d.stats[:, None, :]).sum(1) + np.arange(len(STATS)) * self.bins + self.n_words
        owner = np.concatenate([owner, np.repeat(np.arange(len(d)), len(STATS))])
        order = owner.argsort(kind="stable")
        index = np.concatenate([slot, bins.ravel()])[order]
        value = np.concatenate([value, np.full(bins.size, 0.3)])[order]
        return index, value, np.bincount(owner, minlength=len(d))

    def training_rows(self, d, step=256):
        """``rows`` of a whole sample in 32 bits, made in parts."""
        kinds = (np.int32, np.float32, np.int64)
        got = [[x.astype(t) for x, t in zip(self.rows(d.part(k, k + step)), kinds, strict=True)] for k in range(0, len(d), step)]
        return tuple(np.concatenate([g[k] for g in got] or [np.empty(0, t)]) for k, t in enumerate(kinds))
