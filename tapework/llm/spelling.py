"""Spelling variants: words at an edit distance of one, found by pivotal grams.

The grams of a word are its bigrams with their positions, in one global order from rare to frequent. One edit spoils at
most two bigrams, so of two near words the one whose third gram comes first keeps one of two disjoint grams among its
first three in the other's prefix. Each word's pivots, the two disjoint prefix grams with the fewest words, are chosen by
dynamic programming and looked up among the prefixes of all words, at the positions and lengths that one edit allows.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapework.llm.tokens import LOWER, byte_class, cut, ranges, run_ids, runs
from tapework.llm.words import string_bytes
from tapework.session import stage_table

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form has at least this many times the occurrences of its variant.
FORM_RATIO = 5
#: Runs whose checksum this number divides lose a code point.
SLIP = 199
EDITS = 1
GRAM = 2
#: Runs of more bytes have their checksums taken one by one.
_LONG = 64

_ASCII = byte_class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_BREAKS = ~_ASCII & (np.arange(256) < 128)


def _crc_table():
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(raw, starts, ends, before):
    """crc32 of each run, going on from the checksums ``before`` (one a run)."""
    size = ends - starts
    order = np.argsort(-np.minimum(size, _LONG + 1), kind="stable")
    state, begin, length = (before ^ np.uint32(0xFFFFFFFF))[order], starts[order], size[order]
    live = len(order)
    for j in range(min(int(length[0]), _LONG) if live else 0):
        live = int(np.searchsorted(-length[:live], -j, "left"))
        byte = raw[begin[:live] + j]
        state[:live] = _CRC[(state[:live] ^ byte) & np.uint32(255)] ^ (state[:live] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > _LONG):
        out[i] = zlib.crc32(raw[starts[i]:ends[i]].tobytes(), int(before[i]))
    return out


def _words(least_length, slip):
    """(doc_id, text) → (word, n): words of a range of texts with their counts, after the slips."""
    def run(batches):
        for batch in batches:
            raw, offsets = string_bytes(batch.column(1))
            seeds = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in batch.column(0).to_pylist()], np.uint32)
            for lo, hi in ranges(raw, offsets, _BREAKS):
                low = LOWER[raw[lo:hi]]
                lead = low == 0xC3
                starts, ends = runs(_ASCII[low] | lead | np.concatenate([[False], lead[:-1]]), offsets - lo)
                # code points: bytes without those that only go on
                points = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
                points = points[ends] - points[starts]
                fit = points >= least_length
                starts, ends, points = starts[fit], ends[fit], points[fit]
                if not len(starts):
                    continue
                row = np.searchsorted(offsets, starts + lo, "right") - 1
                slips = checksums(low, starts, ends, seeds[row])
                slipped = slips % np.uint32(slip) == 0
                s, e = starts[~slipped], ends[~slipped]
                _, first, count = np.unique(run_ids(low, s, e), return_index=True, return_counts=True)
                found, n = cut(low, s[first], e[first]), count.tolist()
                for word, h in zip(cut(low, starts[slipped], ends[slipped]), slips[slipped].tolist()):
                    word = word.decode()
                    at = h % len(word)
                    if len(word) > least_length:
                        found.append((word[:at] + word[at + 1:]).encode())
                        n.append(1)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["word", "n"])
    return run


def vocabulary(docs, *, least_length=LEAST_LENGTH, least_count=LEAST_COUNT, slip=SLIP):
    """``word``, ``n``: letter runs of all texts after the slips, of at least ``least_length`` code points and
    ``least_count`` occurrences. A null doc_id counts as an empty one, a null text has no words."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = rows.mapInArrow(_words(least_length, slip), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def pivots(grams, cost, picks=EDITS + 1, size=GRAM):
    """``picks`` disjoint grams of least total cost. ``grams`` are (position, gram) by position, ``cost`` a list by gram.

    ``best[m][j]``: least cost of m disjoint grams among the first j, and the last one taken.
    """
    n = len(grams)
    best = [[(0, None)] * (n + 1)] + [[(float("inf"), None)] * (n + 1) for _ in range(picks)]
    clear = [sum(q + size <= p for q, _ in grams[:j]) for j, (p, _) in enumerate(grams)]
    for m in range(1, picks + 1):
        for j in range(1, n + 1):
            take = best[m - 1][clear[j - 1]][0] + cost[grams[j - 1][1]]
            best[m][j] = (take, j - 1) if take < best[m][j - 1][0] else best[m][j - 1]
    chosen, j = [], n
    for m in range(picks, 0, -1):
        j = best[m][j][1]
        chosen.append(grams[j])
        j = clear[j]
    return chosen[::-1]


def prefix(grams, edits=EDITS, size=GRAM):
    """The grams up to the (edits * size + 1)th in global order and all that tie with it, by position; ``grams`` are
    (position, rank)."""
    least = sorted(g for _, g in grams)
    last = least[min(edits * size, len(least) - 1)]
    return [(p, g) for p, g in grams if g <= last], last


_KEYS = pa.schema([("word", pa.string()), ("n", pa.int64()), *((c, pa.int32()) for c in ("size", "last", "at", "gram")), ("is_pivot", pa.bool_())])


def _keys(order):
    """(word, n) → rows (word, n, size, last, at, gram, is_pivot): prefix grams, and pivots at the places of one edit."""
    def run(batches):
        rank, cost = order.value
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, last = prefix([(i, rank[word[i:i + GRAM]]) for i in range(len(word) - GRAM + 1)])
                size = len(word)
                rows += [(word, n, size, last, p, g, False) for p, g in held]
                # what a pivot at p can meet: the same place at any size, and one place on where the size moves so too
                rows += [(word, n, size + d, last, p + s, g, True) for p, g in pivots(held, cost) for d in (-1, 0, 1) for s in {0, d}]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _KEYS)], schema=_KEYS)
    return run


def near_pairs(words):
    """``word``, ``near`` and both counts of every ordered pair at a distance of exactly one. ``words(word, n)`` must be
    distinct words of four code points or more."""
    spark = words.sparkSession
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - (GRAM - 1)), lambda i: F.substring("word", i, F.lit(GRAM)))).alias("g"))
    # letters are a-z and 64 more, so there are at most 90 * 90 grams
    held = grams.groupBy("g").agg(F.count(F.lit(1)).alias("f")).orderBy("f", "g").collect()
    order = spark.sparkContext.broadcast(({r.g: i for i, r in enumerate(held)}, [r.f for r in held]))
    keys = stage_table(words.select("word", "n").mapInArrow(
        _keys(order), "word string, n long, size int, last int, at int, gram int, is_pivot boolean"), "grams")
    asked = keys.where("is_pivot").drop("is_pivot")
    index = keys.where("not is_pivot").select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), "size", "at", "gram", F.col("last").alias("near_last"))
    one_edit = F.levenshtein("word", "near", EDITS) == EDITS
    found = asked.join(index, ["gram", "at", "size"]).where((F.col("last") <= F.col("near_last")) & one_edit)
    both = found.select(F.inline(F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))))
    return both.distinct()


def variants(docs, *, ratio=FORM_RATIO, **options):
    """Per word of ``vocabulary``: ``form``, its near word of most occurrences (ties: the first in code-point order) if it has
    ``ratio`` times the word's, else null; ``root``, the last of the forms from the word on; ``n``, ``n_near``, ``form_n``.

    Nulls as in ``vocabulary``; repeated rows count each, an empty table gives no rows, texts of any length are worked on
    in ranges, other columns stay out.
    """
    words = stage_table(vocabulary(docs, **options), "vocabulary")
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    kept = -F.col("best.less") >= ratio * F.col("n")
    rows = stage_table(words.join(near, "word", "left").select(
        "word", F.when(kept, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(kept, -F.col("best.less")).alias("form_n")), "forms")
    return rows.join(roots(rows.where("form is not null").select("word", "form"), ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms, ratio=FORM_RATIO):
    """``word``, ``root`` of every word that has a form. Counts rise ``ratio``-fold along a chain, so chains have no circles
    and at most 27 links (counts of 63 bits); links double in length each round until none gets longer."""
    links = stage_table(forms.select("word", F.col("form").alias("root")), "links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = stage_table(links.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "links")
        if longer.where("_moved").isEmpty():
            return longer.select("word", "root")
        links = longer.select("word", "root")
