"""Runs of word bytes in Arrow text columns: where they lie, and 64-bit ids, without a Python step per word.

All separators used here are ASCII, so UTF-8 can be cut by bytes. Texts longer than a range are cut right after a
separator, which bounds what a task holds beside its batch.
"""

import numpy as np

from tapework.llm.words import _INVERSE, _P, _powers, mix

#: Bytes worked on at once.
RANGE_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(characters):
    """Table of 256 booleans, true at the ASCII ``characters``."""
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


def ranges(raw, offsets, breaks, limit=RANGE_BYTES):
    """Byte ranges (from, to) of about ``limit`` that cover ``raw``: whole texts, or parts of one that end after a
    byte of the class ``breaks``; a stretch without such a byte is a range alone."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + limit, end)
        if to < end:
            last = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            if last > at:
                to = last
            else:
                stop = int(offsets[np.searchsorted(offsets, at, "right")])
                while True:
                    hits = np.flatnonzero(breaks[raw[at:to]])
                    if len(hits):
                        to = at + int(hits[-1]) + 1
                        break
                    if to >= stop:
                        break
                    to = min(to + limit, stop)
        yield at, to
        at = to


def runs(inside, offsets):
    """(starts, ends) of the runs of true bytes in ``inside``; none goes over a text's edge (``offsets``)."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets[(offsets >= 0) & (offsets <= len(inside))]] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def run_ids(raw, starts, ends):
    """64-bit id of each run: equal bytes, equal ids."""
    up, down = _powers(_P, len(raw)), _powers(_INVERSE, len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def cut(raw, starts, ends):
    """The runs as a list of bytes."""
    data = raw.tobytes()
    return [data[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
