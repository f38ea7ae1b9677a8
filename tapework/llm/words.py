"""Words of Arrow text columns as 64-bit hashes, a batch at a time."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
#: Texts handled at once: bounds what a task holds beside its batch.
SLICE = 256
SLICE_BYTES = 4 << 20


def mix(h):
    """Spread the bits of 64-bit values (finaliser of a multiply-xor hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base, n):
    out = np.ones(1, np.uint64)
    factor = base
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(factor)])
        factor = factor * factor % (1 << 64)
    return out[:n]


def string_bytes(strings):
    """(bytes, offsets) of an Arrow string array, offsets from 0."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    if not len(strings):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = strings.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def string_hashes(strings):
    """64-bit hash of each string: a polynomial in its bytes by prefix sums, then mixed. Equal strings, equal hashes."""
    raw, offsets = string_bytes(strings)
    powers = _powers(_P, len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=total[1:])
    start, end = offsets[:-1], offsets[1:]
    return mix((total[end] - total[start]) * _powers(_INVERSE, len(raw) + 1)[start])


def word_lists(texts):
    """(flat Arrow array of the words, number of words of each text); words are runs without white space."""
    lists = pc.utf8_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat = lists.flatten()
    counts = np.diff(lists.offsets.to_numpy())
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[full], minlength=len(counts))
        flat = flat.filter(pa.array(full))
    return flat, counts


def word_hashes(texts):
    """(hash of every word, number of words of each text)."""
    flat, counts = word_lists(texts)
    return string_hashes(flat), counts


def slices(batch, column=0):
    """The batch in runs of at most ``SLICE`` rows and about ``SLICE_BYTES`` of text; a longer text is a run alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (i - start >= SLICE or held + n > SLICE_BYTES):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield batch.slice(start)
