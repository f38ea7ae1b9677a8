"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF on top.

The network is trained in numpy from labelled spans of a bounded sample of documents. Texts are decoded in windows that
overlap by half. Each character is decided by the window in whose middle it lies, and spans are assembled over the
whole text, so none ends at a window's edge. A span must hold a digit or an at sign; windows without either cannot add
one and are not decoded.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tapework.llm.words import slices

#: Documents whose spans a fit may use, windows among them, and characters in a window.
TRAIN_DOCS = 6_000
TRAIN_WINDOWS = 1_500
WINDOW = 96
HIDDEN = 16
#: Kinds in the order of a tie, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = "[0-9@]"
#: Characters with an input class of their own; the rest share classes by kind.
_OWN = "@.+-_%() \n:;,/<>\"'="
_TAGS = 1 + 2 * len(KINDS)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        x = x * 2 if i % 2 else x
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(text):
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text):
    """Leftmost matches in linear time: each at sign takes the run of local characters before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text):
    """(start, number of the kind, end) of the fixed patterns, sorted; leftmost and not overlapping within a kind."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def written(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _classes():
    """Input class of each character below 128; the class after them is for all others, the last for padding."""
    out = np.full(129, len(_OWN) + 3, np.int64)
    for i, c in enumerate(_OWN):
        out[ord(c)] = i
    out[ord("a"):ord("z") + 1] = len(_OWN)
    out[ord("A"):ord("Z") + 1] = len(_OWN) + 1
    out[ord("0"):ord("9") + 1] = len(_OWN) + 2
    out[128] = len(_OWN) + 4
    return out


CLASSES = _classes()
PADDING = len(_OWN) + 5
INPUTS = PADDING + 1


def _codes(text):
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CLASSES[np.minimum(points, 128)]


def windows(codes, starts, width=WINDOW):
    """Codes from each start on, padded where they lie beyond the text."""
    to = np.asarray(starts)[:, None] + np.arange(width)
    inside = (to >= 0) & (to < len(codes))
    return np.where(inside, codes[np.clip(to, 0, max(0, len(codes) - 1))], PADDING) if len(codes) else np.full(to.shape, PADDING)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _log_sum(x, axis):
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Tagger:
    """BiLSTM-CRF over windows of character classes; tags are 0 outside, 1 + 2k at the start and 2 + 2k inside kind k."""

    def __init__(self, hidden=HIDDEN, seed=3):
        random = np.random.default_rng(seed)
        h = hidden
        self.p = {"out": random.normal(0, 0.1, (2 * h, _TAGS)), "bias": np.zeros(_TAGS), "move": np.zeros((_TAGS, _TAGS)), "first": np.zeros(_TAGS)}
        for d in "fb":
            self.p |= {f"x{d}": random.normal(0, 0.2, (INPUTS, 4 * h)), f"h{d}": random.normal(0, 0.2, (h, 4 * h)), f"c{d}": np.zeros(4 * h)}
            self.p[f"c{d}"][h:2 * h] = 1.0

    def _lstm(self, x, d, keep):
        n, steps = x.shape
        wx, wh, c0 = self.p[f"x{d}"], self.p[f"h{d}"], self.p[f"c{d}"]
        size = wh.shape[0]
        h, c = np.zeros((n, size), wh.dtype), np.zeros((n, size), wh.dtype)
        out, trace = np.empty((n, steps, size), wh.dtype), []
        table = wx + c0
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = table[x[:, t]] + h @ wh
            gates = _sigmoid(z[:, :3 * size])
            i, f, o = gates[:, :size], gates[:, size:2 * size], gates[:, 2 * size:]
            g = np.tanh(z[:, 3 * size:])
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep:
                trace.append((t, h, c, i, f, o, g, squashed))
            h, c = o * squashed, new
            out[:, t] = h
        return out, trace

    def emissions(self, x, keep=False):
        (f, tf), (b, tb) = self._lstm(x, "f", keep), self._lstm(x, "b", keep)
        both = np.concatenate([f, b], 2)
        return both @ self.p["out"] + self.p["bias"], both, (tf, tb)

    def decode(self, x):
        """Best tag sequence of each window."""
        e, _, _ = self.emissions(x)
        move = self.p["move"]
        score, back = e[:, 0] + self.p["first"], []
        for t in range(1, x.shape[1]):
            paths = score[:, :, None] + move
            back.append(paths.argmax(1))
            score = paths.max(1) + e[:, t]
        tags = np.empty(x.shape, np.int64)
        tags[:, -1] = score.argmax(1)
        for t in range(x.shape[1] - 2, -1, -1):
            tags[:, t] = np.take_along_axis(back[t], tags[:, t + 1][:, None], 1)[:, 0]
        return tags

    def gradient(self, x, y):
        """(mean loss, its gradient by parameter) of the negative log-likelihood of tags ``y``."""
        n, steps = x.shape
        e, both, traces = self.emissions(x, keep=True)
        move, first = self.p["move"], self.p["first"]
        ahead = [e[:, 0] + first]
        for t in range(1, steps):
            ahead.append(_log_sum(ahead[-1][:, :, None] + move, 1) + e[:, t])
        behind = [np.zeros((n, _TAGS))]
        for t in range(steps - 1, 0, -1):
            behind.append(_log_sum(move + (e[:, t] + behind[-1])[:, None, :], 2))
        behind = behind[::-1]
        total = _log_sum(ahead[-1], 1)
        rows = np.arange(n)
        gold = first[y[:, 0]] + e[rows[:, None], np.arange(steps), y].sum(1) + move[y[:, :-1], y[:, 1:]].sum(1)
        de = np.exp(np.stack(ahead, 1) + np.stack(behind, 1) - total[:, None, None])
        grad = {"first": de[:, 0].sum(0), "move": np.zeros_like(move)}
        for t in range(1, steps):
            grad["move"] += np.exp(ahead[t - 1][:, :, None] + move + (e[:, t] + behind[t])[:, None, :] - total[:, None, None]).sum(0)
        np.add.at(grad["move"], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        np.add.at(grad["first"], y[:, 0], -1)
        de[rows[:, None], np.arange(steps), y] -= 1
        flat = de.reshape(-1, _TAGS)
        grad["out"], grad["bias"] = both.reshape(-1, both.shape[2]).T @ flat, flat.sum(0)
        dh_all = de @ self.p["out"].T
        size = both.shape[2] // 2
        for d, trace, part in (("f", traces[0], dh_all[:, :, :size]), ("b", traces[1], dh_all[:, :, size:])):
            wh = self.p[f"h{d}"]
            gx, gh = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(wh)
            dh, dc = np.zeros((n, size)), np.zeros((n, size))
            for t, h, c, i, f, o, g, squashed in reversed(trace):
                dh = dh + part[:, t]
                dc = dc + dh * o * (1 - squashed**2)
                dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], 1)
                gh += h.T @ dz
                np.add.at(gx, x[:, t], dz)
                dh, dc = dz @ wh.T, dc * f
            grad |= {f"x{d}": gx, f"h{d}": gh, f"c{d}": gx.sum(0)}
        return float((total - gold).mean()), {k: v / n for k, v in grad.items()}

    def fit(self, x, y, *, epochs=14, batch=48, rate=0.02, seed=9):
        """Adam over shuffled batches of windows."""
        random = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(x))
            for k in range(0, len(x), batch):
                _, grad = self.gradient(x[order[k:k + batch]], y[order[k:k + batch]])
                norm = np.sqrt(sum((g**2).sum() for g in grad.values()))
                step += 1
                speed = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for name, g in grad.items():
                    g = g * min(1.0, 5 / (norm + 1e-9))
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.001 * (g * g - second[name])
                    self.p[name] -= speed * first[name] / (np.sqrt(second[name]) + 1e-8)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return self


def tags_of(length, spans):
    """Tag of each character; of overlapping spans the earlier start wins, then the earlier kind."""
    out = np.zeros(length, np.int64)
    for s, k, e in spans:
        if not out[s:e].any():
            out[s:e] = 2 + 2 * k
            out[s] = 1 + 2 * k
    return out


def train(docs, spans_of=base_spans, *, rows=TRAIN_DOCS, most=TRAIN_WINDOWS):
    """``Tagger`` fitted on windows around the labelled spans of at most ``rows`` documents, the first with a trigger
    by a hash of the id, and on as many windows around triggers outside them. ``spans_of`` labels a text. None if the
    sample has no span.
    """
    ids = docs.where(F.col("text").cast("string").rlike(TRIGGER)).select(F.col("doc_id").cast("long").alias("_id")).dropna().distinct().orderBy(
        F.xxhash64("_id"), "_id").limit(rows)
    given = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "_id")
    texts = given.groupBy("_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def cut(batches):
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                spans = spans_of(text or "")
                codes, tags = _codes(text or ""), tags_of(len(text or ""), spans)
                starts = [s - (17 * (s + 1) + doc) % (WINDOW // 2) - 4 for s, _, _ in spans]
                outside = [m.start() for m in re.finditer(TRIGGER, text or "") if not tags[m.start()]][::16]
                starts += [s - WINDOW // 2 for s in outside[:len(spans) + 1]]
                if starts:
                    x = windows(codes, starts)
                    y = np.where(x == PADDING, 0, windows(tags, starts)) if len(tags) else np.zeros_like(x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), doc)), pa.array(starts, pa.int64()), pa.array(list(x.astype(np.int32)), pa.list_(pa.int32())),
                         pa.array(list(y.astype(np.int32)), pa.list_(pa.int32()))], ["doc", "start", "x", "y"])

    order = [F.xxhash64("doc", "start"), "doc", "start"]
    found = texts.select("_id", "text").mapInArrow(cut, "doc long, start long, x array<int>, y array<int>").orderBy(*order).limit(most).toArrow()
    if not found.num_rows:
        return None
    x, y = (found[c].combine_chunks().flatten().to_numpy().reshape(-1, WINDOW).astype(np.int64) for c in ("x", "y"))
    return Tagger().fit(x, y) if y.any() else None


def _assembled(text, tags):
    """Runs of one kind's tags as spans, without outer white space and stops. A span must hold a trigger and may not
    cut a word or a number in two."""
    kind = (tags + 1) // 2
    edge = np.flatnonzero(np.diff(kind, prepend=0, append=0) | np.concatenate([(tags % 2 == 1) & (tags > 0), [False]]))
    for s, e in zip(edge[:-1], edge[1:], strict=True):
        if not kind[s]:
            continue
        while s < e and text[s] in " \n\t.,;":
            s += 1
        while s < e and text[e - 1] in " \n\t.,;":
            e -= 1
        cut = text[s - 1:s + 1].isalnum() and s > 0 or text[e - 1:e + 1].isalnum() and e < len(text)
        if e - s >= 5 and not cut and re.search(TRIGGER, text[s:e]):
            yield int(s), int(kind[min(s, len(kind) - 1)] - 1), int(e)


def decode(texts, tagger, most=2_048):
    """Spans of the network in each text: windows of all texts are decoded together, at most ``most`` at once."""
    half, quarter = WINDOW // 2, WINDOW // 4
    codes = [_codes(t) for t in texts]
    owner, piece = [], []
    for i, t in enumerate(texts):
        at = np.array([m.start() for m in re.finditer(TRIGGER, t)], np.int64)
        # window k owns [half k, half (k + 1)) and sees a quarter more on either side
        near = np.unique(np.concatenate([(at - quarter) // half, (at + quarter) // half, at // half])) if len(at) else at
        near = near[(near >= 0) & (near * half < len(t))]
        owner.append(np.full(len(near), i))
        piece.append(near)
    owner, piece = np.concatenate(owner or [np.empty(0, np.int64)]), np.concatenate(piece or [np.empty(0, np.int64)])
    tags = [np.zeros(len(t), np.int64) for t in texts]
    for k in range(0, len(owner), most):
        rows = range(k, min(k + most, len(owner)))
        x = np.concatenate([windows(codes[owner[r]], [piece[r] * half - quarter]) for r in rows])
        for r, best in zip(rows, tagger.decode(x), strict=True):
            into = tags[owner[r]][piece[r] * half:(piece[r] + 1) * half]
            into[:] = best[quarter:quarter + len(into)]
    return [list(_assembled(t, g)) if g.any() else [] for t, g in zip(texts, tags, strict=True)]


def all_spans(texts, tagger):
    """(base spans, all spans) of each text: the network adds what overlaps no base span."""
    base = [base_spans(t) for t in texts]
    added = decode(texts, tagger) if tagger else [[] for _ in texts]
    for spans, more in zip(base, added, strict=True):
        taken = sorted((s, e) for s, _, e in spans)
        yield spans, sorted(spans + [x for x in more if not any(s < x[2] and x[0] < e for s, e in taken)])


_NOTHING = hashlib.sha256(b"").hexdigest()


def scan(docs, tagger):
    """Per row of ``docs``: ``doc_id``, base matches by kind (``n_email``, ``n_ip``, ``n_card``, ``n_phone``),
    ``base_sha256`` of the base spans' text and ``spans``, all spans as ``kind:start:end`` in code points.

    Null and empty texts have no spans, repeated rows are scanned each, other columns stay out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = [f"n_{k}" for k in KINDS]

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                n = part.num_rows
                number, digest, spans = np.zeros((n, len(KINDS)), np.int64), [_NOTHING] * n, [""] * n
                hits = np.flatnonzero(pc.match_substring_regex(part.column(1), TRIGGER).to_numpy(zero_copy_only=False))
                texts = part.column(1).take(pa.array(hits)).to_pylist()
                for i, (base, every) in zip(hits, all_spans(texts, tagger), strict=True):
                    for _, k, _ in base:
                        number[i, k] += 1
                    digest[i], spans[i] = hashlib.sha256(written(base).encode()).hexdigest(), written(every)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, number.T.copy()), pa.array(digest), pa.array(spans, pa.string())],
                                                 ["doc_id", *counts, "base_sha256", "spans"])

    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string")
