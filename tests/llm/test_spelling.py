import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from odd_tables import none, odd, words  # noqa: F401
from tapework.llm import spelling


def slipped(doc, run):
    h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1:] if h % 199 == 0 else run


def vocabulary(rows, least=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            counts[slipped(doc, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run))] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, least=5):
    held = vocabulary(rows, least)
    near_of = {w: [v for v in held if near(v, w)] for w in held}
    form = {}
    for w, others in near_of.items():
        best = min(others, key=lambda v: (-held[v], v), default=None)
        form[w] = best if best is not None and held[best] >= 5 * held[w] else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), n, len(near_of[w]), held[form[w]] if form[w] else None) for w, n in held.items()), key=repr)


def noisy(seed, count=900):
    rng = random.Random(seed)
    stems = ["station", "nation", "ration", "cation", "caution", "ététion", "banana", "bananas", "ananas", "aaaaaaa", "aaaaaaaa", "mississippi", "ßtraßen",
             "internationalisation", "×÷×÷×÷", "abcdefgh"]
    out = []
    for i in range(count):
        got = []
        for _ in range(60):
            w = rng.choice(stems[:1 + int(len(stems) * rng.random())])
            if rng.random() < 0.2:
                at, c = rng.randrange(len(w)), rng.choice("aeiné")
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:]])
            got.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, rng.choice([" ", "-", "1", "\n"]).join(got)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_match_all_pairs(spark, seed):
    rows = noisy(seed) + [(None, "nation " * 9), (5, None), (6, ""), (7, "é"), (8, "chainaa " * 400 + "chainab " * 60 + "chainbb " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in spelling.variants(docs).collect()), key=repr)
    want = brute(rows)
    assert got == want and len(got) > 400
    assert any(r[1] != r[2] for r in got if r[1]) and sum(r[1] is not None for r in got) > 20


@settings(max_examples=300, deadline=None)
@given(st.text("abé", min_size=6, max_size=12), st.text("abé", min_size=1, max_size=1), st.integers(0, 11), st.sampled_from("idr"), st.randoms())
def test_near_words_share_a_pivot_in_place(word, c, at, edit, rng):
    at %= len(word)
    other = {"i": word[:at] + c + word[at:], "d": word[:at] + word[at + 1:], "r": word[:at] + c + word[at + 1:]}[edit]
    if other == word or len(other) < 6:
        return
    grams = sorted({w[i:i + 2] for w in (word, other) for i in range(len(w) - 1)})
    rng.shuffle(grams)
    rank, cost = {g: i for i, g in enumerate(grams)}, [rng.randint(1, 9) for _ in grams]

    def keys(w):
        held, last = spelling.prefix([(i, rank[w[i:i + 2]]) for i in range(len(w) - 1)])
        return held, last, spelling.pivots(held, cost)

    (a, last_a, piv_a), (b, last_b, piv_b) = keys(word), keys(other)
    def meets(pivots, held, size_a, size_b):
        return any(g == h and q - p in {0, size_b - size_a} for p, g in pivots for q, h in held)
    assert (last_a <= last_b and meets(piv_a, b, len(word), len(other))) or (last_b <= last_a and meets(piv_b, a, len(other), len(word)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 5)), min_size=3, max_size=9, unique_by=lambda x: x[0]), st.lists(st.integers(1, 20), min_size=6, max_size=6))
def test_pivots_are_the_cheapest_disjoint_grams(grams, cost):
    grams.sort()
    pairs = [(x, y) for x, y in itertools.combinations(grams, 2) if y[0] - x[0] >= 2]
    chosen = spelling.pivots(grams, cost)
    assert chosen[1][0] - chosen[0][0] >= 2 and sum(cost[g] for _, g in chosen) == min(cost[x[1]] + cost[y[1]] for x, y in pairs)


def test_checksums_go_on(spark):
    rng = random.Random(5)
    found = ["".join(rng.choice("abcé") for _ in range(rng.choice([1, 5, 30, 64, 65, 200]))).encode() for _ in range(300)]
    raw = np.frombuffer(b"".join(found), np.uint8)
    ends = np.cumsum([len(f) for f in found])
    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in range(300)], np.uint32)
    got = spelling.checksums(raw, ends - [len(f) for f in found], ends, seeds)
    assert got.tolist() == [zlib.crc32(f"{i}:".encode() + f) for i, f in enumerate(found)]


def test_chains_are_followed_to_their_end(spark):
    forms = spark.createDataFrame([(f"w{i:02}", f"w{i + 1:02}") for i in range(20)] + [("a", "w03"), ("b", "c")], "word string, form string")
    got = dict(tuple(r) for r in spelling.roots(forms).collect())
    assert got == {f"w{i:02}": "w20" for i in range(20)} | {"a": "w20", "b": "c"}


def test_odd_rows(spark, odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((tuple(r) for r in spelling.variants(odd, least_count=1).where("n > 2").collect()), key=repr) == [
        r for r in brute(docs, 1) if r[3] > 2]
    assert spelling.variants(none).collect() == []
    long = spark.createDataFrame([(1, "stations " * 900_000 + "x" * 100_000 + " nations" * 9)], "doc_id long, text string")
    got = {r.word: r.n for r in spelling.variants(long).collect()}
    assert got == {w: n for w, n in vocabulary([(1, "stations " * 900_000 + "x" * 100_000 + " nations" * 9)]).items()} and got["stations"] == 900_000
