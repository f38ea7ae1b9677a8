import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from odd_tables import none, odd, words  # noqa: F401
from tapework.llm import phrases


def brute(rows, least, top, longest=5):
    """Collocations by counting every phrase of every piece."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            found = re.findall("[^ \t]+", piece)
            totals[lang] += len(found)
            counts.update((lang, *found[i:i + k]) for k in range(1, longest + 1) for i in range(len(found) - k + 1))
    held = {p: n for p, n in counts.items() if n >= least}
    out = {}
    for (lang, *ws), a in held.items():
        inside = any(q[0] == lang and len(q) > len(ws) + 1 and held[q] >= a and any(list(q[i:i + len(ws)]) == ws for i in range(1, len(q) - len(ws) + 1))
                     for q in held)
        if len(ws) == 1 or inside:
            continue
        cuts = [(1000 * a * totals[lang] // (held[lang, *ws[:k]] * held[lang, *ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), held[lang, *ws[:k]], held[lang, *ws[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def sample(seed=3):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "oil", "price", "en", "É", "x", "new", "york", "city", "漢字", "en-fr", "a b"]
    stock = ["new york city", "The price of oil", "x x x x x x x", "rare words here now then"]
    rows = []
    for i in range(160):
        parts = [rng.choice(stock) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        rows.append((rng.choice(["en", "en", "fr", "É", None, "und"]), "".join(p + rng.choice([" ", " ", "\t", "  ", ", ", ".\n", "!"]) for p in parts)))
    return rows + [("en", None), ("fr", ""), ("en", "  \n . "), (None, "x " * 5000)]


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_collocations_match_counting(spark, monkeypatch, limit):
    # small ranges and blocks; 0 takes the semi-joins by shuffle
    monkeypatch.setattr(phrases, "BLOCK", 7)
    rows = sample()
    got = run(spark, rows, least=8, top=3, broadcast_ids=limit, rank_rows=12)
    assert len(got) >= 12 and got == brute(rows, 8, 3)
    assert run(spark, rows, least=8, top=60, broadcast_ids=limit) == brute(rows, 8, 60)


def test_shorter_lengths_and_no_phrase(spark):
    rows = sample(4)
    assert run(spark, rows, least=8, top=5, longest=3) == brute(rows, 8, 5, 3)
    assert run(spark, rows, least=10**6) == []


def test_products_beyond_64_bits(spark):
    big = 3 * 10**15
    row = spark.createDataFrame([("en", "a b c", 3, big // 7, 10**16 + 1, [big, big // 3], [big // 2, big // 5], None)],
                                "lang string, phrase string, length int, a long, n long, heads array<long>, tails array<long>, longer long")
    cuts = [(1000 * (big // 7) * (10**16 + 1) // (big * (big // 5)), 1), (1000 * (big // 7) * (10**16 + 1) // ((big // 3) * (big // 2)), 2)]
    r, = phrases.scored(row).collect()
    assert (r.score, r.l, r.r) == ((min(cuts)[0], big, big // 5) if min(cuts)[1] == 1 else (min(cuts)[0], big // 3, big // 2))


def test_cut_of_equal_scores_is_the_first(spark):
    row = spark.createDataFrame([("en", "a b c", 3, 10, 100, [20, 30], [20, 30], None)],
                                "lang string, phrase string, length int, a long, n long, heads array<long>, tails array<long>, longer long")
    r, = phrases.scored(row.withColumn("tails", F.array(F.lit(30), F.lit(20)).cast("array<long>"))).collect()
    assert (r.score, r.l, r.r) == (1000 * 10 * 100 // 900, 30, 30) or (r.l, r.r) == (20, 20)


def test_long_texts_are_cut_at_pieces(spark):
    text = ("one two three. " * 60_000) + "four " * 300_000 + ", " + "one two three;" * 60_000
    got = run(spark, [("en", text), ("en", "One\ttwo  three")], least=100)
    assert ("en", "one two three") in {(r[0], r[2]) for r in got} and next(r for r in got if r[2] == "one two three")[3] == 120_001
    assert next(r for r in got if r[2] == "four four")[3] == 299_999


def test_odd_rows(odd, none):
    got = sorted(tuple(r) for r in phrases.collocations(odd, least=3, top=10).collect())
    assert got == brute([(r.lang, r.text) for r in odd.collect()], 3, 10) and got
    assert phrases.collocations(none).collect() == []
