import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL
from odd_tables import none, odd, words  # noqa: F401
from tapework.llm import fingerprints


def similarity(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collisions_follow_generalised_jaccard(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.with_edits(docs).collect()}
    true, seen = [], []
    for k, (doc, text) in enumerate(texts):
        after, half = texts[(k + 1) % len(texts)][1], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        true += [similarity(text, edited), similarity(text, after)]
        seen += [r.near_edited, r.near_next]
    error = np.array(seen) - np.array(true)
    assert abs(error.mean()) < 0.02 and (error**2).mean() ** 0.5 < 0.08
    prints = {}
    for doc, text in texts:
        assert prints.setdefault(text, got[doc].fingerprint) == got[doc].fingerprint


def test_weights_count(spark):
    rows = [(1, "a b c"), (2, "a a a a b c"), (3, "c b a a a a")]
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), 300).collect()}
    assert got[2] == got[3]
    same = np.mean([got[1][i:i + 3] == got[2][i:i + 3] for i in range(0, 900, 3)])
    assert abs(same - 0.5) < 0.1


def test_samples_and_bits(spark):
    docs = spark.createDataFrame([(k, f"a{k} b{k}") for k in range(200)], "doc_id long, text string")
    for table in (fingerprints.with_edits(docs), fingerprints.fingerprints(docs)):
        prints = [r.fingerprint for r in table.collect()]
        width = len(prints[0]) // 64
        assert fingerprints.SAMPLES == 64 and {len(p) for p in prints} == {64 * width}
        # 19,900 pairs without a word in common: 12 bits give about 311 equal samples, 16 bits 19
        pieces = [Counter(p[width * i:width * (i + 1)] for p in prints) for i in range(64)]
        assert sum(n * (n - 1) // 2 for c in pieces for n in c.values()) < 60


def test_odd_rows(odd, none):
    got = fingerprints.with_edits(odd, 8).collect()
    assert len(got) == odd.count()
    blank = {r.fingerprint for r in got if r.doc_id in (2, 3, 4)}
    assert len(blank) == 1
    six = [r for r in got if r.doc_id == 6]
    assert len(six) == 3 and len({(r.fingerprint, r.edited_sha256) for r in six}) == 2
    assert next(r for r in got if r.doc_id == 7).fingerprint in {r.fingerprint for r in six}
    assert fingerprints.with_edits(none, 8).collect() == [] == fingerprints.fingerprints(none, 8).collect()


def test_one_document_is_its_own_next(spark):
    r, = fingerprints.with_edits(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string"), 8).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r.near_next == 1.0


def test_no_python_in_the_plan(spark):
    plan = fingerprints.with_edits(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_values_by_definition(spark):
    u, v, b = fingerprints._uniforms(5, 0), fingerprints._uniforms(5, 1), f"(xxhash64(word, {3 * 5 + 2}) & 1048575) / 1048576.0D"
    plain = F.expr(f"ln(-ln({v})) + ln({u}) * (floor(level / -ln({u}) + {b}) - {b} + 1.0D)")
    rows = spark.sql("select xxhash64(id) word, ln(double(w)) level from range(400) lateral view explode(array(1, 2, 3, 40, null)) as w")
    new = rows.select("level", plain.alias("plain"), fingerprints._value(5).alias("value"))
    got = new.collect()
    assert all(r.value is None if r.level is None else abs(r.plain - r.value) < 1e-9 for r in got) and len(got) == 2000
    # a word that occurs once needs no division by r
    assert "CASE WHEN (level" in new._jdf.queryExecution().optimizedPlan().toString()


def test_words_left_out_are_above_the_limit(spark):
    words = spark.sql("""select xxhash64(id) word, ln(double(w)) level, 0.06D * w most, if(w = 1, 1.0D, 0.0D) once
        from range(4000) lateral view explode(array(1, 2, 40)) as w""")
    got = words.select("once", *[F.struct(fingerprints._may_be_least(i).alias("may"), F.exp(fingerprints._value(i)).alias("a")).alias(f"s{i}") for i in range(8)]).collect()
    assert all(s.may or s.a > 0.06 for r in got for s in r[1:])
    # of words that occur once 0.058 are below the limit; the rest need no logarithms
    assert 0.05 < np.mean([s.may for r in got if r.once for s in r[1:]]) < 0.16


def test_least_of_all_words_where_the_limit_is_missed(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(k, " ".join(f"w{(k * k * j) % 977}" for j in range(1 + k % 50))) for k in range(120)] + [(500, ""), (501, " \n"), (502, "one")],
        "doc_id long, text string")
    full = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    redone = []
    of_pairs = fingerprints._of_pairs
    monkeypatch.setattr(fingerprints, "_of_pairs", lambda *a, **k: redone.append(bool(k)) or of_pairs(*a, **k))
    seen = []
    for reach, again in ((24.0, [False]), (3.0, [False, True]), (0.01, [False, True])):
        monkeypatch.setattr(fingerprints, "_REACH", reach)
        redone.clear()
        got = {r.doc_id: r for r in fingerprints.with_edits(docs).collect()}
        assert {k: r.fingerprint for k, r in got.items()} == full and redone == again
        seen.append(got)
    assert seen[0] == seen[1] == seen[2]
