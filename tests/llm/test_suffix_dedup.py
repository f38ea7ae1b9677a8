import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from odd_tables import none, odd, words  # noqa: F401
from tapework.llm import suffix_dedup


def brute(texts, least=50):
    """Covered spans by all runs of ``least`` words of every document."""
    owners, out = {}, set()
    for doc, text in texts.items():
        w = (text or "").split()
        for j in range(len(w) - least + 1):
            owners.setdefault(tuple(w[j:j + least]), set()).add(doc)
    for doc, text in texts.items():
        w, span = (text or "").split(), None
        for j in [j for j in range(len(w) - least + 1) if len(owners[tuple(w[j:j + least])]) > 1]:
            if span and j <= span[1]:
                span[1] = j + least
            else:
                if span:
                    out.add((doc, *span))
                span = [j, j + least]
        if span:
            out.add((doc, *span))
    return out


def found(spark, texts):
    rows = suffix_dedup.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert all(r.n_words == r.end_word - r.start_word for r in rows)
    return {(r.doc_id, r.start_word, r.end_word) for r in rows}


def test_planted_passages(spark, words):
    passages = [words(50 + k, n) for k, n in enumerate((49, 50, 51, 60, 120, 400))]
    texts = {}
    for k, passage in enumerate(passages):
        for copy in range(2 + k):
            texts[10 * k + copy] = f"{words(200 + 10 * k + copy, 5 + 13 * copy)} {passage} {words(400 + 10 * k + copy, 31)}"
    texts[90] = f"{words(700, 20)} {passages[4]} {words(701, 9)} {passages[5]}"
    texts[91] = words(702, 300)
    got = found(spark, texts)
    assert got == brute(texts) and not {0, 1, 91} & {d for d, *_ in got} and {10, 11} <= {d for d, *_ in got}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6))
def test_edited_copies(spark, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    texts = {}
    for doc in range(12):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
        texts[doc] = " ".join(w[rng.randrange(100):])
    got, want = found(spark, texts), brute(texts)
    covered = lambda spans: {(d, i) for d, s, e in spans for i in range(s, e)}
    assert covered(got) <= covered(want) and len(covered(got)) >= 0.99 * len(covered(want))


def test_runs_of_the_same_words(spark, words):
    texts = {1: "De " * 400, 2: words(1, 30) + " De" * 200, 3: "a b " * 300, 4: words(2, 10) + " a b" * 90, 5: "c " * 49, 6: "c " * 49}
    assert found(spark, texts) == brute(texts)


def test_neighbours_across_partitions(spark, words, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ROWS_PER_PART", 7)
    texts = {k: f"{words(100 + k, 20)} {words(1 + k % 4, 90)}" for k in range(24)}
    assert found(spark, texts) == brute(texts)


def test_passages_that_end_in_a_stock_phrase(spark, words):
    phrase, texts = words(1, 15), {}
    for k in range(60):
        passage = f"{words(1000 + k, 35)} {phrase}"
        for copy in range(2):
            texts[10 * k + copy] = f"{words(2000 + 2 * k + copy, 20)} {passage} {words(3000 + 2 * k + copy, 20)}"
    assert found(spark, texts) == brute(texts) and len(brute(texts)) == 120


def test_runs_of_one_document_across_partitions(spark, words, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ROWS_PER_PART", 7)
    texts = {}
    for k in range(6):
        block = words(10 + k, 12)
        texts[2 * k], texts[2 * k + 1] = " ".join([block] * 60), f"{words(100 + k, 30)} {block} {block} {block} {block} {block} {words(200 + k, 30)}"
    assert found(spark, texts) == brute(texts)


def test_odd_rows(odd, none):
    got = {(r.doc_id, r.start_word, r.end_word) for r in suffix_dedup.repeated_passages(odd).collect()}
    assert got == {(6, 0, 60), (7, 0, 60)}  # rows that repeat id and text are one document
    assert suffix_dedup.repeated_passages(none).collect() == []
