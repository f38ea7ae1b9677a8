import itertools

from hypothesis import given, settings
from hypothesis import strategies as st

from odd_tables import none, odd, words  # noqa: F401
from tapework.llm import packing


def padding(cells, bounds):
    return sum(n * min(b for b in bounds if b >= longest) - total for longest, n, total in cells)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 5))
def test_boundaries_are_optimal(counts, buckets):
    cells = [(length, n, length * n) for length, n in sorted(counts.items())]
    got = packing.optimal_boundaries(cells, buckets)
    assert got == sorted(set(got)) and len(got) <= buckets and got[-1] == cells[-1][0]
    lengths = [c[0] for c in cells[:-1]]
    best = min(padding(cells, [*pick, cells[-1][0]]) for k in range(min(buckets, len(cells))) for pick in itertools.combinations(lengths, k))
    assert padding(cells, got) == best


def test_every_length_has_a_cell(spark):
    df = spark.range(0, 300_000).selectExpr("id % 70000 AS n")
    cells = packing.histogram(df, "n")
    assert [c[0] for c in cells] == list(range(70_000)) and sum(c[1] for c in cells) == 300_000 and cells[69_999][2] == 69_999 * cells[69_999][1]


def test_long_lengths_are_told_apart(spark):
    lengths = [5000, 5001, 5002, 5003, 9000, 9001, 9002, 9003]
    df = spark.createDataFrame(list(enumerate(lengths * 3)), "doc_id long, n_tokens long")
    assert all(r.padding == 0 for r in packing.pack(df, buckets=8).collect())
    best = min(sum(min(b for b in (*pick, 9003) if b >= n) - n for n in lengths * 3) for pick in itertools.combinations(lengths[:-1], 2))
    assert sum(r.padding for r in packing.pack(df, buckets=3).collect()) == best


def test_batches_keep_to_the_budget(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_SLICE", 50)
    df = spark.range(0, 2_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE pmod(id * 37, 211) END AS n_tokens")
    rows = packing.pack(df, buckets=5, token_budget=600).collect()
    assert sorted(r.doc_id for r in rows) == list(range(2_000))
    assert all(r.padding == r.bucket_length - r.n_tokens >= 0 for r in rows)
    batches = {}
    for r in rows:
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, number), members in batches.items():
        size = max(1, 600 // max(1, members[0].bucket_length))
        assert sorted(m.row_in_batch for m in members) == list(range(len(members)))
        last = (bucket, number + 1) not in batches
        assert len(members) == size or last and len(members) < size


def test_odd_rows(odd, none):
    rows = packing.pack_documents(odd).collect()
    assert len(rows) == odd.count()
    assert sorted(r.n_tokens for r in rows) == sorted(len((r.text or "").split()) for r in odd.collect())
    assert next(r for r in rows if r.doc_id == 5).row_in_batch == 0
    assert packing.pack_documents(none).collect() == []
