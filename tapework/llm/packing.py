"""Packing by optimal length buckets: dynamic programming over the global length histogram.

Every sequence is padded to its bucket's boundary and batches of a bucket hold as many rows as the token budget
allows. The boundaries are those with the least padding over the whole table.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.llm.common import parts_for
from tapework.session import stage_table

BUCKETS = 16
TOKEN_BUDGET = 65_536
#: Rows of one bucket that one task numbers.
ROWS_PER_SLICE = 4_000


def n_words(text):
    """Length of a text in words: maximal runs without white space; 0 for null and empty texts."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def histogram(df, length):
    """Sorted (length, count, total), one cell for each distinct length: their number is bounded by the longest length, and
    grows far more slowly than the table."""
    cells = df.groupBy(F.col(length).alias("length")).agg(F.count(F.lit(1)).alias("n")).orderBy("length").toArrow().to_pydict()
    return [(length, n, length * n) for length, n in zip(cells["length"], cells["n"])]


def optimal_boundaries(cells, buckets):
    """Ascending bucket boundaries with the least total padding over ``cells``; at most ``buckets`` of them.

    Bucket (i, j] costs longest_j * rows - tokens, so each layer of the dynamic programme is a lower envelope of
    lines with falling slopes asked at rising points: linear in the cells.
    """
    if not cells:
        return []
    rows, tokens = [0], [0]
    for _, n, total in cells:
        rows.append(rows[-1] + n)
        tokens.append(tokens[-1] + total)
    size = len(cells)
    best = [0] + [None] * size
    back = []
    for _ in range(min(buckets, size)):
        lines, at, layer, origin = [], 0, [None] * (size + 1), [0] * (size + 1)
        for j in range(1, size + 1):
            if best[j - 1] is not None:
                slope, base = -rows[j - 1], best[j - 1] + tokens[j - 1]
                while len(lines) >= 2:
                    (s1, b1, _), (s2, b2, _) = lines[-2:]
                    if (base - b1) * (s1 - s2) <= (b2 - b1) * (s1 - slope):
                        lines.pop()
                    else:
                        break
                lines.append((slope, base, j - 1))
                at = min(at, len(lines) - 1)
            if not lines:
                continue
            x = cells[j - 1][0]
            while at + 1 < len(lines) and lines[at + 1][0] * x + lines[at + 1][1] <= lines[at][0] * x + lines[at][1]:
                at += 1
            slope, base, i = lines[at]
            layer[j], origin[j] = slope * x + base + x * rows[j] - tokens[j], i
        # fewer buckets may do as well: an unused layer keeps the earlier answer
        for j in range(size + 1):
            if best[j] is not None and j and (layer[j] is None or best[j] <= layer[j]):
                layer[j], origin[j] = best[j], None
        back.append(origin)
        best = layer
        best[0] = None
    bounds, j, k = [], size, len(back) - 1
    while j > 0:
        if back[k][j] is None:
            k -= 1
            continue
        bounds.append(cells[j - 1][0])
        j, k = back[k][j], k - 1
    return bounds[::-1]


def pack(df, *, key="doc_id", length="n_tokens", buckets=BUCKETS, token_budget=TOKEN_BUDGET, tie=None):
    """Bucket and batch of every row of ``df``.

    Returns ``key``, ``length``, ``bucket`` (from 0), ``bucket_length`` (padded length), ``batch`` (from 0 in its
    bucket), ``row_in_batch`` and ``padding``. A batch of bucket b holds ``token_budget // boundary`` rows, at least
    one, so a sequence longer than the budget has a batch of its own. Rows of a bucket are numbered in slices by a
    hash of the key, then by key and ``tie``; only a bucket's last batch can be short. Repeated rows are packed each.
    Null lengths count as 0; an empty table gives an empty result.
    """
    order = [F.col(key).asc_nulls_last()] + ([F.col(tie).asc_nulls_last()] if tie else [])
    rows = stage_table(
        df.select(F.col(key), F.coalesce(F.col(length), F.lit(0)).cast("long").alias(length), *([F.col(tie)] if tie else [])), "lengths")
    cells = histogram(rows, length)
    bounds = optimal_boundaries(cells, buckets) or [0]
    slices = parts_for(sum(n for _, n, _ in cells), ROWS_PER_SLICE)
    bucket = sum((F.when(F.col(length) > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    placed = (
        rows.withColumn("bucket", bucket.cast("int"))
        .withColumn("_slice", F.pmod(F.xxhash64(key, length, *([tie] if tie else [])), F.lit(slices)).cast("int"))
    )
    sizes = placed.groupBy("bucket", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("bucket").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    bound = F.array(*[F.lit(int(b)) for b in bounds])
    number = F.col("_before") + F.row_number().over(Window.partitionBy("bucket", "_slice").orderBy(length, *order)) - 1
    return (
        placed.join(offsets, ["bucket", "_slice"])
        .withColumn("_row", number)
        .withColumn("bucket_length", F.get(bound, F.col("bucket")).cast("long"))
        .withColumn("_per", F.greatest(F.floor(F.lit(token_budget) / F.greatest("bucket_length", F.lit(1))), F.lit(1)))
        .select(key, length, "bucket", "bucket_length", F.floor(F.col("_row") / F.col("_per")).alias("batch"),
                (F.col("_row") % F.col("_per")).cast("int").alias("row_in_batch"),
                (F.col("bucket_length") - F.col(length)).alias("padding"))
    )


def pack_documents(docs, **options):
    """Pack the documents of any table by their words; other columns, also of clashing names, stay out."""
    text = F.col("text").cast("string")
    lengths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n_words(text).alias("n_tokens"), F.xxhash64(text).alias("_text"))
    return pack(lengths, tie="_text", **options)
