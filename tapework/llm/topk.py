"""Exact top-k inner products: vectors by descending length, SVD-rotated partial sums, Cauchy-Schwarz bounds.

The candidates' second-moment matrix is summed by Spark (its size is the dimension squared) and its eigenvectors
rotate all vectors, so that the first coordinates hold most of every inner product. Candidates are range partitioned
by descending length and packed into blocks. Queries pass over the blocks in rounds of bounded size: the block of
longest vectors gives each query a first threshold; then a block is skipped for a query if |q| * longest is below
its threshold, and a pair if partial sum + residual lengths is. What is left is scored exactly in integers.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.llm.common import parts_for
from tapework.session import stage_table

BLOCK_ROWS = 2_048
QUERIES_PER_ROUND = 4_096
#: Rotated coordinates of the two partial sums.
PREFIXES = (0.25, 0.5)
#: Integer products are exact in doubles below this.
EXACT = 2.0**53
_BLOCKS = "block long, longest double, ids binary, vectors binary"
_HITS = "query_id long, query_key long, vec_id long, score long"


def integer_vectors(df, *, key="vec_id", vector="embedding", scale=1024):
    """``vec_id`` and the vector as ``floor(scale * x)``. Rows without a key, a vector or with a component that is
    null or not finite take no part; an empty vector has length 0."""
    x = F.col(vector).cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return df.where(F.col(key).isNotNull() & x.isNotNull() & good).select(
        F.col(key).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long")).alias("v"))


def _matrix(column, width):
    """Rows of a list column as int64, padded with zeros to ``width``."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def second_moments(vectors, width):
    """Sum of v v' over all vectors: partial matrices per task, summed by coordinate pair."""
    def partial(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width).astype(float)
            total += m.T @ m
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "x"])

    sums = vectors.select("v").mapInArrow(partial, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    out = np.zeros((width, width))
    for r in sums.collect():
        out[r["i"], r["j"]] = r["x"]
    return out


def _blocks(width):
    def build(batches):
        number = -1
        for batch in batches:
            ids, m = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            for k in range(0, len(ids), BLOCK_ROWS):
                part = m[k:k + BLOCK_ROWS]
                longest = float(np.sqrt((part.astype(float) ** 2).sum(1)).max())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([longest]), pa.array([ids[k:k + BLOCK_ROWS].tobytes()], pa.binary()),
                     pa.array([part.tobytes()], pa.binary())], ["block", "longest", "ids", "vectors"])
    return build


def _exact(q, c, big):
    """Integer inner products of all rows of q and c as int64."""
    if not big:
        return np.rint(q.astype(float) @ c.astype(float).T).astype(np.int64)
    return np.stack([(c * row).sum(1) for row in q]) if len(q) else np.zeros((0, len(c)), np.int64)


def _search(queries, ids, keys, rotation, width, k, floor):
    """Function over candidate blocks that yields each task's best k per query, not below the known floors."""
    norms = np.sqrt((queries.astype(float) ** 2).sum(1))
    steps = [max(1, int(width * p)) for p in PREFIXES]
    turned = queries.astype(float) @ rotation
    rest = [np.sqrt(np.maximum((turned[:, s:] ** 2).sum(1), 0)) for s in steps]

    def run(batches):
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)
        least = floor.copy()
        for batch in batches:
            for row in range(batch.num_rows):
                longest = batch.column(1)[row].as_py()
                vec = np.frombuffer(batch.column(2)[row].as_py(), np.int64)
                c = np.frombuffer(batch.column(3)[row].as_py(), np.int64).reshape(len(vec), width)
                slack = 1e-9 * norms * longest + 1e-6
                live = np.flatnonzero(norms * longest + slack >= least)
                if not len(live):
                    continue
                spun = c.astype(float) @ rotation
                keep = np.ones((len(live), len(vec)), bool)
                for s, own in zip(steps, rest, strict=True):
                    tail = np.sqrt(np.maximum((spun[:, s:] ** 2).sum(1), 0))
                    bound = turned[live, :s] @ spun[:, :s].T + np.outer(own[live], tail) + slack[live][:, None]
                    keep &= bound >= least[live][:, None]
                    some = keep.any(1)
                    live, keep, = live[some], keep[some]
                if not len(live):
                    continue
                cols = np.flatnonzero(keep.any(0))
                scores = _exact(queries[live], c[cols], norms[live].max(initial=0) * longest >= EXACT)
                for i, q in enumerate(live):
                    near = keep[i, cols] & (vec[cols] != ids[q]) & (scores[i] >= least[q])
                    if not near.any():
                        continue
                    s = np.concatenate([best[q][0], scores[i][near]])
                    v = np.concatenate([best[q][1], vec[cols][near]])
                    top = np.lexsort((v, -s))[:k]
                    best[q] = (s[top], v[top])
                    if len(top) == k:
                        least[q] = max(least[q], float(s[top[-1]]))
        for q, (s, v) in enumerate(best):
            if len(s):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), ids[q])), pa.array(np.full(len(s), keys[q])), pa.array(v), pa.array(s)],
                    ["query_id", "query_key", "vec_id", "score"])
    return run


def top_k(candidates, queries, k=10):
    """The ``k`` highest integer inner products of each query among ``candidates`` (all, if fewer), without rows of
    the query's own ``vec_id``; ties go to the smaller ``vec_id``. Both tables come from ``integer_vectors``.

    Vectors of different length count as padded with zeros. Repeated candidate rows are candidates each; repeated
    query rows are answered once. Scores have 64 bits, as Spark's long has.
    """
    spark = candidates.sparkSession
    width, n = candidates.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    longest_query, asked = queries.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n or not asked:
        return empty
    width = max(width, longest_query, 1)
    _, rotation = np.linalg.eigh(second_moments(candidates, width))
    rotation = np.ascontiguousarray(rotation[:, ::-1])
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    blocks = stage_table(
        candidates.withColumn("_norm", norm).repartitionByRange(parts_for(n, 4 * BLOCK_ROWS), F.desc("_norm"), F.asc("vec_id"))
        .sortWithinPartitions(F.desc("_norm"), "vec_id").select("vec_id", "v").mapInArrow(_blocks(width), _BLOCKS), "vectors")
    first = blocks.orderBy(F.desc("longest")).limit(1)  # a start for the thresholds only
    rounds = parts_for(asked, QUERIES_PER_ROUND)
    asked_rows = stage_table(
        queries.distinct().withColumn("query_key", F.xxhash64("vec_id", "v")).withColumn("_round", F.pmod("query_key", F.lit(rounds))), "queries")
    found = None
    for r in range(rounds):
        part = asked_rows.where(F.col("_round") == r).select("vec_id", "query_key", "v").orderBy("vec_id", "query_key").toArrow().combine_chunks()
        if not part.num_rows:
            continue
        batch = part.to_batches()[0]
        q, ids, keys = _matrix(batch.column(2), width), batch.column(0).to_numpy(), batch.column(1).to_numpy()
        none = np.full(len(ids), -np.inf)
        least = none.copy()
        head = first.mapInArrow(_search(q, ids, keys, rotation, width, k, none), _HITS).groupBy("query_key").agg(
            F.min("score").alias("s"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).collect()
        known = {x["query_key"]: x["s"] for x in head}
        for i, key in enumerate(keys):
            least[i] = known.get(key, -np.inf)
        hits = stage_table(blocks.mapInArrow(_search(q, ids, keys, rotation, width, k, least), _HITS), "hits")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return empty
    rank = F.row_number().over(Window.partitionBy("query_key", "query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
