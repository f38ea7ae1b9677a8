"""N-gram Jaccard self-join by a MinHash LSH forest, with exact verification.

1. Each text's five-word shingles give a label per tree: eight MinHash values of a byte each, first value first, so a
   tree is its labels in sorted order and a trie's prefix is a run of them. Texts with equal shingle sets are one class.
2. Matching starts at whole labels. Classes that share a prefix form a bucket; buckets with equal members in several
   trees are looked at once, those without pairs that are new at this length not at all. Pairs that did not meet at a
   longer prefix and whose labels agree well enough join candidate groups. From the agreement of the pairs met so far
   the recall at this length is estimated; prefixes are shortened by a value until it reaches the target wherever there
   are pairs. Large buckets are cut into blocks and handled by pairs of blocks.
3. Inside a candidate group every pair is verified exactly on shingle sets, again by pairs of blocks. Tasks emit counts
   and spanning links, never pairs.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.llm.common import components, whole_groups
from tapework.llm.words import mix, slices, word_hashes
from tapework.session import stage_table

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 8
TARGET_RECALL = 0.9999
#: Standard deviations by which the estimate from the labels may fall below the threshold.
MARGIN = 4.5
#: Classes in a block of a bucket or of a candidate group.
BUCKET_BLOCK = 512
GROUP_BLOCK = 256


def meets(similarity, length, trees=TREES):
    """Probability that a pair of this similarity shares a prefix of ``length`` values in some tree."""
    return 1 - (1 - np.asarray(similarity, float) ** length) ** trees


def shortest_prefix(threshold=THRESHOLD, depth=DEPTH, target=TARGET_RECALL):
    """Length at which even pairs of similarity ``threshold`` meet as often as the target asks; no data can need less.
    1 if there is none."""
    return next((d for d in range(depth, 1, -1) if meets(threshold, d) >= target), 1)


def deviation(threshold, values=TREES * DEPTH):
    """Standard deviation of the share of agreeing values at the threshold."""
    return np.sqrt(threshold * (1 - threshold) / values)


def estimated_recall(pairs, length, threshold=THRESHOLD):
    """Recall at prefixes of ``length``, from ``pairs``: agreeing values -> pairs met so far.

    Pairs are taken two deviations less similar than their labels say, but not below the threshold. The lowest recall
    of any agreement that has pairs counts, so many clear copies do not outweigh a few pairs near the threshold.
    1 without pairs."""
    agree = np.array([a for a, n in pairs.items() if n], float)
    similarity = (agree / (TREES * DEPTH) - 1 / 256) / (1 - 1 / 256) - 2 * deviation(threshold)
    return float(meets(np.clip(similarity, threshold, 1), length).min(initial=1))


def shingle_sets(texts, size=SHINGLE):
    """(sorted distinct shingle hashes, number of them per text). A text of fewer words has one shingle of them all,
    a text without words none."""
    words, counts = word_hashes(texts)
    start = np.cumsum(counts) - counts
    total = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        total = mix(total + words[k:len(words) - size + 1 + k] + np.uint64(k)) if len(total) else total
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[owner]
    short = (counts < size)[owner]
    hashes = np.zeros(len(owner), np.uint64)
    hashes[~short] = total[at[~short]]
    for i in np.flatnonzero(short):
        h = np.uint64(counts[owner[i]])
        for w in words[start[owner[i]]:start[owner[i]] + counts[owner[i]]]:
            h = mix(np.array([h]) + w)[0]
        hashes[i] = h
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=len(counts))


def _sums(values, lengths):
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def labels(hashes, lengths, trees=TREES, depth=DEPTH):
    """Label of every set in every tree: ``depth`` MinHash values, a byte each. Empty sets have label 0."""
    random = np.random.default_rng(20)
    salt = random.integers(0, 1 << 32, (trees * depth, 2), dtype=np.uint32) | np.array([0, 1], np.uint32)
    out = np.zeros((len(lengths), trees), np.uint64)
    full = lengths > 0
    if not full.any():
        return out
    starts = (np.cumsum(lengths) - lengths)[full]
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    for j, (a, b) in enumerate(salt):
        low = np.minimum.reduceat((small ^ a) * b, starts).astype(np.uint64)
        out[full, j // depth] = (out[full, j // depth] << np.uint64(8)) | (mix(low + np.uint64(j)) & np.uint64(255))
    return out


def _signatures(size):
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                hashes, n = shingle_sets(part.column(2), size)
                trees = labels(hashes, n)
                ends = pa.array(np.arange(0, trees.size + 1, TREES, dtype=np.int32))
                node = mix(_sums(mix(hashes), n) + n.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(node.view(np.int64)), pa.array(n),
                     pa.ListArray.from_arrays(ends, pa.array(trees.ravel().view(np.int64)))], ["doc_id", "key", "node", "n", "labels"])
    return run


def _blocks(rows, by, size):
    """Rows once for every pair of blocks that theirs is part of, in columns ``p`` <= ``q``; ``own`` is their block."""
    count = F.ceil(F.col("_size") / size).cast("int")
    other = F.explode(F.sequence(F.lit(0), count - 1))
    return (
        rows.withColumn("own", F.pmod(F.xxhash64("node", *by), count).cast("int")).withColumn("_other", other)
        .withColumns({"p": F.least("own", "_other"), "q": F.greatest("own", "_other")}).drop("_other", "_size")
    )


def _spread(rows, keys):
    return rows.repartition(*keys).sortWithinPartitions(*keys, "node")


def _roots(n, a, b):
    """Least index connected with each of n items by the pairs (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root[root] != root).any():
        root = root[root]
    return root


def _groups(table, keys):
    """(start, end) of the runs of equal keys."""
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for k in keys:
        x = table[k].to_numpy()
        change[1:] |= x[1:] != x[:-1]
    starts = np.flatnonzero(change)
    return zip(starts, np.append(starts[1:], table.num_rows), strict=True)


def _candidate_links(length, least):
    """Spanning links (a, b) of the pairs in each bucket whose labels agree in at least the share ``least`` and that
    share ``length`` values in this tree first and more in none; also the number of such pairs by agreeing values."""
    keys = ["tree", "prefix", "p", "q"]

    def run(batches):
        for table in whole_groups(batches, keys):
            node, own, child, tree = (table[c].to_numpy() for c in ("node", "own", "child", "tree"))
            flat = table["labels"].combine_chunks().flatten().to_numpy().astype(">i8").view(np.uint8).reshape(len(node), -1)
            same = (table["p"].to_numpy() == table["q"].to_numpy())
            a, b, count = [], [], np.zeros(TREES * DEPTH + 1, np.int64)
            for i, j in _groups(table, keys):
                for x in range(i, j - 1):
                    y = np.arange(x + 1, j)
                    y = y[child[y] != child[x]]
                    if not same[x]:
                        y = y[own[y] != own[x]]
                    equal = flat[y] == flat[x]
                    agree = equal.sum(1)
                    near = agree >= least * flat.shape[1]
                    runs = np.logical_and.accumulate(equal[near].reshape(-1, TREES, DEPTH), 2).sum(2)
                    new = (runs.max(1) == length) & (runs.argmax(1) == tree[x])
                    y = y[near][new]
                    count += np.bincount(agree[near][new], minlength=len(count))
                    a.append(np.full(len(y), x))
                    b.append(y)
            a, b = (np.concatenate(v).astype(np.int64) if v else np.empty(0, np.int64) for v in (a, b))
            root = _roots(len(node), a, b)
            linked = root != np.arange(len(node))
            some = np.flatnonzero(count)
            links, counts = int(linked.sum()), len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(node[linked]), pa.nulls(counts, pa.int64())]),
                 pa.concat_arrays([pa.array(node[root[linked]]), pa.nulls(counts, pa.int64())]),
                 pa.concat_arrays([pa.nulls(links, pa.int64()), pa.array(some)]),
                 pa.concat_arrays([pa.nulls(links, pa.int64()), pa.array(count[some])])], ["a", "b", "agree", "pairs"])
    return run


def _prefix(length):
    return F.shiftrightunsigned("label", 8 * (DEPTH - length))


def _met(tries, searched, length, threshold):
    """Written links and counts of the pairs that meet at prefixes of ``length`` and at no longer ones."""
    # at whole labels every member is a child of its own; above, pairs of one child met before
    child = _prefix(length + 1) if length < DEPTH else F.col("node")
    rows = tries.select("node", "tree", _prefix(length).alias("prefix"), child.alias("child"))
    buckets = rows.groupBy("tree", "prefix").agg(
        F.count(F.lit(1)).alias("_size"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("_who"),
        F.min("child").alias("_low"), F.max("child").alias("_high")).where("_low < _high")
    once = buckets.groupBy("_size", "_who").agg(F.min(F.struct("tree", "prefix")).alias("b")).select("b.tree", "b.prefix", "_size")
    members = rows.join(once, ["tree", "prefix"]).join(searched.select("node", "labels"), "node")
    least = threshold - MARGIN * deviation(threshold)
    return stage_table(_spread(_blocks(members, ["tree", "prefix"], BUCKET_BLOCK), ["tree", "prefix", "p", "q"]).select(
        "tree", "prefix", "p", "q", "own", "node", "child", "labels").mapInArrow(
            _candidate_links(length, least), "a long, b long, agree long, pairs long"), f"met-{length}")


def candidates(nodes, threshold):
    """(links (a, b) that connect all candidate pairs of ``nodes(node, n, labels)``, prefix length that sufficed).

    Labels that are alone in their bucket at the shortest prefix are alone at every longer one and are left out first."""
    shortest = shortest_prefix(threshold)
    searched = nodes.where("n > 0")
    tries = searched.select("node", F.posexplode("labels").alias("tree", "label"))
    shared = tries.groupBy("tree", _prefix(shortest).alias("prefix")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    tries = stage_table(tries.withColumn("prefix", _prefix(shortest)).join(shared, ["tree", "prefix"], "left_semi").select(
        "node", "tree", "label"), "tries")
    links, pairs = None, Counter()
    for length in range(DEPTH, shortest - 1, -1):
        met = _met(tries, searched, length, threshold)
        links = met.where("a IS NOT NULL") if links is None else links.union(met.where("a IS NOT NULL"))
        for r in met.where("agree IS NOT NULL").groupBy("agree").agg(F.sum("pairs").alias("pairs")).collect():
            pairs[r.agree] += r.pairs
        # without pairs there is nothing to judge by, so the search goes on
        if pairs and estimated_recall(pairs, length, threshold) >= TARGET_RECALL:
            break
    return links.select("a", "b"), length


def overlaps(hashes, lengths, columns=1 << 14):
    """Sizes of all pairwise intersections of sets, by products of blocks of the incidence matrix."""
    values, col = np.unique(hashes, return_inverse=True)
    row = np.repeat(np.arange(len(lengths)), lengths)
    shared = np.bincount(col) > 1
    slot = np.cumsum(shared) - 1
    row, col = row[shared[col]], slot[col[shared[col]]]
    order = col.argsort(kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(lengths), len(lengths)), np.float64)
    for k in range(0, int(shared.sum()), columns):
        i, j = np.searchsorted(col, [k, k + columns])
        m = np.zeros((len(lengths), min(columns, int(shared.sum()) - k)), np.float32)
        m[row[i:j], col[i:j] - k] = 1
        out += m @ m.T
    return out


def _verified(threshold):
    keys = ["component", "p", "q"]

    def run(batches):
        for table in whole_groups(batches, keys):
            for i, j in _groups(table, keys):
                part = table.slice(i, j - i)
                sets = [np.frombuffer(x, np.uint64) for x in part["shingles"].to_pylist()]
                lengths = np.array([len(s) for s in sets])
                both = overlaps(np.concatenate(sets), lengths)
                linked = both >= threshold * (lengths[:, None] + lengths - both) - 1e-9
                own = part["own"].to_numpy()
                if part["p"][0].as_py() != part["q"][0].as_py():
                    linked &= own[:, None] != own
                np.fill_diagonal(linked, False)
                node, copies = part["node"].to_numpy(), part["copies"].to_numpy()
                a, b = np.nonzero(np.triu(linked))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(linked @ copies), pa.array(node[_roots(len(node), a, b)])], ["a", "links", "b"])
    return run


def _shingles(size):
    def run(batches):
        for batch in batches:
            for part in slices(batch, 0):
                hashes, n = shingle_sets(part.column(0), size)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([hashes[e - k:e].tobytes() for e, k in zip(ends, n, strict=True)], pa.binary())],
                    ["node", "component", "copies", "shingles"])
    return run


def _classes(docs, threshold, size):
    """(row signatures with ``doc_id, key, node``; one row per class with ``node, first, copies, links, group``)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("key"),
                       F.col("text").cast("string").alias("text"))
    rows = stage_table(base.mapInArrow(_signatures(size), "doc_id long, key long, node long, n long, labels array<long>"), "signatures")
    nodes = stage_table(
        rows.groupBy("node").agg(F.min_by(F.struct("doc_id", "key"), F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"),
                                 F.count(F.lit(1)).alias("copies"), F.first("labels").alias("labels"), F.first("n").alias("n")), "classes")
    links, _ = candidates(nodes, threshold)
    found = stage_table(components(links, "candidates"), "candidate-groups")
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("_size"))
    wanted = found.join(nodes.select("node", "first", "copies"), "node").select("node", "component", "copies", "first.*")
    keyed = base.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), "text").join(
        wanted, F.col("_doc").eqNullSafe(F.col("doc_id")) & F.col("_key").eqNullSafe(F.col("key"))).select(
        "text", "node", "component", "copies")
    # rows that repeat id and text give their class once
    sets = keyed.mapInArrow(_shingles(size), "node long, component long, copies long, shingles binary").dropDuplicates(["node"])
    checked = stage_table(
        _spread(_blocks(sets.join(sizes, "component"), ["component"], GROUP_BLOCK), ["component", "p", "q"]).select(
            "component", "p", "q", "own", "node", "copies", "shingles").mapInArrow(_verified(threshold), "a long, links long, b long"), "verified")
    groups = components(checked.select("a", "b"), "groups")
    links = checked.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    return rows.select("doc_id", "key", "node"), stage_table(
        nodes.select("node", "first", "copies").join(links, "node", "left").join(groups, "node", "left").select(
            "node", "first", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("group")), "joined")


def join(docs, *, threshold=THRESHOLD, size=SHINGLE):
    """One row per row of ``docs``: ``doc_id``, ``class_id`` and ``n_links``.

    ``n_links`` counts the other rows whose shingle sets have a Jaccard similarity of at least ``threshold``, copies
    included; ``class_id`` is the least ``doc_id`` connected by such links. Texts without words (null, empty, blank)
    are copies of each other and of nothing else. Repeated rows are copies. Sets are told apart by 64-bit hashes.
    """
    rows, nodes = _classes(docs, threshold, size)
    ids = nodes.groupBy("group").agg(F.min("first.doc_id").alias("class_id"))
    each = nodes.join(ids, "group").select("node", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return rows.select("doc_id", "node").join(each, "node").select("doc_id", "class_id", "n_links")


def keep_one(docs, *, threshold=THRESHOLD, size=SHINGLE):
    """Rows of ``docs``, all columns as they are, without near-duplicates: of each class the row with the least
    ``doc_id`` stays (null ids last, then by a hash of the text; one of rows that repeat id and text)."""
    _, nodes = _classes(docs, threshold, size)
    order = F.struct(F.col("first.doc_id").isNull(), F.col("first.doc_id"), F.col("first.key"))
    kept = nodes.groupBy("group").agg(F.min_by("first", order).alias("f")).select(F.col("f.doc_id").alias("doc"), F.col("f.key").alias("key"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc"),
                         F.xxhash64(F.col("text").cast("string")).alias("key"))
    match = packed["doc"].eqNullSafe(kept["doc"]) & packed["key"].eqNullSafe(kept["key"])
    chosen = packed.join(kept, match, "left_semi")
    one = F.row_number().over(Window.partitionBy("doc", "key").orderBy("key"))
    return chosen.withColumn("n", one).where("n = 1").select("row.*")
