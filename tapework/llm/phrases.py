"""Phrase collocations by set-oriented mining of occurrence relations (SETM).

The relation of length k holds one occurrence a row: a position and the id of the k words that start there, sorted by
position, written to the shared folder in blocks of whole pieces. Positions run on inside a piece and jump by two
between pieces, so the relation of length k + 1 is a merge join of that of length k with itself at adjacent
positions. Groups are counted in each batch before they are shuffled; those that are frequent are semi-joined to the
occurrences before the next length is built. The texts are read twice, so that only frequent words are persisted.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.llm.common import whole_groups
from tapework.llm.tokens import LOWER, byte_class, cut, ranges, run_ids, runs
from tapework.llm.words import mix, string_bytes, string_hashes
from tapework.session import stage_table, unstage

LEAST_COUNT = 100
LONGEST = 5
TOP = 2_000
#: Words of a block of the relation; a longer piece is a block alone.
BLOCK = 256
#: Frequent groups up to this many (32 MB of ids) are broadcast for the semi-join; more are joined by a shuffle.
BROADCAST_IDS = 1 << 22
#: Rare phrases that share a slot of the rough count, as a part of the least count.
SLOT_LOAD = 1 / 16
#: Rows that one task ranks.
RANK_ROWS = 50_000

PIECE = byte_class(".,;:!?\n\x0b\x0c\r")
WORD = ~(PIECE | byte_class(" \t"))
RELATION = "at array<int>, ids array<long>"
UNKNOWN = "und"


def _blocks(ids, fresh):
    """Columns ``at`` and ``ids``: rows of whole runs, cut where ``fresh`` says that a run starts."""
    order = np.arange(len(ids))
    at = order + np.cumsum(fresh)
    run = np.maximum.accumulate(np.where(fresh, order, 0))
    first = np.flatnonzero(np.concatenate([[True], np.diff(run // BLOCK) > 0]) & fresh) if len(ids) else order
    sizes = np.diff(np.append(first, len(ids)))
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    at = at - np.repeat(at[first], sizes)
    return [pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(ids.view(np.int64)))]


def _batch(schema, **columns):
    """Record batch of ``schema``; columns that are not given are null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in schema], schema=schema)


_WORDS = pa.schema([("at", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64())), ("id", pa.int64()), ("n", pa.int64()),
                    ("lang", pa.string()), ("word", pa.string())])
_GROUPS = pa.schema([*list(_WORDS)[:2], ("part", pa.int64()), ("id", pa.binary()), ("left", pa.binary()), ("right", pa.binary())])
_COUNTS = pa.schema([("id", pa.int64()), ("n", pa.int64())])
WORDS = f"{RELATION}, id long, n long, lang string, word string"
GROUPS = f"{RELATION}, part long, id binary, left binary, right binary"
#: Parts by the first bits of an id in which groups are gathered.
PART_BITS = 8


def _words_of(batch):
    """Ranges of a batch of (text, lang): lower-cased bytes, where their words start and end, the id of each word, its row, and
    a number that changes between pieces."""
    raw, offsets = string_bytes(batch.column(0))
    # mixed once more: a word that is spelled like its language must not cancel it
    salt = mix(string_hashes(batch.column(1)) + np.uint64(0x9E3779B97F4A7C15))
    for lo, hi in ranges(raw, offsets, PIECE):
        low = LOWER[raw[lo:hi]]
        starts, ends = runs(WORD[low], offsets - lo)
        if len(starts):
            row = np.searchsorted(offsets, starts + lo, "right") - 1
            piece = np.concatenate([[0], np.cumsum(PIECE[low])])[starts] + row
            yield low, starts, ends, mix(run_ids(low, starts, ends) ^ salt[row]), row, piece


def _count_words(batches):
    """(text, lang) → counts of the words of a range of texts."""
    for batch in batches:
        for _, _, _, ids, _, _ in _words_of(batch):
            some, count = np.unique(ids, return_counts=True)
            yield _batch(_COUNTS, id=pa.array(some.view(np.int64)), n=pa.array(count))


def _occurrences(frequent):
    """(text, lang) → the relation of frequent words, the spelling of each, and the languages' words.
    Without ``frequent`` every word is taken."""
    def run(batches):
        told = None if frequent is None else np.zeros(len(frequent.value), bool)
        for batch in batches:
            for low, starts, ends, ids, row, piece in _words_of(batch):
                held, lengths = np.unique(row, return_counts=True)
                yield _batch(_WORDS, lang=batch.column(1).take(pa.array(held)), n=pa.array(lengths))
                keep = np.arange(len(ids)) if frequent is None else np.flatnonzero(_member(ids, frequent.value))
                if not len(keep):
                    continue
                at, found = _blocks(ids[keep], np.concatenate([[True], (np.diff(keep) > 1) | (np.diff(piece[keep]) > 0)]))
                yield _batch(_WORDS, at=at, ids=found)
                some, first = np.unique(ids[keep], return_index=True)
                first = keep[first]
                if told is not None:  # a task spells a word once
                    at = np.searchsorted(frequent.value, some)
                    some, first = some[~told[at]], first[~told[at]]
                    told[at] = True
                words = pa.array(cut(low, starts[first], ends[first]), pa.binary()).cast(pa.string())
                yield _batch(_WORDS, id=pa.array(some.view(np.int64)), lang=batch.column(1).take(pa.array(row[first])), word=words)
    return run


def _flat(batch):
    ids = batch.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    at = batch.column(0).flatten().to_numpy(zero_copy_only=False)
    # blocks start at position 0, so the last of a block and the first of the next are never adjacent
    return ids, np.flatnonzero(np.diff(at) == 1)


def _joined(left, right):
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + mix(right + np.uint64(1)))


def _member(ids, wanted):
    if not len(wanted):
        return np.zeros(len(ids), bool)
    return wanted[np.minimum(np.searchsorted(wanted, ids), len(wanted) - 1)] == ids


def _sketch(bits, part_bits, known=None, known_bits=64):
    """Relation of length k → rows (part, keys, counts): the phrases of k + 1 words of a batch, by the first ``bits`` of their
    ids, sorted and cut into parts by the first ``part_bits``; with ``known`` only those whose first ``known_bits`` are in it.
    Keys are steps from one to the next; the bytes of steps and counts are written plane by plane, of which the upper ones
    are nearly empty and vanish in the shuffle's compression."""
    def run(batches):
        for batch in batches:
            ids, pairs = _flat(batch)
            joined = _joined(ids[pairs], ids[pairs + 1])
            if known is not None:
                joined = joined[_member(joined >> np.uint64(64 - known_bits), known.value)]
            keys, counts = np.unique(joined >> np.uint64(64 - bits), return_counts=True)
            if not len(keys):
                continue
            part = keys >> np.uint64(bits - part_bits)
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            steps = np.diff(keys, prepend=np.uint64(0))
            steps[first] = keys[first] - (part[first] << np.uint64(bits - part_bits))
            ends = np.append(first[1:], len(keys)).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(part[first].astype(np.int64)),
                pa.array([_planes(steps[a:b]) for a, b in zip(first.tolist(), ends)], pa.binary()),
                pa.array([_planes(counts[a:b].astype(np.uint64)) for a, b in zip(first.tolist(), ends)], pa.binary())], ["part", "keys", "counts"])
    return run


def _planes(values):
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(planes):
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _dense(least, bits, part_bits):
    """Rows of ``_sketch`` sorted by part → (id, f): the keys that occur at least ``least`` times, with their counts."""
    def run(batches):
        for group in whole_groups(batches, ["part"]):
            for part, (first, last) in _bounds(group.column("part").to_numpy()):
                rows = group.slice(first, last - first)
                keys = np.concatenate([np.cumsum(_values(x)) for x in rows.column("keys").to_pylist()])
                counts = np.concatenate([_values(x) for x in rows.column("counts").to_pylist()])
                order = np.argsort(keys, kind="stable")
                keys, counts = keys[order], counts[order]
                start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                total = np.add.reduceat(counts, start)
                held = keys[start][total >= least] + (np.uint64(part) << np.uint64(bits - part_bits))
                yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(total[total >= least].astype(np.int64))], ["id", "f"])
    return run


def _bounds(parts):
    first = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
    return zip(parts[first].tolist(), zip(first.tolist(), np.append(first[1:], len(parts)).tolist()))


def _extend(frequent, last):
    """Relation of length k - 1 → the frequent part of that of length k, and the parts of its groups."""
    def run(batches):
        for batch in batches:
            ids, pairs = _flat(batch)
            joined = _joined(ids[pairs], ids[pairs + 1])
            keep = _member(joined, frequent.value)
            yield from _grown(joined[keep], pairs[keep], ids, last)
    return run


def _grown(joined, pairs, ids, last):
    some, first = np.unique(joined, return_index=True)
    yield _packed(some, ids[pairs[first]], ids[pairs[first] + 1])
    if last or not len(joined):
        return
    fresh = np.concatenate([[True], np.diff(pairs) > 1])
    at, found = _blocks(joined, fresh)
    yield _batch(_GROUPS, at=at, ids=found)


def _packed(some, left, right):
    """Sorted groups and their two parts, a row for each part of the ids."""
    part = some >> np.uint64(64 - PART_BITS)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(some) else np.zeros(0, np.int64)
    cuts = list(zip(first.tolist(), np.append(first[1:], len(some)).tolist()))
    return _batch(_GROUPS, part=pa.array(part[first].astype(np.int64)),
                  **{name: pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary()) for name, x in (("id", some), ("left", left), ("right", right))})


def _unpacked(batches):
    """Rows of ``_packed`` sorted by part → (id, left, right), each group once."""
    for group in whole_groups(batches, ["part"]):
        for _, (first, last) in _bounds(group.column("part").to_numpy()):
            rows = group.slice(first, last - first)
            ids, left, right = (np.concatenate([np.frombuffer(x, np.uint64) for x in rows.column(c).to_pylist()]) for c in ("id", "left", "right"))
            some, at = np.unique(ids, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (some, left[at], right[at])], ["id", "left", "right"])


def _pairs_of(batches):
    """Relation of length k - 1 → rows of arrays (at, ids, left, right) of length k, nothing left out."""
    for batch in batches:
        ids, pairs = _flat(batch)
        at = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(0).offsets.to_numpy()))
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[pairs], minlength=batch.num_rows))]).astype(np.int32))
        def column(values):
            return pa.ListArray.from_arrays(ends, pa.array(values))
        yield pa.RecordBatch.from_arrays([column(at[pairs].astype(np.int32)), column(_joined(ids[pairs], ids[pairs + 1]).view(np.int64)),
                                          column(ids[pairs].view(np.int64)), column(ids[pairs + 1].view(np.int64))], ["at", "ids", "left", "right"])


def _regrown(last):
    """As ``_extend`` on rows that the semi-join by shuffle has left."""
    def run(batches):
        for batch in batches:
            at, ids, left, right = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in range(4))
            ids, left, right = (x.view(np.uint64) for x in (ids, left, right))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(0).offsets.to_numpy()))
            some, first = np.unique(ids, return_index=True)
            yield _packed(some, left[first], right[first])
            if last or not len(ids):
                continue
            fresh = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(owner) != 0)])
            columns = _blocks(ids, fresh)
            yield _batch(_GROUPS, at=columns[0], ids=columns[1])
    return run


def _kept(rows, frequent, names):
    """Rows of arrays (at, …) of which only the occurrences with a frequent id are left, by a shuffle of occurrences."""
    one = rows.withColumn("_block", F.monotonically_increasing_id()).select("_block", F.inline(F.arrays_zip(*names)))
    held = one.join(frequent.select(F.col("id").alias("ids")), "ids", "left_semi")
    back = held.groupBy("_block").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("_rows"))
    return back.select(*[F.col(f"_rows.{n}").alias(n) for n in names])


def _known(frequent, broadcast_ids):
    """Sorted ids of ``frequent`` as a broadcast, None if they are more than ``broadcast_ids``."""
    if frequent.count() > broadcast_ids:
        return None
    return frequent.sparkSession.sparkContext.broadcast(np.sort(frequent.select("id").toArrow().column(0).to_numpy().view(np.uint64)))


def _first_relation(texts, frequent, broadcast_ids):
    """(table of the spellings and languages, relation of the frequent words)."""
    known = _known(frequent, broadcast_ids)
    table = stage_table(texts.mapInArrow(_occurrences(known), WORDS), "phrases-1")
    relation = table.where("at is not null").select("at", "ids")
    if known is None:
        kept = _kept(relation, frequent, ["at", "ids"]).mapInArrow(_reblocked, RELATION)
        relation = stage_table(kept, "phrases-1")
    return table, relation


def _extended(relation, frequent, last, broadcast_ids):
    """What the next length brings: its relation and the parts of its groups."""
    known = _known(frequent, broadcast_ids)
    if known is not None:
        return relation.mapInArrow(_extend(known, last), GROUPS)
    pairs = relation.mapInArrow(_pairs_of, f"{RELATION}, left array<long>, right array<long>").where(F.size("at") > 0)
    return _kept(pairs, frequent, ["at", "ids", "left", "right"]).mapInArrow(_regrown(last), GROUPS)


def _frequent(relation, least, words, broadcast_ids):
    """Phrases (id, f) one word longer than those of ``relation`` that occur at least ``least`` times.

    Most such phrases are rare. So they are first counted in slots by the first bits of their ids, as many slots as keep the
    rare ones of a slot far below ``least``, and then those of slots that reach it are counted by their whole ids.
    """
    bits = min(60, max(16, int(words / (least * SLOT_LOAD)).bit_length()))
    part_bits = min(bits, max(6, words.bit_length() - 17))

    def counted(bits, **known):
        rows = relation.mapInArrow(_sketch(bits, part_bits, **known), "part long, keys binary, counts binary")
        return rows.repartition("part").sortWithinPartitions("part").mapInArrow(_dense(least, bits, part_bits), "id long, f long")

    dense = stage_table(counted(bits), "dense")
    frequent = stage_table(counted(64, known=_known(dense, broadcast_ids), known_bits=bits), "frequent")
    unstage(dense)
    return frequent


def _reblocked(batches):
    """Rows (at, ids) with gaps → blocks whose positions run on where words were adjacent."""
    for batch in batches:
        at, ids = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in range(2))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(0).offsets.to_numpy()))
        if len(ids):
            fresh = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(owner) != 0)])
            yield pa.RecordBatch.from_arrays(_blocks(ids.view(np.uint64), fresh), ["at", "ids"])


def mine(docs, *, least=LEAST_COUNT, longest=LONGEST, broadcast_ids=BROADCAST_IDS):
    """Phrases of 2 to ``longest`` words that occur at least ``least`` times in a language, with all counts.

    Returns ``lang``, ``phrase`` (words joined by one space), ``length``, ``a`` (its occurrences), ``n`` (words of the
    language), ``heads`` and ``tails`` (occurrences of its first 1, 2, … and of its last 1, 2, … words), ``longer`` (the most
    occurrences of a frequent phrase of one word more that holds it, null if none).

    Texts are lower-cased in A-Z only. A null language is ``und``, null and empty texts have no words, repeated rows
    count each, an empty table gives no rows, other columns stay out. A text of any length is worked on in ranges that
    end with a piece; ids are 64-bit hashes of the language and the words.
    """
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    counts = texts.mapInArrow(_count_words, "id long, n long").groupBy("id").agg(F.sum("n").alias("f"))
    frequent = stage_table(counts.where(F.col("f") >= least), "frequent")
    table, relation = _first_relation(texts, frequent, broadcast_ids)
    spelled = table.where("word is not null").groupBy("id").agg(F.first("lang").alias("lang"), F.first("word").alias("phrase"))
    totals = stage_table(table.where("n is not null").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    nothing = F.array().cast("array<long>")
    level = stage_table(frequent.join(spelled, "id").select("id", "lang", "phrase", "f", nothing.alias("heads"), nothing.alias("tails")), "frequent-1")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    found = []
    for k in range(2, longest + 1):
        frequent = _frequent(relation, least, n_words, broadcast_ids)
        longer = stage_table(_extended(relation, frequent, k == longest, broadcast_ids), f"phrases-{k}")
        unstage(table)
        table = longer
        parts = (
            table.where("part is not null").select("part", "id", "left", "right").repartition("part").sortWithinPartitions("part")
            .mapInArrow(_unpacked, "id long, left long, right long")
        )
        head = level.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("_start"), F.col("f").alias("_l"), "heads")
        tail = level.select(F.col("id").alias("right"), F.substring_index("phrase", " ", -1).alias("_end"), F.col("f").alias("_r"), "tails")
        level = stage_table(
            frequent.join(parts, "id").join(head, "left").join(tail, "right").select(
                "id", "lang", F.concat_ws(" ", "_start", "_end").alias("phrase"), "f", "left", "right",
                F.concat("heads", F.array("_l")).alias("heads"), F.concat("tails", F.array("_r")).alias("tails")), f"frequent-{k}")
        found.append(level)
        relation = table.where("at is not null").select("at", "ids")
    rows = []
    for k, part in enumerate(found, 2):
        part = part.drop("left", "right").withColumn("length", F.lit(k))
        if k < longest:
            longer = found[k - 1]
            inside = longer.select(F.explode(F.array("left", "right")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("longer"))
            part = part.join(inside, "id", "left")
        else:
            part = part.withColumn("longer", F.lit(None).cast("long"))
        rows.append(part.select("lang", "phrase", "length", F.col("f").alias("a"), "heads", "tails", "longer"))
    every = rows[0]
    for part in rows[1:]:
        every = every.unionByName(part)
    return every.join(totals, "lang")


def scored(phrases):
    """``phrases`` (of ``mine``) with the least-scoring cut: ``l``, ``r`` and ``score`` = floor(1000 a n / (l r)).

    Products are decimals of 38 digits, quotients exact whole numbers; equal scores go to the shorter first part.
    """
    judged = F.expr("""array_min(transform(sequence(1, length - 1), k -> named_struct(
        'score', (cast(1000 * a AS decimal(19,0)) * cast(n AS decimal(19,0)))
                 div (cast(get(heads, k - 1) AS decimal(19,0)) * cast(get(tails, length - k - 1) AS decimal(19,0))),
        'k', k, 'l', get(heads, k - 1), 'r', get(tails, length - k - 1))))""")
    return phrases.withColumn("_best", judged).select(
        "lang", "phrase", "a", F.col("_best.l").alias("l"), F.col("_best.r").alias("r"), "n", F.col("_best.score").alias("score"), "longer")


def first_of(rows, key, order, top, n_rows, rank_rows=RANK_ROWS):
    """The first ``top`` rows of each ``key`` in ``order`` with their ``rank``: slices by a hash are cut to their own first
    rows, round by round, until one task can rank what is left of a key."""
    rank_rows = max(rank_rows, 4 * top)  # so that each round leaves a quarter of the slices at most
    slices = -(-n_rows // rank_rows)
    while slices > 1:
        spread = rows.withColumn("_slice", F.pmod(F.xxhash64(*rows.columns), F.lit(slices)))
        rows = spread.withColumn("_rank", F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order))).where(F.col("_rank") <= top).drop("_rank", "_slice")
        slices = -(-slices * top // rank_rows)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top)


def collocations(docs, *, top=TOP, rank_rows=RANK_ROWS, **options):
    """Each language's first ``top`` phrases by score, occurrences and bytes of the phrase: ``lang``, ``rank``, ``phrase``,
    ``a``, ``l``, ``r``, ``n``, ``score``. Phrases inside a longer one that is as frequent are left out. Nulls, empty
    tables and repeated rows as in ``mine``."""
    rows = scored(mine(docs, **options))
    alone = stage_table(rows.where(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer"), "collocations")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    return first_of(alone, "lang", order, top, alone.count(), rank_rows).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
