"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a bag of words, each weighted by its count. For every word and each of K samples a hash gives
r, c ~ Gamma(2, 1) (minus the logarithm of a product of two uniforms) and b ~ U(0, 1); with
t = floor(ln(weight) / r + b) the sample's value is ln c - r (t - b + 1), and the fingerprint keeps the least value over
the words. Two texts agree on a sample with a probability equal to the generalised Jaccard similarity of their weights
(sum of minima / sum of maxima).

All samples of a text are one hash aggregation by text, on the partitioning that its words were counted in: the
shuffles carry texts, never words. A text and its edited text share the random numbers of their words.

exp of a text's least value is exponentially distributed with the text's number of words as its rate, so it is nearly
always below a small limit. Words whose value a bound without logarithms puts above that limit are not weighed; where
a least value does not come out below it, the text is taken again with all its words. The least values are those of all words.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapework.llm.common import parts_for
from tapework.session import stage_table

SAMPLES = 64
#: Characters of text that a task counts the words of, about.
CHARS_PER_TASK = 5_000_000
#: Stands for a null id in joins.
_NO_ID = -(2**63)
#: The limit that least values lie below, times the text's number of words: a sample misses it once in e^24 times.
_REACH = 24.0
#: Base-64 digits of a sample in a fingerprint, 18 bits.
_DIGITS = 3
#: Sides of a pair of texts: words that both have equally often, words of the text and of the edited text.
_BOTH, _OWN, _NEW = 0, 1, 2


def _uniforms(i, k):
    """Product of two uniform numbers from the halves of hash ``k`` of sample ``i``."""
    h = f"xxhash64(word, {3 * i + k})"
    return f"((({h} & 4294967295) + 0.5D) * (shiftrightunsigned({h}, 32) + 0.5D) * {2.0**-64!r}D)"


def _value(i):
    """Value of sample ``i`` for the columns ``word`` (a hash) and ``level``, ln(weight). Three hashes give r, c and b;
    all of it is arithmetic and three logarithms inside one aggregate's generated code. For a word that occurs once, as
    most do, t is 0, its level; notes have no level and no value."""
    minus_r, c = f"ln({_uniforms(i, 0)})", f"ln(-ln({_uniforms(i, 1)}))"
    b = f"((xxhash64(word, {3 * i + 2}) & 1048575) * {2.0**-20!r}D)"
    return F.expr(f"{c} + {minus_r} * (1.0D - {b} + CASE WHEN level > 0 THEN floor(level / -{minus_r} + {b}) ELSE level END)")


def _may_be_least(i):
    """False only where the value of sample ``i`` is above ln(``most`` / weight), with ``once`` 1 for a word that occurs once, 0 for others.

    exp of the value is -ln(v) u^(1 - b) for the former and at least -ln(v) u / weight for the others;
    -ln(v) >= 2 (1 - v) / (1 + v) and u^(1 - b) >= u / (1 - b (1 - u))."""
    u, v, b = _uniforms(i, 0), _uniforms(i, 1), f"((xxhash64(word, {3 * i + 2}) & 1048575) * {2.0**-20!r}D)"
    return F.expr(f"2.0D * (1.0D - {v}) * {u} <= most * (1.0D + {v}) * (1.0D - once * {b} * (1.0D - {u}))")


def _documents(docs):
    """``did`` (the id, the least long for null), ``text`` and ``key``, a hash of both that stands for the document."""
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    return docs.select(did.alias("did"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select(
        "did", F.xxhash64("did", "text").alias("key"), "text")


def _id():
    return F.when(F.col("did") != _NO_ID, F.col("did")).alias("doc_id")


def _tokens(text):
    return F.split(F.btrim(text, F.lit(" \t\r\n")), r"\s+")


def _counts(texts, sides, note=None):
    """Counts of every distinct word (by hash) of each row of ``texts``, one column a text column of ``sides``.

    ``fewest`` goes along: at most the words of any text whose least values are asked for, 0 to weigh all words.

    ``note`` is a column of 64 hexadecimal digits to carry along: its four numbers are words that count nowhere, with
    ``part`` from -1 to -4 (0 for words). They also keep rows without words."""
    note = F.lit("0" * 64) if note is None else note
    pieces = [F.struct(F.lit(k).alias("side"), F.col(c).alias("t")) for k, c in enumerate(sides)]
    pieces += [F.struct(F.lit(-1 - k).alias("side"), F.substring("note", 16 * k + 1, 16).alias("t")) for k in range(4)]
    word = F.when(F.col("side") >= 0, F.xxhash64("w")).otherwise(F.conv("w", 16, -10).cast("long"))
    return (
        texts.withColumn("note", note).withColumn("row", F.monotonically_increasing_id())
        .select("key", "number", "row", "fewest", F.explode(F.array(*pieces)).alias("s"))
        .select("key", "number", "row", "fewest", "s.side", F.explode(_tokens("s.t")).alias("w")).where("w <> ''")
        .groupBy("key", "number", "row", "fewest", word.alias("word"), F.least("side", F.lit(0)).alias("part"))
        .agg(*[F.sum((F.col("side") == k).cast("long")).alias(c) for k, c in enumerate(sides)])
    )


def _least(words, samples):
    """Least value of every sample per row and side; ``words`` has ``side``, ``word``, ``weight`` and ``part``, and the
    numbers of the rows' notes come out as ``note1`` to ``note4``. Words above the limit for ``fewest`` words are not
    weighed, so a least value is certain only where ``_certain`` says so."""
    weight = F.col("weight").cast("double")
    most = F.when(F.col("fewest") == 0, weight * float("inf")).otherwise(weight * _REACH / F.col("fewest"))
    leveled = words.select("key", "number", "row", "fewest", "side", "word", "part", F.ln(weight).alias("level"), most.alias("most"),
                           F.when(F.col("weight") > 1, 0.0).otherwise(1.0).alias("once"))
    return leveled.groupBy("key", "number", "row", "fewest", "side").agg(
        *[F.min(F.when(_may_be_least(i), _value(i))).alias(f"v{i}") for i in range(samples)],
        *[F.max(F.when(F.col("part") == -k, F.col("word"))).alias(f"note{k}") for k in range(1, 5)])


def _certain(samples):
    """Whether all least values of both texts of a row are below the limit, so that no word left out can be lower."""
    greatest = F.greatest(*[F.coalesce(f"{name}{i}", F.lit(float("inf"))) for name in ("own", "new") for i in range(samples)])
    return F.when(F.col("fewest") == 0, True).otherwise(greatest < F.ln(F.lit(_REACH) / F.col("fewest")) - 1e-6)


def _of_pairs(pairs, samples, every_word=False):
    """Least values of the text (``own0``...) and of the edited text (``new0``...) of every row, and the digest of the
    edited text in ``note1`` to ``note4``; ``fewest`` for ``_certain``.

    The part up to the last white space that both share is split into words once, and a word that both have equally
    often is weighed once."""
    kept = F.substring("text", F.lit(1), F.length("text") - F.floor(F.length("text") / 2).cast("int"))
    head = F.regexp_extract(kept, r"(?s)^(.*)\s", 1)
    rest = lambda c: F.substring(c, F.length("head") + 1, F.length(c))
    parts = pairs.select("key", "number", "text", "edited", head.alias("head")).select(
        "key", "number", "head", rest("text").alias("tail"), rest("edited").alias("patch"), F.sha2("edited", 256).alias("digest"))
    size = lambda c: F.size(F.array_remove(_tokens(c), ""))
    fewest = F.lit(0) if every_word else size("head") + F.least(size("tail"), size("patch"))
    counts = _counts(parts.withColumn("fewest", fewest), ["head", "tail", "patch"], F.col("digest")).select(
        "key", "number", "row", "fewest", "word", "part", (F.col("head") + F.col("tail")).alias("own"), (F.col("head") + F.col("patch")).alias("new"))
    one = lambda side, c: F.struct(F.lit(side).alias("side"), F.col(c).alias("weight"))
    used = (
        F.when(F.col("own") + F.col("new") == 0, None)
        .when(F.col("own") == F.col("new"), F.array(one(_BOTH, "own"))).when(F.col("new") == 0, F.array(one(_OWN, "own")))
        .when(F.col("own") == 0, F.array(one(_NEW, "new"))).when(F.col("new") > 0, F.array(one(_OWN, "own"), one(_NEW, "new")))
    )
    weighed = counts.select("key", "number", "row", "fewest", "word", "part", F.explode_outer(used).alias("u")).select(
        "key", "number", "row", "fewest", "word", "part", "u.*")
    return _least(weighed, samples).groupBy("key", "number", "row", "fewest").agg(
        *[F.min(F.when(F.col("side") != other, F.col(f"v{i}"))).alias(f"{name}{i}") for name, other in (("own", _NEW), ("new", _OWN)) for i in range(samples)],
        *[F.max(f"note{k}").alias(f"note{k}") for k in range(1, 5)])


def _printed(weight, samples):
    """Three base-64 digits a sample: unequal samples look equal once in 2^18 times. No words give the digits of 0."""
    bits = [f"lpad(hex(xxhash64(coalesce({weight}{i}, 0.0D)) & 16777215), 6, '0')" for i in range(samples)]
    return F.concat(*[F.expr(f"left(base64(unhex({x})), {_DIGITS})") for x in bits])


def likeness(a, b, samples=SAMPLES):
    """Share of equal samples of two fingerprints."""
    same = [F.when(F.substring(a, _DIGITS * i + 1, _DIGITS) == F.substring(b, _DIGITS * i + 1, _DIGITS), 1).otherwise(0) for i in range(samples)]
    return sum(same[1:], same[0]) / F.lit(float(samples))


def _numbered(keys):
    """Each distinct document's number, from 0, by descending id (null ids last), then by key.

    Range partitioned, numbered in each partition, shifted by the partitions before it: one row a partition."""
    order = [F.desc("did"), F.asc("key")]
    rows = stage_table(
        keys.groupBy("did", "key").agg(F.first("n_chars").alias("n_chars")).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "order")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return stage_table(rows.join(shifts, "part").select("did", "key", "n_chars", (F.col("shift") + F.col("place")).alias("number")), "numbers")


def with_edits(docs, samples=SAMPLES):
    """Fingerprints of every text and of its edited text.

    The edited text is the text with its last floor(n / 2) code points replaced by the first as many (or all) of the
    next document by descending ``doc_id``; after the last comes the first. Returns ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``, one row per row of
    ``docs``. Null texts are empty. Rows that repeat id and text are one document, whose next is the next other one;
    a table of one document has that as its next. Equal ids go by a hash of the text, null ids come last.
    """
    documents = _documents(docs)
    order = _numbered(documents.select("did", "key", F.length("text").alias("n_chars")))
    total, chars = order.agg(F.count(F.lit(1)), F.sum("n_chars")).first()
    last = F.lit(max(total, 1))
    # one shuffle of the texts and one of the prefixes: all that follows reads these two
    parts = parts_for(chars or 0, CHARS_PER_TASK, 2)
    base = documents.select("key", "text").repartition(parts, "key")
    # what the document before asks of each: its own key and half its length
    asks = order.select(F.pmod(F.col("number") + 1, last).alias("number"), F.col("key").alias("to"), F.col("number").alias("to_number"),
                        F.floor(F.col("n_chars") / 2).cast("int").alias("asked"))
    asked = order.select("number", "key").join(asks, "number").drop("number")
    prefixes = base.join(asked, "key").select(
        F.col("to").alias("key"), F.col("to_number").alias("number"), F.substring("text", F.lit(1), F.col("asked")).alias("prefix")
    ).repartition(parts, "key").dropDuplicates(["key"])  # equal where a document is repeated
    kept = F.substring("text", F.lit(1), F.length("text") - F.floor(F.length("text") / 2).cast("int"))
    pairs = base.join(prefixes, "key").select("key", "number", "text", F.concat(kept, F.col("prefix")).alias("edited"))
    digest = F.lower(F.concat(*[F.lpad(F.hex(f"note{k}"), 16, "0") for k in range(1, 5)]))
    printed = lambda rows: stage_table(
        rows.select("number", digest.alias("edited_sha256"), _printed("own", samples).alias("fingerprint"),
                    _printed("new", samples).alias("edited_fingerprint"), _certain(samples).alias("certain"))
        .withColumn("near_edited", likeness("fingerprint", "edited_fingerprint", samples)), "fingerprints")
    done = printed(_of_pairs(pairs, samples))
    open_ = done.where(~F.col("certain")).select("number").distinct()
    if not open_.isEmpty():
        again = pairs.join(order.join(open_, "number").select("key"), "key", "left_semi")
        done = done.where("certain").unionByName(printed(_of_pairs(again, samples, every_word=True)))
    after = done.select(F.pmod(F.col("number") - 1, last).alias("number"), F.col("fingerprint").alias("_next")).dropDuplicates(["number"])
    named = order.select("number", _id(), F.col("n_chars").cast("long").alias("n_chars"))
    return done.join(after, "number").join(named, "number").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", likeness("fingerprint", "_next", samples).alias("near_next"))


def fingerprints(docs, samples=SAMPLES):
    """``doc_id`` and ``fingerprint`` of every row of ``docs``; null and empty texts share the fingerprint of no words."""
    base = _documents(docs).select(F.col("did").alias("number"), "key", "text").repartition("key")
    words = _counts(base.withColumn("fewest", F.lit(0)), ["text"])
    weighed = words.select("key", "number", "row", "fewest", "word", "part", F.lit(_OWN).alias("side"), F.when(F.col("text") > 0, F.col("text")).alias("weight"))
    return _least(weighed, samples).withColumnRenamed("number", "did").select(_id(), _printed("v", samples).alias("fingerprint"))
