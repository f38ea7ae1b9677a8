"""Secrets: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Everything here is DataFrame functions. Positions come from the lengths of what a pattern splits off and of what it
matches. Both Markov models are bigram counts of labelled samples; a token's log-likelihood ratio is the sum of the
table's entries for its neighbouring characters.
"""

import math
import string

from pyspark.sql import functions as F

#: Kinds in the order of a tie, their patterns, and the least length of what counts.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: A cheap test that is true wherever a kind has a match that counts.
_MAY = {"assign": lambda t: t.rlike(r"""[dtnyDTNY"'\x20][:=]""") & t.rlike(ASSIGN), "access": lambda t: F.contains(t, F.lit("AKIA")), "hex": lambda t: t.rlike(r"[0-9a-f]{24}")}

ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_="
#: Tokens the Markov models judge, runs of 12 characters and groups of four and more joined by dashes or dots, and the
#: log-likelihood ratio from which one counts as random.
#: No match starts inside a run or gives characters back, which the pattern says so that ordinary words are passed quickly.
TOKEN = r"(?<![A-Za-z0-9+/_=])(?:[A-Za-z0-9+/_=]{4,}+(?:[.-][A-Za-z0-9+/_=]{4,}+){2,}+|[A-Za-z0-9+/_=]{12,}+)"
LEAST_RATIO = 12.0
#: Code points of the blocks that masking cuts texts into.
MASK_BLOCK = 256
_STRETCHES = "array<struct<start:int,end:int>>"
#: Elements that one step of a scan walks; what it gathers is copied within the step only.
SCAN = 256
#: Weight, in counts, of a character's own frequency against that after another.
BACK_OFF = 8.0
#: Documents whose tokens a fit may use.
TRAIN_DOCS = 20_000


_SPANS = "array<struct<start:int,kind:int,end:int>>"


def bound(value, body):
    """``body(value)`` with ``value`` computed once: a column named inside a lambda would be computed at each element."""
    return F.get(F.transform(F.array(value), body), 0)


def scan_array(items, state, kind, step):
    """Walk an array from left to right: ``step(state, item)`` gives the next state and an array (type ``kind``) of what the
    item yields; all yields together. Work is linear in the items: they are walked in runs of ``SCAN``, and only a run's
    own yields are copied while it is walked."""
    def run(acc, part):
        def one(inner, item):
            after, out = step(inner["state"], item)
            return F.struct(after.alias("state"), F.concat(inner["out"], out).alias("out"))

        walked = F.aggregate(part, F.struct(acc["state"].alias("state"), F.array().cast(kind).alias("out")), one)
        return bound(walked, lambda w: F.struct(w["state"].alias("state"), F.concat(acc["out"], F.array(w["out"])).alias("out")))

    def whole(v):
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / SCAN).cast("int")), lambda i: F.slice(v, i * SCAN + 1, F.lit(SCAN)))
        walked = F.aggregate(parts, F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out")), run, lambda acc: acc["out"])
        return F.when(F.size(v) > 0, F.flatten(walked)).otherwise(F.array().cast(kind))

    return bound(items, whole)


def matches(text, pattern, kind, keep, group=0):
    """Array of (start, kind, end) of the pattern's leftmost matches in the column ``text``, in code points.

    ``keep(value)`` says of a match's ``group`` whether it counts; what fails is dropped and not searched again. Texts are
    split by the pattern once, and positions are running sums of the pieces' lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = [F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")] if group else []
    # the piece behind the last match has no match
    steps = F.transform(F.filter(F.arrays_zip(found.alias("found"), F.split(text, pattern, -1).alias("piece"), *values), lambda x: x["found"].isNotNull()),
                        lambda x: F.struct(F.length(x["piece"]).alias("gap"), F.length(x["found"]).alias("size"), keep(x["value" if group else "found"]).alias("kept")))

    def step(at, x):
        begin, end = at + x["gap"], at + x["gap"] + x["size"]
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))
        return end, F.when(x["kept"], F.array(span)).otherwise(F.array().cast(_SPANS))

    return scan_array(steps, F.lit(0), _SPANS, step)


def _none():
    return F.array().cast(_SPANS)


def base_spans(text):
    """All spans of the fixed patterns, sorted by start, then kind as listed; ``text`` must not be null."""
    def long_enough(least):
        return lambda value: F.length(value) >= least

    kinds = (("assign", ASSIGN, 1), ("access", ACCESS, 0), ("hex", r"[0-9a-f]{24,}", 0))
    return F.array_sort(F.concat(*[
        F.when(_MAY[k](text), matches(text, p, k, long_enough(LEAST[k]), g)).otherwise(_none()) for k, p, g in kinds]))


def written(spans):
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def labelled_tokens(docs, rows=TRAIN_DOCS):
    """Training samples ``(token, is_random)`` from at most ``rows`` documents, the first by a hash of the id and one text an id: what the
    fixed patterns find is random, the other tokens of four and more characters are ordinary."""
    ids = docs.select(F.col("doc_id").cast("long").alias("_id")).dropna().distinct().orderBy(F.xxhash64("_id"), "_id").limit(rows)
    given = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("t")).join(F.broadcast(ids), "_id")
    texts = given.groupBy("_id").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    secret = F.concat(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(1)), F.regexp_extract_all("t", F.lit(ACCESS), F.lit(0)),
                      F.regexp_extract_all("t", F.lit(r"[0-9a-f]{24,}"), F.lit(0)))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), ACCESS, " "), r"[0-9a-f]{24,}", " ")
    plain = F.regexp_extract_all(rest, F.lit(r"[A-Za-z0-9+/_=]{4,}"), F.lit(0))
    both = F.concat(F.transform(F.filter(secret, lambda s: F.length(s) >= 12), lambda s: F.struct(s.alias("token"), F.lit(True).alias("is_random"))),
                    F.transform(plain, lambda s: F.struct(s.alias("token"), F.lit(False).alias("is_random"))))
    return texts.select(F.explode(both).alias("x")).select("x.*")


def train(samples):
    """Log-likelihood ratios of all character pairs, from ``samples(token, is_random)``; None without both labels.

    A pair's probability is that of its second character after its first, backed off to the second alone where the
    first is rare, with one added to every count. Only pairs over ``ALPHABET`` count, so at most two counts per pair
    reach the driver.
    """
    pairs = F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring("token", i, F.lit(2))))
    counts = (
        samples.where("token is not null and is_random is not null and length(token) > 1").select("is_random", pairs.alias("pair"))
        .where(F.col("pair").rlike("^[A-Za-z0-9+/_=]{2}$")).groupBy("is_random", "pair").agg(F.count(F.lit(1)).alias("n"))
    )
    n = {(r["is_random"], r["pair"]): r["n"] for r in counts.collect()}
    if {k for k, _ in n} != {True, False}:
        return None
    logs = {}
    for kind in (True, False):
        alone = {b: 1 + sum(n.get((kind, a + b), 0) for a in ALPHABET) for b in ALPHABET}
        total = sum(alone.values())
        for a in ALPHABET:
            after = sum(n.get((kind, a + b), 0) for b in ALPHABET)
            for b in ALPHABET:
                logs[kind, a + b] = math.log((n.get((kind, a + b), 0) + BACK_OFF * alone[b] / total) / (after + BACK_OFF))
    return [logs[True, a + b] - logs[False, a + b] for a in ALPHABET for b in ALPHABET]


def ratio(token, table):
    """Log-likelihood ratio of a column of tokens: random against ordinary. Pairs with a character outside ``ALPHABET``, the
    dashes and dots between groups, say nothing."""
    values = F.split(F.lit(",".join(f"{x:.4f}" for x in table)), ",").cast("array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    steps = F.zip_with(F.slice(codes, 1, F.length(token) - 1), F.slice(codes, 2, F.length(token) - 1), lambda a, b: F.when((a >= 0) & (b >= 0), F.get(values, a * len(ALPHABET) + b)).otherwise(0.0))
    return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + x)


def with_spans(docs, table, *, out="_spans", base="_base", text="text"):
    """``docs`` with arrays of (start, kind, end): the fixed patterns' and all; null texts have empty arrays.

    Of a random token that overlaps spans of the fixed patterns, the parts outside of them are added.
    """
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    docs = docs.withColumn(base, base_spans(t))
    if table is None:
        return docs.withColumn(out, F.col(base))

    def is_random(token):
        return ratio(token, table) >= LEAST_RATIO

    # most texts have no random token, so positions are sought only where one is
    judged = F.when(F.exists(F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0)), is_random), matches(t, TOKEN, "random", is_random)).otherwise(_none())
    docs = docs.withColumn("_random", judged)
    added = F.when(F.size("_random") > 0, _outside(F.col(base), F.col("_random"))).otherwise(_none())
    return docs.withColumn(out, F.array_sort(F.concat(F.col(base), added))).drop("_random")


def _outside(base, random):
    """What of the spans ``random``, which are apart from each other, no span of ``base`` covers; one walk over all by start."""
    kind, far = F.lit(KINDS.index("random")), F.lit(2**31 - 1)

    def span(start, end):
        return F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"))

    def step(state, x):
        is_random, rest = x["kind"] == kind, state["start"] < state["end"]
        covered = F.greatest(state["covered"], F.when(is_random, state["covered"]).otherwise(x["end"]))
        # what is pending ends where the next span starts; a random one then becomes pending, from what is covered on
        ends = F.when(is_random, state["end"]).otherwise(F.least(state["end"], x["start"]))
        done = rest & (state["start"] < ends)
        after = F.struct(
            covered.alias("covered"),
            F.when(is_random, F.greatest(x["start"], state["covered"])).otherwise(F.greatest(state["start"], x["end"])).alias("start"),
            F.when(is_random, x["end"]).otherwise(state["end"]).alias("end"))
        return after, F.when(done, F.array(span(state["start"], ends))).otherwise(_none())

    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    every = F.array_sort(F.concat(base, random, F.array(span(far, far))))
    return scan_array(every, start, _SPANS, step)


def scan(docs, table):
    """Per row: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` (kind:start:end).

    Null and empty texts have no spans, repeated rows are scanned each, an empty table gives no rows, other columns stay
    out. The work grows with a text's length and its matches, however long it is.
    """
    rows = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), table)

    def count(kind):
        return F.size(F.filter("_base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *map(count, KINDS[:3]), F.sha2(written(F.col("_base")), 256).alias("base_sha256"), written(F.col("_spans")).alias("spans"))


def mask(docs, table, marker="[SECRET]"):
    """``docs`` with every span of a secret replaced by ``marker``; ``n_chars``, if there, follows the new text.

    All rows and columns stay; a null text stays null, an empty table stays empty. Spans that overlap are replaced as one.
    Texts of any length are masked whole.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("text").cast("string").alias("text"))
    rows = with_spans(packed, table)
    text = F.col("text")

    def step(at, s):
        # the stretch before a span that starts behind all before
        kept = F.struct(at.alias("start"), s["start"].alias("end"))
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, F.array(kept)).otherwise(F.array().cast(_STRETCHES))

    def masked_in(blocks, size):
        def cut(start, end):
            first, last = F.floor(start / MASK_BLOCK).cast("int"), F.floor((end - 1) / MASK_BLOCK).cast("int")
            near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
            return F.when(end > start, F.substring(near, start - first * MASK_BLOCK + 1, end - start)).otherwise(F.lit(""))

        stretches = F.transform(scan_array(F.col("_spans"), F.lit(0), _STRETCHES, step), lambda s: cut(s["start"], s["end"]))
        return F.concat(F.array_join(stretches, marker), F.lit(marker), cut(F.array_max(F.transform("_spans", lambda s: s["end"])), size))

    # cutting by position walks a text from its start, so it is cut into blocks once and stretches are cut from these
    masked = bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{MASK_BLOCK}}}"), F.lit(0)), lambda blocks: masked_in(blocks, F.length(text)))
    new = F.when(F.size("_spans") > 0, masked).otherwise(text)
    rows = rows.select("_row", new.alias("_new"))
    chars = docs.schema["n_chars"].dataType if "n_chars" in names else None
    return rows.select(*[
        F.col("_new").cast(docs.schema["text"].dataType).alias("text") if c == "text"
        else F.when(F.col("_new").isNull(), F.col("_row.n_chars")).otherwise(F.length("_new").cast(chars)).alias(c) if c == "n_chars"
        else F.col(f"_row.`{c}`").alias(c) for c in names])
