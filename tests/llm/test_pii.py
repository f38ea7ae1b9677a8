import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from odd_tables import none, odd, words  # noqa: F401
from tapework.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and (not 14 <= len(digits) <= 19 or doubled % 10):
                continue
            if kind != "phone" or 10 <= len(digits) <= 15:
                out.append((m.start(), k, m.end()))
    return sorted(out)


PIECES = ["a", "b.c", "@", "@x.de", "x@y.z", "%", ".", "-", " ", "1", "255", "256", "0.0.0.0", "1.2.3.4", "4111111111111111", "4111 1111 1111 1111",
          "+49 (30) 123456", "+1", "12-34", "(", ")", "é", "🙂", "\n", "0123456789", "00255", "٣"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join))
def test_base_spans_are_those_of_plain_expressions(text):
    assert pii.base_spans(text) == base(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "1 " * 100_000):
        pii.base_spans(text)


def test_gradient():
    random_ = np.random.default_rng(0)
    tagger, x = pii.Tagger(hidden=3), random_.integers(0, pii.INPUTS, (3, 6))
    y = random_.integers(0, 9, (3, 6))
    _, grad = tagger.gradient(x, y)
    for name, values in tagger.p.items():
        at = tuple(random_.integers(0, s) for s in values.shape)
        kept, losses = values[at], []
        for step in (1e-5, -1e-5):
            values[at] = kept + step
            losses.append(tagger.gradient(x, y)[0])
        values[at] = kept
        assert np.isclose((losses[0] - losses[1]) / 2e-5, grad[name][at], atol=1e-6)


def person(rng):
    name = "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    return rng.choice([
        f"{name}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)),
        f"+{rng.randrange(1, 99)} {rng.randrange(100, 999)} {rng.randrange(100000, 9999999)}"])


def document(rng, n):
    words = lambda k: " ".join("".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(1, 9))) for _ in range(k))
    return " ".join(f"{words(rng.randrange(5, 40))} {person(rng)}" for _ in range(n)) + " " + words(30)


def test_network_finds_held_out_spans(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(k, document(rng, 4)) for k in range(150)], "doc_id long, text string")
    tagger = pii.train(docs)
    hit = miss = extra = 0
    for _ in range(40):
        text = document(rng, 5)
        want, got = set(pii.base_spans(text)), set(pii.decode([text], tagger)[0])
        hit, miss, extra = hit + len(want & got), miss + len(want - got), extra + len(got - want)
    assert hit / (hit + miss) > 0.9 and hit / (hit + extra) > 0.9
    again = pii.train(docs)
    assert all((again.p[k] == v).all() for k, v in tagger.p.items())


def test_decoding_does_not_depend_on_what_is_decoded_together(spark):
    tagger = pii.Tagger(seed=1)
    rng = random.Random(8)
    texts = [document(rng, 6) for _ in range(4)]
    assert [x for t in texts for x in pii.decode([t], tagger)] == pii.decode(texts, tagger) == pii.decode(texts, tagger, most=3)


def test_odd_rows(odd, none, spark):
    docs = odd.unionByName(odd.limit(1).selectExpr(*[
        "77L AS doc_id" if c == "doc_id" else "'🙂 call +49 30 1234567 or x@y.org' AS text" if c == "text" else f"`{c}`" for c in odd.columns]))
    tagger = pii.train(docs)
    rows = pii.scan(docs, tagger).collect()
    assert len(rows) == odd.count() + 1
    r = next(r for r in rows if r.doc_id == 77)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 0, 0, 1) and {"phone:7:21", "email:25:32"} <= set(r.spans.split(","))
    assert r.base_sha256 == hashlib.sha256(b"phone:7:21,email:25:32").hexdigest()
    assert all(x.base_sha256 == hashlib.sha256(b"").hexdigest() for x in rows if x.doc_id in (2, 3, 4, None))
    assert pii.train(none) is None and pii.scan(none, None).collect() == []
