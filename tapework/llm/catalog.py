"""Registered queries of this package and their comparison SQL (DuckDB)."""

from pyspark.sql import functions as F

from tapework.llm import (
    extraction, fingerprints, jaccard_join, mixing, packing, phrases, pii, quality, secrets, spelling, suffix_dedup, topk, warc,
)
from tapework.llm.common import read


#: Wanted token shares of the domains 2 * quality + toxic, and the wanted tokens as a multiple of the present ones.
MIX_TARGETS = {0: 0.04, 1: 0.01, 2: 0.90, 3: 0.05}
MIX_TOTAL = 1.1


def op1_fingerprints(spark, sf_dir):
    """Fingerprints of every document and its edited text. Tested against exact generalised Jaccard similarities."""
    return fingerprints.with_edits(read(spark, sf_dir, "documents"))


def op2_quality(spark, sf_dir):
    """Quality score of every document. Learnt weights have no SQL: tested by held-out accuracy."""
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op3_suffix_dedup(spark, sf_dir):
    """Passages of 50 words and more that documents share. Tested against brute force: SQL would list all 50-grams."""
    return suffix_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op4_secrets(spark, sf_dir):
    """Secrets of every document. Tested against plain regular expressions and labelled strings."""
    docs = read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(secrets.labelled_tokens(docs)))


def op5_jaccard_join(spark, sf_dir):
    """Class and number of links of every document. Pairs by SQL are too many: tested against brute force."""
    return jaccard_join.join(read(spark, sf_dir, "documents"))


def op6_warc(spark, sf_dir):
    """Archives of all pages, written and read back."""
    rows = warc.round_trip(read(spark, sf_dir, "pages"), with_payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_packing(spark, sf_dir):
    """Bucket and batch of every document. SQL has no dynamic programme: tested against brute force."""
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op8_topk(spark, sf_dir):
    """Ten best inner products of every vector whose id is divisible by 100."""
    vectors = topk.integer_vectors(read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def domains(labels):
    """Labelled domains of documents: 2 * quality + toxic."""
    return labels.select("doc_id", (2 * F.col("quality") + F.col("toxic")).alias("domain"))


def op9_mixing(spark, sf_dir):
    """Posteriors and rate of every document. Iterative, so no SQL: tested by its totals and against a direct solver."""
    docs = read(spark, sf_dir, "documents")
    model = mixing.train(docs, domains(read(spark, sf_dir, "labels")), "domain")
    return mixing.mix(docs, model, MIX_TARGETS, total=MIX_TOTAL)


def op10_pii(spark, sf_dir):
    """Personal data of every document. Tested against plain regular expressions and held-out spans."""
    docs = read(spark, sf_dir, "documents")
    return pii.scan(docs, pii.train(docs))


def op11_phrases(spark, sf_dir):
    """Best collocations of each language over all documents."""
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op12_spelling(spark, sf_dir):
    """Words of all documents with their near words, forms and roots."""
    return spelling.variants(read(spark, sf_dir, "documents"))


def op13_extraction(spark, sf_dir):
    """Main text of every page. A trained field has no SQL: tested on held-out labelled pages."""
    pages = read(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train(pages))


QUERIES = {"op1_fingerprints": op1_fingerprints, "op2_quality": op2_quality, "op3_suffix_dedup": op3_suffix_dedup, "op4_secrets": op4_secrets, "op5_jaccard_join": op5_jaccard_join, "op6_warc": op6_warc, "op7_packing": op7_packing, "op8_topk": op8_topk, "op9_mixing": op9_mixing, "op10_pii": op10_pii,
           "op11_phrases": op11_phrases, "op12_spelling": op12_spelling, "op13_extraction": op13_extraction}

OP6 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, sha256(encode(coalesce(html, ''))) AS d FROM pages
), m AS (
  SELECT page_id, octet_length(b) AS n, d, min(page_id) OVER (PARTITION BY d) AS first FROM p
)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM m
"""

OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP11 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k
), totals AS (
  SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang
), f AS (
  SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100
), parts AS (
  SELECT lang, phrase, k, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1
), cuts AS (
  SELECT lang, phrase, a, k, c, array_to_string(ws[1:c], ' ') AS head, array_to_string(ws[c + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS c FROM parts)
), scores AS (
  SELECT u.lang, u.phrase, u.a, u.c, l.a AS l, r.a AS r, n,
         (1000 * u.a::HUGEINT * n) // (l.a::HUGEINT * r.a) AS score
  FROM cuts u JOIN f l ON l.lang = u.lang AND l.phrase = head JOIN f r ON r.lang = u.lang AND r.phrase = tail JOIN totals t ON t.lang = u.lang
), lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS place FROM scores) WHERE place = 1
), inner_ones AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM parts))
  ) GROUP BY lang, phrase
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN inner_ones i ON i.lang = s.lang AND i.phrase = s.phrase WHERE longer IS NULL OR longer < a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

OP12 = r"""
WITH RECURSIVE bits(i, v, s) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, s + 1 FROM bits WHERE s < 8
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM bits WHERE s = 8
), d AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS doc,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents WHERE text IS NOT NULL
), u AS (
  SELECT doc, run, count(*) AS n FROM d WHERE length(run) >= 6 GROUP BY doc, run
), h AS (
  SELECT run, n, xor(list_reduce(
    flatten(list_transform(string_split(doc || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)),
    lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM u, crc
), slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), keys AS (
  SELECT word, n, word AS key FROM words
  UNION ALL SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS key
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM keys a JOIN keys b ON a.key = b.key AND a.word <> b.word
  WHERE abs(length(a.word) - length(b.word)) <= 1 AND
    CASE WHEN length(a.word) = length(b.word) THEN
           len(list_filter(range(1, length(a.word) + 1), lambda i: substr(a.word, i, 1) <> substr(b.word, i, 1))) = 1
         ELSE a.key = a.word OR b.key = b.word END
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top, arg_min(near, (-near_n, encode(near))) AS form FROM near GROUP BY word
), forms AS (
  SELECT w.word, CASE WHEN top >= 5 * w.n THEN form END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain(word, upto) AS (
  SELECT word, word FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = upto WHERE forms.form IS NOT NULL
), roots AS (
  SELECT chain.word, upto AS root FROM chain JOIN forms ON forms.word = upto WHERE forms.form IS NULL
)
SELECT f.word, form, root, n::BIGINT AS n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms f JOIN roots r ON r.word = f.word
"""

ORACLES = {"op11_phrases": OP11, "op12_spelling": OP12, "op6_warc": OP6, "op8_topk": OP8}
