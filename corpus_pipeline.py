"""From raw documents to training batches: each stage works on all that its predecessor kept.

STAGES holds (name, function) pairs. A function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet to the shared folder and rereads it as the next one's docs. All but the last return the columns of
``docs``, extra ones too; null texts count as empty, and an empty table passes through all stages.
"""

from tapework.llm import jaccard_join, mixing, packing, quality, secrets
from tapework.llm.catalog import domains
from tapework.llm.common import read
from tapework.session import fresh_path

#: Wanted token shares of the domains 2 * quality + toxic among what the quality stage keeps, the wanted tokens as a
#: multiple of the present ones, and the most copies of a document.
MIX_TARGETS = {2: 0.95, 3: 0.05}
MIX_TOTAL = 1.25
MIX_MOST = 4.0


def good_quality(spark, docs, sf_dir):
    """Quality classifier (2): rows that score at least 0.7 stay; the model learns from the labelled documents."""
    return quality.keep_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def one_of_each(spark, docs, sf_dir):
    """N-gram Jaccard join (5): of every class of near-duplicates the document with the least id stays."""
    return jaccard_join.keep_one(docs)


def without_secrets(spark, docs, sf_dir):
    """Secret scans (4): every row stays, each secret is replaced by a marker."""
    return secrets.mask(docs, secrets.train(secrets.labelled_tokens(docs)))


def to_targets(spark, docs, sf_dir):
    """Mixing (9): rows are repeated or left out by the rates that bring the domains' tokens to their targets. The
    total is set above the input's, so that documents clearly of the wanted domain have a rate above 1 and all stay."""
    model = mixing.train(docs, domains(read(spark, sf_dir, "labels")), "domain")
    return mixing.resample(docs, model, MIX_TARGETS, total=MIX_TOTAL, most=MIX_MOST)


def pack_lengths(spark, docs, sf_dir):
    """Packing (7): bucket and batch of every document that is left; one row per row of ``docs``."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", to_targets),
    ("packing", pack_lengths),
]

#: The stages learn models and search by fingerprints, which SQL cannot state; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the table ``documents`` of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name.lower().replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
