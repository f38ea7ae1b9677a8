"""What several operators share: input columns, shared files, connected components."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapework.session import stage_table


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs):
    """``doc_id`` and ``text`` of any table of documents: a null text is empty, other columns stay out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def parts_for(rows, rows_per_part, least=1):
    return max(least, math.ceil(rows / rows_per_part))


def whole_groups(batches, keys):
    """Tables of whole groups from batches sorted by ``keys``: what a batch leaves open waits for the next."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        fresh = not held
        for k in keys:
            x = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= x[1:] != x[:-1]
            fresh = fresh or held[-1].column(k)[-1].as_py() != x[0]
        change[0] = fresh
        at = np.flatnonzero(change)
        if len(at):
            last = int(at[-1])
            if held or last:
                yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def components(edges, label="components", node_type="long"):
    """Connected components of ``edges(a, b)``: ``(node, component)``, the least node of each.

    Rounds of hash-to-min with star contraction: each node takes the least label among itself and its neighbours,
    then the label of its label, until nothing changes. Chains halve, so rounds grow with the logarithm of the
    diameter. Every round is a written table; only a count of changes reaches the driver.
    """
    both = stage_table(
        edges.select(F.col("a").cast(node_type).alias("a"), F.col("b").cast(node_type).alias("b"))
        .where("a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b").distinct(), f"{label}-edges")
    labels = stage_table(both.groupBy(F.col("a").alias("node"))
                         .agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), label)
    while True:
        old = labels
        spread = (
            both.join(old.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        )
        hooked = old.join(spread, "node").select("node", "component", F.least("component", "near").alias("low"))
        # a root hears of the lowest label any of its members has seen
        roots = hooked.groupBy(F.col("component").alias("root")).agg(F.min("low").alias("down"))
        lifted = (
            hooked.join(roots, hooked["component"] == roots["root"])
            .select("node", F.col("component").alias("was"), F.least("low", "down").alias("next"))
        )
        labels = stage_table(lifted, label)
        jump = labels.select(F.col("node").alias("next"), F.col("next").alias("far"))
        labels = stage_table(
            labels.join(jump, "next", "left").select("node", "was", F.least("next", F.coalesce("far", "next")).alias("component")), label)
        if labels.where("component <> was").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
