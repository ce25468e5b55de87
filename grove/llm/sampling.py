"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.llm.common import pick


def id_remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids have remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n)), F.lit(0))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int) -> tuple[DataFrame, dict[int, int], dict[int, int]]:
    """Texts of up to ``bound`` rows of each label: ``doc_id, text, y``, and how many of each were there and taken.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1; other rows are ignored, and of several for one id the largest counts);
    ``learn`` is a condition on ``doc_id``. Rows are drawn by the order of a hash of their ids. Only ids are
    collected by that order, at most ``2 * bound``, and sent to the tasks that read the texts.
    """
    known = pick(labels, "doc_id", label).withColumnRenamed(label, "y").where("y IN (0, 1) AND doc_id IS NOT NULL").where(learn)
    known = known.groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id")
    ids = [known.where(F.col("y") == y).orderBy(order, "doc_id").limit(bound) for y in (0, 1)]
    chosen = ids[0].unionByName(ids[1])
    sample = pick(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
    return sample, totals, {y: min(bound, n) for y, n in totals.items()}
