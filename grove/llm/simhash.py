"""Document fingerprints by SimHash, and block tables that find all fingerprints within a Hamming radius.

A term is a word with the next one (the last word alone), its weight the number of times it occurs. Each term's 64-bit
hash votes on 64 bits with its weight; a bit is set if the votes for it prevail. DataFrame functions only: terms are exploded where
they are read, and the votes of two bits share a long of which each has half, so 32 sums serve 64 bits.

The search cuts fingerprints into blocks. Two within radius r differ in at most r blocks, so for some choice of the other
blocks they agree there: one table per choice, keyed by these blocks, holds every such pair. A pair is taken from the
first of its tables only.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grove.llm.common import pick
from grove.llm.quality_rules import words_of

PAIR = 0x0000000100000001


def with_fingerprints(texts: DataFrame, keys: list[str], text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``keys``, ``carry`` and ``fingerprint`` (long) of each row. Null and empty texts have fingerprint 0.

    ``keys`` must tell rows apart; ``carry`` names number columns, which ride along as maxima.
    """
    words = words_of(F.lower(F.coalesce(text, F.lit(""))))
    own = [*keys, *carry]
    terms = (
        texts.select(*own, words.alias("_w"))
        .select(*own, F.expr("zip_with(_w, slice(_w, 2, greatest(size(_w), 1)), (a, b) -> xxhash64(a, coalesce(b, '')))").alias("_t"))
        .select(*own, F.explode_outer("_t").alias("_h"))
    )
    votes = [F.sum(F.shiftrightunsigned("_h", k).bitwiseAND(F.lit(PAIR))).alias(f"_{k}") for k in range(32)]
    summed = terms.groupBy(*keys).agg(F.count("_h").alias("_n"), *votes, *[F.max(c).alias(c) for c in carry])
    bits = None
    for k in range(32):
        low = F.col(f"_{k}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_{k}", 32)
        for b, count in ((k, low), (k + 32, high)):
            one = F.when(2 * count > F.col("_n"), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0))
            bits = one if bits is None else bits.bitwiseOR(one)
    return summed.select(*own, bits.cast("long").alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def with_next(docs: DataFrame, per_bucket: int = 4000, max_buckets: int = 4096) -> DataFrame:
    """Adds to each row the ``text`` and place of the next one by descending ``doc_id``; the last row's next is the first.

    Returns ``bucket, place, doc_id, text, next_text, next_bucket, next_place``. Equal ids go by their text's hash, nulls come last.
    Rows are dealt by ranges of ``doc_id`` and ordered inside each; the row that opens a range is also sent to the range before it.
    Only the range edges and each range's largest id, up to ``max_buckets``, reach the driver.
    """
    docs = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    n = max(1, min(max_buckets, math.ceil(docs.count() / per_bucket)))
    shares = [i / n for i in range(1, n)]
    edges = docs.select("doc_id").agg(F.percentile_approx("doc_id", shares, 100_000).alias("e")).first()["e"] if shares else []
    edges = sorted({*(edges or [])}, reverse=True)
    # Buckets by descending id; two levels of edges keep the search short.
    wide = max(1, math.isqrt(len(edges)))
    above = lambda some: F.size(F.filter(some, lambda e: e >= F.col("doc_id")))
    if edges:
        coarse = F.array(*[F.lit(e) for e in edges[wide - 1 :: wide]])
        every = F.array(*[F.lit(e) for e in edges])
        bucket = F.lit(wide) * above(coarse) + above(F.slice(every, F.lit(wide) * above(coarse) + 1, wide))
        bucket = F.when(F.col("doc_id").isNull(), len(edges)).otherwise(bucket)
    else:
        bucket = F.lit(0)
    placed = docs.withColumn("bucket", bucket)
    heads = placed.select("doc_id", "bucket").groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()
    order = sorted(((r["bucket"], r["head"]) for r in heads), key=lambda x: x[0])
    kind = docs.schema["doc_id"].dataType
    rows = [
        F.struct(F.lit(b).alias("own"), F.lit(h).cast(kind).alias("head"), F.lit(order[i - 1][0]).alias("before"))
        for i, (b, h) in enumerate(order)
    ]
    opening = docs.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("x")).select("x.*") if rows else None
    if opening is None:
        opening = docs.sparkSession.range(0).select(F.lit(0).alias("own"), F.lit(None).cast(kind).alias("head"), F.lit(0).alias("before"))
    # At most max_buckets rows of three numbers.
    joined = placed.join(F.broadcast(opening), placed["bucket"] == opening["own"])
    home = lambda b, ghost: F.struct(F.col(b).alias("b"), F.lit(ghost).alias("ghost"))
    homes = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(home("own", 0), home("before", 1))).otherwise(F.array(home("own", 0)))
    spread = joined.select("doc_id", "text", "own", F.explode(homes).alias("home")).select("doc_id", "text", "own", F.col("home.b").alias("bucket"), F.col("home.ghost").alias("ghost"), F.xxhash64("text").alias("tie"))
    w = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "tie")
    ahead = (
        spread.withColumn("place", F.row_number().over(w))
        .withColumn("next_text", F.lead("text").over(w))
        .withColumn("next_bucket", F.lead("own").over(w))
        .withColumn("to_ghost", F.lead("ghost").over(w))
        .where("ghost = 0")
    )
    place = F.when(F.col("to_ghost") == 1, 1).otherwise(F.col("place") + 1)
    return ahead.select("bucket", "place", "doc_id", "text", "next_text", "next_bucket", place.alias("next_place"))


def edited(text: Column, next_text: Column) -> Column:
    """``text`` whose last half of code points, rounded down, are replaced by as many first ones of ``next_text``."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def block_tables(fingerprint: Column, radius: int, blocks: int) -> Column:
    """Array of ``(table, key)``: the permuted keys of a fingerprint, a table for each choice of blocks that must agree."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    tables = []
    for t, chosen in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
        mask -= (mask >> 63) << 64
        tables.append(F.struct(F.lit(t).alias("table"), fingerprint.bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*tables)


def first_table(difference: Column, radius: int, blocks: int) -> Column:
    """The first table in which two fingerprints with this XOR agree; null if there is none."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    found = F.lit(None).cast("int")
    for t, chosen in reversed(list(enumerate(itertools.combinations(range(blocks), blocks - radius)))):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
        mask -= (mask >> 63) << 64
        found = F.when(difference.bitwiseAND(F.lit(mask)) == 0, F.lit(t)).otherwise(found)
    return found


def find_within(queries: DataFrame, stored: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """Pairs ``query, fingerprint, distance`` of distinct fingerprints within ``radius`` bits, each pair once.

    Both tables need ``fingerprint`` (long); equal ones are searched once, so a group of copies is one entry. Nulls match nothing.
    Keys hold 64 * (blocks - radius) / blocks bits: choose more blocks for larger tables. The tables meet in a sort-merge join:
    they are made from a few MB of fingerprints, by which Spark would judge them small and send all their keys through the driver.
    """
    split = lambda df, name: (
        df.select(F.col("fingerprint").alias(name)).where(F.col(name).isNotNull()).distinct().select(name, F.explode(block_tables(F.col(name), radius, blocks)).alias("at")).select(name, "at.table", "at.key")
    )
    a, b = split(queries, "query"), split(stored, "fingerprint")
    gap = F.col("query").bitwiseXOR(F.col("fingerprint"))
    met = (a["table"] == b["table"]) & (a["key"] == b["key"]) & (F.bit_count(gap) <= radius) & (first_table(gap, radius, blocks) == a["table"])
    return a.join(b.hint("merge"), met).select("query", "fingerprint", F.bit_count(gap).alias("distance"))
