"""Near duplicates by SimHash, with meet-in-the-middle ball hashing.

Two fingerprints at most r bits apart have a 64-bit value within r/2 bits of both. So every distinct fingerprint
emits all variants within r/2 bits of itself, and those that emit the same variant are candidates; nothing else has to be compared.

Variants are shuffled by some of their bits, the bucket. The variants of one fingerprint in one bucket are told by the
fingerprint and the bucket alone, so this pair stands for all of them in the shuffle and they are spelt out on arrival: for 4 bits and
12 bucket bits, 79 pairs stand for 2,081 variants. The number of bucket bits follows the number of distinct fingerprints, so that an
average bucket gets 16,384 of them at most, at any size of the table (31 bits and 497 pairs for 47 billion).

A bucket that gets more fingerprints than ``CHUNK`` is cut into chunks, each a task's work on its own; variants of such
buckets also go through a second shuffle, keyed by the variant with the chunk's least fingerprint, so no link between chunks is lost.
Inside a chunk colliding pairs are deduplicated by their variant's least fingerprint, verified by counting bits,
and merged to one link for each fingerprint. Links of all buckets go through connected components.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grove.llm.common import pick, saved, utf8
from grove.llm.components import components

BUCKET = 16_384  # distinct fingerprints that a bucket gets on average, at most
CHUNK = 4 * BUCKET  # fingerprints of a bucket that one task works on together
SALTS = 16  # parts of a group that meet its least id apart
STEP_VARIANTS = 3_000_000  # variants in memory at a time


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 (seed 42) of every shingle of the lower-cased words; fewer words are one shingle, none are none."""
    from xxhash import xxh64_intdigest

    found = text.lower().split()
    n = len(found)
    if not n:
        return []
    joined = b" ".join(found)
    if n <= words:
        return [xxh64_intdigest(joined, 42)]
    starts = [0, *itertools.accumulate(len(w) + 1 for w in found)]
    return [xxh64_intdigest(joined[a : b - 1], 42) for a, b in zip(starts, starts[words:])]


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (long, the 64 bits as signed) of every whole text; null and empty texts have 0."""
    docs = pick(docs, "doc_id", "text")

    def mark(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(utf8(batch.column(1))):
                hashes = np.array(shingle_hashes(text, words), "<u8")
                if len(hashes):
                    votes = np.zeros(64, np.int64)
                    for low in range(0, len(hashes), 65_536):
                        part = hashes[low : low + 65_536]
                        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                    out[i] = np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fingerprint": pa.array(out.view(np.int64))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(mark, f"doc_id {kind}, fingerprint long")


def flips(bits: range, most: int) -> list[int]:
    """All masks that flip up to ``most`` of ``bits``."""
    return [sum(1 << b for b in some) for k in range(most + 1) for some in itertools.combinations(bits, k)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bucket_bits(n: int, radius: int) -> int:
    """Bucket bits for ``n`` distinct fingerprints: the fewest that give an average bucket ``BUCKET`` of them at most."""
    share = lambda bits: sum(math.comb(bits, k) for k in range(radius // 2 + 1)) / 2**bits
    return next((b for b in range(1, 60) if n * share(b) <= BUCKET), 60)


def least_of_runs(order, keys, values):
    """For entries in ``order`` by key: whether the key is shared, and the least value among equal keys, in that order."""
    import numpy as np

    k, v = keys[order], values[order]
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    sizes = np.diff(np.r_[starts, len(k)])
    least = np.minimum.reduceat(v, starts)
    return starts, sizes, np.repeat(least, sizes), np.repeat(sizes > 1, sizes)


def spell(prints, bucket, low_bits, radius, base: int = 0):
    """Blocks ``(variant, index)`` of all variants in one bucket of ascending ``prints``, at most STEP_VARIANTS a block.

    Blocks are cut by the variant's value, so equal variants are in the same block.
    """
    import numpy as np

    spent = np.bitwise_count((prints ^ bucket) & np.uint64((1 << low_bits) - 1))
    rows, masks = [], []
    for used in range(radius + 1):
        own = np.flatnonzero(spent == used)
        if len(own):
            rows.append(own)
            masks.append(np.array(flips(range(low_bits, 64), radius - used), np.uint64))
    total = sum(len(r) * len(m) for r, m in zip(rows, masks))
    parts = np.uint64(max(1, math.ceil(total / STEP_VARIANTS)))
    low = np.uint64((1 << low_bits) - 1)
    for part in range(int(parts)):
        variants, index = [], []
        for own, mask in zip(rows, masks):
            step = max(1, STEP_VARIANTS // len(mask))
            for a in range(0, len(own), step):
                some = own[a : a + step]
                v = ((prints[some] & ~low) | bucket)[:, None] ^ mask[None, :]
                if parts > 1:
                    mixed = (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    at = np.nonzero((mixed >> np.uint64(33)) % parts == np.uint64(part))
                    variants.append(v[at])
                    index.append(some[at[0]])
                else:
                    variants.append(v.ravel())
                    index.append(np.repeat(some, len(mask)))
        yield np.concatenate(variants), np.concatenate(index).astype(np.int32)


def link_chunk(prints, bucket, low_bits: int, radius: int, across: bool):
    """Links of one chunk: per fingerprint the least one that it is joined to through common variants.

    ``prints``: distinct fingerprints (unsigned, ascending). Returns their labels and, with ``across``, arrays of all variants
    with the least label's fingerprint, for the shuffle between chunks.
    """
    import numpy as np

    label = np.arange(len(prints), dtype=np.int32)
    pairs, outside = [], []
    for variants, index in spell(prints, bucket, low_bits, radius // 2):
        order = np.argsort(variants)
        starts, _, least, shared = least_of_runs(order, variants, index)
        member = index[order]
        keep = shared & (member != least)
        a, b = member[keep], least[keep]
        near = np.bitwise_count(prints[a] ^ prints[b]) <= radius
        pairs.append(np.unique((a[near].astype(np.int64) << 32) | b[near]))
        if across:
            outside.append((variants[order][starts], prints[least[starts]]))
    found = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    a, b = (found >> 32).astype(np.int32), (found & 0xFFFFFFFF).astype(np.int32)
    while len(a):
        # Roots of the two ends take the lesser of both; then every label jumps to its root.
        ra, rb = label[a], label[b]
        differ = ra != rb
        if not differ.any():
            break
        high, low = np.maximum(ra, rb)[differ], np.minimum(ra, rb)[differ]
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label, outside


def link_fingerprints(prints: DataFrame, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fingerprint``, long) that join exactly those with a chain of steps within ``radius``.

    ``radius`` must be even. Every fingerprint with another one within ``radius`` is in a link; equal ones are one.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    distinct = saved(prints.select("fingerprint").where("fingerprint IS NOT NULL").distinct(), "prints")
    low_bits = bucket_bits(distinct.count(), radius)
    low = (1 << low_bits) - 1
    masks = F.array(*[F.lit(m) for m in flips(range(low_bits), radius // 2)])
    # A few MB of fingerprints become many rows: dealt out first, so that all cores share that.
    spread = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fingerprint")
    sent = spread.select("fingerprint", F.explode(F.transform(masks, lambda m: F.col("fingerprint").bitwiseAND(F.lit(low)).bitwiseXOR(m))).alias("bucket"))
    sizes = sent.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > chunk).select("bucket", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    dealt = sent.join(large, "bucket", "left").select(
        "bucket",
        F.when(F.col("chunks").isNull(), -1).otherwise(F.pmod(F.xxhash64("fingerprint"), F.col("chunks"))).cast("int").alias("chunk"),
        "fingerprint",
    )

    def work(key, table):
        import numpy as np
        import pyarrow as pa

        prints = np.unique(table["fingerprint"].to_numpy().astype(np.int64)).view(np.uint64)
        prints.sort()
        label, outside = link_chunk(prints, np.uint64(key[0].as_py()), low_bits, radius, key[1].as_py() >= 0)
        own = np.flatnonzero(label != np.arange(len(label)))
        variants = [x[0].view(np.int64) for x in outside]
        firsts = [x[1].view(np.int64) for x in outside]
        n = sum(map(len, variants))
        return pa.table(
            {
                "a": np.concatenate([prints[own].view(np.int64), *firsts]),
                "b": np.concatenate([prints[label[own]].view(np.int64), *variants]),
                "variant": np.concatenate([np.zeros(len(own), bool), np.ones(n, bool)]),
            }
        )

    got = saved(dealt.groupBy("bucket", "chunk").applyInArrow(work, "a long, b long, variant boolean"), "links")
    inside = got.where("NOT variant").select("a", "b")
    between = got.where("variant").select(F.col("b").alias("v"), "a")
    least = between.groupBy("v").agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1").select("v", "m")
    met = between.join(least, "v").where(F.col("a") != F.col("m")).where(F.bit_count(F.col("a").bitwiseXOR(F.col("m"))) <= radius)
    return inside.unionByName(met.select("a", F.col("m").alias("b"))).distinct()


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` for every row: the least id in reach by steps of up to ``radius`` bits.

    Equal fingerprints are in one component, so a group of copies costs one fingerprint. Null and empty texts have fingerprint
    zero and are near one another like any others. Null ids get a component like others, but name none unless all its ids are null.
    """
    marked = saved(fingerprints(docs, words), "marks")
    roots = components(link_fingerprints(marked, radius))
    groups = marked.join(roots, marked["fingerprint"] == roots["node"], "left").select(
        "doc_id", "fingerprint", F.coalesce("root", "fingerprint").alias("group")
    )
    groups = saved(groups, "groups")
    # Documents alone need no join; the others meet their group's least id by a salted key, as a group may be a third of all rows.
    named = groups.groupBy("group").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    named = named.select("group", "least", F.lit(True).alias("several"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = groups.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return salted.join(named, ["group", "salt"], "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.when(F.col("several"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4, carry: tuple[str, ...] = ()) -> DataFrame:
    """Of each group of near duplicates the row of the smallest id (of repeated rows: all): ``doc_id, text`` and the columns ``carry``.

    Rows of a null id stay only where no other id is in their group.
    """
    docs = pick(docs, *dict.fromkeys(("doc_id", "text", *carry)))
    found = near_duplicates(docs, words, radius)
    ids = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_keep")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_keep"]), "left_semi")
