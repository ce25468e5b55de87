"""Exact Jaccard similarity join of word-shingle sets, with metric-space regions for large candidate groups.

Two sets link when ``|A & B| / |A | B|`` is at least ``percent / 100``. Equal sets are one set with a multiplicity.
Candidate groups come from an exact prefix filter: with shingles in one fixed order, two linked sets share one among the
first ``|A| - ceil(t |A|) + 1`` of each. Any order is exact; shingles that a sample of documents has often come last, so a
line that many texts share seldom makes a group. A group larger than ``LEAF`` is a region that is split by pivots: every
set goes home to its nearest pivot, and is also copied to every other pivot's region that is at most twice its link
radius farther (the triangle inequality puts the partner of a home set there). Regions are split again while they
shrink. In a leaf, each home set meets the sets above its id; a pair found in several groups counts once.

The shingles themselves are many times the text, so no table of all of them is written. A document is known by its
prefix, a digest and a sketch: a bitmap of shingle parities, whose Hamming distance is a metric and at most
``|A ^ B|``. It measures the way to pivots and drops pairs that can't link. Only sets of a pair that is left get their
shingles again, from the text, for the exact check.

Pivots alone can't start the join on text: unrelated documents share no shingle, lie equally far from every pivot,
and would be copied to every region; the prefix filter removes them first.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.llm.common import pick, release, saved, utf8
from grove.llm.components import components
from grove.llm.near_dup import shingle_hashes

#: Sets in a region that is checked pair by pair; larger regions are split.
LEAF = 256
#: Pivots drawn for one split, by the least of as many hashes of the set id.
PIVOTS = 8
#: A split is kept while its largest region holds at most this share of the parent and copies stay below twice it.
SHRINK, COPIES = 0.75, 2.0
ROUNDS = 8
#: One document in so many is looked at for frequent shingles; those found so often there come last, at most so many.
SAMPLE, OFTEN, LATE = 16, 4, 262_144
#: Longs of the smallest sketch; a set of more than twice its bits gets a larger one, by powers of two.
SKETCH = 8
#: Longs of the folded sketch, and shingles of the prefix just before, that a set brings along when it meets others.
MARK, BEFORE = 8, 3
#: Rows that a task hands to Spark at a time.
ROWS = 512


def sorted_shingles(text: bytes, words: int):
    """The distinct shingle hashes (64 bits as signed, ascending) of a text; none for a text without words."""
    import numpy as np

    return np.unique(np.array(shingle_hashes(text, words), "<u8").view(np.int64))


def digests(shingles) -> tuple[int, int]:
    """A 128-bit digest of a sorted array, as two longs."""
    from xxhash import xxh64_intdigest

    from grove.llm.near_dup import signed

    data = shingles.tobytes()
    return signed(xxh64_intdigest(data, 1)), signed(xxh64_intdigest(data, 2))


def sketch(shingles):
    """Parities of the shingles by their low bits, in ``SKETCH`` longs times a power of two: two bits a shingle or fewer, but the least size."""
    import numpy as np

    size = SKETCH
    while 128 * size < len(shingles):
        size *= 2
    odd = np.bincount(shingles & (64 * size - 1), minlength=64 * size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _per_text(docs: DataFrame, words: int, columns: str, row: Callable) -> DataFrame:
    """``doc_id`` and ``columns``, which ``row`` makes of each text's sorted shingles."""
    docs = pick(docs, "doc_id", "text")
    names = [c.split()[0] for c in columns.split(", ")]

    def work(batches) -> Iterator:
        import pyarrow as pa

        types = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
        kinds = [types[c.split()[1]] for c in columns.split(", ")]
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                rows = [row(sorted_shingles(text, words)) for text in utf8(part.column(1))]
                made = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(work, f"doc_id {kind}, {columns}")


def shingle_sets(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, shingles``: the distinct ``words``-word shingles (64-bit hashes, sorted) of each text, and their digest.

    A-Z are lower-cased; words are runs outside white space. A text of fewer words is one shingle; none (or null) is empty.
    """
    return _per_text(docs, words, "n_shingles long, d1 long, d2 long, shingles array<long>", lambda s: (len(s), *digests(s), s))


def late_shingles(docs: DataFrame, words: int = 3):
    """Frequent shingles (ascending) and their ranks, the rarest first, by a sample of the documents.

    They fix the order of the prefix filter only: the join is exact with any.
    """
    import numpy as np

    some = pick(docs, "doc_id", "text").where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    counts = shingle_sets(some, words).select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    counts = saved(counts.where(F.col("n") >= OFTEN), "late")
    least, total = OFTEN, 0
    for n, found in sorted(((r["n"], r["found"]) for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("found")).collect()), reverse=True):
        total += found
        if total > LATE:
            least = n + 1
            break
    got = counts.where(F.col("n") >= least).toArrow()
    release(counts)
    shingles, n = got["shingle"].to_numpy().astype(np.int64), got["n"].to_numpy().astype(np.int64)
    order = np.lexsort((shingles, n))
    ranks = np.empty(len(order), np.int32)
    ranks[order] = np.arange(len(order), dtype=np.int32)
    up = np.argsort(shingles)
    return shingles[up], ranks[up]


def _marks(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, prefix, sketch`` of each text."""
    late, ranks = late_shingles(docs, words)

    def row(s):
        import numpy as np

        n = len(s)
        keep = n - (percent * n + 99) // 100 + 1 if n else 0
        prefix = s
        if n and len(late):
            at = np.minimum(np.searchsorted(late, s), len(late) - 1)
            rank = np.where(late[at] == s, ranks[at], -1)
            prefix = s[np.argsort(rank, kind="stable")]  # s ascends, so the rare ones stay in the order of their hash
        return n, *digests(s), prefix[:keep], sketch(s)

    return _per_text(docs, words, "n_shingles long, d1 long, d2 long, prefix array<long>, sketch array<long>", row)


def _linked(a: Column, b: Column, percent: int) -> Column:
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def _differ(a: Column, b: Column) -> Column:
    """Bits in which two sketches differ, the larger one folded once; 0 (nothing known) if that doesn't make them equal in size."""

    def bits(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, p: s + p)

    def folded(x: Column, y: Column) -> Column:
        return F.zip_with(F.slice(x, F.lit(1), F.size(y)), F.slice(x, F.size(y) + 1, F.size(y)), lambda p, q: p.bitwiseXOR(q))

    return (
        F.when(F.size(a) == F.size(b), bits(a, b))
        .when(F.size(a) == 2 * F.size(b), bits(folded(a, b), b))
        .when(F.size(b) == 2 * F.size(a), bits(a, folded(b, a)))
        .otherwise(F.lit(0))
    )


def _folded(a: Column, longs: int) -> Column:
    """A sketch folded to ``longs`` longs, so all of them can be compared."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(longs)),
        lambda i: F.aggregate(F.sequence(i, F.size(a), F.lit(longs)), F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.element_at(a, j))),
    )


def _candidates(sets: DataFrame) -> DataFrame:
    """``region, set_id, n, place, home``: one group per prefix shingle that two sets or more share, all members at home."""
    rows = sets.select("set_id", F.col("n_shingles").cast("int").alias("n"), F.posexplode("prefix").alias("place", "region"))
    shared = rows.groupBy("region").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("region")
    return rows.join(shared, "region").select("region", "set_id", "n", (F.col("place") + 1).alias("place"), F.lit(True).alias("home"))


def _split(regions: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, bool]:
    """One round: regions above ``LEAF`` sets are split by pivots where that shrinks them; whether any was split.

    Sketches give the distances; only the rows of regions to split meet them.
    """
    big = saved(regions.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > LEAF), "regions")
    if not big.limit(1).count():
        release(big)
        return regions, False
    rows = regions.join(big, "region")
    drawn = rows.groupBy("region").agg(*[F.min_by("set_id", F.xxhash64("set_id", F.lit(j))).alias(f"p{j}") for j in range(PIVOTS)])
    chosen = drawn.select("region", F.explode(F.array_distinct(F.array(*[F.col(f"p{j}") for j in range(PIVOTS)]))).alias("set_id"))
    marks = sets.select("set_id", _folded(F.col("sketch"), SKETCH).alias("mark"))
    lists = chosen.join(marks, "set_id").groupBy("region").agg(F.array_sort(F.collect_list(F.struct("set_id", "mark"))).alias("pivots"))
    rows = rows.join(lists, "region").join(marks, "set_id")
    rows = rows.withColumn("d", F.transform("pivots", lambda p: _differ(F.col("mark"), p["mark"]))).withColumn("near", F.array_min("d"))
    rows = rows.withColumn("nearest", F.array_position("d", F.col("near")) - 1)
    # Linked sets differ in n * (100 - percent) / percent shingles at most, so in no more bits.
    radius = F.floor(F.col("n") * (100 - percent) / percent + 1e-9)
    picked = F.filter(F.sequence(F.lit(0), F.size("d") - 1), lambda j: F.element_at("d", j + 1) <= F.col("near") + 2 * radius)
    moved = rows.select(
        "region", "size", "set_id", "n", "place",
        F.explode(F.transform(picked, lambda j: F.struct(j.alias("j"), (F.col("home") & (j == F.col("nearest"))).alias("home")))).alias("to"),
    ).select("region", "size", "set_id", "n", "place", F.xxhash64("region", "to.j").alias("child"), F.col("to.home").alias("home"))
    moved = saved(moved, "regions")
    stats = moved.groupBy("region", "size", "child").agg(F.count(F.lit(1)).alias("rows")).groupBy("region", "size").agg(F.max("rows").alias("largest"), F.sum("rows").alias("copies"))
    good = stats.where((F.col("largest") <= SHRINK * F.col("size")) & (F.col("copies") <= COPIES * F.col("size"))).select("region")
    good = saved(good, "regions")
    split = moved.join(good, "region").select(F.col("child").alias("region"), "set_id", "n", "place", "home")
    kept = regions.join(good, "region", "left_anti")
    out = saved(kept.unionByName(split), "regions")
    done = good.limit(1).count() > 0
    for table in (big, moved, good, regions):
        release(table)
    return out, done


def _pairs(sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` (a < b): pairs of distinct sets, all that link among them, that sizes, places and sketches don't rule out."""
    regions = saved(_candidates(sets), "regions")
    for _ in range(ROUNDS):
        regions, any_split = _split(regions, sets, percent)
        if not any_split:
            break
    known = sets.select("set_id", "prefix", (F.size("sketch") > MARK).alias("more"), _folded(F.col("sketch"), MARK).alias("mark"))
    known = known.select("set_id", "prefix", "more", *[F.col("mark")[i].alias(f"m{i}") for i in range(MARK)])
    before = F.slice("prefix", F.greatest(F.col("place") - BEFORE, F.lit(1)), F.least(F.col("place") - 1, F.lit(BEFORE)))
    rows = regions.join(known, "set_id").select("set_id", "n", "place", before.alias("before"), "more", *[f"m{i}" for i in range(MARK)], "region", "home")
    names = ("", "n", "p", "v", "more_", *[f"m{i}" for i in range(MARK)])
    a = rows.where("home").drop("home").toDF(*[f"{x}a" for x in names], "region")
    b = rows.drop("home").toDF(*[f"{x}b" for x in names], "region")
    total = F.col("na") + F.col("nb")
    sized = (F.col("a") < F.col("b")) & (percent * F.col("na") <= 100 * F.col("nb")) & (percent * F.col("nb") <= 100 * F.col("na"))
    # At most so many are shared up to the common shingle, and after it.
    most = F.least("pa", "pb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    differ = functools.reduce(operator.add, [F.bit_count(F.col(f"m{i}a").bitwiseXOR(F.col(f"m{i}b"))) for i in range(MARK)])
    near = ((100 + percent) * most >= percent * total) & ((100 + percent) * (total - differ) >= 2 * percent * total)
    # A pair that shares a shingle just before met in that one's group; where it shares its first, nothing is dropped.
    met = a.join(b, "region").where(sized & near & ~F.arrays_overlap("va", "vb")).select("a", "b", (F.col("more_a") | F.col("more_b")).alias("more"))
    met = saved(met.distinct(), "met")
    # Where both sketches are no longer than what was compared, there is no more to compare.
    marks = sets.select("set_id", F.col("n_shingles").alias("n"), "sketch")
    pairs = met.where("more").join(marks.toDF("a", "na", "sa"), "a").join(marks.toDF("b", "nb", "sb"), "b")
    likely = (100 + percent) * (total - _differ(F.col("sa"), F.col("sb"))) >= 2 * percent * total
    out = saved(met.where("NOT more").select("a", "b").unionByName(pairs.where(likely).select("a", "b")), "pairs")
    for table in (regions, met):
        release(table)
    return out


def _links(docs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b, ca, cb`` (a < b): every pair of distinct sets that link, with their copies; sets of a likely pair get their shingles from the text."""
    pairs = _pairs(sets, percent)
    # Each end is counted down to its sets before they meet, so no table of both ends of all pairs is made.
    ends = [pairs.select(F.col(x).alias("set_id")).distinct() for x in ("a", "b")]
    ids = ends[0].unionByName(ends[1]).distinct()
    wanted = saved(ids.join(sets.select("set_id", "d1", "d2", "copies"), "set_id"), "wanted")
    texts = pick(docs, "doc_id", "text").join(wanted.select(F.col("set_id").alias("doc_id")).distinct(), "doc_id")
    found = shingle_sets(texts, words).join(wanted.withColumnRenamed("set_id", "doc_id"), ["doc_id", "d1", "d2"])
    arrays = saved(found.groupBy("doc_id", "d1", "d2").agg(F.any_value("shingles").alias("shingles"), F.any_value("copies").alias("copies")).drop("d1", "d2"), "arrays")
    both = pairs.join(arrays.toDF("a", "sa", "ca"), "a").join(arrays.toDF("b", "sb", "cb"), "b")
    out = saved(both.where(_linked(F.col("sa"), F.col("sb"), percent)).select("a", "b", "ca", "cb").distinct(), "links")
    for table in (pairs, wanted, arrays):
        release(table)
    return out


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """Per document of ``doc_id, text``: ``doc_id, n_shingles, component_id, n_links``.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` of their shingle sets (``shingle_sets``); equal
    non-empty sets link. ``component_id`` is the smallest ``doc_id`` reachable by links, itself included; ``n_links`` the
    number of other documents it links with. An empty set links with nothing. Rows of a null ``doc_id`` take part in no
    link and get a null component; repeated rows of one id count once. Empty table: no rows.
    """
    docs = pick(docs, "doc_id", "text")
    every = saved(_marks(docs, words, percent), "marks")
    # Equal sets (a 128-bit digest of the sorted hashes) are one set; its prefix and sketch are taken from any copy.
    named = every.where("doc_id IS NOT NULL AND n_shingles > 0")
    light = named.groupBy("d1", "d2").agg(F.min("doc_id").alias("set_id"), *[F.any_value(c).alias(c) for c in ("n_shingles", "prefix", "sketch")])
    copies = named.select("doc_id", "d1", "d2").groupBy("d1", "d2").agg(F.count_distinct("doc_id").alias("copies"))  # ids only
    sets = saved(light.join(copies, ["d1", "d2"]), "sets")
    members = named.select("doc_id", "d1", "d2").join(sets.select("d1", "d2", "set_id"), ["d1", "d2"]).select("doc_id", "set_id")
    links = _links(docs, sets, words, percent)
    roots = components(links.select("a", "b"))
    weight = sets.select("set_id", "copies")
    ends = [links.groupBy(F.col(x).alias("set_id")).agg(F.sum(f"c{y}").alias("c")) for x, y in ("ab", "ba")]
    partners = ends[0].unionByName(ends[1]).groupBy("set_id").agg(F.sum("c").alias("partners"))
    per_set = weight.join(partners, "set_id", "left").join(roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left").select(
        "set_id", (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"), F.coalesce("root", "set_id").alias("component_id")
    )
    linked = members.join(per_set, "set_id").select("doc_id", "component_id", "n_links")
    ids = every.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("n_shingles").alias("n_shingles"))  # repeated rows: one
    known = ids.join(linked.dropDuplicates(["doc_id"]), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    nameless = every.where("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(0).alias("n_links"))
    return known.unionByName(nameless).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_shingles", F.col("component_id").cast("long").alias("component_id"), F.col("n_links").cast("long").alias("n_links")
    )
