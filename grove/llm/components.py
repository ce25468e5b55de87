"""Connected components of an edge table by repeated star contraction, a few shuffles a round."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grove.llm.common import release, saved

#: Nodes that a task keeps in mind while it thins its links; past them it starts afresh.
NODES = 524_288


def spanning(edges: DataFrame) -> DataFrame:
    """Of the links (two columns) that a task reads, those that join two components of the ones before: a spanning forest.

    Components stay as they are, and a task leaves fewer links than it has nodes, however densely they are linked. A task of
    more than ``NODES`` nodes leaves a forest of each stretch of its links, which drops fewer of them.
    """
    most = NODES

    def work(batches) -> Iterator:
        import pyarrow as pa

        up = {}

        def top(x):
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for batch in batches:
            if len(up) > most:
                up.clear()
            keep = []
            for i, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                x, y = top(a), top(b)
                if x != y:
                    up[y] = x
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64()))

    return edges.mapInArrow(work, edges.schema)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, any order); the root is the smallest node of the component.

    Links are thinned to spanning forests of the tasks first, so a group that all links with all isn't shuffled as its
    square. Each round links every node's larger neighbours to its smallest one, then its smaller neighbours, until nothing
    changes. A node of many links is counted down by partial aggregation of the minimum; its links meet their minimum
    in a join, which Spark splits when it is skewed. Each round's table is written to the shared folder.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    now = saved(spanning(links).distinct(), "edges")

    def stars(links: DataFrame, both: bool) -> DataFrame:
        """``u, v`` with u > v: neighbours of a node, and the node itself, linked to the least of them all."""
        around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else links
        least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        met = around.join(least, around["u"] == least["c"])
        if both:  # larger neighbours go to the least
            out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # smaller neighbours, and the node itself
            out = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    sign = None
    for _ in range(max_rounds):
        # Bits of a hash of every link tell whether the round changed anything.
        facts = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(facts) == sign or not facts[0]:
            break
        sign = tuple(facts)
        after = saved(stars(stars(now, True), False), "edges")
        release(now)
        now = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
