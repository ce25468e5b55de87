"""Text sources and sinks: lineitem and documents written as text and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from grove.operators.prepare import training_table
from grove.queries import register
from grove.queries.inputs import ALL_TOKENS_SQL, TOKENS_SQL, document_table, read, scratch, unlabelled_table
from grove.sources import tables, text


def _orders(spark, sf):
    """Keyed rows: dense numbers with the key as the line order."""
    df = read(spark, sf, "orders")
    return training_table(df, ["o_custkey", "o_totalprice"], F.col("o_totalprice"), F.expr("o_custkey + 1D"), key="o_orderkey")


_NUMBERED = "WITH o AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, CAST(o_custkey AS DOUBLE) AS a, o_totalprice AS b FROM orders)"


@register("s_dense", _NUMBERED + " SELECT row_id, a, b FROM o")
def s_dense(spark, sf):
    path = scratch(spark)
    text.write_table(_orders(spark, sf), path, "x")
    df = text.read_dense(spark, path)
    return df.select("row_id", F.col("features")[0].alias("a"), F.col("features")[1].alias("b"))


@register("s_dense_named", _NUMBERED + " SELECT row_id, a AS customer, b AS price FROM o WHERE row_id < 500")
def s_dense_named(spark, sf):
    """Names from a file and the reader's own row limit."""
    path, names = scratch(spark), scratch(spark)
    text.write_table(_orders(spark, sf), path, "x")
    spark.createDataFrame([("customer",), ("price",)], "value string").coalesce(1).write.text(names)
    return text.read_dense(spark, path, names, max_rows=500).select("row_id", "customer", "price")


@register("s_labeled_dense", _NUMBERED + " SELECT row_id, a + 1 AS weight, b AS label, a, b FROM o")
def s_labeled_dense(spark, sf):
    path = scratch(spark)
    text.write_table(_orders(spark, sf), path, "w.y.x")
    df = text.read_labeled(spark, path, "w.y.x")
    return df.select("row_id", "weight", "label", F.col("features")[0].alias("a"), F.col("features")[1].alias("b"))


_DOCS = "WITH " + TOKENS_SQL + ", num AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM (SELECT DISTINCT doc_id FROM docs))"


_ALL_DOCS = "WITH " + ALL_TOKENS_SQL + ", num AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM (SELECT DISTINCT doc_id FROM counts))"


@register("s_sparse", _ALL_DOCS + " SELECT row_id, CAST(feature AS BIGINT) AS feature, value FROM counts JOIN num USING (doc_id)")
def s_sparse(spark, sf):
    """Sparse text with a header line and 0-based ``index:value`` entries."""
    path = scratch(spark)
    text.write_table(unlabelled_table(spark, sf), path, "header", n_features=1 << 28)
    df, _ = text.read_sparse(spark, path)
    return df.select("row_id", F.explode("features").alias("feature", "value")).withColumn("feature", F.col("feature").cast("bigint"))


@register("s_labeled_sparse", _DOCS + " SELECT row_id, y AS label, CAST(feature AS BIGINT) AS feature, value FROM docs JOIN num USING (doc_id)")
def s_labeled_sparse(spark, sf):
    path = scratch(spark)
    text.write_table(document_table(spark, sf), path, "y.sparse")
    df = text.read_labeled(spark, path, "y.sparse")
    return df.select("row_id", "label", F.explode("features").alias("feature", "value")).withColumn("feature", F.col("feature").cast("bigint"))


@register("s_labeled_groups", _NUMBERED + " SELECT row_id, a, b, CAST(7 AS BIGINT) AS k, a + 1 AS v FROM o")
def s_labeled_groups(spark, sf):
    """Dense values and a sparse group on one line."""
    path = scratch(spark)
    rows = _orders(spark, sf).withColumn("groups", F.array(F.map_from_arrays(F.array(F.lit(7), F.lit(9)), F.array(F.col("weight"), F.lit(1.0)))))
    text.write_table(rows, path, "x")
    df = text.read_labeled(spark, path, "x")
    return df.select(
        "row_id", F.col("features")[0].alias("a"), F.col("features")[1].alias("b"), F.lit(7).cast("bigint").alias("k"), F.col("groups")[0][7].alias("v")
    )


@register("s_align", _NUMBERED + " SELECT row_id, a, b AS label, a + 1 AS weight FROM o")
def s_align(spark, sf):
    """Features, targets and weights in three files, matched by line."""
    rows = _orders(spark, sf)
    paths = [scratch(spark) for _ in range(3)]
    text.write_table(rows, paths[0], "x")
    text.write_table(rows.withColumn("features", F.array("label")), paths[1], "x")
    text.write_table(rows.withColumn("features", F.array("weight")), paths[2], "x")
    x = text.read_dense(spark, paths[0])
    y, w = (text.read_dense(spark, p).select("row_id", F.col("features")[0].alias("v")) for p in paths[1:])
    return tables.align(x, y, w).select("row_id", F.col("features")[0].alias("a"), "label", "weight")


@register("s_training_table", "SELECT o_orderkey AS row_id, CAST(o_custkey AS DOUBLE) AS a, o_totalprice AS b, o_totalprice AS label, CAST(o_custkey + 1 AS DOUBLE) AS weight FROM orders")
def s_training_table(spark, sf):
    return _orders(spark, sf).select("row_id", F.col("features")[0].alias("a"), F.col("features")[1].alias("b"), "label", "weight")


@register("s_merge_columns", "SELECT o_orderkey AS row_id, CAST(o_custkey AS DOUBLE) AS a, o_totalprice AS b, CAST(length(o_orderpriority) AS DOUBLE) AS c FROM orders")
def s_merge_columns(spark, sf):
    extra = read(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.length("o_orderpriority").alias("c"))
    df = tables.merge_columns(_orders(spark, sf), extra, ["c"], into_features=True)
    return df.select("row_id", *[F.col("features")[i].alias(n) for i, n in enumerate("abc")])


@register(
    "s_write_scores",
    "SELECT CAST(round(o_totalprice / 7, 3) AS DOUBLE) AS score, count(*) AS n FROM orders GROUP BY 1",
)
def s_write_scores(spark, sf):
    path = scratch(spark)
    scored = read(spark, sf, "orders").selectExpr("o_orderkey AS row_id", "round(o_totalprice / 7, 3) AS score")
    text.write_scores(scored, path, digits=3)
    back = spark.read.text(path).select(F.col("value").cast("double").alias("score"))
    return back.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
