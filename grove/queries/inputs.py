"""Training tables made from the given tables, in Spark and as SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grove.operators.prepare import training_table
from grove.session import cut_lineage, ensure_checkpoint_dir

FEATURES = ["l_quantity", "l_discount", "l_tax"]
PRICE = "l_extendedprice / 1000"
RETURNED = "IF(l_returnflag = 'R', 1.0D, -1.0D)"

# lineitem as rows of three features q, d, t with label y and weight w.
ROWS_SQL = """rows_ AS (SELECT l_quantity AS q, l_discount AS d, l_tax AS t, l_extendedprice / 1000 AS y,
 CAST(1 AS DOUBLE) AS w, l_linenumber AS ln, l_returnflag AS rf FROM lineitem)"""
# The same in long form.
CELLS_SQL = ROWS_SQL + """, cells AS (SELECT f.feature, CASE f.feature WHEN 0 THEN q WHEN 1 THEN d ELSE t END AS value, y, w, ln, rf
 FROM rows_, (VALUES (0), (1), (2)) f(feature))"""
# Bins of the values as they are: one bin per distinct value.
BINS_SQL = CELLS_SQL + """, vals AS (SELECT feature, value, dense_rank() OVER (PARTITION BY feature ORDER BY value) - 1 AS bin,
 lead(value) OVER (PARTITION BY feature ORDER BY value) AS nxt FROM (SELECT DISTINCT feature, value FROM cells)),
 binned AS (SELECT cells.*, vals.bin FROM cells JOIN vals USING (feature, value))"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem")


def price_table(spark: SparkSession, sf_dir: str, label: str = PRICE, weight: str | None = None) -> DataFrame:
    return training_table(lineitem(spark, sf_dir), FEATURES, label, weight)


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("label"))


def scratch(spark: SparkSession) -> str:
    """A fresh folder beside the checkpoints, so all executors can reach it."""
    return f"{ensure_checkpoint_dir(spark)}/grove-{uuid.uuid4().hex}"


# Tokens of a document become features by the first digits of their MD5, a rule both sides can follow.
TOKENS_SQL = """tokens AS (SELECT doc_id, CAST('0x' || substr(md5(tok), 1, 7) AS INTEGER) AS feature FROM
 (SELECT doc_id, unnest(string_split(text, ' ')) AS tok FROM documents) WHERE tok <> ''),
 counts AS (SELECT doc_id, feature, CAST(count(*) AS DOUBLE) AS value FROM tokens GROUP BY doc_id, feature),
 docs AS (SELECT counts.*, CASE WHEN quality = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS y, CAST(1 AS DOUBLE) AS w
 FROM counts JOIN labels USING (doc_id))"""


TOKEN_FEATURE = "CAST(conv(substr(md5(tok), 1, 7), 16, 10) AS INT) AS feature"
# The same tokens of all documents, labelled or not.
ALL_TOKENS_SQL = TOKENS_SQL.split(",\n docs AS")[0]


#: Text of one task that counts tokens; a task's memory follows it, not the table.
TASK_TEXT = 4 << 20


def document_cells(spark: SparkSession, sf_dir: str, labelled: bool = True) -> DataFrame:
    """``(doc_id, feature, value)``: token counts of all documents, or of the labelled ones."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    if labelled:
        docs = docs.join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    # Spread by document first: tokens are then counted and gathered where they are made. The number of tasks follows
    # the text; the number of shuffle partitions does not, and a task's counts and maps would grow with the table.
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.repartition(max(1, -(-size // TASK_TEXT)), "doc_id")
    tokens = docs.select("doc_id", F.explode(F.split("text", " ")).alias("tok")).filter("tok <> ''")
    return tokens.selectExpr("doc_id", TOKEN_FEATURE).groupBy("doc_id", "feature").agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct ``feature`` of all documents: distinct tokens first, so each is hashed and shuffled once."""
    docs = read(spark, sf_dir, "documents").select("text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    docs = docs.repartition(max(1, -(-size // TASK_TEXT)))  # a file's row groups may be few
    tokens = docs.select(F.explode(F.split("text", " ")).alias("tok")).filter("tok <> ''").distinct()
    return tokens.selectExpr(TOKEN_FEATURE).distinct()


def unlabelled_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse table of the token counts of every document; its label is 0."""
    rows = document_cells(spark, sf_dir, labelled=False).groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("features")
    )
    return training_table(rows, "features", "0D", key="doc_id")


def document_table(spark: SparkSession, sf_dir: str, keep: bool = False) -> DataFrame:
    """Sparse training table of token counts with the quality label; one row per labelled document.

    ``keep`` writes it to the checkpoint folder for queries that pass over it several times.
    """
    rows = document_cells(spark, sf_dir).groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("features")
    )
    labels = read(spark, sf_dir, "labels")
    joined = rows.join(labels, "doc_id").withColumn("y", F.expr("IF(quality = 1, 1.0D, -1.0D)"))
    table = training_table(joined, "features", "y", key="doc_id")
    return cut_lineage(table) if keep else table
