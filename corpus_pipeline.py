"""From raw documents to packed training sequences: five stages, each one of the operators in ``grove.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that it keeps, with the columns of ``documents``; the last one
returns the pieces of the packed sequences. Extra columns of ``docs`` are dropped. Every stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grove.llm import line_dedup, near_dup, packing, quality_rules, toxicity
from grove.llm.common import DOCUMENT_COLUMNS, pick, read, saved
from grove.llm.queries import END_ID, PACK_SEQUENCE, WINDOW, vocabulary
from grove.llm.sampling import id_remainder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; texts stay as they are."""
    return quality_rules.keep_good(docs, carry=DOCUMENT_COLUMNS).select(*DOCUMENT_COLUMNS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of 0.5 or more go; learnt from the labels outside the held-out fifth."""
    docs = pick(docs, *DOCUMENT_COLUMNS)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), "toxic", id_remainder("doc_id", 5) != 0)
    return toxicity.score(docs, model, carry=DOCUMENT_COLUMNS).where("score < 0.5").select(*DOCUMENT_COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go, but in the last of them; ``n_chars`` follows the text."""
    cut = line_dedup.dedup_lines(docs, min_chars=40, min_docs=5, carry=("lang", "source"))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id."""
    return near_dup.keep_one(docs, words=4, radius=4, carry=DOCUMENT_COLUMNS).select(*DOCUMENT_COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of up to 4,096 ids."""
    cut = packing.token_pieces(docs, vocabulary("word_bpe_49k.json").decode(), END_ID, WINDOW, with_ids=False)
    return packing.pack(cut, WINDOW).select(PACK_SEQUENCE)


STAGES = [
    ("quality_rules", quality),
    ("toxicity", clean),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("packing", pack),
]
#: Tokenizing and 64-bit XXH64 votes have no counterpart in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
