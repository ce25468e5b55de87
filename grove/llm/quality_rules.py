"""Quality rules: per-document counts, then lines that too many documents of one host share.

Base rules look at one document: its words, symbols, repeated lines and repeated word windows. The rule across documents
hashes every normalised line, counts the distinct documents of a host that hold it, takes out lines above
the host's limit, and rejects documents of which too little is left. Documents of equal text count as one: copies
are left to deduplication and don't make their own lines frequent. DataFrame functions only.

A host may hold a third of all rows, and a line most of its host's documents: lines are counted by
host, line and text first, so a frequent one is already spread over all tasks when it is summed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.llm.common import SPACE, pick, saved

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
SPLIT = "[ \\t\\n\\x0B\\f\\r]+"


def words_of(text: Column) -> Column:
    """The maximal runs without white space."""
    return F.filter(F.split(F.btrim(text, F.lit(SPACE)), SPLIT), lambda w: w != "")


def with_base_counts(docs: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` to a table with ``text`` (null: no words).

    Word windows are compared by 64-bit hashes, chained from the hashes of words.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    out = docs.withColumns(
        {
            "word_chars": F.length(F.translate(text, SPACE, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "_h": F.transform(words_of(text), lambda w: F.xxhash64(w)),
        }
    ).withColumn("n_words", F.size("_h").cast("long"))
    # Hashes of 2, 4, then 8 words: each from two of half the length, as far apart as these are long.
    step = "IF(n_words < {w}, array(), zip_with(slice({a}, 1, CAST(n_words AS INT) - {o}), slice({a}, {half} + 1, CAST(n_words AS INT) - {o}), (x, y) -> xxhash64(x, y)))"
    for half, a, b in ((1, "_h", "_h2"), (2, "_h2", "_h4"), (4, "_h4", "_h8")):
        out = out.withColumn(b, F.expr(step.format(w=WINDOW, a=a, half=half, o=2 * half - 1)))
    # Only where a hash repeats: positions of repeated windows, from hashes in order.
    out = out.withColumn(
        "_order",
        F.expr("IF(size(array_distinct(_h8)) < size(_h8), sort_array(transform(_h8, (h, i) -> struct(h, i))), array())"),
    ).withColumn(
        "_at",
        F.expr(
            """sort_array(transform(filter(_order, (x, k) -> get(_order, k - 1).h <=> x.h OR get(_order, k + 1).h <=> x.h), x -> x.i))"""
        ),
    )
    covered = f"aggregate(zip_with(_at, slice(_at, 2, greatest(size(_at), 1)), (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW}))), 0L, (s, x) -> s + x)"
    out = out.withColumn("n_repeat_words", F.expr(f"IF(size(_at) = 0, 0L, {covered})"))
    return out.drop("_h", "_h2", "_h4", "_h8", "_order", "_at")


def lines_of(text: Column) -> Column:
    """The lines that are not blank."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")


def line_hash(line: Column) -> Column:
    """Hash of a line as lines are compared: stripped, A-Z in lower case."""
    return F.xxhash64(F.translate(F.btrim(line, F.lit(SPACE)), UPPER, UPPER.lower()))


def judge(docs: DataFrame, host: str = "source", min_share: float = 0.05, min_docs: int = 20, keep_share: float = 0.2) -> DataFrame:
    """Counts and verdict per row of ``doc_id, text`` and ``host``; other columns are ignored.

    A line (stripped, A-Z in lower case) is above the limit when more than ``min_docs`` and more than ``min_share`` of
    the host's distinct documents hold it. A document is rejected if the base rules fail it, or if
    fewer than ``keep_share`` of its words are left without such lines. Returns ``doc_id, text_hash, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words, kept`` for every input row; null texts have no
    words and fail, null hosts are one host. Repeated rows get equal verdicts.
    """
    return judged(docs, host, min_share, min_docs, keep_share).drop("host", "frequent_lines")


def judged(
    docs: DataFrame,
    host: str = "source",
    min_share: float = 0.05,
    min_docs: int = 20,
    keep_share: float = 0.2,
) -> DataFrame:
    """``judge`` with the host and ``frequent_lines``, the hashes of a row's lines above the limit."""
    text = F.coalesce("text", F.lit(""))
    docs = pick(docs, "doc_id", "text", host).withColumnRenamed(host, "host")
    counted = with_base_counts(docs).withColumns({"text_hash": F.xxhash64(text), "row": F.monotonically_increasing_id()})
    counted = counted.withColumn(
        "lines",
        F.transform(
            lines_of(text),
            lambda x: F.struct(
                line_hash(x).alias("line"),
                F.size(words_of(x)).alias("words"),
            ),
        ),
    )
    kept = saved(counted.drop("text"), "quality")
    hosts = kept.select("host", "text_hash").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    lines = kept.select("row", "host", "text_hash", F.explode("lines").alias("x")).select("row", "host", "text_hash", "x.line", "x.words")
    holders = lines.groupBy("host", "line", "text_hash").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    frequent = (
        holders.where(F.col("n") > min_docs)
        .join(hosts, holders["host"].eqNullSafe(hosts["host"]))
        .where(F.col("n") > min_share * F.col("host_docs"))
        .select(holders["host"].alias("f_host"), F.col("line").alias("f_line"))
    )
    removed = (
        lines.join(frequent, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line") == F.col("f_line")))
        .groupBy("row")
        .agg(F.sum("words").alias("n_removed_words"), F.collect_set("line").alias("frequent_lines"))
    )
    out = kept.join(removed, "row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_removed_words") < keep_share * F.col("n_words")
    return out.select(
        "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "n_removed_words", (~failed & ~depleted).alias("kept"), "host", "frequent_lines",
    )


def keep_good(docs: DataFrame, carry: tuple[str, ...] = (), **limits) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps: ``doc_id, text`` as they are, the host column and the columns ``carry``."""
    docs = pick(docs, *dict.fromkeys(("doc_id", "text", limits.get("host", "source"), *carry)))
    bad = judge(docs, **limits).where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["_hash"])
    return docs.join(bad, same, "left_anti")


def without_frequent_lines(docs: DataFrame, carry: tuple[str, ...] = (), **limits) -> DataFrame:
    """The rows that ``judge`` keeps, as ``keep_good`` gives them, but with lines above the limit taken out of ``text``; all other lines stay as they are."""
    host = limits.get("host", "source")
    docs = pick(docs, *dict.fromkeys(("doc_id", "text", host, *carry)))
    good = judged(docs, **limits).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("host").alias("_host"), F.coalesce("frequent_lines", F.array().cast("array<bigint>")).alias("_gone")
    ).dropDuplicates(["_id", "_hash", "_host"])
    same = docs["doc_id"].eqNullSafe(good["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == good["_hash"]) & docs[host].eqNullSafe(good["_host"])
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.col("_gone"), line_hash(x)) | (F.btrim(x, F.lit(SPACE)) == "")), "\n")
    cut = docs.join(good, same).withColumn("text", F.when(F.size("_gone") > 0, left).otherwise(F.col("text")))
    return cut.select(docs.columns)
