"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grove.llm import chat, line_dedup, near_dup, packing, pieces, quality_model, quality_rules, register, simhash, toxicity, warc
from grove.llm.common import read, saved, scratch_path
from grove.llm.sampling import id_remainder

WINDOW, END_ID = 4096, 2


def vocabulary(name: str) -> bytes:
    """Content of a public vocabulary file."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


OP2_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
 d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
 f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to FROM f"""


@register("op2_warc", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as an archive with revisit records, read back."""
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    path = scratch_path(spark, "warc")
    boundary = warc.write_archive(pages.toDF("record_id", "url", "payload"), path, min_bytes=100)
    got = warc.resolved_headers(warc.read_archive(spark, path, boundary))
    return got.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def hex_digits(c):
    return F.lpad(F.lower(F.hex(c)), 16, "0")


@register("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how like they are."""
    ahead = simhash.with_next(read(spark, sf_dir, "documents", "doc_id", "text"))
    changed = simhash.edited(F.col("text"), F.col("next_text"))
    sha = F.sha2(changed, 256)
    # Digests travel as four longs each: numbers stay in the hash aggregation, strings would not.
    quarters = [F.conv(F.substring(sha, 16 * i + 1, 16), 16, -10).cast("long").alias(f"sha_{i}") for i in range(4)]
    both = ahead.select(
        "bucket", "place", "doc_id", "next_bucket", "next_place", F.length("text").cast("long").alias("n_chars"),
        F.col("text"), changed.alias("changed"), *quarters,
    )
    carry = ("doc_id", "n_chars", "next_bucket", "next_place", *[f"sha_{i}" for i in range(4)])
    texts = both.select(
        "bucket", "place", *carry,
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("changed").alias("t")))).alias("x"),
    ).select("bucket", "place", *carry, "x.kind", F.col("x.t").alias("text"))
    marks = saved(simhash.with_fingerprints(texts, ["bucket", "place", "kind"], carry=carry), "simhash")
    own, other = marks.where("kind = 0"), marks.where("kind = 1")
    own = own.join(other.select("bucket", "place", F.col("fingerprint").alias("edited")), ["bucket", "place"])
    ahead_of = marks.where("kind = 0").select(F.col("bucket").alias("next_bucket"), F.col("place").alias("next_place"), F.col("fingerprint").alias("next"))
    own = own.join(ahead_of, ["next_bucket", "next_place"])
    return own.select(
        "doc_id",
        "n_chars",
        F.concat(*[hex_digits(F.col(f"sha_{i}")) for i in range(4)]).alias("edited_sha256"),
        hex_digits(F.col("fingerprint")).alias("fingerprint"),
        hex_digits(F.col("edited")).alias("edited_fingerprint"),
        simhash.likeness(F.col("fingerprint"), F.col("edited")).alias("near_edited"),
        simhash.likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )


@register("simhash_search")
def simhash_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document whose id is divisible by 100: how many documents lie within 3 bits of it, by the block tables."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    marks = saved(simhash.with_fingerprints(docs, ["doc_id"]), "simhash")
    counts = marks.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))
    asked = marks.where("doc_id % 100 = 0")
    found = simhash.find_within(asked, marks).join(counts.hint("merge"), "fingerprint")  # a row per distinct fingerprint
    totals = found.groupBy("query").agg(F.sum("n").alias("n_near"))
    return asked.join(totals.hint("merge"), asked["fingerprint"] == totals["query"]).select("doc_id", hex_digits(F.col("query")).alias("fingerprint"), "n_near")


PACK_SEQUENCE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@register("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their place in a sequence."""
    tokenizer = vocabulary("word_bpe_49k.json").decode()
    cut = packing.token_pieces(read(spark, sf_dir, "documents"), tokenizer, END_ID, WINDOW, with_ids=False)
    return packing.pack(cut, WINDOW).select(PACK_SEQUENCE)


OP7_SQL = """WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
 keyed AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
 shared AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
 marked AS (SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM marked GROUP BY doc_id"""


@register("op7_line_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more that 5 documents or more share go, but in the last document."""
    cut = line_dedup.dedup_lines(read(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@register("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of all documents under the public SentencePiece model."""
    coded = pieces.encode_texts(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


WS = r"[^\x20\x09-\x0D]"
# Words, then windows of 8 by position; a window's position is repeated if its words are found twice; the counts follow.
OP9_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
 w AS (SELECT r, regexp_extract_all(text, '{WS}+') AS ws FROM d),
 ww AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
 g AS (SELECT r, i, array_to_string(ws[i:i+7], ' ') AS win FROM ww),
 rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM g) WHERE c > 1),
 cover AS (SELECT r, sum(least(8, coalesce(nx - i, 8))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM rep) GROUP BY r),
 ln AS (SELECT r, doc_id, text, host, unnest(string_split(text, chr(10))) AS line FROM d),
 good AS (SELECT *, lower_ascii AS key FROM (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM ln) WHERE lower_ascii <> ''),
 dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM good GROUP BY r),
 hosts AS (SELECT host, count(DISTINCT text) AS n FROM d GROUP BY host),
 freq AS (SELECT g.host, key FROM good g JOIN hosts h ON g.host = h.host GROUP BY g.host, key, h.n
  HAVING count(DISTINCT g.text) > 20 AND count(DISTINCT g.text) > 0.05 * h.n),
 gone AS (SELECT r, sum(len(regexp_extract_all(line, '{WS}+'))) AS n FROM good JOIN freq USING (host, key) GROUP BY r),
 base AS (SELECT d.r, d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
  FROM d JOIN w ON d.r = w.r LEFT JOIN dup ON d.r = dup.r LEFT JOIN cover ON d.r = cover.r LEFT JOIN gone ON d.r = gone.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
 n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
 NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (n_words - n_removed_words < 0.2 * n_words) AS kept FROM base"""


@register("op9_quality_rules", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for all documents; a document's host is its source."""
    return quality_rules.judge(read(spark, sf_dir, "documents")).drop("text_hash")


OP10_SQL = r"""WITH all_turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL
 SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v(conv_id, turn, role, text)),
 marked AS (SELECT *, replace(replace(text, '&', '&amp;'), '<', '&lt;') AS inside,
 role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS opens FROM all_turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(length(inside) + CASE WHEN opens THEN length('<turn role="">') + length(role) + length('</turn>') + 1 ELSE length('<next/>') END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id"""


@register("op10_chat_format", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = "'\\\\### Assistant: </turn> ok'"
    extra = spark.range(2).selectExpr(
        "-7L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role", f"{said} AS text"
    )
    out = chat.format_conversations(turns.unionByName(extra))
    back = out.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("segments")).alias("loss"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@register("op4_simhash_near_dup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 4-word SimHash fingerprints at most 4 bits apart."""
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"), words=4, radius=4)


@register("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt outside the held-out fifth; with the number of offending sentences."""
    docs, labels = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, "toxic", id_remainder("doc_id", 5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


@register("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt outside the held-out third."""
    docs, labels = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels, "quality", id_remainder("doc_id", 3) != 1)
    return quality_model.score(docs, model).select(
        "doc_id",
        (id_remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
