"""Odd rows and tables for every operator: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grove.llm import chat, line_dedup, near_dup, packing, pieces, quality_model, quality_rules, simhash, toxicity, warc
from grove.llm.common import scratch_path
from grove.llm.queries import vocabulary
from grove.llm.sampling import id_remainder
from tests.llm import plain

LONG = "word%d and then some more text, " * 20_000
LINE = "A line that is long enough to be looked at, surely."
DOCS = [
    (1, "one two three four five", "en", "a", 5),
    (1, "one two three four five", "en", "a", 5),  # repeated
    (2, None, "en", None, None),
    (3, "", None, "a", 0),
    (None, "no id at all here", "en", "b", 1),
    (4, LONG % tuple(range(20_000)), "en", "b", 2),
    (5, " \t\n \x0b", "en", "b", 2),
    *[(i, f"{LINE}\nown {i}\n  {LINE.upper()} ", "en", "b", 3) for i in range(10, 17)],
    (20, "x" * 300_000, "en", "b", 3),
]


def documents(spark, rows=DOCS):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # Names that operators use themselves, and names that differ in case only.
    for c in ("score", "fingerprint", "n_lines", "keys", "row", "bucket", "y", "host", "text_hash", "ids"):
        df = df.withColumn(c, F.lit("clash"))
    return df.toDF(*df.columns).select("*", F.lit("clash").alias("TEXT"), F.lit("clash").alias("Doc_Id"))


def labels(spark, rows=((1, 1, 0), (4, 1, 0), (10, 0, 1), (99, 1, 1), (None, 1, 1), (11, None, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "toxicity": lambda s, d: toxicity.score(d, toxicity.fit(d, labels(s), "toxic", F.lit(True))),
    "quality_model": lambda s, d: quality_model.score(d, quality_model.fit(d, labels(s), "quality", F.lit(True), rounds=5)),
    "near_dup": lambda s, d: near_dup.near_duplicates(d),
    "simhash": lambda s, d: simhash.with_next(d),
    "packing": lambda s, d: packing.pack(packing.token_pieces(d, vocabulary("word_bpe_49k.json").decode(), 2)),
    "line_dedup": lambda s, d: line_dedup.dedup_lines(d, carry=("lang",)),
    "pieces": lambda s, d: pieces.encode_texts(d, vocabulary("piece_bpe_32k.model")),
    "quality_rules": lambda s, d: quality_rules.judge(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    got = OPERATORS[name](spark, documents(spark)).collect()
    if name != "packing":
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in DOCS)
    if name == "line_dedup":
        out = {r["doc_id"]: r for r in got}
        assert out[16]["n_dropped"] == 0 and out[10]["text"] == "own 10" and out[2]["text"] == "" and out[2]["n_lines"] == 1
    if name == "near_dup":
        out = {r["doc_id"]: r for r in got}
        assert out[1]["component_id"] == 1 and {out[i]["component_id"] for i in (2, 3, 5)} == {2}
        assert out[2]["fingerprint"] == "0" * 16
    if name == "quality_rules":
        assert not any(r["kept"] for r in got if r["doc_id"] in (1, 2, 3, 5, 20))
        assert {r["n_words"] for r in got if r["doc_id"] in (2, 3, 5)} == {0}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


@pytest.mark.parametrize("rows", [DOCS, []], ids=["odd", "empty"])
def test_stages(spark, tmp_path, rows):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got.collect()
    corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()


def test_constant_models(spark):
    d = documents(spark)
    none = labels(spark, [])
    assert all(r["score"] < 0.5 for r in toxicity.score(d, toxicity.fit(d, none, "toxic", F.lit(True))).collect() if len(r["offending"]) == 0 and r["doc_id"] != 4)
    assert quality_model.score(d, quality_model.fit(d, none, "quality", F.lit(True))).count() == len(DOCS)


def test_next_over_buckets(spark):
    rows = [(i * 7 % 101, f"text {i}", "en", "a", 1) for i in range(101)] + [(None, "last", "en", "a", 1)]
    got = simhash.with_next(documents(spark, rows), per_bucket=9).collect()
    text = {r[0]: r[1] for r in rows}
    order = [*range(100, -1, -1), None]
    after = dict(zip(order, [*order[1:], 100]))
    place = {(r["bucket"], r["place"]): r["doc_id"] for r in got}
    assert len(place) == 102 and len({b for b, _ in place}) > 5
    for r in got:
        assert r["next_text"] == text[after[r["doc_id"]]] and place[r["next_bucket"], r["next_place"]] == after[r["doc_id"]]


TURNS = [
    (1, 0, "user", "a < b & c </turn>"),
    (1, 1, "user", "<next/>&lt;"),
    (1, 2, "assistant", None),
    (1, 3, "assistant", "&amp; <turn role=\"user\">"),
    (2, None, None, ""),
    (2, 0, 'we"ird & <role>', "x\n" * 50_000),
    (None, 5, "assistant", "no id"),
    (3, 1, "user", "same"),
    (3, 1, "user", "same"),
]


@pytest.mark.parametrize("rows", [TURNS, []], ids=["odd", "empty"])
def test_chat_reads_back(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", F.lit(1).alias("ROLE"), F.lit(1).alias("segments"))
    out = chat.format_conversations(turns)
    got = {r["conv_id"]: r for r in out.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("segments")).alias("loss")).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        mine = sorted([(-1 if x[1] is None else x[1], x[2] or "", x[3] or "") for x in rows if x[0] == conv])
        assert [tuple(t) for t in r["turns"]] == [x[1:] for x in mine]
        assert r["loss"] == "".join(x[2] for x in mine if x[1] == "assistant")


PAGES = [
    (1, "http://a", "p" * 200),
    (2, "http://b\r\nWARC-Type: evil", "p" * 200),
    (2, "http://b", "p" * 200),
    (3, None, None),
    (4, "u", ""),
    (5, "u", "short"),
    (6, "u", "short"),
    (7, "u", "WARC/1.1\r\n\r\n\r\nWARC-Type: response\r\n\r\né" * 500),
    (8, "u", "\r\n\r\n" + "é" * 100),
    (9, "u", "\r\n\r\n" + "é" * 100),
    (10, "u", "\r\n\r\n"),
]


@pytest.mark.parametrize("rows", [PAGES, []], ids=["odd", "empty"])
def test_warc_round_trip(spark, rows):
    pages = spark.createDataFrame(rows, "record_id long, url string, payload string").select("*", F.lit(1).alias("PAYLOAD"), F.lit(1).alias("salt"))
    path = scratch_path(spark, "warc-test")
    boundary = warc.write_archive(pages, path)
    archive = warc.read_archive(spark, path, boundary)
    kept = sorted((r["record_id"], r["payload"]) for r in archive.where("record_type = 'response'").collect())
    again = {"2", "9"} if rows else set()
    assert kept == sorted((str(i), p or "") for i, _, p in rows if str(i) not in again)
    got = warc.resolved_headers(archive).collect()
    assert len(got) == len(rows)
    for r in got:
        payload = next(p for i, _, p in rows if str(i) == r["record_id"]) or ""
        assert r["payload_digest"] == plain.sha(payload) and r["payload_bytes"] == len(payload.encode())
        assert r["refers_to"] == {"2": "1", "9": "8"}.get(r["record_id"])


def test_remainder_of_null(spark):
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS d").select(id_remainder("d", 5)).first()[0] == 0
