"""The registered queries of ``grove.llm``: against SQL where there is some, else against plain versions."""

import zlib

import pytest
from pyspark.sql import functions as F

from grove import llm
from tests.compare import connect, difference
from tests.llm import plain

SF = "/root/testdata/sf0.001"
llm.load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_matches_sql(spark, con, name):
    assert difference(llm.QUERIES[name](spark, SF), con, llm.ORACLES[name]) is None


def rows(spark, name):
    return llm.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name, label, n, held, floor", [("op1_toxicity", "toxic", 5, 0, 0.9), ("op3_quality_classifier", "quality", 3, 1, 0.95)])
def test_classifiers_keep_their_split(spark, con, docs, name, label, n, held, floor):
    got = {r["doc_id"]: r for r in rows(spark, name)}
    assert set(got) == {i for i, _ in docs}
    truth = dict(con.execute(f"SELECT doc_id, {label} FROM labels").fetchall())
    right = []
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % n == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and i in truth:
            right.append(r["predicted"] == truth[i])
    assert sum(right) / len(right) >= floor


def test_near_duplicates(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op4_simhash_near_dup")}
    prints = [plain.shingle_print(t) for _, t in docs]
    roots = plain.groups(prints, 4)
    for (i, _), p, root in zip(docs, prints, roots):
        assert got[i]["fingerprint"] == f"{p:016x}" and got[i]["component_id"] == docs[root][0]


def test_simhash_of_edits(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op5_simhash")}
    assert len(got) == len(docs)
    down = docs[::-1]
    for (i, text), (_, after) in zip(down, [*down[1:], down[0]]):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        own, other, ahead = plain.pair_print(text), plain.pair_print(changed), plain.pair_print(after)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), plain.sha(changed))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (f"{own:016x}", f"{other:016x}")
        assert r["near_edited"] == 1 - (own ^ other).bit_count() / 64 and r["near_next"] == 1 - (own ^ ahead).bit_count() / 64


def test_simhash_search(spark, docs):
    prints = {i: plain.pair_print(t) for i, t in docs}
    want = {i: sum((p ^ q).bit_count() <= 3 for q in prints.values()) for i, p in prints.items() if i % 100 == 0}
    assert {r["doc_id"]: r["n_near"] for r in rows(spark, "simhash_search")} == want


def test_packing(spark, docs):
    import numpy as np
    from tokenizers import Tokenizer

    from grove.llm.queries import vocabulary

    tokenizer = Tokenizer.from_str(vocabulary("word_bpe_49k.json").decode())
    by_doc, by_sequence = {}, {}
    for r in rows(spark, "op6_packing"):
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(by_doc.pop(i), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096


def test_sentencepiece(spark, docs):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in rows(spark, "op8_sentencepiece")}
    for i, text in docs:
        ids = sp.encode(text or "")
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == plain.sha(",".join(map(str, ids)))
        assert got[i]["decoded_sha256"] == plain.sha(sp.decode(ids))


def test_pipeline(spark):
    """Each stage against a plain version on what the stage before kept; the classifier by its own scores."""
    import corpus_pipeline

    from grove.llm import toxicity
    from grove.llm.common import read
    from grove.llm.sampling import id_remainder

    table = read(spark, SF, "documents")
    kept = {}
    before = {r["doc_id"]: r["text"] for r in table.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, table, SF)
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = after.cache()
        kept[name] = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "quality_rules":
            bad = {i for i, t in before.items() if len(plain.WORD.findall(t)) < 20 or 100 * plain.repeat_words(t) > 30 * len(plain.WORD.findall(t))}
            assert not bad & set(kept[name]) and len(kept[name]) >= 0.97 * (len(before) - len(bad))
        elif name == "toxicity":
            model = toxicity.fit(table, read(spark, SF, "labels"), "toxic", id_remainder("doc_id", 5) != 0)
            assert set(kept[name]) == {i for i, t in before.items() if toxicity.score_text(t, model, {})[0] < 0.5}
        elif name == "line_dedup":
            assert kept[name] == {i: x[0] for i, x in plain.dedup_lines(list(before.items())).items()}
        else:
            ids = sorted(before)
            roots = plain.groups([plain.shingle_print(before[i]) for i in ids], 4)
            assert set(kept[name]) == {ids[r] for r in roots}
        table, before = after, kept[name]
    packed = corpus_pipeline.STAGES[-1][1](spark, table, SF)
    assert packed.agg(F.count_distinct("doc_id")).first()[0] == len(before)
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
