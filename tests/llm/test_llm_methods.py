"""The methods inside the operators, on small inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from grove.llm import line_dedup, near_dup, packing, pieces, quality_model, quality_rules, simhash, toxicity
from grove.llm import components as component_steps
from grove.llm.components import components
from grove.llm.queries import vocabulary
from tests.llm import plain


def clustered(n: int, seed: int) -> list[int]:
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(n)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base[: n // 3] for _ in range(4)]
    return sorted({*base, *near})


def as_long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("chunk", [near_dup.CHUNK, 40])
def test_ball_hashing_finds_every_link(spark, monkeypatch, chunk):
    """Also with tiny buckets and chunks, where links go through the shuffle between chunks."""
    monkeypatch.setattr(near_dup, "BUCKET", 60)
    prints = clustered(150, 3)
    centre = prints[0]
    prints = sorted({*prints, *(centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a))})
    df = spark.createDataFrame([(as_long(p),) for p in prints * 2], "fingerprint long")
    got = {r["node"] % 2**64: r["root"] for r in components(near_dup.link_fingerprints(df, 4, chunk)).collect()}
    roots = plain.groups(prints, 4)
    sizes = {r: roots.count(r) for r in roots}
    for p, root in zip(prints, roots):
        members = {got.get(q) for q, r in zip(prints, roots) if r == root}
        assert (p in got) == (sizes[root] > 1) and len(members) == 1


def test_ball_hashing_in_steps(monkeypatch):
    prints = np.array(clustered(120, 5), np.uint64)
    whole, _ = near_dup.link_chunk(prints, np.uint64(0), 0, 4, False)
    monkeypatch.setattr(near_dup, "STEP_VARIANTS", 5_000)
    parts, _ = near_dup.link_chunk(prints, np.uint64(0), 0, 4, False)
    assert (whole == parts).all() and whole.tolist() == plain.groups([int(p) for p in prints], 4)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 200: 0, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("nodes", [component_steps.NODES, 0])
def test_components_of_dense_groups(spark, monkeypatch, nodes):
    """Groups that all link with all leave fewer links than their nodes in each task; a task that starts afresh loses none."""
    monkeypatch.setattr(component_steps, "NODES", nodes)
    written = []
    saved = component_steps.saved

    def watched(df, what):
        out = saved(df, what)
        written.append(out.count())
        return out

    monkeypatch.setattr(component_steps, "saved", watched)
    groups = [range(80), range(100, 160), range(200, 202)]
    pairs = [(a, b) if (a + b) % 2 else (b, a) for g in groups for a in g for b in g if a < b] + [(79, 100), (5, 5)]
    tasks = 3
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(tasks)).collect()}
    assert got == {**dict.fromkeys([*range(80), *range(100, 160)], 0), 200: 200, 201: 200}
    assert max(written) <= tasks * len(got) < len(pairs) / 10


def test_block_tables_find_all(spark):
    prints = clustered(120, 8)
    df = spark.createDataFrame([(as_long(p),) for p in prints], "fingerprint long")
    for blocks in (4, 6):
        got = simhash.find_within(df.limit(60), df, 3, blocks).collect()
        pairs = {(r["query"] % 2**64, r["fingerprint"] % 2**64, r["distance"]) for r in got}
        assert len(pairs) == len(got)
        asked = {r["fingerprint"] % 2**64 for r in df.limit(60).collect()}
        assert pairs == {(a, b, (a ^ b).bit_count()) for a in asked for b in prints if (a ^ b).bit_count() <= 3}


def test_filters_miss_nothing():
    rng = np.random.default_rng(1)
    bits, keys = 2**14, [rng.bytes(16) for _ in range(300)]
    pairs = []
    for part in (keys[:200], keys[100:250], keys[240:]):
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        line_dedup._set(once, line_dedup._positions(part, bits).astype(np.int64).ravel())
        pairs.append((once, twice))
    _, twice = line_dedup.merge_filters(pairs)
    hit = line_dedup._holds(twice, line_dedup._positions(keys, bits).astype(np.int64))
    assert hit[100:200].all() and hit[240:250].all() and hit.sum() < 150


def test_full_filters_give_the_same_lines(spark):
    rng = random.Random(4)
    pool = [f"line {k} " + "abcdefgh " * 5 for k in range(40)]
    docs = [(i, "\n".join(rng.choices(pool, k=6))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for bits in (2**28, 2**15):
        got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.dedup_lines(df, max_filter_bits=bits).collect()}
        assert got == plain.dedup_lines(docs)


def test_repeated_windows(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(60)] + ["a " * 500, "", " \n ", "é " * 9]
    got = quality_rules.with_base_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")).collect()
    for r in got:
        assert r["n_repeat_words"] == plain.repeat_words(texts[r["i"]]), texts[r["i"]]


def test_frequent_lines_deplete(spark):
    rows = [(i, "s", f"{'shared words in a menu line ' * 6}\n{'own%d ' % i * 2}") for i in range(40)]
    rows += [(100 + i, "s", " ".join(f"w{i}x{k}" for k in range(40))) for i in range(40)]
    rows += [(200 + i, "t", rows[0][2]) for i in range(30)]  # copies of one text count as one document
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert not any(got[i]["kept"] for i in range(40) if not got[i]["base_failed"]) and all(got[100 + i]["kept"] for i in range(40))
    assert all(got[200 + i]["n_removed_words"] == 0 for i in range(30))


@pytest.mark.parametrize("seed", range(5))
def test_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 64) for _ in range(200)]
    placed = packing.best_fit_decreasing(lengths, 64)
    room: list[int] = []
    for i in sorted(range(200), key=lambda i: -lengths[i]):
        fit = [(r, w) for w, r in enumerate(room) if r >= lengths[i]]
        if fit:
            least = min(fit)[0]
            assert room[placed[i][0]] == least
        else:
            assert placed[i][0] == len(room)
            room.append(64)
        assert placed[i][1] == 64 - room[placed[i][0]]
        room[placed[i][0]] -= lengths[i]


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, f"some words {i} " * (i * 3)) for i in range(40)], "doc_id long, text string")
    cut = packing.token_pieces(docs, vocabulary("word_bpe_49k.json").decode(), 2, window=64)
    packed = packing.pack(cut, 64).cache()
    full = {r["sequence_id"]: r for r in packing.sequences(packed, 0, 64).collect()}
    for r in packed.collect():
        own = np.frombuffer(r["ids"], "<u4").tolist()
        assert full[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]] == own
    assert all(len(r["ids"]) == 64 or len(r["ids"]) & (len(r["ids"]) - 1) == 0 for r in full.values())


def test_pieces_match_the_library():
    import public_tokenizers
    import sentencepiece

    codec = pieces.PieceCodec(vocabulary("piece_bpe_32k.model"))
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(1)
    letters = list("aeiou thes  \n\t▁ñé日本語中文字😀́　\x00.,;!?0123456789ABC'\"") + ["<s>", "<unk>", "tion", "   "]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        ids = sp.encode(text)
        assert codec.encode(text) == ids and codec.decode(ids) == sp.decode(ids)
        n, told, back = codec.both(text)
        assert (n, told.decode(), back) == (len(ids), ",".join(map(str, ids)), sp.decode(ids))
    for k in range(50):
        assert codec.encode(" " * k + "x") == sp.encode(" " * k + "x")


def test_noisy_or_finds_the_sentence(spark):
    rng = random.Random(2)
    calm = [f"{a}{b}" for a in "bcdfg" for b in ("ab", "ec", "id", "of", "ug")]
    rows, marks = [], []
    for i in range(300):
        text = [" ".join(rng.choices(calm, k=6)) for _ in range(rng.randint(1, 12))]
        toxic = i % 3 == 0
        if toxic:
            text[rng.randrange(len(text))] += " nasty" + rng.choice(["ly", "er", ""])
        rows.append((i, ". ".join(text) + "."))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"), "toxic", F.col("doc_id") % 5 != 0)
    for r in toxicity.score(docs, model).collect():
        text = rows[r["doc_id"]][1]
        assert (r["score"] >= 0.5) == ("nasty" in text)
        assert all("nasty" in text[o["start"] : o["end"]] for o in r["offending"]) and bool(r["offending"]) == ("nasty" in text)


def test_toxicity_learns_every_telling_feature(spark):
    """300 words of 7 features each, every word in 12 toxic documents."""
    rng = random.Random(6)
    telling = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=10)) for _ in range(300)})
    dealt = telling * 12
    toxic = [f"the river runs. here are {' '.join(dealt[i : i + 6])} again" for i in range(0, len(dealt), 6)]
    rows = [(i, f"{i} {t}") for i, t in enumerate(toxic + ["the river runs. here are stones again"] * len(toxic))]
    marks = spark.createDataFrame([(i, int(i < len(toxic))) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), marks, "toxic", F.lit(True))
    want = {f for w in telling for f in toxicity.features_of(w)}
    assert len(want) > 2_000 and want <= model.weights.keys()
    assert all(model.weight(w) > 0 for w in telling)


@pytest.mark.parametrize("text, spans", [("Nice day.moron", [(9, 14)]), ("Well!moron?yes", [(5, 10)]), ("a.b.c MORON.day", [(4, 11)]), ("Nice day.more", [])])
def test_toxicity_looks_up_words_glued_to_sentences(text, spans):
    score, found = toxicity.score_text(text, toxicity.ToxicityModel({"w moron": 9.0}, -6.0), {})
    assert [(a, b) for a, b, _ in found] == spans and (score >= 0.5) == bool(spans)


def test_toxicity_counts_words_glued_to_sentences(spark):
    rows = [(i, f"{i} it was a nice {w}.{'moron' if i % 2 else 'stone'}") for i, w in enumerate(f"d{chr(97 + k % 26)}{chr(97 + k // 26)}y" for k in range(200))]
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), marks, "toxic", F.lit(True))
    assert model.weight("moron") > 0


@pytest.mark.parametrize("word", ["moron", "moronically", "o'neill-like", "abc'def", "..", "ab"])
def test_leading_feature_tells_all_others(word):
    own = toxicity.features_of(word)
    for first in range(len(own)):
        number = {f: i for i, f in enumerate(own[first:] if first else own)} | ({} if first % 2 else {f: 50 + i for i, f in enumerate(own[1:first])})
        lead = toxicity.leading_feature(word, number)
        name = next(f for f, i in number.items() if i == lead)
        assert {f for f in toxicity.parts(name) if f in number} == {f for f in own if f in number}
    assert toxicity.leading_feature(word, {}) is None


def test_quality_rules_take_frequent_lines_out(spark):
    """A short menu line goes from every document of the host that shares it, and stays at another host."""
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    text = lambda i: f"  Home | ABOUT \n\n{body(i)}\nend {i}"
    rows = [(i, text(i), "a") for i in range(30)] + [(7, text(7), "a"), (100, text(100), "b"), (101, "home | about", "a"), (102, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r["doc_id"], r["text"]) for r in quality_rules.without_frequent_lines(df).collect())
    assert got == sorted([(i, f"\n{body(i)}\nend {i}") for i in [*range(30), 7]] + [(100, text(100))])
    assert sorted(r["doc_id"] for r in quality_rules.keep_good(df).collect()) == [i for i, _ in got]


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    kw = dict(max_bins=16, rounds=100)
    with_pairs = quality_model.fit_additive(x[:2000], y[:2000], np.ones(2000), **kw)
    without = quality_model.fit_additive(x[:2000], y[:2000], np.ones(2000), n_pairs=0, **kw)
    right = lambda m: ((m.score(x[2000:]) >= 0.5) == y[2000:]).mean()
    assert right(with_pairs) > 0.93 and right(without) < 0.65
