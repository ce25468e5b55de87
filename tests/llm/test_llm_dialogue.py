"""The conversation trie, the structure repair and the shingle Jaccard join: against plain versions, and odd rows."""

import random

import pytest

from grove.llm import jaccard_join, prefix_trie, repair
from tests.compare import connect
from tests.llm import plain

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
TURNS = [
    (0, 0, "user", "Hello there."),
    (0, 1, "assistant", "Hi!"),
    (0, 1, "assistant", "Hi!"),  # repeated row
    (0, 2, None, None),
    (1, 0, "user", "Hello there."),
    (1, 3, "assistant", "Other"),
    (2, None, "system", "Be brief."),
    (2, 0, "user", "Hello there."),
    (5, 0, "user", "x" * 100_000),  # very long
    (6, 2, "user", ""),
    (6, 2, "tool", "   \t"),  # tie on turn
    (7, None, None, None),
    (None, 0, "user", "no conversation id"),
    (-7, 0, "user", "\\### Assistant: </turn> ok"),
    (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
    *[(10 + i % 3, i, ("user", "assistant")[i % 2], f"Line {i % 4}.") for i in range(30)],
]


def clashing(spark, rows=TURNS):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "'clash' AS key_hi", "'clash' AS shard", "'clash' AS position", "'clash' AS TEXT", "'clash' AS Conv_Id")


def test_trie_matches_plain(spark):
    got = sorted((tuple(r) for r in prefix_trie.trie(clashing(spark)).collect()), key=repr)
    assert got == plain.trie(TURNS)


def test_trie_of_the_table_and_tiny_shards(spark, monkeypatch):
    rows = [tuple(r) for r in connect(SF).execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()]
    want = plain.trie(rows)
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 7)  # many shards: partial rows of one node meet in Spark
    got = sorted((tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == want


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_auction_against_search():
    rng = random.Random(7)
    for _ in range(1500):
        n = rng.randint(0, 6)
        roles = [rng.choice(["user", "assistant", "system", "tool", " ", "u2", ""]) for _ in range(n)]
        marks = [rng.choice([None, None, "blank", "duplicate", "truncated"]) for _ in range(n)]
        texts = [f"t{k}" for k in range(n)]
        assert repair.repair(roles, texts, marks) == plain.cheapest_repair(roles, texts, marks)


def test_auction_prices_are_distances():
    roles, marks = ["user", "user", "assistant", "system", "assistant"], [None, "truncated", None, None, "duplicate"]
    price = repair.auction_prices(roles, marks)
    for node, p in price.items():
        if node is not None:
            best = min(c + price[j] for c, _, j, _ in repair.arcs(roles, marks, node))
            assert p == best  # Bellman's equation holds everywhere: the prices are exact


def test_repair_matches_plain(spark):
    got = sorted((tuple(r) for r in repair.audit_conversations(clashing(spark)).collect()), key=repr)
    assert got == plain.audits(TURNS)


def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in connect(SF).execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()]
    got = sorted((tuple(r) for r in repair.audit_conversations(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == plain.audits(rows)


def test_repair_of_a_conversation_that_damage_empties(spark):
    import zlib

    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair.audit_conversations(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", plain.sha(""))]
    assert repair.audit_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


DOCS = [
    (1, "a b c d e f g h i j k l m n o p q r s t"),
    (2, "A B C D E F G H I J K L M N O P Q R S T"),  # equal after lower-casing
    (3, "a b c d e f g h i j k l m n o p q r s t u"),  # 18 of 19: linked
    (4, "a b c d e f g h i j k l m n o p q r x y"),  # 17 of 20: not linked
    (5, None),
    (6, ""),
    (7, "  \t "),
    (8, "two words"),
    (9, "Two   words"),
    (9, "Two   words"),  # repeated row
    (None, "a b c d e f g h i j k l m n o p q r s t"),
    (10, " ".join(f"w{i}" for i in range(30_000))),  # very long
    (11, " ".join(f"w{i}" for i in range(30_000)) + " tail"),
]


def test_jaccard_matches_plain(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAF", 2)  # split every candidate group that pivots can shrink
    df = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "'clash' AS shingles", "'clash' AS region", "'x' AS Doc_ID")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard_join.jaccard_components(df).collect()}
    want = plain.jaccard(DOCS)
    assert got.pop(None) == (19 - 1, None, 0)
    assert got == want
    assert want[2][1:] == (1, 2) and want[4][1:] == (4, 0) and want[6] == (0, 6, 0) and want[8][2] == 1


@pytest.mark.parametrize("leaf", [3, jaccard_join.LEAF])
def test_jaccard_of_the_table(spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    rows = connect(SF).execute("SELECT doc_id, text FROM documents").fetchall()
    got = {r["doc_id"]: tuple(r)[1:] for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain.jaccard(rows)


def test_jaccard_of_nothing(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def family(n: int, words: int = 60) -> list[tuple[int, str]]:
    """``n`` near copies of one text, each with two words of its own, and as many texts that share only a line with it."""
    line = [f"common{i}" for i in range(12)]
    texts = []
    for i in range(n):
        w = [f"w{j}" for j in range(words)]
        w[(7 * i) % words], w[(11 * i + 3) % words] = f"x{i % 5}", f"y{i}"
        texts += [" ".join(line + w), " ".join(line + [f"z{i}_{j}" for j in range(words)])]
    return [*enumerate(texts, 1)]


def test_jaccard_candidates_are_few(spark, monkeypatch):
    """Near copies and a common line: few pairs that don't link are left for the exact check, and no link is lost."""
    monkeypatch.setattr(jaccard_join, "SAMPLE", 1)
    rows = family(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    pairs = jaccard_join._pairs
    monkeypatch.setattr(jaccard_join, "_pairs", lambda *a: seen.append(pairs(*a)) or seen[-1])
    counted = []
    monkeypatch.setattr(jaccard_join, "release", lambda table: counted.append(table.count()) if seen and table is seen[-1] else None)
    got = {r["doc_id"]: tuple(r)[1:] for r in jaccard_join.jaccard_components(df).collect()}
    want = plain.jaccard(rows)
    assert got == want
    assert counted[0] <= sum(x[2] for x in want.values()) + 60


def test_jaccard_pairs_are_not_doubled(spark, monkeypatch):
    """The sets of candidate pairs are found without a row for each end of each pair."""
    plans = {}
    saved = jaccard_join.saved
    monkeypatch.setattr(jaccard_join, "saved", lambda df, what: plans.update({what: df._jdf.queryExecution().optimizedPlan().toString()}) or saved(df, what))
    rows = [(i, " ".join([*(f"w{j}" for j in range(60)), f"x{i}"])) for i in range(12)]
    got = {r["doc_id"]: tuple(r)[1:] for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain.jaccard(rows) == {i: (59, 0, 11) for i in range(12)}
    assert "Generate" not in plans["wanted"]


def test_jaccard_compares_whole_sketches_once(spark, monkeypatch):
    """Only pairs with a set whose sketch is longer than its folded one meet their sketches again."""
    met = []
    saved = jaccard_join.saved

    def watched(df, what):
        out = saved(df, what)
        if what == "met":
            met.extend(tuple(r) for r in out.collect())
        return out

    monkeypatch.setattr(jaccard_join, "saved", watched)
    n = 128 * jaccard_join.MARK
    long = [(100 + i, " ".join([*(f"v{j}" for j in range(n + 50)), *(f"q{i}_{j}" for j in range(20 * i))])) for i in range(4)]
    rows = [(i, " ".join([*(f"w{j}" for j in range(60)), f"x{i}"])) for i in range(12)] + long
    got = {r["doc_id"]: tuple(r)[1:] for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain.jaccard(rows) and got[100][2] == 3
    assert {(a >= 100, more) for a, _, more in met} == {(False, False), (True, True)}


def test_jaccard_writes_no_table_of_all_shingles(spark, monkeypatch):
    """Only prefixes and sketches are kept of texts that are like no other."""
    kept = {}
    saved = jaccard_join.saved

    def watched(df, what):
        out = saved(df, what)
        kept[what] = max(kept.get(what, 0), sum(x[0] or 0 for c, t in df.dtypes if t == "array<bigint>" for x in out.selectExpr(f"sum(size({c}))").collect()))
        return out

    monkeypatch.setattr(jaccard_join, "saved", watched)
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(2_000))) for i in range(40)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got) == [(i, 1998, i, 0) for i in range(40)]
    assert all(n < 0.2 * 40 * 1998 for n in kept.values())
