"""Prefix trie of conversations by vertical bitmaps.

Conversations are dealt into shards by a hash of their id. Inside a shard every ``(position, turn)`` has a posting: the
bitset of the shard's conversations that hold that turn there. A depth-first walk intersects a node's bitset with the
postings of the next position that its members hold; each non-empty intersection is a child. Popcounts give member
counts, the lowest set bit the smallest member, and the bitset of conversations of the node's length its end list.

Shards only see their own conversations, so each emits partial rows per node, keyed by a 128-bit hash of the node's
turn sequence; Spark adds them up by key. Subtree figures are not sums over shards (a node can be in several), so they
are written as sums over members of per-conversation facts: a node of the subtree is counted once, through its smallest
member. The walk runs a second time with these facts, which Spark gathers between the walks.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grove.llm.common import pick, saved

#: Rebuilt turns a shard holds, about; the bitsets of a shard have as many bits as it has conversations.
SHARD_ROWS = 20_000
#: Fixed values of the contract: the base conversation is c - c % 5, and h = crc32(decimal c) % 9 turns come from it.
BASE_OF, PREFIX_OF = 5, 9
ROOT = (0, 0)
NODE_SCHEMA = (
    "depth long, key_hi long, key_lo long, parent_hi long, parent_lo long, n long, least long, last_bytes long, "
    "below long, below_own long, leaf_reps long, ends array<long>"
)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, position`` (from 1), ``role, text, bytes`` of every rebuilt conversation; ``ids``: every ``conv_id``.

    Turns go by ``turn`` (nulls first, then role and text); null role or text is empty. Conversation c takes the first
    h turns of conversation ``c - c % 5`` (fewer if it has fewer, none if it is absent), then its own turns after its first
    h. Rows of a null ``conv_id`` are left out. A base conversation meets at most five ids.
    """
    turns = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.select("conv_id", F.row_number().over(order).alias("position"), "role", "text")
    ids = turns.groupBy("conv_id").agg(F.max("position").alias("length"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(PREFIX_OF))
    wants = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % BASE_OF).alias("base"), h.alias("h"))
    lengths = ids.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    wants = wants.join(lengths, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("base_length", F.lit(0))).alias("taken"))
    head = wants.join(turns.withColumnRenamed("conv_id", "base"), "base").where("position <= h").select("conv_id", "position", "role", "text")
    own = turns.join(wants.select("conv_id", "h", "taken"), "conv_id").where("position > h")
    tail = own.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "role", "text")
    rows = head.unionByName(tail).withColumn("bytes", F.octet_length("text").cast("long"))
    return rows, ids.select("conv_id")


def _chain(parent: tuple[int, int], turn: tuple[int, int]) -> tuple[int, int]:
    digest = hashlib.blake2b(b"".join(x.to_bytes(8, "little", signed=True) for x in (*parent, *turn)), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def walk(table) -> dict[str, list]:
    """Rows of the nodes of one shard, as columns of ``NODE_SCHEMA``.

    ``table`` has one row per conversation and position: ``conv_id, length, position`` (0 for a turnless conversation),
    ``k1, k2`` (turn hash), ``bytes``, and the facts ``first_own`` (depth from which the conversation is the smallest member
    of its nodes) and ``leaf_rep`` (it is the smallest member of its end node, which is childless); facts may be null.
    """
    import numpy as np

    ids = np.asarray(table.column("conv_id").to_numpy(zero_copy_only=False), np.int64)
    convs, local = np.unique(ids, return_inverse=True)  # ascending: the lowest bit is the smallest member
    m, words = len(convs), (len(convs) + 63) // 64
    pos = np.asarray(table.column("position").to_numpy(zero_copy_only=False), np.int64)
    length = np.zeros(m, np.int64)
    np.maximum.at(length, local, np.asarray(table.column("length").to_numpy(zero_copy_only=False), np.int64))
    top = int(length.max()) if m else 0
    # Bytes of turn d of conversation c at offset[c] + d (0 for the root), flat; ``below`` sums them from a depth on.
    offset = np.concatenate([[0], np.cumsum(length + 1)])
    size = np.zeros(int(offset[-1]), np.int64)
    turn_of = {}
    k1, k2 = (table.column(c).to_pylist() for c in ("k1", "k2"))
    nbytes = table.column("bytes").to_pylist()
    for i in range(len(ids)):
        if pos[i] > 0:
            size[offset[local[i]] + pos[i]] = nbytes[i]
            turn_of[int(local[i]), int(pos[i])] = (k1[i], k2[i])
    before = np.concatenate([[0], np.cumsum(size)])

    def below(who, depth):
        """Bytes of the turns of conversations ``who`` from ``depth`` (an array or a number) on."""
        start = offset[who] + np.minimum(depth, length[who] + 1)
        return int((before[offset[who] + length[who] + 1] - before[start]).sum())

    own = np.full(m, top + 1, np.int64)
    rep = np.zeros(m, np.int64)
    facts = table.column("first_own").to_pylist(), table.column("leaf_rep").to_pylist()
    for i in range(len(ids)):
        if facts[0][i] is not None:
            own[local[i]] = min(facts[0][i], top + 1)
        if facts[1][i]:
            rep[local[i]] = 1

    def bits(members) -> np.ndarray:
        out = np.zeros(words * 64, np.uint8)
        out[members] = 1
        return np.packbits(out, bitorder="little").view(np.uint64)

    postings: dict[tuple[int, int, int], np.ndarray] = {}
    for (c, d), key in turn_of.items():
        cell = postings.setdefault((d, *key), np.zeros(words, np.uint64))
        cell[c >> 6] |= np.uint64(1) << np.uint64(c & 63)
    ends = {int(d): bits(np.flatnonzero(length == d)) for d in np.unique(length)}
    out = {k: [] for k in ("depth", "key_hi", "key_lo", "parent_hi", "parent_lo", "n", "least", "last_bytes", "below", "below_own", "leaf_reps", "ends")}
    stack = [(0, ROOT, None, bits(np.arange(m)))]
    while stack:
        depth, key, parent, members = stack.pop()
        who = np.flatnonzero(np.unpackbits(members.view(np.uint8), bitorder="little")[:m])
        ending = members & ends[depth] if depth in ends else None
        out["depth"].append(depth)
        out["key_hi"].append(key[0])
        out["key_lo"].append(key[1])
        out["parent_hi"].append(None if parent is None else parent[0])
        out["parent_lo"].append(None if parent is None else parent[1])
        out["n"].append(int(np.bitwise_count(members).sum()))
        out["least"].append(int(convs[who[0]]))
        out["last_bytes"].append(int(size[offset[who[0]] + depth]))
        out["below"].append(below(who, depth))
        out["below_own"].append(below(who, np.maximum(own[who], depth)))
        out["leaf_reps"].append(int(rep[who].sum()))
        out["ends"].append([] if ending is None else convs[np.flatnonzero(np.unpackbits(ending.view(np.uint8), bitorder="little")[:m])].tolist())
        going = who[length[who] > depth]
        for turn in sorted({turn_of[int(c), depth + 1] for c in going}):
            child = members & postings[(depth + 1, *turn)]
            stack.append((depth + 1, _chain(key, turn), key, child))
    return out


def _walk_shards(rows: DataFrame) -> DataFrame:
    import pyarrow as pa

    schema = pa.schema(
        [(n, pa.int64()) for n in ("depth", "key_hi", "key_lo", "parent_hi", "parent_lo", "n", "least", "last_bytes", "below", "below_own", "leaf_reps")]
        + [("ends", pa.list_(pa.int64()))]
    )

    def run(table):
        return pa.Table.from_pydict(walk(table), schema=schema)

    return rows.groupBy("shard").applyInArrow(run, NODE_SCHEMA)


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations (see ``rebuilt``).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of the subtree, itself included), ``saved_tokens`` (over the subtree, each node's
    ``n_convs - 1`` times the UTF-8 bytes of its last text; the root has none), ``ends_sha256`` (SHA-256 of the
    comma-joined ascending ids of members of the node's own length; of the empty string without any). Turnless
    conversations are members of the root only. Repeated rows are turns of their own. Empty table: no rows.
    """
    turns, ids = rebuilt(conversations)
    spark = conversations.sparkSession
    turns = turns.select("conv_id", "position", F.xxhash64(F.lit(1), "role", "text").alias("k1"), F.xxhash64(F.lit(2), "role", "text").alias("k2"), "bytes")
    lengths = turns.groupBy("conv_id").agg(F.max("position").alias("length"))
    n_rows = turns.count()
    shards = max(1, -(-n_rows // SHARD_ROWS))
    # A turnless conversation is one row of position 0, so that it is a member of the root.
    rows = ids.join(lengths, "conv_id", "left").select("conv_id", F.coalesce("length", F.lit(0)).alias("length"))
    rows = rows.join(turns, "conv_id", "left").select(
        "conv_id", "length", F.coalesce("position", F.lit(0)).alias("position"), "k1", "k2", F.coalesce("bytes", F.lit(0)).alias("bytes"),
        F.pmod(F.xxhash64("conv_id"), F.lit(shards)).alias("shard"),
    )
    key = ["key_hi", "key_lo"]
    blank = rows.select("*", F.lit(None).cast("long").alias("first_own"), F.lit(None).cast("boolean").alias("leaf_rep"))
    first = saved(_walk_shards(blank), "trie")  # read three times below
    nodes = first.groupBy(key).agg(
        F.min("least").alias("conv_id"), F.sum("n").alias("n_convs"), F.first("depth").alias("depth"),
        F.first("parent_hi").alias("parent_hi"), F.first("parent_lo").alias("parent_lo"), F.first("last_bytes").alias("last_bytes"),
        F.sum("below").alias("below"),
    )
    children = nodes.where("parent_hi IS NOT NULL").groupBy(F.col("parent_hi").alias("key_hi"), F.col("parent_lo").alias("key_lo")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # Facts per conversation: the depth from which it is the smallest member, and whether it stands for a childless end.
    mins = nodes.select(*key, F.col("conv_id").alias("global_least"), "n_children")
    firsts = first.join(mins, key).where("least = global_least").groupBy(F.col("least").alias("conv_id")).agg(F.min("depth").alias("first_own"))
    ends = first.select(*key, F.explode("ends").alias("conv_id"))
    reps = ends.join(mins, key).select("conv_id", ((F.col("conv_id") == F.col("global_least")) & (F.col("n_children") == 0)).alias("leaf_rep"))
    facts = firsts.join(reps, "conv_id", "full")
    second = _walk_shards(rows.join(facts, "conv_id", "left"))
    sums = second.groupBy(key).agg(F.sum("below_own").alias("below_own"), F.sum("leaf_reps").alias("n_leaves"))
    digests = _end_digests(ends)
    parents = nodes.select(F.col("key_hi").alias("parent_hi"), F.col("key_lo").alias("parent_lo"), F.col("conv_id").alias("parent_conv_id"))
    got = nodes.join(sums, key).join(digests, key, "left").join(parents, ["parent_hi", "parent_lo"], "left")
    return got.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n_convs").cast("long").alias("n_convs"),
        F.col("n_children").cast("long").alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"),
        (F.col("below") - F.col("below_own")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    """``key_hi, key_lo, ends_sha256`` of nodes with ends: ids sorted within partitions and hashed as they stream by."""
    import pyarrow as pa

    schema = pa.schema([("key_hi", pa.int64()), ("key_lo", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches):
        now, digest, first = None, None, True
        out = {"key_hi": [], "key_lo": [], "ends_sha256": []}
        for batch in batches:
            for hi, lo, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (hi, lo) != now:
                    if now is not None:
                        out["key_hi"].append(now[0])
                        out["key_lo"].append(now[1])
                        out["ends_sha256"].append(digest.hexdigest())
                    now, digest, first = (hi, lo), hashlib.sha256(), True
                digest.update(f"{'' if first else ','}{conv}".encode())
                first = False
            if len(out["key_hi"]) >= 4096:
                yield pa.RecordBatch.from_pydict(out, schema=schema)
                out = {k: [] for k in out}
        if now is not None:
            out["key_hi"].append(now[0])
            out["key_lo"].append(now[1])
            out["ends_sha256"].append(digest.hexdigest())
        yield pa.RecordBatch.from_pydict(out, schema=schema)

    ordered = ends.repartition("key_hi", "key_lo").sortWithinPartitions("key_hi", "key_lo", "conv_id")
    return ordered.select("key_hi", "key_lo", "conv_id").mapInArrow(run, "key_hi long, key_lo long, ends_sha256 string")
