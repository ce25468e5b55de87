"""Conversation structure repair: the cheapest edits that give a legal role sequence, by the auction shortest-path method.

Faults are found with Spark expressions over each conversation's rows in order. Each conversation is then a lattice of
``(row, state)`` nodes: the state is where the role initials so far stand in ``(s?(ua)+)?``. Every row is kept, rerolled or
deleted, and empty user or assistant turns may be inserted anywhere; each arc costs a whole number. The auction algorithm
(path extension and contraction under node prices) is run from every node towards the end, so the converged prices are
the exact distances to the end; arcs whose cost equals the fall in price are tight, and tracing tight arcs with the least
edit initial first gives the ASCII-least audit among the cheapest repairs.

The lattice of one conversation is small (rows times four states); conversations are streamed one after another through
each task after a shuffle by ``conv_id``, so a task holds one conversation at a time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grove.llm.common import pick

# Fixed values of the contract: edit costs, fault marks, and the legal role pattern (s?(ua)+)?.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ENDS = ".!?"
BLANK_FAULT, DUPLICATE_FAULT, TRUNCATED_FAULT = "blank", "duplicate", "truncated"
# States of the pattern: nothing yet, after s, after u, after a; the end is reached from nothing yet or after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
FINAL = (START, AFTER_A)
NAMES = {"u": "user", "a": "assistant"}
NOT_SPACE = r"[^\x20\x09-\x0D]"
LEGAL_PAIRS = ("su", "ua", "au")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of ``conv_id, turn, role, text`` after damage, with ``conv_id, turn, role, text, copy``.

    Null role or text is one space. ``crc32`` of ``conv_id:turn`` (decimal; a null id or turn is one space there) modulo 20
    picks: 0 drops the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it (same turn, ``copy`` 1),
    4 sets its role to user; other rows stay.
    """
    rows = pick(rows, "conv_id", "turn", "role", "text")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hit = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    out = rows.select(
        "conv_id", "turn", hit.alias("hit"),
        F.when(hit == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text).alias("text"),
    )
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return out.where("hit <> 0").select("conv_id", "turn", "role", "text", copies.alias("copy"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Damaged rows with ``position`` (order by turn, nulls first, then role, text and copy) and their first ``fault``.

    Blank: no character outside white space; duplicate: role and text equal to an earlier row's; truncated: the last
    character outside white space is none of ``.!?``. Rows of one conversation meet in one window partition.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "copy")
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy")
    last = F.regexp_extract("text", rf"({NOT_SPACE})[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.col("text").rlike(NOT_SPACE), F.lit(BLANK_FAULT))
        .when(F.row_number().over(same) > 1, F.lit(DUPLICATE_FAULT))
        .when(~last.isin(*ENDS), F.lit(TRUNCATED_FAULT))
    )
    return rows.select("conv_id", "turn", "role", "text", F.row_number().over(order).alias("position"), fault.alias("fault"))


def arcs(roles: list[str], faults: list[str | None], node: tuple[int, int]):
    """The arcs ``(cost, initial, next node, row role or None)`` out of ``(row, state)``; the end is ``None``."""
    i, state = node
    out = []
    for x in ("u", "a"):  # an empty turn inserted before row i
        if (state, x) in STEP:
            out.append((INSERT, "I", (i, STEP[state, x]), NAMES[x]))
    if i == len(roles):
        if state in FINAL:
            out.append((0, "", None, None))
        return out
    out.append((DELETE, "D", (i + 1, state), None))
    if faults[i] in (BLANK_FAULT, DUPLICATE_FAULT):
        return out
    extra = TRUNCATED if faults[i] == TRUNCATED_FAULT else 0
    own = roles[i][:1]
    if (state, own) in STEP:
        out.append((KEEP + extra, "K", (i + 1, STEP[state, own]), roles[i]))
    for x in ("u", "a"):
        if roles[i] != NAMES[x] and (state, x) in STEP:
            out.append((REROLE + extra, "R", (i + 1, STEP[state, x]), NAMES[x]))
    return out


def auction_prices(roles: list[str], faults: list[str | None]) -> dict:
    """Prices of all lattice nodes that equal their cheapest cost to the end (``None``, price 0).

    The auction algorithm for one origin keeps a path from the origin and prices ``p`` with ``p[i] <= cost + p[j]`` on
    every arc and equality on the path's arcs. At the path's last node ``i``: if ``p[i]`` is below the cheapest
    ``cost + p[j]``, the price rises to it and ``i`` leaves the path (contraction; the origin stays), else the path extends
    to that ``j``. Reaching the end makes the path a cheapest one and the origin's price exact. Running it from every node
    with the same prices, last rows first, makes every price exact; prices only rise and never pass the true cost.
    """
    n = len(roles)
    nodes = [(i, s) for i in range(n, -1, -1) for s in (AFTER_A, AFTER_U, AFTER_S, START)]
    out = {node: arcs(roles, faults, node) for node in nodes}
    price = dict.fromkeys(nodes, 0)
    price[None] = 0
    for origin in nodes:
        path = [origin]
        while path and path[-1] is not None:
            i = path[-1]
            if not out[i]:  # no way on: the node can't reach the end
                price[i] = float("inf")
                path.pop()
                if not path:
                    break
                continue
            best = min(out[i], key=lambda a: a[0] + price[a[2]])
            bid = best[0] + price[best[2]]
            if price[i] < bid:
                price[i] = bid
                if len(path) > 1:
                    path.pop()
            else:
                path.append(best[2])
    return price


def repair(roles: list[str], texts: list[str], faults: list[str | None]) -> tuple[int, str, list[tuple[str, str]]]:
    """``cost, audit, repaired rows (role, text)`` of one conversation's rows in order.

    The audit has one initial per edit: K keep, R rerole, D delete, I insert. Among all cheapest repairs, the ASCII-least
    audit is traced over tight arcs, a set of nodes at a time (the end counts as the least initial). The audit fixes the
    repair: an s can only come from a kept system row, and the other initials alternate u, a.
    """
    price = auction_prices(roles, faults)
    start = (0, START)
    frontier = {start: None}  # node -> repaired rows so far, as a chain of (row, rest) cells
    audit = []
    while True:
        ends = [node for node in sorted(frontier) if any(a[2] is None and a[0] == price[node] for a in arcs(roles, faults, node))]
        if ends:
            chain, rows = frontier[ends[0]], []
            while chain is not None:
                rows.append(chain[0])
                chain = chain[1]
            return int(price[start]), "".join(audit), rows[::-1]
        tight = [
            (a[1], a[2], kept if a[3] is None else ((a[3], "" if a[1] == "I" else texts[node[0]]), kept))
            for node, kept in sorted(frontier.items(), key=lambda x: x[0])
            for a in arcs(roles, faults, node)
            if a[2] is not None and a[0] + price[a[2]] == price[node]
        ]
        least = min(t[0] for t in tight)
        audit.append(least)
        frontier = {}
        for initial, node, kept in tight:
            if initial == least and node not in frontier:
                frontier[node] = kept


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, cost, audit, repaired_sha256`` for every conversation of faulted rows (``with_faults``).

    Rows are shuffled by ``conv_id`` and sorted within partitions; each Arrow batch is cut at conversation ends, so one
    conversation is repaired at a time and memory holds one conversation and one batch.
    """
    import pyarrow as pa

    schema = "conv_id long, cost long, audit string, repaired_sha256 string"

    def run(batches):
        held = None

        def solve(table):
            out = {"conv_id": [], "cost": [], "audit": [], "repaired_sha256": []}
            ids = table.column("conv_id").to_pylist()
            roles, texts, faults = (table.column(c).to_pylist() for c in ("role", "text", "fault"))
            start = 0
            for end in range(1, len(ids) + 1):
                if end == len(ids) or ids[end] != ids[start]:
                    cost, audit, kept = repair(roles[start:end], texts[start:end], faults[start:end])
                    text = "\n".join(f"{r}:{t}" for r, t in kept)
                    out["conv_id"].append(ids[start])
                    out["cost"].append(cost)
                    out["audit"].append(audit)
                    out["repaired_sha256"].append(hashlib.sha256(text.encode("utf-8")).hexdigest())
                    start = end
            return pa.RecordBatch.from_pydict(out, schema=pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]))

        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if table.num_rows == 0:
                continue
            ids = table.column("conv_id")
            last = ids[table.num_rows - 1].as_py()
            cut = table.num_rows
            while cut > 0 and ids[cut - 1].as_py() == last:
                cut -= 1
            if cut:
                yield solve(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held)

    ordered = rows.select("conv_id", "position", "role", "text", "fault").repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(run, schema)


def _initial(c: Column) -> Column:
    return F.substring(c, 1, 1)


def audit_conversations(rows: DataFrame) -> DataFrame:
    """Per original ``conv_id`` of ``conv_id, turn, role, text``: counts of the damaged rows and their cheapest repair.

    ``gaps`` (turns missing between the least and largest, nulls ignored; 0 without turns), ``blank``, ``duplicate``,
    ``truncated`` (rows by first fault), ``illegal`` (adjacent role initials other than su, ua, au), ``cost``, ``audit``,
    ``repaired_sha256``. A conversation with no row left after damage has zeros, an empty audit and the empty string's
    hash. Rows of a null ``conv_id`` are one conversation. Empty table: no rows.
    """
    rows = pick(rows, "conv_id", "turn", "role", "text")
    faulted = with_faults(damaged(rows))
    order = Window.partitionBy("conv_id").orderBy("position")
    pair = F.concat(_initial(F.lag("role").over(order)), _initial(F.col("role")))
    marked = faulted.withColumn("bad_pair", (F.lag("role").over(order).isNotNull() & ~pair.isin(*LEGAL_PAIRS)).cast("long"))
    counts = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count(F.when(F.col("fault") == f, 1)).cast("long").alias(f) for f in (BLANK_FAULT, DUPLICATE_FAULT, TRUNCATED_FAULT)],
        F.sum("bad_pair").cast("long").alias("illegal"),
    )
    fixed = repaired_conversations(faulted)
    ids = rows.select("conv_id").distinct()
    got = ids.join(counts, ids["conv_id"].eqNullSafe(counts["conv_id"]), "left").drop(counts["conv_id"])
    got = got.join(fixed, got["conv_id"].eqNullSafe(fixed["conv_id"]), "left").drop(fixed["conv_id"])
    empty = hashlib.sha256(b"").hexdigest()
    return got.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", BLANK_FAULT, DUPLICATE_FAULT, TRUNCATED_FAULT, "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
