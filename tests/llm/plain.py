"""Plain row-by-row versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash

SPACES = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def votes(hashes: list[int], weights=None) -> int:
    total = len(hashes)
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > total)


def shingle_print(text: str | None, k: int = 4) -> int:
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return 0
    runs = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    return votes([xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs])


def pair_print(text: str | None) -> int:
    words = WORD.findall((text or "").lower())
    return votes([xxhash.xxh64_intdigest(b.encode(), seed=xxhash.xxh64_intdigest(a.encode(), seed=42)) for a, b in zip(words, [*words[1:], ""])])


def groups(prints: list[int], radius: int) -> list[int]:
    """For each print the index of the first one in reach."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def dedup_lines(docs: list[tuple[int, str | None]], min_chars: int = 40, min_docs: int = 5) -> dict[int, tuple[str, int, int]]:
    key = lambda line: line.strip(SPACES).translate(UPPER)
    holders: dict[str, set[int]] = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, text in docs:
        rows = (text or "").split("\n")
        kept = [r for r in rows if len(holders.get(key(r), ())) < min_docs or max(holders[key(r)]) == i]
        out[i] = "\n".join(kept), len(rows), len(rows) - len(kept)
    return out


def repeat_words(text: str, window: int = 8) -> int:
    words = WORD.findall(text)
    spans = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    often = Counter(spans)
    return len({k for i, s in enumerate(spans) if often[s] > 1 for k in range(i, i + window)})


def trie(rows) -> list[tuple]:
    """op11 on ``(conv_id, turn, role, text)`` rows: one tuple per node, in the query's column order."""
    import zlib

    convs: dict[int, list] = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t, r or "", x or ""))
    turns = {c: [(r, x) for t, r, x in sorted(v, key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2]))] for c, v in convs.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = turns.get(c - int(math.fmod(c, 5)), [])  # truncating remainder, as in SQL
        built[c] = base[:h] + turns[c][h:]
    nodes: dict[tuple, list] = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        sub = [q for q in nodes if q[: len(p)] == p]
        kids = [q for q in sub if len(q) == len(p) + 1]
        leaves = sum(1 for q in sub if not any(len(z) == len(q) + 1 and z[: len(q)] == q for z in sub))
        saved = sum((len(nodes[q]) - 1) * (len(q[-1][1].encode()) if q else 0) for q in sub)
        ends = ",".join(str(c) for c in sorted(c for c in members if len(built[c]) == len(p)))
        parent = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), parent, len(members), len(kids), leaves, saved, sha(ends)))
    return sorted(out, key=repr)


def damage(rows) -> dict:
    """op12's damage of ``(conv_id, turn, role, text)`` rows: conv_id -> rows (turn, role, text, copy)."""
    import zlib

    out: dict = {}
    for c, t, r, x in rows:
        out.setdefault(c, [])
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = (" " if r is None else r), (" " if x is None else x)
        if hit == 0:
            continue
        r = "user" if hit == 4 else r
        x = "" if hit == 1 else re.sub(r"[.!?]", "", x) if hit == 2 else x
        out[c] += [(t, r, x, k) for k in range(2 if hit == 3 else 1)]
    return out


def faults(rows) -> list[str | None]:
    seen, got = set(), []
    for _, r, x, _ in rows:
        if not x.strip(SPACES):
            got.append("blank")
        elif (r, x) in seen:
            got.append("duplicate")
        elif x.rstrip(SPACES)[-1] not in ".!?":
            got.append("truncated")
        else:
            got.append(None)
        seen.add((r, x))
    return got


def cheapest_repair(roles, texts, marks):
    """Uniform-cost search over (cost, audit) on the edit lattice; the first end reached is the answer."""
    import heapq

    from grove.llm import repair

    n, heap = len(roles), [(0, "", 0, repair.START, ())]
    while heap:
        cost, audit, i, state, kept = heapq.heappop(heap)
        if state is None:
            return cost, audit[:-1], list(kept)
        for c, initial, nxt, role in repair.arcs(roles, marks, (i, state)):
            if nxt is None:
                heapq.heappush(heap, (cost, audit + "\x00", n + 1, None, kept))
            elif not (initial == "I" and audit.count("I") >= 4):
                row = kept if role is None else kept + ((role, "" if initial == "I" else texts[i]),)
                heapq.heappush(heap, (cost + c, audit + initial, nxt[0], nxt[1], row))


def audits(rows) -> list[tuple]:
    """op12 on ``(conv_id, turn, role, text)`` rows, by brute force."""
    out = []
    for c, got in damage(rows).items():
        got.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2], z[3]))
        marks = faults(got)
        turns = {t for t, *_ in got if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[:1] for _, r, _, _ in got]
        illegal = sum(1 for a, b in zip(initials, initials[1:]) if a + b not in ("su", "ua", "au"))
        cost, audit, kept = cheapest_repair([r for _, r, _, _ in got], [x for _, _, x, _ in got], marks)
        counts = [marks.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((c, gaps, *counts, illegal, cost, audit, sha("\n".join(f"{r}:{x}" for r, x in kept))))
    return sorted(out, key=repr)


def jaccard(docs, percent: int = 90) -> dict:
    """op13 on ``(doc_id, text)``: doc_id -> (n_shingles, component_id, n_links), all pairs compared."""
    sets = {}
    for d, t in docs:
        if d is not None and d not in sets:
            w = WORD.findall((t or "").translate(UPPER))
            sets[d] = {" ".join(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({" ".join(w)} if w else set())
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = dict.fromkeys(ids, 0)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d), links[d]) for d in ids}
