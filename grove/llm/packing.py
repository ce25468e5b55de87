"""Packing tokenized documents into windows of fixed size: best fit, longest piece first.

Documents longer than a window are first cut into full windows; what remains of each is packed whole. In a group of
some 20,000 pieces a segment tree over remaining capacity finds the open window that a piece leaves
fullest. Groups are drawn by a hash of the row, so each is a fair sample of lengths and is packed on its own; their number
grows with the input, and each has at most one badly filled window at its end.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grove.llm.common import pick, saved, utf8, worker_state

GROUP = 20_000  # pieces that are packed together
WORDS = 900_000  # words whose ids a task remembers


class WindowTree:
    """Segment tree that counts open windows by the room they have left."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        i = self.leaves + room
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._add(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least room of ``need`` or more: ``(room, window)``."""
        i = self.leaves + need
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """``(window number, offset)`` of each piece; no length exceeds ``window``."""
    tree, out, made = WindowTree(window), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        if need < window and (found := tree.tightest(need)):
            room, number = found
        else:
            room, number, made = window, made, made + 1
        out[i] = number, window - room
        if room > need:
            tree.put(room - need, number)
    return out


def _kinds() -> bytes:
    """A table of bytes by kind: a letter a-z or digit, a mark, a blank, the lead byte of Latin-1 letters, a continuation, others."""
    table = bytearray(b"x" * 256)
    for chars, kind in ((b"abcdefghijklmnopqrstuvwxyz0123456789", "a"), (b".,", "."), (b" ", " "), (b"\xc3", "c"), (bytes(range(0x80, 0xC0)), "b")):
        for c in chars:
            table[c] = ord(kind)
    table[0x97] = table[0xB7] = ord("x")  # the two signs among the Latin-1 letters
    return bytes(table)


KINDS = _kinds()
# Marks before a blank that may belong to what is before them: not after a letter or digit that we know.
ODD = (b"x. ", b".. ", b"xb. ", b"bb. ")


def units(text: bytes) -> list[bytes]:
    """A text cut at white space, and before a comma or full stop between a word and a blank; A-Z in lower case.

    The tokenizer does both itself, so the ids stay the same, but fewer words differ. Texts that may hold a special token, or have marks in
    other places, are cut at white space only.
    """
    if b"<|" not in text:
        text = text.lower()
        kinds = text.translate(KINDS)
        if not any(odd in kinds for odd in ODD):
            text = text.replace(b". ", b" . ").replace(b", ", b" , ")
    return text.split()


class WordTokenizer:
    """Ids of texts by a tokenizer that drops white space, so that every word stands alone and equal words share a result.

    Words of letters with commas or full stops behind them share their letters' ids, which such a tokenizer
    parts from the marks and puts in lower case itself.
    """

    def __init__(self, content: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.ids: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.suffix = json.loads(content)["model"].get("end_of_word_suffix")
        self.ends = bytearray(max(vocabulary.values()) + 1)  # ids that end a word
        for piece, i in vocabulary.items():
            self.ends[i] = bool(self.suffix) and piece.endswith(self.suffix)

    def learn(self, words: set[bytes]) -> None:
        """Add the ids of words that ``self.ids`` lacks."""
        import numpy as np

        known = self.ids
        cores, others, parts = {}, {}, []
        for word in words:
            if word.isalpha() and word.islower():  # a-z only
                cores[word] = None
                continue
            text = word.decode()
            core = text.rstrip(".,")
            low = core.lower()
            if low.isalpha() and "\u03a3" not in core:  # capital sigma: its small form depends on its place
                tail = text[len(core) :]
                parts.append((word, low.encode(), tail))
                cores[low.encode()] = None
                if tail:
                    others[tail] = None
            else:
                others[text] = None
        cores = [w for w in cores if w not in known]
        if self.suffix and cores:
            # Words of letters are one unit each, so one text of them all can be cut at the ids that end a unit.
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(cores).decode()], add_special_tokens=False)[0].ids, "<u4")
            cut = 4 * (np.flatnonzero(np.frombuffer(self.ends, np.uint8)[ids]) + 1)
            if len(cut) == len(cores):
                packed, low = ids.tobytes(), 0
                for core, high in zip(cores, cut.tolist()):
                    known[core] = packed[low:high]
                    low = high
                cores = []
        rest = [w for w in [*(c.decode() for c in cores), *others] if w.encode() not in known]
        for word, x in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            known[word.encode()] = np.array(x.ids, "<u4").tobytes()
        for word, core, tail in parts:
            known[word] = known[core] + (known[tail.encode()] if tail else b"")

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.ids) > WORDS:
            self.ids.clear()
        get = self.ids.get
        split = [units(t) for t in texts]
        parts = [list(map(get, words)) for words in split]
        lacking = []
        for words, found in zip(split, parts):
            at = -1
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                lacking.append((words[at], found, at))
        self.learn({word for word, _, _ in lacking})
        for word, found, at in lacking:
            found[at] = get(word)
        return [b"".join(p) for p in parts]


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = 4096, with_ids: bool = True) -> DataFrame:
    """Tokenize whole texts, append ``end_id`` and cut into pieces of at most ``window`` ids.

    ``tokenizer`` is the content of a tokenizer file whose pre-tokenizer drops white space. Returns
    ``doc_id, start, length, ids_crc32, doc_tokens`` and, on demand, ``ids`` (little-endian 32-bit). A
    null or empty text has the end id alone. Repeated rows give repeated pieces.
    """
    docs = pick(docs, "doc_id", "text")
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)
    key = hashlib.sha256(tokenizer.encode()).hexdigest()

    def cut(batches):
        import zlib

        import pyarrow as pa

        words, end = worker_state("words", key, lambda: WordTokenizer(content.value)), end_id.to_bytes(4, "little")
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows: list[tuple] = []
                for i, ids in enumerate(words.encode(utf8(part.column(1)))):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        rows.append((i, start, len(piece) // 4, zlib.crc32(piece), n, piece if with_ids else None))
                at, start, length, crc, n, pieces = zip(*rows)
                out = {"doc_id": part.column(0).take(pa.array(at))}
                out |= {k: pa.array(v, pa.int64()) for k, v in (("start", start), ("length", length), ("ids_crc32", crc), ("doc_tokens", n))}
                yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(pieces, pa.binary())} if with_ids else {}))

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.mapInArrow(cut, schema)


def pack(pieces: DataFrame, window: int = 4096) -> DataFrame:
    """Place every piece of ``token_pieces`` in a window: its columns plus ``sequence_id, offset``."""
    kept = saved(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(kept.count() / GROUP))

    def place(key, table):
        import pyarrow as pa

        table = table.sort_by("row")
        placed = best_fit_decreasing(table["length"].to_pylist(), window)
        base = key[0].as_py() << 32
        table = table.drop_columns(["row", "pack_group"])
        table = table.append_column("sequence_id", pa.array([base + p[0] for p in placed], pa.int64()))
        return table.append_column("offset", pa.array([p[1] for p in placed], pa.int64()))

    grouped = kept.withColumn("pack_group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    types = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return grouped.groupBy("pack_group").applyInArrow(place, f"{types}, sequence_id long, offset long")


def sequences(packed: DataFrame, pad_id: int, window: int = 4096) -> DataFrame:
    """The windows themselves: ``sequence_id, n_tokens, ids`` (array of int, padded to ``window`` unless its length is a power of two)."""

    def fill(key, table):
        import numpy as np
        import pyarrow as pa

        ids = np.frombuffer(b"".join(table.sort_by("offset")["ids"].to_pylist()), "<u4")
        n = len(ids)
        if n & (n - 1):
            ids = np.concatenate([ids, np.full(window - n, pad_id, "<u4")])
        return pa.table({"sequence_id": pa.array([key[0].as_py()]), "n_tokens": pa.array([n], pa.int64()), "ids": pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(fill, "sequence_id long, n_tokens long, ids array<int>")
