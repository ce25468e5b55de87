"""Exact encoding and decoding with a SentencePiece BPE model by backtracking over longest matches.

A sequence of pieces is what merging would give exactly if every piece merges back to itself and
every two neighbours, merged anew from their characters, come out as the same two pieces. So a
segment is covered from the left by the longest piece that an Aho-Corasick pass found at a position;
where no piece fits its left neighbour, the last piece is shortened, and the position is marked as
failed for good, as the pieces up to a position are unique.

Texts are first cut where no piece can reach across: before a word mark that doesn't follow another
one, and around line ends when the model has no piece with them. Equal segments share one result. Segments that hold a
piece whose score isn't unique (runs of blanks) are merged directly, since ties go by position.
"""

from __future__ import annotations

import hashlib
import heapq
import re

from pyspark.sql import DataFrame

from grove.llm.common import pick, utf8, worker_state

MARK = "▁"
CACHE = 300_000  # segments or pairs that a task remembers


class PieceCodec:
    """Encoder and decoder over the pieces of a model; ``model`` is the content of the model file."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i in range(n) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        skip = {*self.byte_of, *self.silent, self.unknown} | {i for i in range(n) if sp.is_unused(i)}
        self.score = {self.pieces[i]: sp.get_score(i) for i in range(n) if i not in skip}
        self.id = {self.pieces[i]: i for i in range(n) if i not in skip}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("the model has pieces that reach over word marks")
        self.chars = {c for p in self.id for c in p}
        seen: dict[float, int] = {}
        for s in self.score.values():
            seen[s] = seen.get(s, 0) + 1
        # single characters need no merge, so their scores don't matter
        tied = [p for p, s in self.score.items() if seen[s] > 1 and len(p) > 1]
        self.tied = [p for p in tied if not any(q in p for q in tied if q != p)]
        self.decimal = [str(i) for i in range(n)]
        self.plain = [p.replace(MARK, " ") if p in self.id else None for p in self.pieces]
        line = "" if any("\n" in p for p in self.id) else "\n"
        self.segments = re.compile(f"{MARK}*[^{MARK}{line}]+|{MARK}+" + ("|\n" if line else "")).findall
        self.found = ahocorasick.Automaton()
        for p, i in self.id.items():
            if self.merged(p) == [i]:
                self.found.add_word(p, i)
        self.found.make_automaton()
        self.length = [len(p) for p in self.pieces]
        self.shorter = [-1] * n  # the longest piece that a piece begins with
        for p, i in self.id.items():
            self.shorter[i] = next((self.id[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.found), -1)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, bytes, str]] = {}
        self.older: dict[str, tuple[int, bytes, str]] = {}

    def merged(self, text: str) -> list[int]:
        """Pieces of ``text`` by merging: the best score first, then the leftmost."""
        part: list[str | None] = list(text)
        n = len(part)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int, j: int) -> None:
            s = self.score.get(part[i] + part[j])
            if s is not None:
                heapq.heappush(heap, (-s, i, j, part[i] + part[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if part[i] is None or part[j] is None or after[i] != j or part[i] + part[j] != both:
                continue
            part[i], part[j] = both, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        out: list[int] = []
        for p in part:
            if p is not None:
                out += [self.id[p]] if p in self.id else [self.byte_ids[b] for b in p.encode()] if self.byte_ids else [self.unknown]
        return out

    def fits(self, left: int, right: int) -> bool:
        """Whether the two pieces, merged anew, stay the same two pieces."""
        pair = left, right
        if pair not in self.pairs:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            self.pairs[pair] = self.merged(self.pieces[left] + self.pieces[right]) == [left, right]
        return self.pairs[pair]

    def cover(self, text: str) -> list[int]:
        """Pieces of a text whose characters the model all has.

        One pass of longest matches goes along as long as each is taken; after a shorter piece it starts anew there.
        """
        for some in self.tied:
            if some in text:
                return self.merged(text)
        n, pairs, shorter, length = len(text), self.pairs, self.shorter, self.length
        failed = bytearray(n + 1)
        ids: list[int] = []
        path: list[int] = []  # where each piece starts
        matches, pos, left = self.found.iter_long(text), 0, -1
        piece = next(matches)[1]
        while True:
            taken = piece
            while piece >= 0:
                if not failed[pos + length[piece]]:
                    if left < 0:
                        break
                    fits = pairs.get((left, piece))
                    if fits or fits is None and self.fits(left, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                ids.append(piece)
                path.append(pos)
                pos, left = pos + length[piece], piece
                if pos == n:
                    return ids
                if piece != taken or matches is None:
                    matches = self.found.iter_long(text, pos)
                piece = next(matches)[1]
            else:
                failed[pos] = 1
                if not path:
                    return self.merged(text)
                pos, piece, matches = path.pop(), shorter[ids.pop()], None
                left = ids[-1] if ids else -1

    def segment(self, text: str) -> list[int]:
        if self.chars.issuperset(text):
            return self.cover(text)
        out: list[int] = []
        run: list[str] = []
        for c in text:
            if c in self.chars:
                run.append(c)
                continue
            if run:
                out += self.cover("".join(run))
                run = []
            out += [self.byte_ids[b] for b in c.encode()] if self.byte_ids else [self.unknown]
        return out + self.cover("".join(run)) if run else out

    def cut(self, text: str) -> list[str]:
        return self.segments(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for s in self.cut(text) for i in self.segment(s)]

    def raw_text(self, ids: list[int]) -> str:
        """Text of ``ids`` with the leading blank still there."""
        try:
            return "".join([self.plain[i] for i in ids])
        except TypeError:  # there are bytes or special ids
            pass
        out: list[str] = []
        run = bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            if i is not None and i not in self.silent:
                out.append(" ⁇ " if i == self.unknown else self.pieces[i].replace(MARK, " "))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.raw_text(ids)
        return text[1:] if text.startswith(" ") else text

    def both(self, text: str) -> tuple[int, bytes, str]:
        """Number of ids, the ids as decimals joined by commas, and the decoded text."""
        known, decimal, found = self.known, self.decimal, []
        for s in self.cut(text):
            hit = known.get(s)
            if hit is None:
                if len(known) >= CACHE:
                    self.older, known = known, {}
                    self.known = known
                hit = self.older.get(s)
                if hit is None:
                    ids = self.segment(s)
                    hit = len(ids), ",".join([decimal[i] for i in ids]).encode(), self.raw_text(ids)
                known[s] = hit
            found.append(hit)
        back = "".join([x[2] for x in found])
        return sum([x[0] for x in found]), b",".join([x[1] for x in found]), back[1:] if back.startswith(" ") else back


def encode_texts(docs: DataFrame, model: bytes) -> DataFrame:
    """Ids and decoded text of every whole text: ``doc_id, n_tokens, ids, decoded``.

    ``ids`` are decimals joined by commas, so very long texts need no array of boxed numbers. A null
    or empty text has no ids and decodes to the empty text. Rows stay as they are, repeated ones too.
    The model's content travels as a broadcast (its size is that of the vocabulary file).
    """
    docs = pick(docs, "doc_id", "text")
    content = docs.sparkSession.sparkContext.broadcast(model)
    key = hashlib.sha256(model).hexdigest()

    def encode(batches):
        import pyarrow as pa

        codec = worker_state("pieces", key, lambda: PieceCodec(content.value))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                n, ids, back = zip(*(codec.both(t.decode()) for t in utf8(part.column(1))))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column(0), "n_tokens": pa.array(n, pa.int64()), "ids": pa.array(ids, pa.binary()).cast(pa.string()), "decoded": pa.array(back, pa.string())}
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(encode, f"doc_id {kind}, n_tokens long, ids string, decoded string")
