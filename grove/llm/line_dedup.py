"""Lines that repeat over many documents: two Bloom filters name the suspects, a shuffle of only those decides.

Every task notes the hashes of its lines in two Bloom filters, for hashes seen once and seen twice.
Merging two tasks' filters, whatever stands in both "once" filters moves to "twice"; the merged
"twice" filter therefore holds every key of two or more documents (and a few others). A second pass
sends only keys found there through a shuffle, where exact 128-bit keys are counted per document
and the surviving occurrence is chosen. False positives cost shuffled rows, never a wrong result.

The filters grow with the number of documents up to ``max_filter_bits``; the "twice" filter is the only
thing that is broadcast, 32 MiB at the default bound. Beyond it the filters only get less selective. Tasks
that build filters read up to ``max_builders`` input slices side by side, so the filters' own shuffle is bounded too.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grove.llm.common import pick, saved, utf8

HASHES = 3
SALTS = 16  # parts of a key's documents that meet its decision apart
SLICE = 4096  # bytes of a filter that travel together
LINES_GUESS = 8  # filter sizing only: expected lines of a document that are long enough


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """Per line the 16-byte hash of its key, or None for keys under ``min_chars`` code points."""
    from xxhash import xxh3_128_digest

    out = []
    for line in text.split(b"\n"):
        key = line.strip().lower()
        n = len(key)
        if n >= 4 * min_chars or n >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars:
            out.append(xxh3_128_digest(key))
        else:
            out.append(None)
    return out


def _positions(keys, bits: int):
    """Filter positions, one column per hash function, of 16-byte keys."""
    import numpy as np

    halves = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
    steps = np.arange(HASHES, dtype=np.uint64)
    return (halves[:, :1] + steps * (halves[:, 1:] | np.uint64(1))) & np.uint64(bits - 1)


def _holds(filter_, at):
    return ((filter_[at >> 3] >> (at & 7).astype("uint8")) & 1).all(axis=1)


def _set(filter_, at) -> None:
    import numpy as np

    np.bitwise_or.at(filter_, at >> 3, np.left_shift(1, at & 7).astype("uint8"))


def merge_filters(pairs):
    """Fold ``(once, twice)`` bit arrays of disjoint sets of documents into one pair."""
    once = twice = None
    for a, b in pairs:
        if once is None:
            once, twice = a.copy(), b.copy()
        else:
            twice |= b | (once & a)
            once |= a
    return once, twice


def seen_twice(docs: DataFrame, min_chars: int, bits: int, max_builders: int) -> bytes:
    """The merged filter of keys that two documents or more hold."""

    def build(batches):
        import numpy as np
        import pyarrow as pa

        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            keys = [k for t in utf8(batch.column(0)) for k in {*line_keys(t, min_chars)} - {None}]
            if not keys:
                continue
            at = _positions(keys, bits).astype(np.int64)
            _, first, counts = np.unique(at, axis=0, return_index=True, return_counts=True)
            distinct = at[first]
            _set(twice, distinct[(counts > 1) | _holds(once, distinct)].ravel())
            _set(once, distinct.ravel())
        used = np.flatnonzero(once.reshape(-1, SLICE).any(axis=1))
        for start in range(0, len(used), 1024):
            part = used[start : start + 1024]
            yield pa.RecordBatch.from_pydict(
                {
                    "slice": pa.array(part, pa.int32()),
                    "once": pa.array([once[i * SLICE : (i + 1) * SLICE].tobytes() for i in part], pa.binary()),
                    "twice": pa.array([twice[i * SLICE : (i + 1) * SLICE].tobytes() for i in part], pa.binary()),
                }
            )

    def fold(table):
        import numpy as np
        import pyarrow as pa

        pairs = (
            (np.frombuffer(a.as_py(), np.uint8), np.frombuffer(b.as_py(), np.uint8))
            for a, b in zip(table["once"], table["twice"])
        )
        _, twice = merge_filters(pairs)
        return pa.table({"slice": table["slice"][:1], "twice": pa.array([twice.tobytes()], pa.binary())})

    slices = docs.select("text").coalesce(max_builders).mapInArrow(build, "slice int, once binary, twice binary")
    rows = slices.groupBy("slice").applyInArrow(fold, "slice int, twice binary").collect()
    out = bytearray(bits // 8)
    for row in rows:
        out[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = row["twice"]
    return bytes(out)


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    carry: tuple[str, ...] = (),
    max_filter_bits: int = 2**28,
    max_builders: int = 4096,
) -> DataFrame:
    """Drop lines that ``min_docs`` documents or more share, but in the document of the largest id that has them.

    ``docs`` needs ``doc_id`` and ``text``; ``carry`` names columns to pass on; all others are ignored.
    Returns ``doc_id, text, n_lines, n_dropped`` and the carried columns, a row for each input row.
    A null or empty text is one empty line and comes back empty. A line's key is the line stripped of
    white space with A-Z in lower case; keys under ``min_chars`` code points always stay. Rows of one
    ``doc_id`` (or of null) count as one document. A document may come back as an empty text.
    """
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text", *carry)
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = max(1, docs.count()) * LINES_GUESS * 16
    bits = min(max_filter_bits, max(2**18, 2 ** math.ceil(math.log2(wanted))))
    filter_ = spark.sparkContext.broadcast(seen_twice(docs, min_chars, bits, max_builders))

    def suspects(batches):
        import numpy as np
        import pyarrow as pa

        twice = np.frombuffer(filter_.value, np.uint8)
        for batch in batches:
            rows, keys = [], []
            for i, text in enumerate(utf8(batch.column(1))):
                own = {*line_keys(text, min_chars)} - {None}
                keys += own
                rows += [i] * len(own)
            if keys:
                hit = np.flatnonzero(_holds(twice, _positions(keys, bits).astype(np.int64)))
                if len(hit):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": pa.array([keys[i] for i in hit], pa.binary()),
                            "doc_id": batch.column(0).take(pa.array(np.array(rows)[hit])),
                        }
                    )

    found = saved(docs.select("doc_id", "text").mapInArrow(suspects, f"key binary, doc_id {kind}"), "lines")
    # By key and document first: a line of a third of all documents is counted by many tasks.
    holders = found.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    shared = (
        holders.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("key", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    drops = (
        found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        .join(shared, ["key", "salt"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("keys"))
        .withColumnRenamed("doc_id", "drop_id")
    )
    joined = docs.join(drops, docs["doc_id"].eqNullSafe(drops["drop_id"]), "left").drop("drop_id")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            texts, lines, dropped = [], [], []
            for text, keys in zip(utf8(batch.column("text")), batch.column("keys").to_pylist()):
                rows = text.split(b"\n")
                if keys:
                    out = {*keys}
                    kept = [r for r, k in zip(rows, line_keys(text, min_chars)) if k not in out]
                else:
                    kept = rows
                texts.append(text if len(kept) == len(rows) else b"\n".join(kept))
                lines.append(len(rows))
                dropped.append(len(rows) - len(kept))
            named = {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.binary()).cast(pa.string())}
            named |= {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_pydict(named | {c: batch.column(c) for c in carry})

    types = dict(docs.dtypes)
    schema = f"doc_id {kind}, text string, n_lines long, n_dropped long"
    return joined.mapInArrow(cut, schema + "".join(f", `{c}` {types[c]}" for c in carry))
