"""Toxicity by multiple-instance learning: sentences are the instances, only documents have labels.

A sentence's probability is logistic in its words and their beginnings; a document is toxic if any sentence is, so its
probability is the noisy-or 1 - prod(1 - p) over its sentences. The labels of documents alone train the weights, and the trained
sentence probabilities then tell which sentences made a document toxic.
"""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.llm.common import pick, saved, utf8, worker_state
from grove.llm.sampling import labelled_sample

SENTENCE = re.compile(r"[^.!?\n]+")
STOPS = str.maketrans(".!?", "   ")
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…“”„«»¿¡"
CACHE = 200_000  # words whose weights a task remembers


def features_of(word: str) -> list[str]:
    """The word in lower case without marks at its ends, and its first three to eight letters."""
    word = word.strip(EDGES)
    return [f"w {word}", *(f"{k} {word[:k]}" for k in range(3, 9) if len(word) > k)] if word else []


def leading_feature(word: str, number: dict[str, int]) -> int | None:
    """Number of the longest numbered feature of ``word``, which tells all others; none if it has none."""
    own = features_of(word)
    return next((number[f] for f in (*own[:1], *own[:0:-1]) if f in number), None)


def parts(feature: str) -> list[str]:
    """All features of a word whose longest is ``feature``."""
    kind, word = feature.split(" ", 1)
    return features_of(word) if kind == "w" else [f"{k} {word[:k]}" for k in range(3, int(kind) + 1)]


def sentences_of(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence, in code points; a text without any is one empty sentence."""
    return [m.span() for m in SENTENCE.finditer(text) if not m[0].isspace()] or [(0, 0)]


def words_in(text: str) -> list[str]:
    """The words of all sentences, cut as inside each: after white space and the marks that end sentences."""
    return text.translate(STOPS).split()


def fit_noisy_or(y, plain, sentences, sizes, cell_f, part_of, part, n_features: int, scale: tuple[float, float] = (1.0, 1.0), steps: int = 400, sparse: float = 0.03):
    """Weights and bias from arrays: per document its label, the number of its sentences without features and of those with some;
    per sentence with features the number of its words that have any; and the leading features of all these words in that order. A leading
    feature stands for all features of its words: ``part`` are those of ``part_of``.

    Full-batch Adam on the document likelihood; ``scale`` weighs the documents of each class. ``sparse`` is an L1 penalty in
    documents: words that only keep company with toxic ones get no weight of their own.
    """
    import numpy as np

    doc, cell_s = np.repeat(np.arange(len(y)), sentences), np.repeat(np.arange(len(sizes)), sizes)
    n_s, n_d = len(doc), len(y)
    weight = np.where(y > 0, scale[1], scale[0])
    weight /= weight.sum()
    w, m, v = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    w[-1] = -6.0
    for t in range(1, steps + 1):
        whole = np.bincount(part_of, w[part], n_features)
        z = w[-1] + np.bincount(cell_s, whole[cell_f], n_s)
        q = -plain * np.logaddexp(0, w[-1]) - np.bincount(doc, np.logaddexp(0, z), n_d)  # log of no toxic sentence
        pull = weight * np.where(y > 0, -np.exp(q) / np.maximum(-np.expm1(q), 1e-12), 1.0)
        ps, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + math.exp(-w[-1]))
        gz = pull[doc] * ps
        g = np.append(np.bincount(part, np.bincount(cell_f, gz[cell_s], n_features)[part_of], n_features), gz.sum() + (pull * plain).sum() * p0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        pace = 0.1 / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w = w - pace * (m / (1 - 0.9**t))
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - np.minimum(pace[:-1] * sparse / n_d, 0.05), 0)
    return w[:-1], float(w[-1])


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def __post_init__(self):
        # What a word must begin with to have any weight.
        self.heads = {f.split(" ", 1)[1][:3] for f in self.weights}

    def weight(self, word: str) -> float:
        word = word.strip(EDGES)
        if word[:3] not in self.heads:
            return 0.0
        return sum(self.weights.get(f, 0.0) for f in features_of(word))


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int = 8_000) -> ToxicityModel:
    """Learn from ``bound`` labelled rows of each class at most; ``learn`` is a condition on ``doc_id``.

    Features are all those whose document frequency leans to label 1 significantly; only the sample bounds their number. Counts and bags are made in
    tasks; the driver gets the chosen features and their places in the sampled sentences. Without rows of both classes
    the model is constant: near 0, or near 1 where only label 1 occurs.
    """
    import numpy as np

    sample, totals, taken = labelled_sample(docs, labels, label, learn, bound)
    # Copies would make every word of a copied document tell: equal texts count once.
    sample = saved(sample.groupBy(F.sha2("text", 256).alias("same")).agg(F.first("text").alias("text"), F.max("y").alias("y")), "toxic-sample")

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        seen = Counter(), Counter()
        for batch in batches:
            for text, y in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                seen[y].update({f for w in {*words_in(text.decode().lower())} for f in features_of(w)})
        names = list(seen[0].keys() | seen[1].keys())
        for a in range(0, len(names), 50_000):
            part = names[a : a + 50_000]
            yield pa.RecordBatch.from_pydict({"feature": part} | {f"n{y}": pa.array([seen[y][f] for f in part], pa.int64()) for y in (0, 1)})

    there = {r["y"] for r in sample.select("y").distinct().collect()}
    if len(there) < 2:
        return ToxicityModel({}, 10.0 if 1 in there else -10.0)
    n0, n1 = taken[0], taken[1]
    counts = sample.select("text", "y").mapInArrow(count, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    lean = F.log((F.col("n1") + 0.5) / n1) - F.log((F.col("n0") + 0.5) / n0)
    sure = lean / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    chosen = [r["feature"] for r in counts.withColumn("sure", sure).where("sure > 2 AND n1 >= 3").orderBy(F.desc("sure"), "feature").collect()]
    number = {f: i for i, f in enumerate(chosen)}

    def gather(batches):
        import pyarrow as pa

        for batch in batches:
            plain, found = [], []
            for text in utf8(batch.column(0)):
                text = text.decode().lower()
                hits = [[f for w in text[a:b].split() if (f := leading_feature(w, number)) is not None] for a, b in sentences_of(text)]
                found.append([h for h in hits if h])
                plain.append(len(hits) - len(found[-1]))
            yield pa.RecordBatch.from_pydict({"y": batch.column(1), "plain": pa.array(plain, pa.int32()), "hits": pa.array(found, pa.list_(pa.list_(pa.int32())))})

    rows = sample.select("text", "y").mapInArrow(gather, "y int, plain int, hits array<array<int>>").toArrow().combine_chunks()
    order = np.lexsort([rows["plain"].to_numpy(), rows["y"].to_numpy()])  # much the same sums in whatever order rows come
    rows = rows.take(order)
    hits = rows["hits"].combine_chunks()
    inner = hits.flatten()
    pairs = [(i, number[g]) for f, i in number.items() for g in parts(f) if g in number]
    part_of, part = np.array(pairs, np.int64).reshape(-1, 2).T
    weights, bias = fit_noisy_or(
        rows["y"].to_numpy().astype(float), rows["plain"].to_numpy().astype(float), np.diff(hits.offsets.to_numpy()), np.diff(inner.offsets.to_numpy()),
        inner.flatten().to_numpy(), part_of, part, len(chosen), (totals[0] / taken[0], totals[1] / taken[1]),
    )
    return ToxicityModel({f: float(w) for f, w in zip(chosen, weights) if w}, bias)


def score_text(text: str, model: ToxicityModel, known: dict[str, float], threshold: float = 0.5):
    """Document probability, and ``(start, end, probability)`` of sentences at ``threshold`` or above, in code points."""
    hot = {}
    lowered = text.lower()
    if len(lowered) != len(text):  # a few letters grow in lower case; offsets must stay
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for word in {*words_in(lowered)}:
        w = known.get(word)
        if w is None:
            if len(known) >= CACHE:
                known.clear()
            w = known[word] = model.weight(word)
        if w:
            hot[word] = w
    spans = sentences_of(lowered)
    calm = math.log1p(math.exp(model.bias))
    if not hot:
        return -math.expm1(-calm * len(spans)), []
    q, found = 0.0, []
    for a, b in spans:
        z = model.bias + sum(hot[w] for w in lowered[a:b].split() if w in hot)
        q -= z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
        p = 1 / (1 + math.exp(-z)) if z > -700 else 0.0
        if p >= threshold:
            found.append((a, b, p))
    return -math.expm1(q), found


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score, offending`` and the columns ``carry`` of every whole text.

    ``offending``: array of ``start, end, score`` (code points) of its toxic sentences. A null or empty text is one empty sentence. Repeated
    rows get equal scores; other columns are ignored.
    """
    docs = pick(docs, "doc_id", "text", *(c for c in carry if c not in ("doc_id", "text")))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def judge(batches):
        import pyarrow as pa

        own = sent.value
        known = worker_state("toxic", key, dict)
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            found = [score_text(t.decode(), own, known, threshold) for t in utf8(batch.column(1))]
            where = [[{"start": a, "end": b, "score": p} for a, b, p in x[1]] for x in found]
            out = {"doc_id": batch.column(0), "score": pa.array([x[0] for x in found], pa.float64()), "offending": pa.array(where, spans)}
            yield pa.RecordBatch.from_pydict(out | {c: batch.column(c) for c in more})

    types, more = dict(docs.dtypes), [c for c in carry if c != "doc_id"]
    schema = f"doc_id {types['doc_id']}, score double, offending array<struct<start:int,end:int,score:double>>"
    return docs.mapInArrow(judge, schema + "".join(f", `{c}` {types[c]}" for c in more))
