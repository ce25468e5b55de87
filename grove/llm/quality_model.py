"""Quality by a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, and so has each chosen pair of features. Tables are learnt by cyclic boosting: in
turn every feature gets one shallow tree on what is left to explain, added at a small rate, so no feature can
take another's share; pairs follow on the remainder. A row's score is the sum of its bins' entries.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.llm.common import pick, utf8
from grove.llm.sampling import labelled_sample

FEATURES = (
    "log_words", "word_bytes", "long_words", "distinct_words", "same_as_last", "log_lines", "line_words", "dup_lines",
    "upper", "digits", "other_ascii", "beyond_ascii", "exclaims", "symbols", "stops", "commas", "bars", "marked_ends",
)
MARKED_END = re.compile(rb"[^\w\s.,;:)\"'\x80-\xff](?=\s|$)")


def features_of(text: bytes) -> list[float]:
    """Numbers that tell about the form of a whole text; an empty text has zeros."""
    import math

    import numpy as np

    n = len(text)
    words = text.split()
    n_words = len(words)
    if not n_words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [x for x in text.split(b"\n") if x.strip()]
    sizes = list(map(len, words))
    other = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    return [
        math.log1p(n_words),
        sum(sizes) / n_words,
        sum(k > 24 for k in sizes) / n_words,
        len({*words}) / n_words,
        sum(map(bytes.__eq__, words, words[1:])) / n_words,
        math.log1p(len(lines)),
        n_words / len(lines),
        1 - len({*lines}) / len(lines),
        float(counts[65:91].sum()) / n,
        float(counts[48:58].sum()) / n,
        float(other) / n,
        float(counts[128:].sum()) / n,
        float(counts[33]) / n_words,
        float(sum(counts[c] for c in b"#*$%&<>@^~_=")) / n_words,
        float(counts[46] + counts[63]) / n_words,
        float(counts[44] + counts[59]) / n_words,
        float(counts[124]) / n_words,
        len(MARKED_END.findall(text)) / n_words,
    ]


@dataclass
class AdditiveModel:
    """Bin edges and tables; ``pairs`` are ``(feature, feature, table)``."""

    edges: list
    offset: float
    tables: list
    pairs: list = field(default_factory=list)

    def bins(self, x):
        import numpy as np

        return [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]

    def margin(self, x):
        import numpy as np

        at = self.bins(x)
        out = np.full(len(x), self.offset)
        for b, table in zip(at, self.tables):
            out += table[b]
        for i, j, table in self.pairs:
            out += table[at[i], at[j]]
        return out

    def score(self, x):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


def shallow_tree(g, h, leaves: int, smooth: float):
    """Values per bin of a tree of up to ``leaves`` leaves on bin sums ``g, h``: each cut the one of most gain."""
    import numpy as np

    cuts = [0, len(g)]
    cg, ch = np.r_[0.0, np.cumsum(g)], np.r_[0.0, np.cumsum(h)]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            gain = (cg[k] - cg[a]) ** 2 / (ch[k] - ch[a] + smooth) + (cg[b] - cg[k]) ** 2 / (ch[b] - ch[k] + smooth) - (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + smooth)
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (gain[i], int(k[i]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + smooth)
    return out


def pair_tree(g, h, smooth: float):
    """Values per cell of a tree that cuts one feature of a pair once, then the other one on either side; and its gain."""
    import numpy as np

    best = (-1.0, None)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for cut in range(1, gg.shape[0]):
            gain, out = 0.0, np.zeros(gg.shape)
            for rows in (slice(0, cut), slice(cut, None)):
                sg, sh = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
                values = shallow_tree(sg, sh, 2, smooth)
                gain += float((values * sg).sum())
                out[rows] = values
            if gain > best[0]:
                best = (gain, out.T if turned else out)
    return best[1] if best[1] is not None else np.zeros(g.shape), best[0]


def fit_additive(x, y, weight, max_bins: int = 64, rounds: int = 150, rate: float = 0.1, n_pairs: int = 6, pair_bins: int = 8, smooth: float = 1.0) -> AdditiveModel:
    """Cyclic boosting of one-feature trees with three leaves, then of trees on the pairs that explain most of the rest."""
    import numpy as np

    edges = []
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        cuts = (values[1:] + values[:-1]) / 2 if len(values) <= max_bins else np.unique(np.quantile(x[:, j], np.arange(1, max_bins) / max_bins))
        edges.append(cuts)
    share = float(np.clip((y * weight).sum() / weight.sum(), 1e-6, 1 - 1e-6))
    model = AdditiveModel(edges, float(np.log(share / (1 - share))), [np.zeros(len(e) + 1) for e in edges])
    at = model.bins(x)
    margin = np.full(len(x), model.offset)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            if len(table) > 1:
                g, h = slopes()
                step = rate * shallow_tree(np.bincount(at[j], g, len(table)), np.bincount(at[j], h, len(table)), 3, smooth)
                table += step
                margin += step[at[j]]
    coarse = [np.minimum(b * pair_bins // len(t), pair_bins - 1) for b, t in zip(at, model.tables)]
    sums = lambda i, j, v: np.bincount(coarse[i] * pair_bins + coarse[j], v, pair_bins**2).reshape(pair_bins, pair_bins)
    g, h = slopes()
    gains = [(pair_tree(sums(i, j, g), sums(i, j, h), smooth)[1], i, j) for i in range(len(edges)) for j in range(i)]
    grids = [(i, j, np.zeros((pair_bins, pair_bins))) for gain, i, j in sorted(gains, reverse=True)[:n_pairs] if gain > 1e-6]
    for _ in range(rounds // 5):
        for i, j, grid in grids:
            g, h = slopes()
            step = rate * pair_tree(sums(i, j, g), sums(i, j, h), smooth)[0]
            grid += step
            margin += step[coarse[i], coarse[j]]
    for i, j, grid in grids:
        spread = [np.minimum(np.arange(len(model.tables[k])) * pair_bins // len(model.tables[k]), pair_bins - 1) for k in (i, j)]
        model.pairs.append((i, j, grid[np.ix_(*spread)]))
    return model


def _numbers(batch_texts):
    import numpy as np

    return np.array([features_of(t) for t in batch_texts], float).reshape(-1, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int = 10_000, **how) -> AdditiveModel:
    """Learn from ``bound`` labelled rows of each class at most, weighted back to the classes' true shares.

    ``learn`` is a condition on ``doc_id``. Only the sample's features, 18 numbers a row, reach the driver. Without
    rows of both classes the model is constant: near 0 where only label 0 occurs, else near 1.
    """
    import numpy as np

    sample, totals, taken = labelled_sample(docs, labels, label, learn, bound)
    def measure(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"y": batch.column(1), "x": pa.array(list(_numbers(utf8(batch.column(0)))), pa.list_(pa.float64()))})

    rows = sample.select("text", "y").mapInArrow(measure, "y int, x array<double>").toArrow()
    y = rows["y"].to_numpy().astype(float)
    x = np.array(rows["x"].to_pylist(), float).reshape(len(y), len(FEATURES))
    if len({*y}) < 2:
        return AdditiveModel([np.zeros(0)] * len(FEATURES), -10.0 if 0 in y else 10.0, [np.zeros(1)] * len(FEATURES))
    order = np.lexsort([*x.T, y])  # as rows come in any order
    x, y = x[order], y[order]
    scale = {c: totals[c] / max(1, taken[c]) for c in totals}
    weight = np.where(y > 0, scale[1], scale[0])
    return fit_additive(x, y, weight * len(y) / weight.sum(), **how)


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """``doc_id, score`` of every whole text; null and empty texts are scored by their zeros. Repeated rows score alike."""
    docs = pick(docs, "doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": pa.array(sent.value.score(_numbers(utf8(batch.column(1)))), pa.float64())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(judge, f"doc_id {kind}, score double")
