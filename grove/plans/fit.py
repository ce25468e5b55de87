"""Entry points: one table in, a forest (or a path of forests, or one forest per class) out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from grove.forest import Forest, Tree
from grove.functions.losses import CLASSIFICATION
from grove.operators.binning import DENSE_MAX_BINS, SPARSE_MAX_BINS, BinSet, fit_bins, fit_fine_bins, fit_sparse_bins
from grove.operators.prepare import center_target, class_list, clean_features, validate
from grove.plans.binned import BinnedParams, BinnedTrainer
from grove.plans.leafwise import LeafwiseParams, LeafwiseTrainer
from grove.plans.rows import TrainingRows, binned_rows, maybe_collapse

LOG_SCHEMA = (
    "step int, sweep int, trees int, leaves int, delta double, loss double, abs_weight double, sq_weight double, "
    "precision double, recall double"
)


@dataclass
class Fitted:
    """The path of models (the last is the final forest), the bins and the training log."""

    path: list[Forest]
    bins: BinSet
    log: list[dict] = field(default_factory=list)

    @property
    def forest(self) -> Forest:
        return self.path[-1]

    def log_df(self, spark) -> DataFrame:
        names = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in self.log], LOG_SCHEMA)


def _is_sparse(table: DataFrame) -> bool:
    return table.schema["features"].dataType.typeName() == "map"


def find_bins(table: DataFrame, params: LeafwiseParams | BinnedParams) -> BinSet:
    if isinstance(params, LeafwiseParams):
        return fit_fine_bins(table, params.max_bins)
    if _is_sparse(table):
        return fit_sparse_bins(
            table, params.max_bins or SPARSE_MAX_BINS, params.min_child_weight, params.data_l2,
            params.sparse_min_occurrences, params.sparse_max_features,
        )
    return fit_bins(table, params.max_bins or DENSE_MAX_BINS, params.min_child_weight, params.data_l2)


def _with_cuts(bins: BinSet, forest: Forest | None) -> BinSet:
    """Cuts of an initial model become boundaries, so its routing stays exact."""
    if forest is None:
        return bins
    cuts: dict[int, set] = {}
    for tree in forest.trees:
        for node in tree.nodes:
            if node.left >= 0:
                cuts.setdefault(node.feature, set()).add(node.cut)
    kept = bins.kept
    merged = {f: np.array(sorted(set(map(float, b)) | cuts.get(f, set()))) for f, b in bins.boundaries.items() if f not in kept}
    merged.update({f: b.with_cuts(cuts[f]) if f in cuts else b for f, b in kept.items()})
    merged.update({f: np.array(sorted(c)) for f, c in cuts.items() if f not in merged})
    return BinSet(merged, bins.gains, bins.sparse, bins.missing)


def _trees_on_bins(forest: Forest, bins: BinSet) -> list[Tree]:
    trees = forest.copy().trees
    inner = [node for tree in trees for node in tree.nodes if node.left >= 0]
    places = bins.cut_bins((node.feature, node.cut) for node in inner)
    for node in inner:
        node.bin = places[node.feature, node.cut]
    return trees


def width_of(table: DataFrame, facts: dict) -> int:
    if facts["max_features"] is not None:
        return facts["max_features"]
    return int(table.select(F.explode(F.map_keys("features")).alias("f")).agg(F.max("f")).first()[0] or 0) + 1


def fit_forest(
    table: DataFrame,
    params: LeafwiseParams | BinnedParams,
    bins: BinSet | None = None,
    init_model: Forest | None = None,
    facts: dict | None = None,
) -> Fitted:
    """Train on ``(features, label, weight)``; classification losses expect labels +1 / -1.

    Features are cleaned first. A table without any feature to cut gives a forest of its constant alone.
    """
    params.check()
    table = clean_features(table)
    leafwise = isinstance(params, LeafwiseParams)
    facts = facts or validate(table, params.loss in CLASSIFICATION, init_model.n_features if init_model else None)
    constant = 0.0
    if leafwise and params.normalize:
        table, constant = center_target(table)
    bins = _with_cuts(bins or find_bins(table, params), init_model)
    if not bins.features:
        missing = "zero" if leafwise and bins.sparse else "lowest"
        name = "leafwise" if leafwise else "binned"
        return Fitted([Forest([], constant, width_of(table, facts), missing, params.loss, name, config=asdict(params))], bins)
    return train_on_bins(binned_rows(table, bins, facts["rows"]), bins, params, facts["rows"], width_of(table, facts), constant, init_model)


def train_on_bins(
    rows: DataFrame,
    bins: BinSet,
    params: LeafwiseParams | BinnedParams,
    n_rows: int,
    n_features: int,
    constant: float = 0.0,
    init_model: Forest | None = None,
    class_bins: list[BinSet] | None = None,
) -> Fitted | list[Fitted]:
    """Train on an already binned table ``(label, weight, n, bins, score)``; with ``class_bins`` (binned engine), rows of
    every class whose last bin is the class, and a ``Fitted`` per class."""
    leafwise = isinstance(params, LeafwiseParams)
    full = rows.persist(StorageLevel.MEMORY_AND_DISK)
    merged = maybe_collapse(full, params.loss, n_rows)
    state = TrainingRows(merged, bins, params.loss, "leafwise" if leafwise else "binned")
    if merged is not full and params.loss == "LS":
        square = F.sum(F.col("weight") * F.col("label") * F.col("label")).alias("s")
        state.inner_square = full.agg(square).first()["s"] - state.df.agg(square).first()["s"]
    full.unpersist()
    init = _trees_on_bins(init_model, bins) if init_model else None
    if leafwise:
        trainer = LeafwiseTrainer(state, params, n_rows, constant, n_features, init, init_model.constant if init_model else None)
    else:
        classes = len(class_bins) if class_bins else 1
        trainer = BinnedTrainer(state, params, n_rows, n_features, init, classes=classes, class_bins=class_bins)
    path = trainer.run()
    state.close()
    if class_bins:
        return [Fitted(p, b, trainer.log) for p, b in zip(path, class_bins)]
    if not leafwise and bins.sparse:
        for forest in path:
            forest.missing = "lowest"
    return Fitted(path, bins, trainer.log)


@dataclass
class Classifier:
    """One forest for two classes (the first sorted class is the positive one), else one per class."""

    classes: list
    fits: list[Fitted]

    @property
    def forests(self) -> list[Forest]:
        return [f.forest for f in self.fits]


def _fit_classes_together(source: DataFrame, label: str, params: BinnedParams, classes: list) -> list[Fitted] | None:
    """One-vs-rest forests of all classes from one training pass: the rows once per class, the class as their last bin.

    Each class keeps its own bins (fitted on its labels) and grows, limits and corrects its trees exactly as alone, but
    every training job serves all classes, so their number does not grow with the classes. None when a class has no
    feature to cut (then each class trains alone).
    """
    params.check()
    table = clean_features(source)
    owns = [table.withColumn("label", F.when(F.col(label) == F.lit(name), F.lit(1.0)).otherwise(F.lit(-1.0))) for name in classes]
    facts = validate(owns[0], True, None)
    bins = [find_bins(own, params) for own in owns]
    if any(not b.features for b in bins):
        return None
    width = max(max(b.features) for b in bins) + 1
    parts = [binned_rows(own, b, facts["rows"]).withColumn("bins", F.concat("bins", F.array(F.lit(k)))) for k, (own, b) in enumerate(zip(owns, bins))]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    longest = {f: max((b.boundaries.get(f, np.zeros(0)) for b in bins), key=len) for f in range(width)}
    longest[width] = np.arange(len(classes) - 1) + 0.5  # the class cell: bin k is class k
    merged = BinSet(longest, dict.fromkeys(longest, 0.0), False)
    return train_on_bins(stacked, merged, params, facts["rows"], width_of(owns[0], facts), class_bins=bins)


def fit_classifier(
    table: DataFrame, label: str, params: LeafwiseParams | BinnedParams, classes: Sequence | None = None, max_classes: int = 10_000,
    init_models: Sequence[Forest] | None = None, together: bool = True,
) -> Classifier:
    """``table`` has ``features, weight`` and the class column ``label``; one-vs-rest beyond two classes.

    ``init_models``, a forest for each one to train in the order of ``classes``, are trained further. ``max_classes`` guards against a column that is no class at all: every class is a forest of its own.
    With ``together``, the binned engine trains all classes of a dense table in one pass (``_fit_classes_together``);
    otherwise, and for the leaf-wise engine, sparse tables and initial models, one class after another.
    """
    classes = class_list(table, label, max_classes) if classes is None else sorted(classes)
    source = table.persist(StorageLevel.MEMORY_AND_DISK)
    if together and isinstance(params, BinnedParams) and len(classes) > 2 and not init_models and not _is_sparse(source):
        fits = _fit_classes_together(source, label, params, classes)
        if fits is not None:
            for k, (name, fitted) in enumerate(zip(classes, fits)):
                for forest in fitted.path:
                    forest.class_id, forest.class_label = k, str(name)
            source.unpersist()
            return Classifier(classes, fits)
    shared: BinSet | None = None
    fits = []
    for k, name in enumerate(classes if len(classes) > 2 else classes[:1]):
        own = source.withColumn("label", F.when(F.col(label) == F.lit(name), F.lit(1.0)).otherwise(F.lit(-1.0)))
        fitted = fit_forest(own, params, bins=shared, init_model=init_models[k] if init_models else None)
        if isinstance(params, LeafwiseParams) and all(g == 0.0 for g in fitted.bins.gains.values()):
            shared = fitted.bins  # one bin per distinct value: the same for every class
        for forest in fitted.path:
            forest.class_id, forest.class_label = k, str(name)
        fits.append(fitted)
    source.unpersist()
    return Classifier(classes, fits)
