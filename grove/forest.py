"""The forest: node tables as small as the model, and the operators that apply them to rows."""

from __future__ import annotations

import copy
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grove.functions.trees import Access, forest_leaves, forest_value
from grove.operators.binning import BinSet

NODE_SCHEMA = (
    "model_id string, class_id int, tree int, node int, parent int, depth int, feature int, cut double, "
    "left int, right int, weight double, gain double, n bigint"
)
META_SCHEMA = (
    "model_id string, class_id int, seq int, constant double, n_features int, n_trees int, missing string, "
    "loss string, engine string, class_label string, config string"
)


@dataclass
class Node:
    parent: int = -1
    depth: int = 0
    feature: int = -1
    cut: float = 0.0
    bin: int = -1
    left: int = -1
    right: int = -1
    weight: float = 0.0
    gain: float = 0.0
    n: int = 0


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)

    def leaves(self) -> list[int]:
        return [i for i, n in enumerate(self.nodes) if n.left < 0]

    def max_depth(self) -> int:
        return max((n.depth for n in self.nodes), default=0)

    def split(self, at: int, feature: int, bin_: int, gain: float, left: dict, right: dict) -> tuple[int, int]:
        """Turn leaf ``at`` into an inner node and return the ids of its children."""
        node = self.nodes[at]
        node.feature, node.bin, node.gain = feature, bin_, gain
        node.left, node.right = len(self.nodes), len(self.nodes) + 1
        for facts in (left, right):
            self.nodes.append(Node(parent=at, depth=node.depth + 1, **facts))
        return node.left, node.right


@dataclass
class Forest:
    trees: list[Tree] = field(default_factory=list)
    constant: float = 0.0
    n_features: int = 0
    missing: str = "lowest"
    loss: str = "LS"
    engine: str = "leafwise"
    model_id: str = "forest"
    class_id: int = 0
    class_label: str | None = None
    seq: int = 1
    config: dict = field(default_factory=dict)

    # ------------------------------------------------------------ applying

    def _access(self, df: DataFrame, features: str) -> Access:
        kind = df.schema[features].dataType.typeName()
        if kind not in ("array", "map"):
            raise ValueError(f"{features} must be an ARRAY (dense) or a MAP (sparse) column")
        return Access(features, kind == "map", False, self.missing)

    def _checked(self, df: DataFrame, features: str, value: Column) -> Column:
        """Rows of another width than the model's raise when they are scored."""
        if df.schema[features].dataType.typeName() == "map":
            return value
        wrong = F.raise_error(
            F.concat(F.lit(f"the model has {self.n_features} features, the row has "), F.size(features).cast("string"))
        )
        return F.when(F.size(features) == self.n_features, value).otherwise(wrong.cast("double"))

    def score(self, df: DataFrame, features: str = "features", ntrees: int | None = None) -> Column:
        trees = self.trees if ntrees is None else self.trees[:ntrees]
        return self._checked(df, features, forest_value(trees, self._access(df, features), self.constant))

    def transform(self, df: DataFrame, features: str = "features", ntrees: int | None = None, out: str = "score") -> DataFrame:
        return df.withColumn(out, self.score(df, features, ntrees))

    def leaf_index(self, df: DataFrame, features: str = "features", out: str = "leaves") -> DataFrame:
        """Add the node reached in each tree."""
        return df.withColumn(out, forest_leaves(self.trees, self._access(df, features)))

    # ------------------------------------------------------------ tables

    def nodes_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (self.model_id, self.class_id, t, i, n.parent, n.depth, n.feature, float(n.cut), n.left, n.right)
            + (float(n.weight), float(n.gain), int(n.n))
            for t, tree in enumerate(self.trees)
            for i, n in enumerate(tree.nodes)
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def meta_df(self, spark: SparkSession) -> DataFrame:
        row = (self.model_id, self.class_id, self.seq, float(self.constant), self.n_features, len(self.trees))
        row += (self.missing, self.loss, self.engine, self.class_label, json.dumps(self.config, default=str))
        return spark.createDataFrame([row], META_SCHEMA)

    @property
    def n_leaves(self) -> int:
        return sum(len(t.leaves()) for t in self.trees)

    def copy(self) -> Forest:
        return copy.deepcopy(self)

    def set_cuts(self, bins: BinSet) -> Forest:
        """Bin thresholds back to cuts on original values."""
        inner = [node for tree in self.trees for node in tree.nodes if node.left >= 0]
        cuts = bins.cut_values((node.feature, node.bin) for node in inner)
        for node in inner:
            node.cut = cuts[node.feature, node.bin]
        return self


def save_forests(spark: SparkSession, forests: Sequence[Forest], path: str, mode: str = "overwrite") -> None:
    """Two Parquet tables; models, classes and steps of a path live side by side."""
    nodes = [f.nodes_df(spark).withColumn("seq", F.lit(f.seq)) for f in forests]
    metas = [f.meta_df(spark) for f in forests]
    for name, parts in (("nodes", nodes), ("meta", metas)):
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        whole.coalesce(1).write.mode(mode).partitionBy("model_id", "class_id").parquet(f"{path}/{name}")


def forests_from_tables(nodes: DataFrame, meta: DataFrame) -> list[Forest]:
    """Rebuild forests from their tables (model-sized)."""
    found = {}
    for m in meta.collect():
        found[(m["model_id"], m["class_id"], m["seq"])] = Forest(
            [Tree() for _ in range(m["n_trees"])], m["constant"], m["n_features"], m["missing"], m["loss"], m["engine"],
            str(m["model_id"]), m["class_id"], m["class_label"], m["seq"], json.loads(m["config"] or "{}"),
        )
    has_seq = "seq" in nodes.columns
    for r in nodes.orderBy("tree", "node").collect():
        key = (r["model_id"], r["class_id"], r["seq"] if has_seq else 1)
        tree = found[key].trees[r["tree"]]
        tree.nodes.append(
            Node(r["parent"], r["depth"], r["feature"], r["cut"], -1, r["left"], r["right"], r["weight"], r["gain"], r["n"])
        )
    return [found[k] for k in sorted(found)]


def load_forests(spark: SparkSession, path: str, model_id: str | None = None) -> list[Forest]:
    nodes, meta = spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/meta")
    if model_id is not None:
        nodes, meta = nodes.filter(F.col("model_id") == model_id), meta.filter(F.col("model_id") == model_id)
    return forests_from_tables(nodes, meta)
