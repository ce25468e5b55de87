"""Row-level preparation of training tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The finite range that features are clamped to, and the density limits.
VALUE_MIN = -3.4028234663852886e38
VALUE_MAX = 3.4028234663852886e38
SPARSE_BELOW_RATIO = 0.4
DENSE_FROM_PRESENCE = 0.5
LABEL_TOLERANCE = 1e-5


def clean_value(x: Column) -> Column:
    """NULL, NaN and -inf become the lowest value, +inf the highest."""
    low, high = F.lit(VALUE_MIN), F.lit(VALUE_MAX)
    x = x.cast("double")
    return F.when(x.isNull() | F.isnan(x), low).otherwise(F.greatest(low, F.least(high, x)))


def clean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clean_value(F.col(c)) for c in cols})


def clean_features(table: DataFrame, column: str = "features") -> DataFrame:
    """``clean`` for an ARRAY or MAP column."""
    if table.schema[column].dataType.typeName() == "map":
        return table.withColumn(column, F.transform_values(column, lambda _, v: clean_value(v)))
    return table.withColumn(column, F.transform(column, clean_value))


def training_table(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str | Column,
    weight: str | Column | None = None,
    key: str | None = None,
) -> DataFrame:
    """``(row_id?, features, label, weight)``.

    ``features`` is a list of numeric columns, one ARRAY column (dense) or one MAP<INT, DOUBLE>
    column (sparse, absent entries are missing). ``label`` and ``weight`` may be SQL expressions.
    """
    if isinstance(features, str):
        if df.schema[features].dataType.typeName() in ("map", "array"):
            df = clean_features(df, features)
            x = F.col(features)
        else:
            x = F.array(clean_value(F.col(features)))
    else:
        x = F.array(*[clean_value(F.col(c)) for c in features])
    y = F.expr(label) if isinstance(label, str) else label
    w = F.lit(1.0) if weight is None else F.expr(weight) if isinstance(weight, str) else weight
    columns = [F.col(key).alias("row_id")] if key else []
    return df.select(*columns, x.alias("features"), y.cast("double").alias("label"), w.cast("double").alias("weight"))


def profile(table: DataFrame) -> DataFrame:
    """One row of facts that ``validate`` judges; a single aggregation."""
    kind = table.schema["features"].dataType.typeName()
    size = F.size("features") if kind == "array" else F.lit(None).cast("int")
    return table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("label").isNull() | F.isnan("label")).alias("bad_labels"),
        F.count_if(~(F.coalesce(F.col("weight"), F.lit(0.0)) > 0)).alias("bad_weights"),
        F.min("label").alias("min_label"),
        F.max("label").alias("max_label"),
        F.min(size).alias("min_features"),
        F.max(size).alias("max_features"),
    )


def validate(table: DataFrame, classification: bool = False, n_features: int | None = None) -> dict:
    """Raise ``ValueError`` on an unusable table, else return the facts found."""
    facts = profile(table).first().asDict()
    if facts["rows"] == 0:
        raise ValueError("the training table is empty")
    if facts["bad_labels"]:
        raise ValueError(f"{facts['bad_labels']} labels are missing")
    if facts["bad_weights"]:
        raise ValueError(f"{facts['bad_weights']} row weights are not positive")
    if facts["min_features"] != facts["max_features"]:
        raise ValueError(f"rows have {facts['min_features']} to {facts['max_features']} features")
    if n_features is not None and facts["max_features"] not in (None, n_features):
        raise ValueError(f"expected {n_features} features, found {facts['max_features']}")
    if classification and facts["min_label"] == facts["max_label"]:
        raise ValueError("classification needs at least two classes")
    return facts


def binary_label(y: Column) -> Column:
    """+1 where the value is 1 within the tolerance, else -1."""
    return F.when(F.abs(y - 1) < LABEL_TOLERANCE, F.lit(1.0)).otherwise(F.lit(-1.0))


def class_list(df: DataFrame, label: str, limit: int = 10_000) -> list:
    """Sorted distinct classes; a class list is part of the model, so its size is checked."""
    rows = df.select(label).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{label} has more than {limit} classes")
    if any(r[0] is None for r in rows):
        raise ValueError(f"{label} has missing values")
    classes = sorted(r[0] for r in rows)
    if len(classes) < 2:
        raise ValueError("classification needs at least two classes")
    return classes


def class_index(label: Column, classes: Sequence) -> Column:
    return (F.array_position(F.array(*[F.lit(c) for c in classes]), label) - 1).cast("int")


def encode_label(df: DataFrame, label: str, classes: Sequence | None = None) -> DataFrame:
    """Add ``class_index``; with two classes also ``binary``: +1 for the first class, -1 for the other."""
    classes = class_list(df, label) if classes is None else list(classes)
    out = df.withColumn("class_index", class_index(F.col(label), classes))
    if len(classes) == 2:
        out = out.withColumn("binary", F.when(F.col("class_index") == 0, F.lit(1.0)).otherwise(F.lit(-1.0)))
    return out


def ovr_labels(df: DataFrame, label: str, classes: Sequence | None = None) -> DataFrame:
    """Add ``ovr``: an array with +1 at the row's own class and -1 elsewhere."""
    classes = class_list(df, label) if classes is None else list(classes)
    own = [F.when(F.col(label) == F.lit(c), F.lit(1.0)).otherwise(F.lit(-1.0)) for c in classes]
    return df.withColumn("ovr", F.array(*own))


def center_target(df: DataFrame, label: str = "label", n: str | None = None) -> tuple[DataFrame, float]:
    """Subtract the unweighted mean of the label and return it as the model constant."""
    count = F.count(label) if n is None else F.sum(n)
    total = F.sum(label) if n is None else F.sum(F.col(label) * F.col(n))
    mean = df.agg((total / count).alias("mean")).first()["mean"]
    mean = 0.0 if mean is None else float(mean)
    return df.withColumn(label, F.col(label) - F.lit(mean)), mean


def density_profile(table: DataFrame) -> DataFrame:
    """Per feature: present (non-zero) rows, their share, and the handling both rules choose.

    ``by_table`` looks at the share of non-zero cells of the whole table, ``by_feature`` at one
    feature's own share.
    """
    if table.schema["features"].dataType.typeName() == "map":
        cells = table.select(F.explode("features").alias("feature", "value"))
    else:
        cells = table.select(F.posexplode("features").alias("feature", "value"))
    total = table.agg(F.count(F.lit(1)).alias("rows"))
    per = cells.groupBy("feature").agg(F.count_if(F.col("value") != 0).alias("present"))
    overall = per.agg(F.sum("present").alias("all_present"), F.count(F.lit(1)).alias("n_features"))
    facts = F.broadcast(total.crossJoin(overall))  # one row
    share = F.col("present") / F.col("rows")
    ratio = F.col("all_present") / (F.col("rows") * F.col("n_features"))
    return per.crossJoin(facts).select(
        "feature",
        "present",
        share.alias("share"),
        F.when(ratio < SPARSE_BELOW_RATIO, F.lit("sparse")).otherwise(F.lit("dense")).alias("by_table"),
        F.when(share >= DENSE_FROM_PRESENCE, F.lit("dense")).otherwise(F.lit("sparse")).alias("by_feature"),
    )


def init_constant(df: DataFrame, loss: str, label: str = "label", weight: str | None = None) -> DataFrame:
    """The best constant score: the mean label, or its log-odds for the logistic losses (labels +1 / -1)."""
    if weight is not None and loss in ("Log", "Logit"):
        raise ValueError("a weighted constant is not defined for logistic losses")
    mean = F.avg(label) if weight is None else F.sum(F.col(label) * F.col(weight)) / F.sum(weight)
    if loss in ("Log", "Logit"):
        odds = F.log((1 + mean) / (1 - mean))
        mean = odds if loss == "Log" else odds / 2
    return df.agg(mean.alias("constant"))
