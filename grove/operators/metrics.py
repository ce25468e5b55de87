"""Evaluation of scored tables; every metric is one or two aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grove.functions.losses import loss_value
from grove.operators.ranking import TARGET_ROWS, running_sums

# Fixed value: the guard added to denominators by the binned engine's reports.
GUARD = 1e-10


def _ratio(a: Column, b: Column, guarded: bool) -> Column:
    if guarded:
        return a / (b + GUARD)
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def evaluate(
    df: DataFrame,
    loss: str = "LS",
    by: Sequence[str] = (),
    score: str = "score",
    label: str = "label",
    engine: str = "leafwise",
    weight: str | None = None,
) -> DataFrame:
    """Count, accuracy (same side of zero), RMSE, squared error and mean loss."""
    s, y = F.col(score), F.col(label)
    w = F.lit(1.0) if weight is None else F.col(weight)
    total = F.sum(w)
    error = (s - y) * (s - y)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(F.when((s > 0) == (y > 0), w).otherwise(F.lit(0.0))) / total).alias("accuracy"),
        F.sqrt(F.sum(w * error) / total).alias("rmse"),
        F.sum(w * error).alias("squared_error"),
        (F.sum(w * loss_value(loss, score, label, engine)) / total).alias("mean_loss"),
    )


def confusion(
    df: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label", guarded: bool = False
) -> DataFrame:
    """Counts and rates at threshold 0; ``guarded`` adds a tiny term where a rate may be undefined."""
    predicted, actual = F.col(score) > 0, F.col(label) > 0
    counts = df.groupBy(*by).agg(
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & ~actual).alias("tn"),
        F.count_if(~predicted & actual).alias("fn"),
    )
    tp = F.col("tp").cast("double")
    rated = counts.withColumn("precision", _ratio(tp, F.col("tp") + F.col("fp"), guarded)).withColumn(
        "recall", _ratio(tp, F.col("tp") + F.col("fn"), guarded)
    )
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1", _ratio(2 * p * r, p + r, guarded))


def _by_score(df: DataFrame, by: Sequence[str], score: str, label: str) -> DataFrame:
    # Adding 0.0 makes -0.0 and 0.0 one score.
    return df.groupBy(*by, (F.col(score).cast("double") + 0.0).alias("score")).agg(
        F.count_if(F.col(label) > 0).alias("pos"), F.count_if(~(F.col(label) > 0)).alias("neg")
    )


def auc(
    df: DataFrame,
    by: Sequence[str] = (),
    score: str = "score",
    label: str = "label",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule over distinct scores."""
    ranked = running_sums(_by_score(df, by, score, label), by, "score", ["pos", "neg"], target_rows)
    # A trapezoid of one score: its negatives times the positives above it plus half of those tied.
    piece = F.col("neg") * (F.col("tot_pos") - F.col("cum_pos") + F.col("pos") / 2)
    area = F.sum(piece) / ((F.max("tot_pos") + GUARD) * (F.max("tot_neg") + GUARD))
    return ranked.groupBy(*by).agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), area.alias("auc"))


def best_threshold(
    df: DataFrame,
    by: Sequence[str] = (),
    score: str = "score",
    label: str = "label",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Best F1 and best accuracy when rows with ``score >= threshold`` are called positive."""
    ranked = running_sums(_by_score(df, by, score, label), by, "score", ["pos", "neg"], target_rows)
    # Everything at or above this score.
    hits = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    called = hits + F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    total = F.col("tot_pos") + F.col("tot_neg")
    f1 = F.when(hits == 0, F.lit(0.0)).otherwise(2 * hits / (called + F.col("tot_pos")))
    accuracy = (total - called - F.col("tot_pos") + 2 * hits) / total
    cuts = ranked.select(*by, "score", f1.alias("f1"), accuracy.alias("accuracy"))
    best = cuts.groupBy(*by).agg(
        F.max(F.struct("f1", "score")).alias("by_f1"), F.max(F.struct("accuracy", "score")).alias("by_accuracy")
    )
    return best.select(
        *by,
        F.col("by_f1.f1").alias("best_f1"),
        F.col("by_f1.score").alias("f1_threshold"),
        F.col("by_accuracy.accuracy").alias("best_accuracy"),
        F.col("by_accuracy.score").alias("accuracy_threshold"),
    )


def r2(df: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label", weight: str | None = None) -> DataFrame:
    """Coefficient of determination, optionally weighted."""
    w = F.lit(1.0) if weight is None else F.col(weight)
    s, y = F.col(score), F.col(label)
    sums = df.groupBy(*by).agg(
        F.sum(w * (y - s) * (y - s)).alias("_res"),
        F.sum(w).alias("_w"),
        F.sum(w * y).alias("_wy"),
        F.sum(w * y * y).alias("_wyy"),
    )
    return sums.select(*by, (1 - F.col("_res") / (F.col("_wyy") - F.col("_wy") * F.col("_wy") / F.col("_w"))).alias("r2"))


def class_accuracy(
    df: DataFrame, by: Sequence[str] = (), predicted: str = "prediction", label: str = "label", weight: str | None = None
) -> DataFrame:
    w = F.lit(1.0) if weight is None else F.col(weight)
    hit = F.when(F.col(predicted) == F.col(label), w).otherwise(F.lit(0.0))
    return df.groupBy(*by).agg((F.sum(hit) / F.sum(w)).alias("accuracy"))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("ratio", F.col("n") / F.sum("n").over(Window.partitionBy()))
