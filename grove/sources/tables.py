"""Joining row-aligned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align(x: DataFrame, y: DataFrame, w: DataFrame | None = None, key: str = "row_id") -> DataFrame:
    """Features, targets and weights read from separate files, matched by line number.

    A line that one of the files lacks is an error; the outer join that finds it is the join itself.
    """
    parts = [x.withColumn("_x", F.lit(True)), y.select(key, F.col(y.columns[-1]).alias("label"), F.lit(True).alias("_y"))]
    if w is not None:
        parts.append(w.select(key, F.col(w.columns[-1]).alias("weight"), F.lit(True).alias("_w")))
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.join(part, key, "full_outer")
    marks = ["_x", "_y"] + (["_w"] if w is not None else [])
    complete = F.lit(True)
    for m in marks:
        complete = complete & F.col(m).isNotNull()
    # The check rides on the output rows: an incomplete line fails the job that reads it.
    key_or_error = F.when(complete, F.col(key)).otherwise(
        F.raise_error(F.concat(F.lit("the files differ in length at line "), F.col(key).cast("string"))).cast("bigint")
    )
    out = joined.withColumn(key, key_or_error)
    if w is None:
        out = out.withColumn("weight", F.lit(1.0))
    return out.drop(*marks)


def merge_columns(df: DataFrame, extras: DataFrame, columns: Sequence[str], key: str = "row_id", into_features: bool = False) -> DataFrame:
    """Append columns of ``extras`` by row, as columns of their own or at the end of ``features``."""
    joined = df.join(extras.select(key, *columns), key)
    if not into_features:
        return joined
    more = F.array(*[F.col(c).cast("double") for c in columns])
    return joined.withColumn("features", F.concat("features", more)).drop(*columns)
