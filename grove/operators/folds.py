"""Fold assignment and hold-out splits that depend only on keys, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grove.operators.ranking import TARGET_ROWS, tile


def drawn(key: str, seed: int) -> Column:
    """A number below 2^60 that looks random but is fixed by key and seed: the first digits of their MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("bigint")


def _order(key: str, shuffle: bool, seed: int) -> Column:
    return drawn(key, seed) if shuffle else F.col(key)


def folds(
    df: DataFrame, k: int, key: str, shuffle: bool = False, seed: int = 0, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Contiguous blocks in key order (or in hashed order); the first ``n % k`` folds get one row more."""
    return tile(df, k, _order(key, shuffle, seed), key, target_rows=target_rows)


def stratified_folds(
    df: DataFrame,
    k: int,
    by: str,
    key: str,
    numeric: bool = False,
    shuffle: bool = False,
    seed: int = 0,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """``k`` folds inside each class of ``by``, or inside each of ``k`` equal-width ranges of it."""
    if numeric:
        low, high = df.agg(F.min(by), F.max(by)).first()
        if low is None or low == high:
            stratum: Column = F.lit(1)
        else:
            # The top edge belongs to the last range.
            stratum = F.least(F.lit(k), F.expr(f"width_bucket(cast({by} as double), {float(low)!r}D, {float(high)!r}D, {k})"))
        df = df.withColumn("stratum", stratum.cast("int"))
    else:
        df = df.withColumn("stratum", F.col(by))
    return tile(df, k, _order(key, shuffle, seed), key, ["stratum"], target_rows)


def holdout(df: DataFrame, fraction: float, key: str, seed: int = 0) -> DataFrame:
    """Add ``is_test``: a fixed function of the key, so a re-read table splits the same way."""
    return df.withColumn("is_test", drawn(key, seed) / F.lit(float(1 << 60)) < fraction)
