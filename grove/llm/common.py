"""Small helpers shared by the operators: column picking, shared scratch tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grove.session import ensure_checkpoint_dir

#: The columns of ``documents``, which every pipeline stage but the last returns.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: White space as the contracts define it: blank, and U+0009 to U+000D.
SPACE = " \t\n\x0b\f\r"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only ``names``, matched by exact spelling or else without regard to case, the first of equal ones.

    Columns are renamed by position first, so extra columns whose names differ in case only, or
    repeat, can't make a reference ambiguous. A missing column raises ``ValueError``.
    """
    found = df.columns
    lower = [c.lower() for c in found]
    where = {n: found.index(n) if n in found else lower.index(n.lower()) if n.lower() in lower else None for n in names}
    missing = [n for n in names if where[n] is None]
    if missing:
        raise ValueError(f"columns {missing} are missing; there are {found}")
    plain = df.toDF(*[f"_{i}" for i in range(len(found))])
    return plain.select([F.col(f"_{where[n]}").alias(n) for n in names])


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return pick(df, *columns) if columns else df


def scratch_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the checkpoint folder, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def saved(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cut lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a ``saved`` table that no later result reads."""
    path = getattr(df, "saved_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def utf8(column) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def worker_state(kind: str, key: str, make):
    """What ``make`` returned for ``key`` the first time in this Python worker; only the last kind and key are kept.

    Caches outlive the task, but hold no results that matter.
    """
    import sys
    import types

    keep = sys.modules.setdefault("_grove_worker", types.ModuleType("_grove_worker")).__dict__
    if keep.get(kind, ("",))[0] != key:
        for name in [n for n in keep if not n.startswith("__")]:
            del keep[name]  # what an earlier operator has left here
        keep[kind] = key, make()
    return keep[kind][1]
