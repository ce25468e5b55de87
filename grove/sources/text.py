"""Whitespace text tables with line numbers that follow file order, not task order."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grove.operators.prepare import clean_value
from grove.session import ensure_checkpoint_dir

# The line formats of labelled text files.
LABELED_FORMATS = ("x", "y.x", "w.y.x", "sparse", "y.sparse", "w.y.sparse")
RANGE_BYTES = 8 << 20  # text of one range that a task sorts and writes


def _lines(spark: SparkSession, path: str, blank: bool = False) -> DataFrame:
    """``(row_id, value)`` of all lines, numbered from 0 in file order; blank ones are left out unless asked for.

    Rows of one input split are consecutive, so a split's lines are numbered by a running id, and only
    one count per split has to be known to place it.
    """
    raw = (
        spark.read.text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_id"),
        )
    )
    splits = raw.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("lines"), F.min("_id").alias("_first"))
    earlier = (Window.unboundedPreceding, -1)
    # Lines of the files before, a row for each file; then of the splits before in the same file.
    files = splits.groupBy("_file").agg(F.sum("lines").alias("lines"))
    files = files.select("_file", F.coalesce(F.sum("lines").over(Window.orderBy("_file").rowsBetween(*earlier)), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("lines").over(Window.partitionBy("_file").orderBy("_start").rowsBetween(*earlier)), F.lit(0))
    shifts = splits.withColumn("_inside", inside).join(files, "_file").select("_file", "_start", (F.col("_first") - F.col("_before") - F.col("_inside")).alias("_shift"))
    # One row per input split, so lines stay where they are read.
    numbered = raw.join(F.broadcast(shifts), ["_file", "_start"]).select((F.col("_id") - F.col("_shift")).alias("row_id"), "value")
    return numbered if blank else numbered.filter(F.length(F.trim("value")) > 0)


def _tokens(value: str = "value") -> Column:
    return F.split(F.trim(F.regexp_replace(value, r"\s+", " ")), " ")


def read_names(spark: SparkSession, path: str) -> list[str]:
    """Feature names, one per line."""
    return [r["value"].strip() for r in _lines(spark, path).orderBy("row_id").collect()]


def read_dense(spark: SparkSession, path: str, names: str | None = None, max_rows: int | None = None) -> DataFrame:
    """``(row_id, features ARRAY<DOUBLE>)``; every line must have the same number of values.

    With a file of names the values become named columns as well.
    """
    lines = _lines(spark, path)
    if max_rows is not None:
        lines = lines.filter(F.col("row_id") < max_rows)
    table = lines.select("row_id", F.transform(_tokens(), lambda t: t.cast("double")).alias("features"))
    width = table.agg(F.min(F.size("features")).alias("lo"), F.max(F.size("features")).alias("hi")).first()
    if width["lo"] != width["hi"]:
        raise ValueError(f"lines have {width['lo']} to {width['hi']} values")
    if names is not None:
        found = read_names(spark, names)
        if width["hi"] is not None and len(found) != width["hi"]:
            raise ValueError(f"{len(found)} names for {width['hi']} features")
        table = table.withColumns({n: F.col("features")[i] for i, n in enumerate(found)})
    return table


def _entries(tokens: Column, default: float | None) -> Column:
    """``index:value`` tokens as structs; a token without value gets ``default`` (or fails)."""

    def one(token: Column) -> Column:
        parts = F.split(token, ":")
        value = F.element_at(parts, 2) if default is None else F.try_element_at(parts, F.lit(2))
        value = value.cast("double")
        if default is not None:
            value = F.coalesce(value, F.lit(default))
        return F.struct(parts[0].cast("int").alias("index"), value.alias("value"))

    return F.transform(tokens, one)


def _keys(entries: Column) -> Column:
    return F.transform(entries, lambda e: e["index"])


def read_sparse(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """``(row_id, features MAP<INT, DOUBLE>)`` and the width from the ``sparse d`` header line.

    Values default to 1; an index twice in a line or outside the width is an error.
    """
    lines = _lines(spark, path, blank=True)  # an empty line is a row without entries
    header = lines.filter("row_id = 0").first()
    words = header["value"].split() if header else []
    if len(words) != 2 or words[0] != "sparse":
        raise ValueError("the first line must be: sparse <number of features>")
    width = int(words[1])
    tokens = F.filter(_tokens(), lambda t: t != "")
    # The header line is emptied rather than only filtered: it must never be parsed, whatever runs first.
    body = lines.withColumn("value", F.expr("IF(row_id = 0, '', value)"))
    rows = body.select((F.col("row_id") - 1).alias("row_id"), _entries(tokens, 1.0).alias("e")).filter("row_id >= 0")
    keys = _keys(F.col("e"))
    bad = rows.agg(
        F.count_if(F.size(F.array_distinct(keys)) < F.size(keys)).alias("repeated"),
        F.count_if(F.exists(keys, lambda k: k.isNull() | (k < 0) | (k >= width))).alias("outside"),
    ).first()
    if bad["repeated"] or bad["outside"]:
        raise ValueError(f"{bad['repeated']} lines repeat an index, {bad['outside']} have one outside 0..{width - 1}")
    return rows.select("row_id", F.map_from_entries("e").alias("features")), width


def read_labeled(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """``(row_id, [weight], [label], features, groups)`` of one of the labelled formats.

    Dense formats may mix plain values and sparse groups ``i:v|i:v``; each group is one map in
    ``groups``. Sparse formats have one map in ``features``. Values are cleaned, and of an index that
    occurs twice the first value is kept.
    """
    if fmt not in LABELED_FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {LABELED_FORMATS}")
    lines = _lines(spark, path).select("row_id", _tokens().alias("t"))
    lead = fmt.count(".")
    columns = ["row_id"]
    if fmt.startswith("w."):
        columns.append(F.col("t")[0].cast("double").alias("weight"))
    if lead:
        columns.append(F.col("t")[lead - 1].cast("double").alias("label"))
    body = F.slice("t", lead + 1, F.greatest(F.size("t") - lead, F.lit(0)))

    def to_map(entries: Column) -> Column:
        keys = _keys(entries)
        first = F.filter(entries, lambda e, i: F.array_position(keys, e["index"]) == i + 1)
        kept = F.when(F.size(F.array_distinct(keys)) < F.size(keys), first).otherwise(entries)
        return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["index"], clean_value(e["value"]))))

    if fmt.endswith("sparse"):
        return lines.select(*columns, to_map(_entries(body, None)).alias("features"))
    dense = F.filter(body, lambda t: ~t.contains(":"))
    groups = F.filter(body, lambda t: t.contains(":"))
    table = lines.select(
        *columns,
        F.transform(dense, clean_value).alias("features"),
        F.transform(groups, lambda g: to_map(_entries(F.split(g, r"\|"), None))).alias("groups"),
    )
    width = table.agg(F.min(F.size("features")).alias("lo"), F.max(F.size("features")).alias("hi")).first()
    if width["lo"] != width["hi"]:
        raise ValueError(f"lines have {width['lo']} to {width['hi']} dense values")
    return table


def _text(x: Column, digits: int | None) -> Column:
    return x.cast("string") if digits is None else F.format_string(f"%.{digits}f", x.cast("double"))


def write_table(df: DataFrame, path: str, fmt: str = "x", digits: int | None = None, n_features: int | None = None) -> None:
    """Write ``features`` (ARRAY or MAP) with optional ``weight`` and ``label`` as text, in ``row_id`` order.

    ``fmt`` is a labelled format, or ``header`` for a sparse file that starts with ``sparse d``. Sorting
    is by range, so a large table becomes many files whose names follow the row order.
    """
    kind = df.schema["features"].dataType.typeName()
    if fmt == "header":
        if n_features is None:
            raise ValueError("a sparse file with header needs n_features")
        lead: list[Column] = []
    else:
        lead = ([_text(F.col("weight"), digits)] if fmt.startswith("w.") else []) + (
            [_text(F.col("label"), digits)] if "." in fmt else []
        )
    if kind == "map":
        entries = F.array_sort(F.map_entries("features"))
        body = F.transform(entries, lambda e: F.concat(e["key"].cast("string"), F.lit(":"), _text(e["value"], digits)))
    else:
        body = F.transform("features", lambda x: _text(x, digits))
    parts = [*lead, F.array_join(body, " ")]
    if "groups" in df.columns:
        def group(g: Column) -> Column:
            items = F.array_sort(F.map_entries(g))
            return F.array_join(F.transform(items, lambda e: F.concat(e["key"].cast("string"), F.lit(":"), _text(e["value"], digits))), "|")

        parts.append(F.array_join(F.transform("groups", group), " "))
    line = F.concat_ws(" ", *parts)
    key = F.col("row_id").cast("bigint")
    lines = df.select(key.alias("row_id"), line.alias("value"))
    if fmt == "header":
        head = df.sparkSession.createDataFrame([(-(1 << 62), f"sparse {n_features}")], "row_id bigint, value string")
        lines = lines.unionByName(head)
    made = f"{ensure_checkpoint_dir(df.sparkSession)}/lines-{uuid.uuid4().hex}"
    lines.write.parquet(made)
    kept = df.sparkSession.read.schema(lines.schema).parquet(made)
    size = kept.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    ordered = kept.repartitionByRange(ranges, "row_id").sortWithinPartitions("row_id")
    ordered.select("value").write.mode("overwrite").text(path)


def write_scores(df: DataFrame, path: str, score: str = "score", digits: int = 6) -> None:
    """One score per line in ``row_id`` order."""
    df.orderBy("row_id").select(F.format_string(f"%.{digits}f", score).alias("value")).write.mode("overwrite").text(path)
