"""Rows by the place where they are stored: file after file in the order of their paths,
row after row inside a file.

A frame must come straight from a parquet reader, whose hidden ``_metadata`` columns give
the place.  No key is needed and nothing is sorted; the only thing counted is the rows of
each file, for which no column is read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from textloom.plans.checks import require_absent
from textloom.plans.lineage import durable
from textloom.plans.ordering import with_running_total
from textloom.plans.skew import lookup_join

MAX_SHIPPED_FILES = 50_000   # a list of at most so many files is broadcast; a longer one is joined
MAX_ORDERED_FILES = 99_999   # Spark numbers part files with five digits; one more and paths sort otherwise


def _place(df: DataFrame) -> tuple[Column, Column]:
    place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    try:
        df.select(*place)
    except AnalysisException as e:
        raise ValueError("rows have no stored place: pass a frame straight from a parquet reader") from e
    return place


def file_rows(df: DataFrame) -> DataFrame:
    """``(file, n, start)``: the rows of every file and the rows in all files before it."""
    path, _ = _place(df)
    counts = df.groupBy(path.alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return with_running_total(counts, "n", "file", name="start", index="file_idx").select("file", "n", "start")


def with_stored_index(df: DataFrame, name: str = "row_idx") -> DataFrame:
    """``df`` with the dense 0-based place of every row in stored order.  No row moves, unless
    there are too many files for their list to be broadcast."""
    require_absent(df, name, "__file", "__row")
    return _indexed(df, durable(file_rows(df), "files"), name)


def _indexed(df: DataFrame, files: DataFrame, name: str) -> DataFrame:
    path, row = _place(df)
    placed = df.select("*", path.alias("__file"), row.alias("__row"))
    starts = files.select(F.col("file").alias("__file"), F.col("start").alias("__start"), F.col("n").alias("__n"))
    if files.count() <= MAX_SHIPPED_FILES:
        joined = placed.join(F.broadcast(starts.drop("__n")), "__file")
    else:
        joined = lookup_join(placed, starts, ["__file"], "__n")
    return joined.withColumn(name, F.col("__start") + F.col("__row")).drop("__file", "__row", "__start")


def range_scan_stored(df: DataFrame, skip: int, take: int) -> DataFrame:
    """Rows ``skip`` .. ``skip + take - 1`` in stored order.

    Only the files that hold some of them are read: their paths are a range, and a range of
    paths is cut out when the scan is planned.  Rows of its first and last file are chosen
    by their place in the file.  Beyond the last row there is nothing.
    """
    if skip < 0 or take < 0:
        raise ValueError("skip and take must not be negative")
    path, row = _place(df)
    hit = file_rows(df).where((F.col("start") < skip + take) & (F.col("start") + F.col("n") > skip))
    ends = hit.agg(F.min(F.struct("file", "start")).alias("first"), F.max(F.struct("file", "start")).alias("last")).first()
    if take == 0 or ends["first"] is None:
        return df.where(F.lit(False))
    first, last = ends["first"], ends["last"]
    return df.where(
        (path >= first["file"]) & (path <= last["file"])
        & ((path > first["file"]) | (row >= skip - first["start"]))
        & ((path < last["file"]) | (row < skip + take - last["start"]))
    )


def zip_stored(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two tables without a common key, row by row in stored order.

    Tables of unequal length are an error, found from the files' row counts before any row
    is read.  Rows meet by their place, which is unique on both sides, so no task gets more
    than its share.  Columns must differ in name.
    """
    require_absent(left, *right.columns)
    files = [durable(file_rows(t), "files") for t in (left, right)]
    lengths = [f.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for f in files]
    if lengths[0] != lengths[1]:
        raise ValueError(f"tables of unequal length: {lengths[0]} and {lengths[1]} rows")
    a, b = (_indexed(t, f, "__idx") for t, f in zip((left, right), files))
    return a.join(b, "__idx").drop("__idx")


def write_in_order(df: DataFrame, path: str, *keys: Column | str, mode: str = "errorifexists") -> str:
    """Write ``df`` so that its stored order is that of ``keys``: ranges of them become files."""
    order = [F.col(k) if isinstance(k, str) else k for k in keys]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts > MAX_ORDERED_FILES:
        raise ValueError(f"at most {MAX_ORDERED_FILES} files sort by their numbers; there would be up to {parts}")
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)
    return path
