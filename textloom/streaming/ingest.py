"""The row-wise steps as streams over arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textloom.plans.lineage import discard, durable


def _source(spark: SparkSession, src: str, schema: StructType, glob: str | None, files_per_trigger: int) -> DataFrame:
    """Files of the folder ``src``; with ``glob``, those whose names match, or, if it is a plain name,
    the table of that name, stored as one file or as a folder of files."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob and any(c in glob for c in "*?[{\\"):
        return reader.option("pathGlobFilter", glob).parquet(src)
    # braces make a pattern of a plain name; a path without one would have to be a folder
    return reader.parquet(f"{src.rstrip('/')}/{{{glob}}}" if glob else src)


def _sink(df: DataFrame, dst: str, checkpoint: str, once: bool) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(dst)


def stream_filter(
    spark: SparkSession, src: str, dst: str, checkpoint: str, schema: StructType,
    transform: Callable[[DataFrame], DataFrame], glob: str | None = None, once: bool = True,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Apply a row-wise ``transform`` to documents as their files arrive.

    The transform is the same function a batch job uses; the sink is exactly-once
    through its checkpoint.  ``once`` handles what is there and stops.
    """
    return _sink(transform(_source(spark, src, schema, glob, files_per_trigger)), dst, checkpoint, once)


def _write_part(df: DataFrame, dst: str, batch_id: int) -> None:
    """The rows of one micro-batch; a replayed batch writes over what it left before."""
    df.write.mode("overwrite").parquet(f"{dst}/batch_id={batch_id}")


def stream_split(
    spark: SparkSession, src: str, kept: str, rejects: str, checkpoint: str, schema: StructType,
    score: Callable[[DataFrame], DataFrame], keep: Column, glob: str | None = None, once: bool = True,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Score documents as their files arrive, and part them into two tables.

    ``score`` is any function of a frame that a batch job uses, joins and models included; each
    micro-batch runs through it once, is stored, and is then written to ``kept`` where
    ``keep`` holds and to ``rejects`` where it does not (or is null).  Both tables are
    partitioned by ``batch_id``; a batch that is replayed after a failure has the same rows and
    the same number and replaces its own part, so every document ends in exactly one table, once.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        scored = durable(score(batch), "scored")
        good = F.coalesce(keep, F.lit(False))
        _write_part(scored.where(good), kept, batch_id)
        _write_part(scored.where(~good), rejects, batch_id)
        discard(scored)

    rows = _source(spark, src, schema, glob, files_per_trigger)
    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_distinct_urls(
    spark: SparkSession, src: str, dst: str, checkpoint: str, schema: StructType, url_col: str = "url",
    extract: Callable[[DataFrame], DataFrame] | None = None, glob: str | None = None, once: bool = True,
    files_per_trigger: int = 1000, arrival_col: str | None = None, forget_after: str = "30 days",
) -> StreamingQuery:
    """Pass each URL on the first time it is seen, across micro-batches.

    The state holds every URL seen; with ``arrival_col`` it is limited to
    ``forget_after``, at the price of passing an older URL again.
    """
    rows = _source(spark, src, schema, glob, files_per_trigger)
    rows = extract(rows) if extract else rows
    if arrival_col:
        unique = rows.withWatermark(arrival_col, forget_after).dropDuplicatesWithinWatermark([url_col])
    else:
        unique = rows.select(url_col).dropDuplicates([url_col])
    return _sink(unique, dst, checkpoint, once)
