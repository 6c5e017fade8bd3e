"""Where rows come from: tables, metadata files, listings, text dumps."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BOOK_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("downloads", T.MapType(T.StringType(), T.StringType())),
        T.StructField("filename", T.StringType()),
    ]
)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; a missing path gives one clear error and no stack of causes."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise FileNotFoundError(f"no table at {path}") from None
        raise


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """One split.  On a table partitioned by ``split_col`` only its folder is listed."""
    return read_table(spark, path).where(F.col(split_col) == split)


def read_metadata_json(spark: SparkSession, path: str) -> DataFrame:
    """Book records from a JSON array or JSON lines; a malformed file stops the run."""
    reader = spark.read.schema(BOOK_SCHEMA).option("mode", "FAILFAST")
    head = spark.read.text(path, wholetext=False).where(F.trim("value") != "").limit(1).first()
    is_array = head is not None and head[0].lstrip("\ufeff \t").startswith("[")
    return reader.option("multiLine", is_array).json(path)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, name, length)`` of files whose name matches; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def read_sentences(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Gzip text, one sentence per line.  A gzip file is read by one task, so the
    rows are spread again before any later work: evenly by size, or over a given
    number of partitions."""
    lines = spark.read.text(path).withColumnRenamed("value", "text")
    return lines.repartition(partitions) if partitions else lines.hint("rebalance")


def rename_text(df: DataFrame, column: str, text_col: str = "text") -> DataFrame:
    return df.withColumnRenamed(column, text_col)
