"""Publishing a table in versions that readers can rely on.

    <path>/data/v0000000003-<random>/   the files of a version
    <path>/versions/0000000003          its commit marker: version, folder, run, schema

A version exists once its marker is complete.  Data is written first, to a folder of its
own; the marker is created last and never overwritten, so a reader sees a whole version
or the one before, a broken run leaves only a folder that nobody reads, and of two
writers that want the same number one takes the next.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_DIGITS = 10


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    run: str | None
    schema: str


class _Store:
    """The few calls to Hadoop's file system that markers need."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.root = spark, path.rstrip("/")
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        where = self.path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(f"{self.root}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, content: str) -> bool:
        """False if the file is there already."""
        try:
            out = self.fs.create(self.path(f"{self.root}/{name}"), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(content.encode()))
        finally:
            out.close()
        return True


def _marker(store: _Store, name: str) -> Version | None:
    """A committed version; None for a marker that was never finished."""
    try:
        found = json.loads(store.read(f"versions/{name}"))
    except ValueError:
        return None
    return Version(found["version"], found["folder"], found["run"], found["schema"])


def _numbers(store: _Store) -> list[str]:
    return [n for n in store.names("versions") if n.isdigit() and len(n) == _DIGITS]


def published_versions(spark: SparkSession, path: str) -> list[Version]:
    """All committed versions, oldest first."""
    store = _Store(spark, path)
    return [v for v in (_marker(store, n) for n in _numbers(store)) if v]


def publish_version(df: DataFrame, path: str, run: str | None = None) -> int:
    """Write ``df`` as the next version of the table at ``path``; its number.

    With ``run``, the name of a job's run, a run that has been committed before is not
    written again: its version is returned, so a job can be started anew at any point.
    The input may be an earlier version of the same table.
    """
    store = _Store(df.sparkSession, path)
    taken = _numbers(store)
    if run is not None:
        for name in reversed(taken):
            done = _marker(store, name)
            if done and done.run == run:
                return done.number
    number = int(taken[-1]) + 1 if taken else 1
    folder = f"data/v{number:0{_DIGITS}d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{store.root}/{folder}")
    while True:
        content = {"version": number, "folder": folder, "run": run, "schema": df.schema.json()}
        if store.create(f"versions/{number:0{_DIGITS}d}", json.dumps(content)):
            return number
        number += 1  # another writer was faster


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest committed version, or a given one."""
    store = _Store(spark, path)
    for name in reversed(_numbers(store)) if number is None else [f"{number:0{_DIGITS}d}"]:
        found = _marker(store, name) if number is None or store.fs.exists(store.path(f"{store.root}/versions/{name}")) else None
        if found:
            schema = StructType.fromJson(json.loads(found.schema))
            return spark.read.schema(schema).parquet(f"{store.root}/{found.folder}")
    raise FileNotFoundError(f"no version {'' if number is None else number} at {path}".replace("  ", " "))
