"""Tables that are published together: a reader sees all of one version or all of another, never some of each.

A version is a folder of its own, in which all tables are written before anyone can see it. The file ``CURRENT`` beside the
versions names the one in force, with the schema of each table; it is replaced by a single rename, which the file system
must do in one step (HDFS and mounted file systems do). A publication that fails before this leaves the old version in
force, and one that has been renamed is complete. Readers resolve the name once, when they open the snapshot, and go on
reading that version whatever is published meanwhile, until ``drop_old`` deletes it.

One publisher at a time: the last rename wins.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ordermart.session import at_once, delete_path

POINTER = "CURRENT"


@dataclass
class Snapshot:
    """The tables of one version."""

    spark: SparkSession
    place: str
    version: str
    schemas: dict[str, str]

    def names(self, pattern: str = "*") -> list[str]:
        """Table names that match, letter case aside."""
        return sorted(n for n in self.schemas if fnmatchcase(n.lower(), pattern.lower()))

    def read(self, name: str) -> DataFrame | None:
        """A table by name, letter case aside; None if the version has none of it."""
        found = [n for n in self.schemas if n.lower() == name.lower()]
        if not found:
            return None
        schema = T.StructType.fromJson(json.loads(self.schemas[found[0]]))
        return self.spark.read.schema(schema).parquet(f"{folder_of(self.place, self.version)}/{found[0]}")


def folder_of(place: str, version: str) -> str:
    return f"{place.rstrip('/')}/versions/{version}"


def _path(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def open_snapshot(spark: SparkSession, place: str) -> Snapshot | None:
    """The version in force; None where nothing has been published."""
    path, system = _path(spark, f"{place.rstrip('/')}/{POINTER}")
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    return Snapshot(spark, place, found["version"], found["schemas"])


def _point(spark: SparkSession, place: str, version: str, schemas: dict[str, str]) -> None:
    """Put the version in force: the pointer is written beside the old one and takes its name in one step."""
    beside, system = _path(spark, f"{place.rstrip('/')}/{POINTER}-{version}")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(json.dumps({"version": version, "schemas": schemas}), "utf-8"))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    option = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    option[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context.rename(system.makeQualified(beside), system.makeQualified(_path(spark, f"{place.rstrip('/')}/{POINTER}")[0]), option)


def publish_snapshot(spark: SparkSession, tables: dict[str, DataFrame], place: str) -> Snapshot:
    """Write all tables as a new version and put it in force. A failed publication deletes what it has written."""
    version = uuid.uuid4().hex
    folder = folder_of(place, version)
    try:
        at_once(spark, {n: lambda n=n, df=df: df.write.parquet(f"{folder}/{n}") for n, df in tables.items()})
        _point(spark, place, version, {n: df.schema.json() for n, df in tables.items()})
    except Exception:
        now = open_snapshot(spark, place)
        if now is None or now.version != version:
            delete_path(spark, folder)
        raise
    return open_snapshot(spark, place)


def versions(spark: SparkSession, place: str) -> list[str]:
    """All versions that are still there, the newest last."""
    path, system = _path(spark, f"{place.rstrip('/')}/versions")
    if not system.exists(path):
        return []
    found = sorted((f.getModificationTime(), f.getPath().getName()) for f in system.listStatus(path))
    return [name for _, name in found]


def drop_old(spark: SparkSession, place: str, keep: int = 2) -> None:
    """Delete all versions but the one in force and the newest ``keep``; readers of those deleted end with them."""
    now = open_snapshot(spark, place)
    have = versions(spark, place)
    for version in have[: max(0, len(have) - keep)]:
        if now is None or version != now.version:
            delete_path(spark, folder_of(place, version))
