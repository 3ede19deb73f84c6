"""Small file-system helpers on Hadoop's FileSystem, so any cluster storage works."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _at(spark, path)
    return system.exists(location)


def names(spark: SparkSession, path: str) -> list[str]:
    system, location = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(location)) if system.exists(location) else []


def remove(spark: SparkSession, path: str) -> None:
    system, location = _at(spark, path)
    system.delete(location, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to ``target``; what was there, of either kind, is set aside until the move is done."""
    system, location = _at(spark, source)
    _, destination = _at(spark, target)
    system.mkdirs(destination.getParent())
    aside = None
    if system.exists(destination):
        aside = spark._jvm.org.apache.hadoop.fs.Path(destination.getParent(), f"_replaced-{destination.getName()}")
        system.delete(aside, True)
        system.rename(destination, aside)
    if not system.rename(location, destination):
        if aside:
            system.rename(aside, destination)
        raise OSError(f"could not move {source} to {target}")
    if aside:
        system.delete(aside, True)


class Snapshots:
    """Full versions of a table as folders ``version=N``; Spark's ``_SUCCESS`` file commits one.

    A replayed batch overwrites its own version, so a rerun changes nothing. Every version is
    a full copy: meant for tables that are rewritten anyway. Large keyed tables that take
    small batches belong in an append-only log (``streaming.changes.upsert_stream``).
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, version: int) -> str:
        return f"{self.folder}/version={version}"

    def versions(self) -> list[int]:
        found = [int(n.split("=")[1]) for n in names(self.spark, self.folder) if n.startswith("version=")]
        return sorted(v for v in found if exists(self.spark, f"{self.path(v)}/_SUCCESS"))

    def committed_at(self) -> dict[int, datetime]:
        """When each version was committed (UTC): the time of its ``_SUCCESS`` file."""
        found = {}
        for version in self.versions():
            system, location = _at(self.spark, f"{self.path(version)}/_SUCCESS")
            millis = system.getFileStatus(location).getModificationTime()
            found[version] = datetime.fromtimestamp(millis / 1000, timezone.utc)
        return found

    def history(self) -> DataFrame:
        """(version, committed_at), one row for each version that is still there."""
        rows = [(v, at) for v, at in self.committed_at().items()]
        return self.spark.createDataFrame(rows, "version int, committed_at timestamp")

    def read_at(self, when: datetime) -> DataFrame:
        """The table as it was committed at a time (TIMESTAMP AS OF): the newest version not later than that."""
        if when.tzinfo is None:
            when = when.replace(tzinfo=timezone.utc)
        earlier = [v for v, at in self.committed_at().items() if at <= when]
        if not earlier:
            raise ValueError(f"no version of {self.folder} was committed by {when}")
        return self.read(earlier[-1])

    def read(self, version: int | None = None) -> DataFrame:
        """The latest version, or the one asked for (VERSION AS OF)."""
        versions = self.versions()
        if version is None:
            version = versions[-1]
        elif version not in versions:
            raise ValueError(f"no version {version} in {self.folder}")
        return self.spark.read.parquet(self.path(version))

    def write(self, df: DataFrame, version: int | None = None) -> int:
        if version is None:
            version = (self.versions() or [-1])[-1] + 1
        df.write.mode("overwrite").parquet(self.path(version))
        return version

    def restore(self, version: int) -> int:
        """Make an old version the newest one."""
        return self.write(self.read(version))
