"""Snapshots of a folder of tables: which version of each table is the current one.

Every write of a table goes to a folder of its own.  A snapshot is a small file that names
the folder of each table, with its schema and what was counted while it was written.
One pointer file names the current snapshot and is replaced last, in one step of the file
system, so a reader sees all tables of one build or all tables of the next, and a build
that fails leaves no trace in what is read.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "_current"
SNAPSHOTS = "_snapshots"


class NoSuchTable(KeyError):
    """The snapshot has no table of that name."""


@dataclass(frozen=True)
class Version:
    """A written table: its folder below the root, its schema and its counts."""

    folder: str
    schema: str
    counts: Mapping[str, int] = field(default_factory=dict)


class Files:
    """Small files and folders, through the file system that holds the root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._system = self.path("").getFileSystem(self._conf)

    def path(self, name: str):
        return self._fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        if not self._system.exists(self.path(name)):
            return None
        stream = self._system.open(self.path(name))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._system.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file aside and put it in place of the old one in one rename."""
        aside = f"{name}.{uuid.uuid4().hex}"
        self.write(aside, text)
        kinds = getattr(self._fs, "Options$Rename")
        overwrite = self.spark.sparkContext._gateway.new_array(kinds, 1)
        overwrite[0] = kinds.OVERWRITE
        context = self._fs.FileContext.getFileContext(self.path(name).toUri(), self._conf)
        context.rename(self._system.makeQualified(self.path(aside)), self._system.makeQualified(self.path(name)), overwrite)

    def names(self, name: str) -> list[str]:
        if not self._system.exists(self.path(name)):
            return []
        return [status.getPath().getName() for status in self._system.listStatus(self.path(name))]

    def remove(self, name: str) -> None:
        self._system.delete(self.path(name), True)


@dataclass(frozen=True)
class Snapshot:
    """Tables as one build left them; a reader that holds it is bound to these versions."""

    name: str
    tables: Mapping[str, Version]

    def open(self, spark: SparkSession, root: str, table: str) -> DataFrame:
        if table not in self.tables:
            raise NoSuchTable(table)
        version = self.tables[table]
        schema = T.StructType.fromJson(json.loads(version.schema))
        frame = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{version.folder}")
        return frame.select(*[f"`{name}`" for name in schema.names])


EMPTY = Snapshot("", {})


class Catalogue:
    """The snapshots below a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.files = Files(spark, root)

    def named(self, name: str) -> Snapshot:
        text = self.files.read(f"{SNAPSHOTS}/{name}.json")
        if text is None:
            raise NoSuchTable(f"no snapshot {name}")
        return Snapshot(name, {table: Version(**version) for table, version in json.loads(text).items()})

    def current(self) -> Snapshot:
        name = self.files.read(POINTER)
        return self.named(name) if name else EMPTY

    def commit(self, tables: Mapping[str, Version]) -> Snapshot:
        """Make these tables current beside all others that the current snapshot has."""
        merged = {**self.current().tables, **tables}
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        text = json.dumps({table: asdict(version) for table, version in sorted(merged.items())})
        self.files.write(f"{SNAPSHOTS}/{name}.json", text)
        self.files.replace(POINTER, name)
        return Snapshot(name, merged)

    def history(self) -> list[str]:
        """Names of all snapshots, oldest first."""
        return sorted(name.removesuffix(".json") for name in self.files.names(SNAPSHOTS) if name.endswith(".json"))

    def expire(self, keep: int = 2) -> list[str]:
        """Forget all but the last snapshots; delete the versions that none of these names.

        Versions of a build that is under way are in no snapshot yet, so this must not run
        beside one.  Returns the folders deleted.
        """
        if keep < 1:
            raise ValueError("the current snapshot must be kept")
        history = self.history()
        current = self.current().name
        kept = set(history[-keep:]) | {current}
        used = {version.folder for name in kept if name for version in self.named(name).tables.values()}
        gone = []
        for layer in self.files.names(""):
            if layer.startswith("_"):
                continue
            for table in self.files.names(layer):
                for version in self.files.names(f"{layer}/{table}"):
                    folder = f"{layer}/{table}/{version}"
                    if folder not in used:
                        self.files.remove(folder)
                        gone.append(folder)
        for name in history:
            if name not in kept:
                self.files.remove(f"{SNAPSHOTS}/{name}.json")
        return gone


class SnapshotSource:
    """Built tables of the snapshot that is current now; later builds do not reach it."""

    def __init__(self, spark: SparkSession, root: str, snapshot: str | None = None):
        self.spark, self.root = spark, root
        catalogue = Catalogue(spark, root)
        self.snapshot = catalogue.named(snapshot) if snapshot else catalogue.current()

    def table(self, name: str) -> DataFrame:
        return self.snapshot.open(self.spark, self.root, name)
