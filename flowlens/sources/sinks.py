"""Stores for built tables: each is written once and read back by its users."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from flowlens.config import LayerConfig
from flowlens.sources.snapshots import Catalogue, Snapshot, Version

# Gives what was counted during a write, once the write is done.
Counted = Callable[[], Mapping[str, int]]

# Tables read through one equality predicate are sorted by that column inside
# each written partition (no shuffle), so row-group statistics skip the rest.
CLUSTERED = {
    "silver.issue_field_history": "field_id",
    "silver.issue_multiselect_history": "field_id",
}

# Tables split into folders by a column of few values that many readers filter on:
# reports on open issues skip the resolved ones, which are most of a long history.
PARTITIONED = {"gold.fct_issue": "is_resolved"}

# Tables with few rows per issue: bucketing them alike on the issue saves the
# shuffles of their joins.  History and worklog are left out, as one busy issue
# would make one bucket, and with it one task, far larger than the others.
ISSUE_KEYED = {
    "silver.issue": "id",
    "silver.sprint_issue": "issue_id",
    "silver.epic_issue": "issue_id",
    "gold.fct_issue": "issue_id",
}


# Stored tables are most of what a build has on disk: this codec makes them smaller than Spark's own choice.
COMPRESSION = "zstd"

# Whether the shuffle files of a query are deleted once it ends.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing = Lock()
# Sessions that write: how many writes are under way, and what the session said before them.
_writes: dict[SparkSession, tuple[int, str | None]] = {}


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun in here delete their shuffle files as they end.

    Otherwise these stay until the driver collects its garbage, and the shuffles of all tables
    of a build are on disk at once.  What a caller makes afterwards follows its own setting.
    """
    with _writing:
        count, before = _writes.get(spark) or (0, spark.conf.get(_FREED, None))
        _writes[spark] = (count + 1, before)
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _writing:
            count, before = _writes.pop(spark)
            if count > 1:
                _writes[spark] = (count - 1, before)
            elif before is None:
                spark.conf.unset(_FREED)
            else:
                spark.conf.set(_FREED, before)


def _writer(name: str, frame: DataFrame) -> DataFrameWriter:
    column = CLUSTERED.get(name)
    writer = (frame.sortWithinPartitions(column) if column else frame).write.mode("overwrite")
    writer = writer.option("compression", COMPRESSION)
    return writer.partitionBy(PARTITIONED[name]) if name in PARTITIONED else writer


class FolderStore:
    """Parquet folders below a root that all executors reach, in versions.

    ``save`` writes a table to a new folder and reads it back from there.  ``commit`` makes
    all tables saved since the last one current at once; until then other readers of the
    root (``SnapshotSource``) keep what they had, also where the build fails halfway.

    ``slices`` is how many parts, one written after the other, a large table may come in.
    """

    def __init__(self, spark: SparkSession, root: str, slices: int = 1):
        self.spark, self.root, self.slices = spark, root.rstrip("/"), slices
        self.catalogue = Catalogue(spark, root)
        self._saved: dict[str, Version] = {}
        self._lock = Lock()

    def save(
        self, name: str, frame: DataFrame, counted: Counted | None = None, further: Iterable[DataFrame] = ()
    ) -> DataFrame:
        """Write a table, of which ``further`` has the other slices, each after the one before."""
        folder = f"{name.replace('.', '/')}/{uuid.uuid4().hex}"
        with freeing_shuffles(self.spark):
            _writer(name, frame).parquet(f"{self.root}/{folder}")
            for part in further:
                _writer(name, part).mode("append").parquet(f"{self.root}/{folder}")
        version = Version(folder, frame.schema.json(), counted() if counted else {})
        with self._lock:
            self._saved[name] = version
        return Snapshot("", {name: version}).open(self.spark, self.root, name)

    def commit(self) -> Snapshot:
        with self._lock:
            snapshot = self.catalogue.commit(self._saved) if self._saved else self.catalogue.current()
            self._saved = {}
        return snapshot

    def counts(self, name: str) -> Mapping[str, int]:
        """What was counted while the table was written last, committed or not."""
        saved = self._saved.get(name) or self.catalogue.current().tables.get(name)
        return saved.counts if saved else {}


@dataclass(frozen=True)
class CatalogStore:
    """Catalog tables, with issue-keyed tables bucketed when a bucket count is set.

    A table is written under another name and takes its place once it is whole, so a write
    that fails leaves the old table.  Its counts are properties of the table.
    """

    spark: SparkSession
    config: LayerConfig
    buckets: int = 0

    def save(self, name: str, frame: DataFrame, counted: Counted | None = None) -> DataFrame:
        layer, table = name.split(".")
        target = self.config.table_name(layer, table)
        aside = self.config.table_name(layer, f"{table}__{uuid.uuid4().hex[:8]}")
        key = ISSUE_KEYED.get(name)
        if self.buckets and key:
            spread = frame.repartition(self.buckets, key)
            writer = _writer(name, spread).bucketBy(self.buckets, key).sortBy(key)
        else:
            writer = _writer(name, frame)
        try:
            with freeing_shuffles(self.spark):
                writer.saveAsTable(aside)
            counts = counted() if counted else {}
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {aside}")
            raise
        counts = json.dumps(dict(counts)).replace("'", "\\'")
        self.spark.sql(f"ALTER TABLE {aside} SET TBLPROPERTIES ('quality' = '{layer}', 'counts' = '{counts}')")
        self.spark.sql(f"DROP TABLE IF EXISTS {target}")
        self.spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")
        if name in PARTITIONED:
            # The catalog still has the folders of the old name.
            self.spark.sql(f"MSCK REPAIR TABLE {target} SYNC PARTITIONS")
        return self.spark.read.table(target).select(*frame.columns)

    def commit(self) -> None:
        """Tables take their places one by one as they are saved."""

    def counts(self, name: str) -> Mapping[str, int]:
        target = self.config.table_name(*name.split("."))
        if not self.spark.catalog.tableExists(target):
            return {}
        found = self.spark.sql(f"SHOW TBLPROPERTIES {target}").where("key = 'counts'").first()
        return json.loads(found.value) if found else {}
