"""Helpers that the corpus operators share: landing, words, components, folds."""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Blanks between words: space and \x09 to \x0D, nothing else.
BLANK = r"[ \x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Links that one task of a round of ``components`` writes, two numbers or short keys each.
LINKS_PER_FILE = 100_000

_shipped: set[str] = set()
_landings: set[tuple[SparkSession, str]] = set()


def shared_root(spark: SparkSession) -> str:
    """A fresh folder for this application in the folder the cluster shares.

    A session that names no ``spark.checkpoint.dir`` is refused: a folder of one
    machine would lose rows on a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = f"{named.rstrip('/')}/corpus-{uuid.uuid4().hex}"
    _landings.add((spark, root))
    return root


def land(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage: an executor lost later costs nothing that was landed,
    and the planner sees real sizes.
    """
    spark = frame.sparkSession
    path = f"{shared_root(spark)}/{name}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def land_few(frame: DataFrame, name: str, rows: int) -> DataFrame:
    """Land a frame of ``rows`` rows at most in as few files as these need, however many partitions shuffles have."""
    return land(frame.coalesce(max(1, math.ceil(rows / LINKS_PER_FILE))), name)


def drop_landed(*frames: DataFrame) -> None:
    """Delete tables that ``land`` wrote, once all that reads them is written itself."""
    for frame in frames:
        spark = frame.sparkSession
        for root in {file.rsplit("/", 2)[0] for file in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def release(spark: SparkSession) -> None:
    """Delete what this application landed."""
    for owner, root in [entry for entry in _landings if entry[0] is spark]:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _landings.discard((owner, root))


def _release_all() -> None:
    for spark in {owner for owner, _ in _landings}:
        if spark.sparkContext._jsc is not None:
            release(spark)


atexit.register(_release_all)


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def bytes_of(text: Column) -> Column:
    """UTF-8 bytes of a text; none for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def crc_of(text: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def held_out(doc_id: Column) -> Column:
    """The fifth of all ids whose labels are never learned from; a null id is in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def let(value: Column, use) -> Column:
    """Bind an expression so that what uses it many times computes it once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def attach(rows: DataFrame, table: DataFrame, key: Column, on: str) -> DataFrame:
    """Inner join of rows to a landed table on ``key <=> table[on]``.

    The table's real size is known as it is landed: Spark sends it to all executors below
    its own threshold, and else shuffles both sides and splits the partitions of a hot key.
    """
    return rows.join(table, key.eqNullSafe(F.col(on)))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """Connected components of the undirected links (a, b): one row (node, root).

    ``root`` is the smallest node that can be reached.  Large-star and small-star
    rounds: each round points every node at the smallest node near it, so the
    number of rounds grows with the logarithm of the longest chain.  Minima are
    aggregated before they are joined back, so a node with very many links is
    never gathered in one task; each round is landed, in files that follow its links, as
    a few links in hundreds of partitions cost hundreds of tasks a step.  Links of a node
    to itself and null ends are ignored; no links give no rows.
    """
    edges = land(
        links.select("a", "b")
        .where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = _fingerprint_of(edges)
    while state[0]:
        near, most = _both_ways(edges), 2 * state[0]  # no step makes more rows
        low = land_few(near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "low", most)
        large = near.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = land_few(large.where("a <> b").distinct(), "large", most)
        low = land_few(large.groupBy("a").agg(F.min("b").alias("low")), "low", most)
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        edges = land_few(small.where("a <> b").distinct(), "small", most)
        after = _fingerprint_of(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _fingerprint_of(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)),
        F.expr("bit_xor(xxhash64(a, b))"),
        F.expr("sum(cast(xxhash64(b, a) as decimal(38, 0)))"),
    ).first()
    return tuple(row)
