"""Texts whose word shingles overlap: an exact set-similarity join by prefixes.

Two sets with a Jaccard similarity of 4/5 or more share an element among the first
n - ceil(4n/5) + 1 elements of each, whatever order all sets are sorted in.  So the
prefixes are postings, and texts that meet in one are candidates.  The order is by
hash, with shingles that a sample shows to be frequent last: the sample decides how
many candidates there are, never which pairs are found.  The sizes and the places of
a shared element bound the overlap further; then the whole sets are compared.

Most elements stand in one text only.  Bitmaps of a bounded size (``sieve``) tell so without
their rows being shuffled: one of the elements seen twice, one of the texts that share any.
What they let through is joined exactly.

Only components are wanted.  Each posting list has its smallest text as its head.  A text
is first held against the smallest of its lists' heads, which joins a large group of near
copies with one comparison a text; then against the other heads that are still in another
component; then against a centre of each list that is another for every list; then pairs of a
list are compared whose texts are still in different ones.
Pairs that another method proposes are compared first, and leave fewer texts apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import components, drop_landed, land
from flowlens.llm.sieve import dealt_whole, may_hold, sieve_of_column, sieve_of_repeated

SHINGLE = 5
SIMILARITY = (4, 5)  # Jaccard similarity of a link, as a fraction
SEED = 42
# One text in so many is looked at for frequent shingles; so many of these are put last.
SAMPLED = 16
FREQUENT = 50_000
_NO_WORDS = np.zeros(1, np.int64)


def shingles_of(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the word shingles, ascending; a text without words has one of its own."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return _NO_WORDS
    digest = xxhash.xxh64_intdigest
    count = max(1, len(words) - shingle + 1)
    found = (digest(b" ".join(words[i : i + shingle]), SEED) for i in range(count))
    return np.unique(np.fromiter(found, np.uint64, count).view(np.int64))


def least_overlap(sizes: int) -> int:
    """Common elements that sets of so many elements together must have."""
    over, under = SIMILARITY
    return -(-over * sizes // (over + under))


def key_of(text: Column) -> Column:
    """Names a text by 128 bits; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def in_sieve(rows: DataFrame, marks: DataFrame):
    """A predicate over 64-bit hashes that is true for all in ``marks``, and for few others."""
    sent = rows.sparkSession.sparkContext.broadcast(sieve_of_column(marks, "mark"))

    @F.pandas_udf(T.BooleanType())
    def held(hashes: pd.Series) -> pd.Series:
        return pd.Series(may_hold(sent.value, hashes.to_numpy(np.int64)))

    return held


class Chosen:
    """Which rows of a table are searched: all, or those whose ``mark`` a sieve may hold.

    The tasks that read the texts ask it themselves, so that no second worker sits before them.
    """

    def __init__(self, sent=None):
        self.sent = sent

    def of(self, marks: pa.Array | pd.Series) -> np.ndarray:
        if self.sent is None:
            return np.ones(len(marks), bool)
        return may_hold(self.sent.value, np.asarray(marks, dtype=np.int64))


def _frequent(docs: DataFrame, chosen: Chosen) -> dict[int, int]:
    """Ranks, from 1, of the shingles that most sampled texts have."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def tokens(texts: pd.Series, marks: pd.Series) -> pd.Series:
        none = np.zeros(0, np.int64)
        return pd.Series([shingles_of(text) if one else none for text, one in zip(texts, chosen.of(marks))])

    sampled = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    counts = sampled.select(F.explode(tokens("text", "mark")).alias("token")).groupBy("token").count()
    top = counts.where("count > 3").orderBy(F.desc("count"), "token").limit(FREQUENT).collect()
    return {row.token: rank for rank, row in enumerate(reversed(top), 1)}


def prefix_of(text: str | None, ranks: dict[int, int]) -> tuple[int, np.ndarray]:
    """The number of a text's shingles, and the first of them that a similar text must share one of."""
    own = shingles_of(text)
    n = len(own)
    rank = np.fromiter((ranks.get(token, 0) for token in own.tolist()), np.int64, n)
    over, under = SIMILARITY
    return n, own[np.argsort(rank, kind="stable")][: n - -(-over * n // under) + 1]


def _postings(docs: DataFrame, chosen: Chosen) -> DataFrame:
    """(token, key, n, pos) of the elements of texts' prefixes that another text may have too."""
    spark = docs.sparkSession.sparkContext
    known = spark.broadcast(_frequent(docs, chosen))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (batch["text"].filter(pa.array(chosen.of(batch["mark"]))).to_pylist() for batch in batches)
        yield from dealt_whole(prefix_of(text, known.value)[1] for some in texts for text in some)

    rows = docs.mapInArrow(seen, "block int, buckets binary")
    twice = spark.broadcast(sieve_of_repeated(rows))

    @F.pandas_udf("n int, tokens array<long>, places array<int>")
    def shared(texts: pd.Series, marks: pd.Series) -> pd.DataFrame:
        sizes, tokens, places = [], [], []
        for text, one in zip(texts, chosen.of(marks)):
            n, prefix = prefix_of(text, known.value) if one else (0, np.zeros(0, np.int64))
            at = np.flatnonzero(may_hold(twice.value, prefix))
            sizes.append(n)
            tokens.append(prefix[at])
            places.append(at.astype(np.int32))
        return pd.DataFrame({"n": pd.Series(sizes, dtype="int32"), "tokens": tokens, "places": places})

    rows = docs.select(key_of(docs["text"]).alias("key"), shared("text", "mark").alias("of"))
    rows = rows.select("key", "of.n", F.inline(F.arrays_zip("of.tokens", "of.places")))
    return rows.select(F.col("tokens").alias("token"), "key", "n", F.col("places").alias("pos")).distinct()


def _texts(docs: DataFrame, wanted: DataFrame, chosen: Chosen) -> DataFrame:
    """(key, packed) of each wanted text, compressed, one row however many copies there are."""
    marks = docs.sparkSession.sparkContext.broadcast(
        sieve_of_column(wanted.select(F.xxhash64("key").alias("mark")), "mark")
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            keep = may_hold(marks.value, np.asarray(batch["named"], dtype=np.int64)) & chosen.of(batch["mark"])
            kept = pa.Table.from_batches([batch]).filter(pa.array(keep))
            small = [pack(text) for text in kept["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [kept["key"].cast(pa.binary()).combine_chunks(), pa.array(small, pa.binary())],
                names=["key", "packed"],
            )

    rows = docs.select(key_of(docs["text"]).alias("key"), F.coalesce(docs["text"], F.lit("")).alias("text"), "mark")
    rows = rows.withColumn("named", F.xxhash64("key")).mapInArrow(packed, "key binary, packed binary")
    texts = rows.groupBy("key").agg(F.first("packed").alias("packed"))
    return texts.join(wanted.hint("merge"), "key", "left_semi")


@F.pandas_udf(T.BooleanType())
def _similar(left: pd.Series, right: pd.Series) -> pd.Series:
    unpack = zstandard.ZstdDecompressor().decompress
    last: tuple[bytes, np.ndarray] = (b"", _NO_WORDS)

    def linked(a: bytes, b: bytes) -> bool:
        nonlocal last
        # The pairs of one head arrive together, so it is cut into shingles once.
        if last[0] != a:
            last = (a, shingles_of(unpack(a).decode("utf-8")))
        one, other = last[1], shingles_of(unpack(b).decode("utf-8"))
        common = len(np.intersect1d(one, other, assume_unique=True))
        return common >= least_overlap(len(one) + len(other))

    return pd.Series([linked(a, b) for a, b in zip(left, right)], dtype=bool)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar; ``pairs`` are landed.

    Only texts that a sieve of the pairs' ends may hold are shuffled, whatever all texts are.
    """

    held = in_sieve(texts, pairs.select(F.explode(F.array(F.xxhash64("a"), F.xxhash64("b"))).alias("mark")))
    texts = texts.where(held(F.xxhash64("key")))
    left = texts.select(F.col("key").alias("a"), F.col("packed").alias("own"))
    right = texts.select(F.col("key").alias("b"), F.col("packed").alias("other"))
    joined = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    return joined.where(_similar("own", "other")).select("a", "b")


def _still_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    roots = land(roots, "roots")
    for end in ("a", "b"):
        own = roots.select(F.col("node").alias("of"), F.col("root").alias(f"root_{end}"))
        pairs = pairs.join(own.hint("merge"), F.col(end) == F.col("of"), "left").drop("of")
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    return land(pairs.where(apart).select("a", "b"), "apart")


def _may_reach(n: str, pos: str, other_n: str, other_pos: str) -> Column:
    """Whether sets whose first common element is at these places can be similar."""
    over, under = SIMILARITY
    a, b = F.col(n), F.col(other_n)
    rest = F.least(a - F.col(pos), b - F.col(other_pos))
    return rest * (over + under) >= (a + b) * over


def _mixed(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """The postings, with their texts' roots, of lists whose texts are in several components; landed."""
    roots = land(roots, "roots")
    placed = shared.join(roots.hint("merge"), shared["key"] == roots["node"], "left").select(
        "token", "key", "n", "pos", F.coalesce("root", "key").alias("root")
    )
    placed = land(placed, "placed")
    mixed = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = mixed.where("low <> high").select("token")
    left = land(placed.join(mixed.hint("merge"), "token", "left_semi"), "mixed")
    drop_landed(placed)
    return left


def _centred(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of each list's centre and its texts in other components.

    The centre is the text whose hash with the list's element is smallest.  So each list has
    another one, where heads of lists that share many texts are mostly one text, far from some.
    """
    chance = F.struct(F.xxhash64("token", "key").alias("chance"), "key", "n", "pos", "root")
    centres = mixed.groupBy("token").agg(F.min(chance).alias("centre")).select(
        "token", *[F.col(f"centre.{name}").alias(f"other_{name}") for name in ("key", "n", "pos", "root")]
    )
    pairs = mixed.join(centres.hint("merge"), "token").where(
        (F.col("root") != F.col("other_root")) & _may_reach("n", "pos", "other_n", "other_pos")
    )
    return pairs.select(F.least("key", "other_key").alias("a"), F.greatest("key", "other_key").alias("b")).distinct()


def similar_texts(docs: DataFrame, chosen: Chosen | None = None, proposed: DataFrame | None = None) -> DataFrame:
    """(node, root) of each text, named by ``key_of``, that is similar to a different one.

    With ``chosen``, only the rows whose ``mark`` it holds are searched.  ``proposed`` are landed
    pairs (a, b) of texts that another method found: they are compared first, and texts that
    those of them that are similar put into one component are not compared again.

    ``root`` is the smallest node of the component.  Texts are similar by the Jaccard
    similarity of their distinct five-word shingles, in lower case; a shorter text is
    one shingle, and texts without words are alike.  An empty table gives no rows.
    """
    chosen = chosen or Chosen()
    docs = docs.select(docs["text"].alias("text"), docs["mark"] if chosen.sent else F.lit(0).alias("mark"))
    postings = land(_postings(docs, chosen), "postings")
    lists = postings.groupBy("token").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    lists = land(lists.where("first <> last").select("token", "first"), "lists")
    shared = land(postings.join(lists.hint("merge"), "token"), "shared")
    drop_landed(postings, lists)

    # Pairs (head, text) of each list.
    head = shared.where("key = first").select(
        "token", F.col("key").alias("a"), F.col("n").alias("head_n"), F.col("pos").alias("head_pos")
    )
    stars = shared.where("key <> first").join(head.hint("merge"), "token")
    stars = stars.where(_may_reach("n", "pos", "head_n", "head_pos"))
    stars = land(stars.select("a", F.col("key").alias("b")).distinct(), "stars")

    # Any text of a shared list may be compared in the second round.
    texts = land(_texts(docs, land(shared.select("key").distinct(), "wanted"), chosen), "texts")

    links = None
    if proposed is not None:
        links = land(_verified(proposed, texts), "proposed_links")
        apart = _still_apart(stars, components(links))
        drop_landed(stars)
        stars = apart
    nearest = land(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "nearest")
    near = land(_verified(nearest, texts), "nearest_links")
    links = near if links is None else links.unionByName(near)
    links = links.unionByName(land(_verified(_still_apart(stars, components(links)), texts), "star_links"))
    left = _mixed(shared, components(links))
    met = land(_verified(land(_centred(left), "centred"), texts), "centre_links")
    drop_landed(left)
    links = links.unionByName(met)
    left = _mixed(shared, components(links))
    right = left.select(
        "token", *[F.col(name).alias(f"other_{name}") for name in ("key", "n", "pos", "root")]
    )
    pairs = left.join(right.hint("merge"), "token").where(
        (F.col("key") < F.col("other_key"))
        & (F.col("root") != F.col("other_root"))
        & _may_reach("n", "pos", "other_n", "other_pos")
    )
    pairs = land(pairs.select(F.col("key").alias("a"), F.col("other_key").alias("b")).distinct(), "pairs")
    found = land(_verified(pairs, texts), "pair_links")
    drop_landed(texts, shared, left, stars)
    return components(links.unionByName(found))
