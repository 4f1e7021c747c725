"""Mix sources to target weights by Poisson replication.

Each source gets a rate: the repetitions a document of it has on average so that
the sources' shares of all text come to the target.  A document's count of copies
is a Poisson number with that mean, read off the inverse distribution at a point
that a hash of (seed, doc_id, text) fixes.  So documents are counted independently
of each other, without a shuffle, and always alike.  The copies are then put into
a global random order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import attach, land, let

SEED = "mix-1"
POWER = 0.5  # target shares are the sources' own shares to this power
# From this rate on the sum starts at a later term: exp(-rate) would no longer be exact.
LARGEST_RATE = 500.0


def unit(*parts: Column | str) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of the parts."""
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson(rate: Column, at: Column) -> Column:
    """Smallest count whose cumulative Poisson probability exceeds ``at``.

    The sum is folded term by term up to a count beyond which less than 1e-15 of
    the distribution lies (mean + 40 + 12 deviations); the fold stops changing
    once the count is found.  From ``LARGEST_RATE`` on the fold starts as far below
    the mean (12 deviations and 40, more than 100), where as little lies, at a term from
    logarithms.
    """
    large = rate >= LARGEST_RATE
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    low = F.greatest(F.lit(1), F.floor(rate - 12 * F.sqrt(rate) - 40).cast("int"))
    begin = F.when(large, low).otherwise(0)
    term = F.when(large, F.exp(_log_term(rate, low))).otherwise(F.exp(-rate))
    start = F.struct(begin.alias("count"), term.alias("term"), term.alias("sum"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * rate / k
        return F.when(
            state["sum"] <= at,
            F.struct(k.alias("count"), term.alias("term"), (state["sum"] + term).alias("sum")),
        ).otherwise(state)

    return F.aggregate(F.sequence(begin + 1, last), start, step)["count"]


def _log_term(rate: Column, count: Column) -> Column:
    """Logarithm of the Poisson probability of a count over 100, from Stirling's series.

    The series' first left-out term is below 1e-17 there.
    """
    n = count.cast("double")
    series = 1 / (12 * n) - 1 / (360 * n * n * n) + 1 / (1260 * n * n * n * n * n)
    # n * ln(rate / n) + n - rate is kept as one small number.
    away = (rate - n) / n
    return n * (F.log1p(away) - away) - 0.5 * F.log(2 * F.lit(math.pi) * n) - series

# Characters of text in one partition of the mixture, about.
PART_CHARACTERS = 64 << 20


def source_rates(
    docs: DataFrame, weights: dict[str, float] | None = None, power: float = POWER, budget: float = 1.0
) -> DataFrame:
    """(source, rate): mean copies of a document so that shares of text meet the target.

    Shares are of characters, one more per document than its text has.  Without
    ``weights`` the target is each source's own share to the ``power``; with them,
    sources that they do not name get none.  The mixture holds ``budget`` times the
    present text.  A null source is a source of its own.
    """
    return _rates(docs, weights, power, budget).select("source", "rate")


def _rates(docs: DataFrame, weights: dict[str, float] | None, power: float, budget: float) -> DataFrame:
    """(source, rate, mass): the rates with the characters that each source has now."""
    size = (F.coalesce(F.length(docs["text"]), F.lit(0)) + 1).cast("long")
    mass = docs.groupBy(docs["source"].alias("source")).agg(F.sum(size).alias("mass"))
    mass = land(mass, "masses")
    if weights is None:
        wanted = F.pow(F.col("mass").cast("double"), F.lit(float(power)))
    else:
        wanted = F.lit(0.0)
        for name, weight in weights.items():
            wanted = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(wanted)
    wished = mass.withColumn("wanted", wanted)
    # Two numbers, however many sources there are.
    present, wishes = wished.agg(F.sum("mass"), F.sum("wanted")).first()
    if not wishes:
        return wished.select("source", F.lit(0.0).alias("rate"), "mass")
    scale = budget * (present or 0) / wishes
    rate = F.col("wanted") * F.lit(float(scale)) / F.col("mass")
    return wished.select("source", rate.alias("rate"), "mass")


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    power: float = POWER,
    budget: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """All columns of ``docs`` for each copy, with ``mix_copy`` (from 1) and ``mix_order``.

    Rows come in ascending ``mix_order``, spread over all partitions.  Repeated
    rows have the same count each; null ids, texts and sources are hashed as
    the word null; no documents give no rows.  Columns of ``docs`` named like the
    two new ones are replaced, all others may have any name.
    """
    rates = _rates(docs, weights, power, budget).select(
        F.col("source").alias("of_source"), "rate", (F.col("rate") * F.col("mass")).alias("wished")
    )
    rates = land(rates, "rates")
    names = [name for name in docs.columns if name not in ("mix_copy", "mix_order")]
    # The row is one column on its way, so its names meet no others.
    rows = docs.select(
        F.struct(*[docs[f"`{name}`"] for name in names]).alias("row"),
        docs["source"].alias("source"),
        F.coalesce(docs["doc_id"].cast("string"), F.lit("null")).alias("shown"),
        F.md5(F.coalesce(docs["text"], F.lit("null"))).alias("content"),
    )
    counted = attach(rows, rates, F.col("source"), "of_source")
    point = unit(seed, F.col("shown"), F.col("content"))
    copies = let(point, lambda at: poisson(F.col("rate"), at))
    exploded = counted.withColumn("copies", copies).where("copies > 0").select(
        "row", "shown", "content", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("mix_copy")
    )
    order = unit(seed, F.lit("order"), F.col("shown"), F.col("content"), F.col("mix_copy").cast("string"))
    ordered = exploded.withColumn("mix_order", order).select("row", "mix_copy", "mix_order")
    # The order is uniform, so equal ranges of it are partitions of equal size:
    # no pass over the data is needed to find the bounds, and their number follows the text.
    wished = rates.agg(F.sum("wished")).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, math.ceil(wished / PART_CHARACTERS))
    place = F.floor(F.col("mix_order") * parts).cast("int")
    placed = ordered.repartitionById(parts, place).sortWithinPartitions("mix_order")
    return placed.select("row.*", "mix_copy", "mix_order")
