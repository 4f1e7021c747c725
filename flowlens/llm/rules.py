"""Quality rules: text statistics in SQL, and a decision list learned from labels.

The list is an ordered set of conjunctions of thresholds, each of which rejects a
document.  Sequential covering finds them: a rule is grown condition by condition
on two thirds of the labelled rows, by information gain, pruned from its end on
the last third, and taken when it is pure there; the rows it covers are set aside
and the next one is grown.  What is learned is an ordinary Spark expression.

Every step of the search is one aggregation over the labelled rows, which hold a
bin number per statistic; the driver sees counts per (statistic, bin) only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import BLANK, held_out, land, let

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words

# What a rule may test: name -> expression over the columns of statistics().
MEASURES = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
}

BINS = 64
RULES, CONDITIONS = 8, 3
LEAST_COVER = 10  # labelled rows that a rule must cover while it grows
LEAST_PURITY = 0.8  # smoothed share of low-quality rows that it must have when pruned


def _repeated(hashes: Column) -> Column:
    """Words in windows found twice or more, from the hashes of all windows in order.

    Equal hashes are neighbours once sorted; each repeated window then adds the
    words that the repeated window before it does not already cover.
    """
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(rows: Column) -> Column:
        return F.filter(
            F.transform(
                rows,
                lambda row, k: F.when(
                    row["h"].eqNullSafe(F.get(rows, k - 1)["h"])
                    | row["h"].eqNullSafe(F.get(rows, k + 1)["h"]),
                    row["i"],
                ),
            ),
            lambda i: i.isNotNull(),
        )

    def covered(found: Column) -> Column:
        gaps = F.transform(
            found, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(i - F.get(found, k - 1), F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    return let(F.sort_array(let(placed, places)), covered)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each row's whole text; a null text has no words.

    n_words, word_chars (code points in words), n_symbols, n_lines (with a word),
    n_dup_lines (equal to an earlier line) and n_repeat_words (in five-word windows
    found twice or more).  Further columns are not read; repeated rows stay.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    split = docs.select(
        docs["doc_id"].alias("doc_id"),
        F.filter(F.split(text, BLANK), lambda word: word != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \x09-\x0D]")).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.element_at("words", i + k) for k in range(WINDOW)])

    last = F.size("words") - (WINDOW - 1)
    counted = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(last < 1, F.array().cast("array<bigint>"))
        .otherwise(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), window))
        .alias("windows"),
    )
    none = F.size(F.array_distinct("windows")) == F.size("windows")
    repeated = F.when(none, F.lit(0).cast("long")).otherwise(_repeated(F.col("windows")))
    return counted.withColumn("n_repeat_words", repeated).drop("windows")


def base_failed() -> Column:
    return F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words")


@dataclass(frozen=True)
class Condition:
    """``measure > bound`` or ``measure <= bound``."""

    measure: str
    above: bool
    bound: float

    @property
    def sql(self) -> str:
        return f"{MEASURES[self.measure]} {'>' if self.above else '<='} {self.bound!r}D"


@dataclass
class Rule:
    conditions: list[Condition] = field(default_factory=list)

    @property
    def sql(self) -> str:
        return " and ".join(f"({condition.sql})" for condition in self.conditions)


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def keeps(self) -> Column:
        """False under the first rule that holds, true where none does."""
        return reduce(
            lambda chain, rule: chain.when(F.expr(rule.sql), False),
            self.rules,
            F.when(F.lit(False), False),
        ).otherwise(True)


def labelled_bins(stats: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
    """Labelled rows with ``bad``, ``grow`` and each measure's bin, and the bins' bounds.

    Of several labels for an id the larger counts; held-out, null and unlabelled
    ids take no part.
    """
    marks = (
        labels.select(labels["doc_id"].alias("__id"), labels["quality"].cast("int").alias("__good"))
        .where("__good is not null")
        .where(~held_out(F.col("__id")))
        .groupBy("__id")
        .agg(F.max("__good").alias("__good"))
    )
    rows = stats.join(marks, F.col("doc_id") == F.col("__id")).select(
        (F.col("__good") == 0).alias("bad"),
        (F.pmod(F.xxhash64("__id"), F.lit(3)) < 2).alias("grow"),
        *[F.expr(sql).alias(name) for name, sql in MEASURES.items()],
    )
    rows = land(rows, "labelled")
    quantiles = [i / BINS for i in range(BINS + 1)]
    cuts = rows.agg(
        *[F.percentile_approx(name, quantiles, 10_000).alias(name) for name in MEASURES]
    ).first()
    # Halfway between neighbouring quantiles: a bound at a value itself would part
    # the labelled rows as well, but not the rows that lie a little beyond.
    values = {name: sorted(set(cuts[name] or [])) for name in MEASURES}
    bounds = {name: [(a + b) / 2 for a, b in zip(own, own[1:])] for name, own in values.items()}

    def bin_of(name: str) -> Column:
        """How many bounds lie below the value."""
        below = F.array(*[F.lit(float(bound)) for bound in bounds[name]]).cast("array<double>")
        return F.size(F.filter(below, lambda bound: bound < F.col(name))).cast("int").alias(name)

    return land(rows.select("bad", "grow", *[bin_of(name) for name in MEASURES]), "bins"), bounds


def _holds(condition: Condition, bounds: dict[str, list[float]]) -> Column:
    place = bounds[condition.measure].index(condition.bound)
    inside = F.col(condition.measure) > place if condition.above else F.col(condition.measure) <= place
    return inside


def _all(conditions: list[Condition], bounds: dict[str, list[float]]) -> Column:
    return reduce(lambda a, c: a & _holds(c, bounds), conditions, F.lit(True))


def _best_condition(rows: DataFrame, bounds: dict[str, list[float]]) -> tuple[Condition | None, bool]:
    """The condition with the largest information gain, and whether it leaves good rows."""
    cells = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("bin")) for n in MEASURES])
    counts = (
        rows.select("bad", F.explode(cells).alias("cell"))
        .groupBy("cell.measure", "cell.bin")
        .agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
        .collect()
    )
    best, gain, pure = None, 0.0, True
    for measure in MEASURES:
        bins = {row["bin"]: (row["bad"], row["good"]) for row in counts if row["measure"] == measure}
        bad, good = (sum(pair[i] for pair in bins.values()) for i in (0, 1))
        if not bad:
            continue
        before = math.log2(bad / (bad + good))
        below_bad = below_good = 0
        for place, bound in enumerate(bounds[measure]):
            more = bins.get(place, (0, 0))
            below_bad, below_good = below_bad + more[0], below_good + more[1]
            for above, p, n in ((False, below_bad, below_good), (True, bad - below_bad, good - below_good)):
                if p + n < LEAST_COVER or not p or p + n == bad + good:
                    continue
                now = p * (math.log2(p / (p + n)) - before)
                if now > gain + 1e-9:
                    best, gain, pure = Condition(measure, above, bound), now, n == 0
    return best, pure


def learn(stats: DataFrame, labels: DataFrame) -> DecisionList:
    """The decision list for low quality; an empty one without enough labels."""
    rows, bounds = labelled_bins(stats, labels)
    found = DecisionList()
    left = rows
    while len(found.rules) < RULES:
        conditions: list[Condition] = []
        while len(conditions) < CONDITIONS:
            grown = left.where("grow").where(_all(conditions, bounds))
            condition, pure = _best_condition(grown, bounds)
            if condition is None:
                break
            conditions.append(condition)
            if pure:
                break
        if not conditions:
            break
        prefixes = [conditions[: i + 1] for i in range(len(conditions))]
        counts = left.where("not grow").agg(
            *[
                F.count_if(_all(prefix, bounds) & (F.col("bad") if bad else ~F.col("bad")))
                for prefix in prefixes
                for bad in (True, False)
            ]
        ).first()
        value = [
            ((counts[2 * i] - counts[2 * i + 1]) / max(counts[2 * i] + counts[2 * i + 1], 1), -i)
            for i in range(len(prefixes))
        ]
        length = -max(value)[1]
        bad, good = counts[2 * length], counts[2 * length + 1]
        if (bad + 1) / (bad + good + 2) < LEAST_PURITY:
            break
        found.rules.append(Rule(prefixes[length]))
        left = left.where(~_all(prefixes[length], bounds))
    return found


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """statistics() of every row with ``base_failed`` and ``kept``."""
    stats = land(statistics(docs), "statistics")
    rules = learn(stats.where(~base_failed()), labels)
    return stats.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & rules.keeps()
    )
