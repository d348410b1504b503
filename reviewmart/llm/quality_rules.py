"""Quality rules: a decision list learned from labelled text statistics by sequential covering.

Rules are conjunctions of thresholds on per-document statistics. Each is grown one condition at a
time on two thirds of the labelled rows, pruned on the last third, and taken if it is precise
enough there; the rows it covers are then set aside. The list becomes one conditional expression.
Labelled rows stay distributed: a step brings only counts per feature and bin to the driver.

A rule's support on the pruning third must be at least ``min_support`` junk rows and ``min_share`` of
its junk, and so many that junk's share among the rows left would bring them about with a
probability of ``chance`` at most: five pure rows where half of the rows are junk, two where a tenth is.

A null or empty text has no words, and texts of any length are measured whole. Repeated rows count
once each, in the labels' weight and in the result; of equally good conditions the first feature and
lowest limit wins. An empty table has no rows. Without labels (or without both classes) no rule is
learned and only the fixed limits decide.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmart.llm.common import as_doc, count_of, let, text_of, words
from reviewmart.llm.numbering import numbered
from reviewmart.workspace import cut

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_UPPER, _DIGITS, _MARKS, _STOPS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!?", ".,;:"
# What is not counted character by character.
_UNCOUNTED = f"[^{SYMBOLS}{_UPPER}{_DIGITS}{_MARKS}{_STOPS}]+"
_WORD_CHARACTER = r"[^\x20\x09-\x0D]"
# A place in an array takes so many bits at most.
_PLACE_BITS = 31
_PLACES = (1 << _PLACE_BITS) - 1


def _windows(hashes: Column) -> Column:
    """A 64-bit hash of each three-word window, from its words' hashes."""
    n = F.greatest(F.size(hashes) - 2, F.lit(0))
    return F.zip_with(
        F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, 2, n), lambda a, b: F.xxhash64(a, b)),
        F.slice(hashes, 3, n),
        lambda ab, c: F.xxhash64(ab, c),
    )


def _covered(windows: Column) -> Column:
    """Words that lie in a window found twice or more.

    Numbers made of a window's upper bits and its place are sorted first: numbers compare without
    being boxed, and windows that share these bits with none are out. Sorting the few others with
    their places puts equal ones side by side; the words that the repeated ones cover are then
    counted without overlap.
    """

    def paired(ordered: Column, key_of: Callable[[Column], Column]) -> Column:
        """Entries with the key of the one before or after them."""
        return F.filter(
            ordered,
            lambda entry, at: key_of(entry).eqNullSafe(key_of(F.get(ordered, at - 1)))
            | key_of(entry).eqNullSafe(key_of(F.get(ordered, at + 1))),
        )

    def candidates(ordered: Column) -> Column:
        found = paired(ordered, lambda number: F.shiftright(number, _PLACE_BITS))
        return F.transform(found, lambda number: number.bitwiseAND(_PLACES).cast("int"))

    def repeated(ordered: Column) -> Column:
        return paired(ordered, lambda entry: entry["key"])["at"]

    def spread(at: Column) -> Column:
        # The last one has none after it, and least() passes over nulls.
        steps = F.transform(at, lambda here, i: F.least(F.get(at, i + 1) - here, F.lit(3)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    packed = F.transform(
        windows, lambda key, at: key.bitwiseAND(~_PLACES).bitwiseOR(at.cast("long"))
    )
    places = let(F.sort_array(packed), candidates)
    placed = F.transform(places, lambda at: F.struct(F.get(windows, at).alias("key"), at.alias("at")))
    return let(F.sort_array(let(F.sort_array(placed), repeated)), spread)


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc`` and ``m``, a struct of counts over the whole text.

    Words, lines and windows are columns of their own on the way, so that each is made once, and
    characters are counted in what is left of the text without all others.
    """
    text, left = F.col("text"), F.col("left")
    split = docs.select(as_doc(docs), text_of(docs, text_col).alias("text")).select(
        "doc",
        "text",
        words(text).alias("words"),
        F.regexp_replace(text, _UNCOUNTED, "").alias("left"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD_CHARACTER)).alias("lines"),
    )
    counted = split.select(
        "doc",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count_of(left, SYMBOLS).alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        count_of(left, _UPPER).alias("n_upper"),
        count_of(left, _DIGITS).alias("n_digits"),
        count_of(left, _MARKS).alias("n_marks"),
        count_of(left, _STOPS).alias("n_stops"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    windowed = counted.withColumn("windows", _windows(F.col("hashes")))
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    return windowed.select(
        "doc",
        F.struct(
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            F.when(repeats, _covered(F.col("windows"))).otherwise(0).cast("long").alias("n_repeat_words"),
            "n_lines",
            "n_upper",
            "n_digits",
            "n_marks",
            "n_stops",
            F.size(F.array_distinct("hashes")).cast("long").alias("n_different"),
        ).alias("m"),
    )


def features(m: Column) -> dict[str, Column]:
    """What rules may test: sizes and shares, 0 where there is nothing to share."""

    def share(part: str, whole: str) -> Column:
        return F.when(m[whole] > 0, m[part] / m[whole]).otherwise(F.lit(0.0))

    return {
        "n_words": m["n_words"].cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols": share("n_symbols", "n_words"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "line_length": share("n_words", "n_lines"),
        "upper_case": share("n_upper", "word_chars"),
        "digits": share("n_digits", "word_chars"),
        "marks": share("n_marks", "n_words"),
        "stops": share("n_stops", "n_words"),
        "different_words": share("n_different", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def holds(self, values: dict[str, Column]) -> Column:
        return values[self.feature] > self.limit if self.above else values[self.feature] <= self.limit


Rule = tuple[Condition, ...]


def _matches(rule: Rule, values: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, (condition.holds(values) for condition in rule), F.lit(True))


def _precision(junk: int, good: int) -> float:
    """Share of junk, with one good row more than was seen."""
    return junk / (junk + good + 1)


def _by_chance(junk: int, good: int, rate: float) -> float:
    """The probability of at least ``junk`` among so many rows, if ``rate`` of all rows were junk."""
    if rate >= 1:
        return 1.0
    n = junk + good
    ways = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) for k in range(junk, n + 1)]
    return math.fsum(
        math.exp(way + k * math.log(rate) + (n - k) * math.log1p(-rate)) for k, way in enumerate(ways, junk)
    )


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds rejects."""

    rules: tuple[Rule, ...]

    def rule_number(self, m: Column) -> Column:
        """Place of the first rule that holds, from 1; 0 if none does."""
        values, verdict = features(m), None
        for place, rule in enumerate(self.rules, 1):
            test = _matches(rule, values)
            verdict = F.when(test, place) if verdict is None else verdict.when(test, place)
        return F.lit(0) if verdict is None else verdict.otherwise(0)


def fit(
    stats: DataFrame,
    bins: int = 32,
    max_rules: int = 12,
    max_conditions: int = 4,
    min_precision: float = 0.97,
    min_share: float = 0.002,
    min_support: int = 2,
    chance: float = 0.05,
) -> DecisionList:
    """Learn a decision list from ``m``, the boolean column ``junk`` and the text's ``key``, a row per
    labelled text.

    Thresholds are ``bins`` quantiles of each feature over all labelled rows. A rule needs
    ``min_precision`` on the pruning third, and the support there that the module names.
    """
    names = list(features(F.col("m")))
    known = stats.where(F.col("junk").isNotNull()).select(
        F.col("junk").cast("long").alias("junk"),
        F.xxhash64("key", "m").alias("draw"),
        *(value.alias(name) for name, value in features(F.col("m")).items()),
    )
    # Every third row of either class, in the order of a hash.
    placed = (
        numbered(known, F.col("junk"), F.col("draw"), name="place")
        .withColumn("prunes", F.col("place") % 3 == 0)
        .drop("place", "draw")
    )
    values = {name: F.col(name) for name in names}
    steps = [i / bins for i in range(1, bins)]
    first = placed.agg(
        F.sum(F.col("junk") * (~F.col("prunes")).cast("long")).alias("grow"),
        F.sum(F.col("junk") * F.col("prunes").cast("long")).alias("prune"),
        F.sum(1 - F.col("junk")).alias("good"),
        *(F.percentile_approx(name, steps, 10000).alias(name) for name in names),
    ).first()
    if not first["grow"] or not first["prune"] or not first["good"]:
        return DecisionList(())
    limits = {name: sorted(set(first[name])) for name in names}
    # Each row's bins are found once, not again in every step.
    bin_of = [
        reduce(lambda a, b: a + b, ((values[name] > limit).cast("int") for limit in limits[name]))
        for name in names
    ]
    rows = cut(placed.withColumn("bins", F.array(*bin_of)), "labelled-statistics")

    def best(left: Column, rule: Rule) -> tuple[float, Condition] | None:
        """The condition with the largest information gain on the rows that are left."""
        found = (
            rows.where(left & ~F.col("prunes") & _matches(rule, values))
            .select("junk", F.posexplode("bins").alias("feature", "bin"))
            .groupBy("feature", "bin")
            .agg(F.sum("junk").alias("junk"), F.sum(1 - F.col("junk")).alias("good"))
            .collect()
        )
        counts = {(row["feature"], row["bin"]): (row["junk"], row["good"]) for row in found}
        choice = None
        for place, name in enumerate(names):
            n = len(limits[name])
            per_bin = [counts.get((place, i), (0, 0)) for i in range(n + 1)]
            all_junk, all_good = (sum(column) for column in zip(*per_bin, strict=True))
            before = _precision(all_junk, all_good)
            low_junk = low_good = 0
            for i, limit in enumerate(limits[name]):
                low_junk, low_good = low_junk + per_bin[i][0], low_good + per_bin[i][1]
                for above, junk, good in (
                    (False, low_junk, low_good),
                    (True, all_junk - low_junk, all_good - low_good),
                ):
                    gain = _gain(junk, good, before)
                    if gain > 0 and (choice is None or gain > choice[0]):
                        choice = gain, Condition(name, above, limit)
        return choice

    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = ~reduce(lambda a, b: a | b, (_matches(r, values) for r in rules), F.lit(False))
        rule: Rule = ()
        while len(rule) < max_conditions and (step := best(left, rule)):
            rule = (*rule, step[1])
        if not rule:
            break
        tails = [rule[:n] for n in range(1, len(rule) + 1)]
        tried = rows.where(left & F.col("prunes")).agg(
            *(
                F.coalesce(F.sum(F.when(_matches(tail, values), part)), F.lit(0)).alias(f"{what}{n}")
                for n, tail in enumerate([*tails, ()])
                for what, part in (("junk", F.col("junk")), ("good", 1 - F.col("junk")))
            )
        ).first()
        *scores, (junk, good) = [(tried[f"junk{n}"], tried[f"good{n}"]) for n in range(len(tails) + 1)]
        support = max(min_support, min_share * first["prune"])
        fit_ones = [
            n
            for n, s in enumerate(scores)
            if s[0] >= support and s[0] >= min_precision * sum(s) and _by_chance(*s, junk / (junk + good)) <= chance
        ]
        if not fit_ones:
            break
        # The tail that removes the most junk for the good it costs; shorter ones win ties.
        rules.append(tails[max(fit_ones, key=lambda n: (scores[n][0] - 10 * scores[n][1], -n))])
    return DecisionList(tuple(rules))


def _gain(junk: int, good: int, before: float) -> float:
    """Bits saved on the junk that stays covered."""
    if not junk or not before:
        return 0.0
    return junk * (math.log2(_precision(junk, good)) - math.log2(before))


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """``docs`` that have a label, with their ``key`` and ``junk``: whether most of their labels are 0."""
    verdict = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("label_of"))
        .agg((F.avg(label) < 0.5).alias("junk"))
    )
    return docs.join(verdict, F.col(f"doc.{key}") == F.col("label_of")).withColumnRenamed("label_of", "key")


def judge(measured: DataFrame, rules: DecisionList) -> DataFrame:
    """Add ``base_failed``, ``rule`` (0: none) and ``kept`` to ``doc`` and ``m``."""
    m = F.col("m")
    failed = (m["n_words"] < MIN_WORDS) | (
        100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]
    )
    return measured.select(
        "doc", "m", failed.alias("base_failed"), rules.rule_number(m).alias("rule")
    ).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
