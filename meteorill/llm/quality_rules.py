"""Quality rules learned as a decision list over text statistics, applied as one Spark expression.

Sequential covering: a rule is grown, condition by condition, on two thirds of the labelled rows
by information gain, then cut back on the other third; rows it covers are set aside and the next
rule is grown on the rest. All labelled rows take part, and each step is one small aggregation over
their statistics. The list is emitted as ordered conditional branches.

Null and empty texts have no words: all their statistics are 0. Repeated rows count as often as
they occur. Without labels, or without a rule that is precise enough, the list is empty and keeps
every row. A row without statistics (null) fits no condition on them. Very long texts have large
statistics and nothing else. Conditions of equal gain are taken in the order of the statistics and thresholds. Only doc_id and
text of the documents are read, whatever further columns are called; an empty table has an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteorill.llm.tables import SPACE, let, stored, text_or_empty

#: Symbols that are rare in prose.
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def _repeated_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs more than once; `hashes` has one for each start."""

    def count(starts):
        widths = F.transform(starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))))
        return F.aggregate(widths, F.lit(0), lambda total, width: total + width)

    def twice(ordered):
        same = F.filter(ordered, lambda x, k: (F.get(ordered, k - 1)["h"] == x["h"]) | (F.get(ordered, k + 1)["h"] == x["h"]))
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), count)

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(ordered, twice))


def _word_counts(words: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    repeated = F.when(F.size(words) > WINDOW, let(hashes, _repeated_words)).otherwise(F.lit(0))
    return F.struct(
        F.size(words).alias("n_words"),
        F.length(F.array_join(words, "")).alias("word_chars"),
        repeated.alias("n_repeat_words"),
    )


def _only(kept: str) -> Column:
    """How many characters of the text are in the class `kept`."""
    return F.length(F.regexp_replace(text_or_empty(), f"[^{kept}]+", ""))


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, counts...) of every document's whole text, stored.

    Two windows are taken as equal if their 64-bit hashes are, which can fail only within one text.
    """
    text = text_or_empty()
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        "doc_id",
        let(F.array_remove(F.split(text, SPACE), ""), _word_counts).alias("of_words"),
        _only(SYMBOLS.replace("&", r"\&")).alias("n_symbols"),
        _only("A-Z").alias("n_capitals"),
        let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), F.size(F.array_distinct(x)).alias("n_distinct"))).alias("of_lines"),
    )
    return stored(counted).select(
        "doc_id",
        F.col("of_words.n_words").cast("long").alias("n_words"),
        F.col("of_words.word_chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.col("of_lines.n_lines") - F.col("of_lines.n_distinct")).cast("long").alias("n_dup_lines"),
        F.col("of_words.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("n_capitals").cast("long").alias("n_capitals"),
        F.col("of_lines.n_lines").cast("long").alias("n_lines"),
    )


#: What conditions may be about.
FEATURES = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "duplicate_line_share": "n_dup_lines / greatest(n_lines, 1)",
}


def features() -> list[Column]:
    return [F.expr(text).alias(name) for name, text in FEATURES.items()]


@dataclass(frozen=True)
class Condition:
    """`feature` at least the threshold, or below it."""

    feature: str
    threshold: float
    at_least: bool

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold!r}"


Rule = tuple[Condition, ...]


def fits(conditions: Iterable[Condition]) -> Column:
    column = F.lit(True)
    for condition in conditions:
        column = column & F.coalesce(condition.column(), F.lit(False))
    return column


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a row that any of them fits is rejected."""

    rules: tuple[Rule, ...]

    def rule_number(self) -> Column:
        """Place of the first rule that fits, from 1, else null."""
        number = F.lit(None).cast("int")
        for place, rule in reversed(list(enumerate(self.rules, 1))):
            number = F.when(fits(rule), F.lit(place)).otherwise(number)
        return number

    def sql(self) -> str:
        branches = (f"WHEN {' AND '.join(map(str, rule))} THEN false" for rule in self.rules)
        return f"CASE {' '.join(branches)} ELSE true END" if self.rules else "true"


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """Information gained on the positives by going from (p0, n0) to (p, n)."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best_condition(rows: DataFrame, features: list[str], thresholds: dict[str, list[float]]) -> tuple[Condition | None, float]:
    """The condition of most gain on `rows`, whose `bins` say how many thresholds each value reaches."""
    counted = (
        rows.select("bad", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("feature", "bin")
        .agg(F.sum(F.col("bad").cast("long")).alias("p"), F.count("*").alias("all"))
        .collect()
    )
    table: dict[int, list[tuple[int, int]]] = {f: [(0, 0)] * (len(thresholds[name]) + 1) for f, name in enumerate(features)}
    for row in counted:
        if row["bin"] is not None and row["bin"] >= 0:
            table[row["feature"]][row["bin"]] = (row["p"], row["all"] - row["p"])
    best, most = None, 1e-9
    for f, name in enumerate(features):
        p0, n0 = (sum(x) for x in zip(*table[f], strict=True))
        if not p0:
            continue
        below_p = below_n = 0
        for k, threshold in enumerate(thresholds[name]):
            below_p, below_n = below_p + table[f][k][0], below_n + table[f][k][1]
            for at_least, (p, n) in ((True, (p0 - below_p, n0 - below_n)), (False, (below_p, below_n))):
                if (gain := _gain(p, n, p0, n0)) > most:
                    best, most = Condition(name, threshold, at_least), gain
    return best, most


def _pruned(rule: Rule, rows: DataFrame) -> tuple[Rule, float, int]:
    """The shortest beginning of `rule` that is worth most on `rows`; its precision and cover there."""
    sums = []
    for length in range(1, len(rule) + 1):
        inside = fits(rule[:length])
        sums += [F.count_if(inside & F.col("bad")).alias(f"p{length}"), F.count_if(inside & ~F.col("bad")).alias(f"n{length}")]
    found = rows.agg(*sums).first()

    def worth(length):
        p, n = found[f"p{length}"], found[f"n{length}"]
        return (p - n) / (p + n) if p + n else -1.0

    length = max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))
    p, n = found[f"p{length}"], found[f"n{length}"]
    return rule[:length], p / (p + n) if p + n else 0.0, p + n


def learn(
    labelled: DataFrame, *, bins: int = 64, max_rules: int = 8, max_conditions: int = 4, min_precision: float = 0.9, min_cover: int = 4
) -> DecisionList:
    """The list learned from rows of statistics and `bad` (boolean; null rows are left out).

    Thresholds are quantiles of all labelled rows. Learning stops at a rule whose precision or
    cover on the pruning rows is too low.
    """
    names = list(FEATURES)
    rows = labelled.where("bad is not null").select("bad", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("part"), *features())
    rows = stored(rows)
    cuts = [k / bins for k in range(1, bins)]
    quantiles = rows.agg(*(F.percentile_approx(f, cuts, 10_000).alias(f) for f in names)).first()
    thresholds = {f: sorted(set(quantiles[f] or [])) for f in names}

    def binned(f):
        known = F.array(*(F.lit(t) for t in thresholds[f])).cast("array<double>")
        return F.size(F.filter(known, lambda t: F.col(f) >= t)).alias(f)

    rows = stored(rows.select("*", F.array(*(binned(f) for f in names)).alias("bins")))
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows.where(~DecisionList(tuple(rules)).rule_number().isNotNull())
        grow, prune = left.where("part < 2"), left.where("part = 2")
        rule: Rule = ()
        while len(rule) < max_conditions:
            condition, _ = _best_condition(grow.where(fits(rule)), names, thresholds)
            if condition is None:
                break
            rule += (condition,)
        if not rule:
            break
        rule, precision, cover = _pruned(rule, prune)
        if precision < min_precision or cover < min_cover:
            break
        rules.append(rule)
    return DecisionList(tuple(rules))


def base_failed() -> Column:
    """Too few words, or over a fifth of them in repeated windows: no rule has to be learned for that."""
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def judge(statistics: DataFrame, rules: DecisionList) -> DataFrame:
    """`statistics` with base_failed, rule (number of the first that fits) and kept."""
    judged = statistics.select("*", *features())
    return judged.select(
        *statistics.columns, base_failed().alias("base_failed"), rules.rule_number().alias("rule")
    ).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
