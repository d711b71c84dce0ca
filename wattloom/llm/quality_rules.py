"""Quality rules: text statistics, fixed base rules and a learned decision list.

All of it is DataFrame expressions. The list is learned by sequential covering: a rule for bad documents
grows one threshold condition at a time on two thirds of the labelled statistics and is pruned on the
rest; what it covers is taken out and the next rule grows. Each step is one small aggregate over the
labelled rows, a count per (statistic, bin, label); the driver sees only those counts. The result is an
ordered list of conjunctions, written as one conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.sources.tables import stage

# Labelled documents that the list is learned from: the first by a hash of their identifiers.
LABELLED = 20_000
BINS = 32
MAX_RULES, MAX_CONDITIONS = 8, 3
# A rule stands if, on rows it was not grown on, so large a share of what it covers is bad.
LEAST_PRECISION = 0.98
LEAST_COVER = 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"

_OWN = "__quality_"


def _per_word(name: str) -> Column:
    return F.coalesce(F.try_divide(F.col(name).cast("double"), F.col("n_words").cast("double")), F.lit(0.0))


def features() -> dict[str, Column]:
    """What conditions may speak of, over the base statistics."""
    return {
        "mean_word_chars": _per_word("word_chars"),
        "symbols_per_word": _per_word("n_symbols"),
        "repeat_share": _per_word("n_repeat_words"),
        "n_dup_lines": F.col("n_dup_lines").cast("double"),
        "n_words": F.col("n_words").cast("double"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the five base statistics of each whole text; a null text has none.

    Words in repeated windows: each 3-word window becomes a 64-bit hash, hashes are sorted together
    with their positions (as many high bits of the hash as the positions leave in 64 bits), neighbours
    with the same hash mark repeated windows, and marked positions cover up to three words each. So a
    text of n words costs n log n however often it repeats itself.
    """
    own = lambda name: F.col(_OWN + name)
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in BASE]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = lambda *names: [*rest, *(own(n) for n in names)]
    steps = docs.select(
        *rest,
        F.regexp_extract_all(text, F.lit(f"({NOT_SPACE}+)"), F.lit(1)).alias(_OWN + "words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE)).alias(_OWN + "lines"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("bigint").alias(_OWN + "symbols"),
    )
    words = own("words")
    steps = steps.select(
        *kept("words", "symbols"),
        (F.size("__quality_lines") - F.size(F.array_distinct(own("lines")))).cast("bigint").alias(_OWN + "dups"),
        F.length(F.array_join(words, "")).cast("bigint").alias(_OWN + "chars"),
        F.size(words).cast("bigint").alias(_OWN + "n"),
        # Bits for a position: those of the number of words.
        F.length(F.bin(F.size(words).cast("bigint"))).alias(_OWN + "bits"),
        F.transform(
            F.when(F.size(words) >= 3, F.slice(words, F.lit(1), F.size(words) - 2)).otherwise(F.array().cast("array<string>")),
            lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)),
        ).alias(_OWN + "hashes"),
    )
    steps = steps.select(
        *kept("symbols", "dups", "chars", "n", "bits", "hashes"),
        F.sort_array(
            F.transform(own("hashes"), lambda h, i: h.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("bigint"), own("bits"))).bitwiseOR(i.cast("bigint")))
        ).alias(_OWN + "sorted"),
    )

    def place(packed: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("bigint"), own("bits")) - 1
        return packed.bitwiseAND(low).cast("int")

    def same(one: Column, two: Column) -> Column:
        prefix = F.call_function("shiftright", one, own("bits")) == F.call_function("shiftright", two, own("bits"))
        full = F.get(own("hashes"), place(one)) == F.get(own("hashes"), place(two))
        return F.coalesce(prefix & full, F.lit(False))

    steps = steps.select(
        *kept("symbols", "dups", "chars", "n", "bits", "hashes"),
        F.filter(
            own("sorted"),
            lambda x, i: same(x, F.get(own("sorted"), i + 1)) | ((i > 0) & same(x, F.get(own("sorted"), i - 1))),
        ).alias(_OWN + "repeated"),
    )
    steps = steps.select(
        *kept("symbols", "dups", "chars", "n"), F.sort_array(F.transform(own("repeated"), place)).alias(_OWN + "starts")
    )
    covered = F.transform(own("starts"), lambda p, i: F.least(F.lit(3), F.coalesce(F.get(own("starts"), i + 1) - p, F.lit(3))))
    # A condition on the statistics must be checked on their values: pushed through the selections above, it
    # would be their whole definition many times over. Nothing is pushed through this one.
    here = F.spark_partition_id() >= 0
    return steps.select(
        *rest,
        F.when(here, own("n")).alias("n_words"),
        own("chars").alias("word_chars"),
        own("symbols").alias("n_symbols"),
        own("dups").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("bigint"), lambda total, x: total + x).alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered conjunctions; a document that meets one is bad."""

    rules: tuple[tuple[Condition, ...], ...]

    def rule_number(self) -> Column:
        """The number of the first rule that a document meets, from 1; null if it meets none."""
        number = F.lit(None).cast("int")
        for at in range(len(self.rules), 0, -1):
            met = reduce(Column.__and__, (c.column() for c in self.rules[at - 1]))
            number = F.when(met, F.lit(at)).otherwise(number)
        return number

    def __str__(self) -> str:
        return "\n".join(" AND ".join(map(str, rule)) for rule in self.rules)


def _gain(bad: int, good: int, bad_now: int, good_now: int) -> float:
    """FOIL's information gain of going from the first counts to the second."""
    if not bad_now:
        return 0.0
    return bad_now * (math.log2(bad_now / (bad_now + good_now)) - math.log2(bad / (bad + good)))


def _bin(cuts: list[float], value: Column) -> Column:
    """How many of the cuts lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda cut: cut < value))


def _in_bins(rule: list[tuple[int, bool, int]]) -> Column:
    return reduce(
        Column.__and__,
        (F.get("bins", F.lit(f)) > b if above else F.get("bins", F.lit(f)) <= b for f, above, b in rule),
        F.lit(True),
    )


def _grow(rows: DataFrame, cuts: list[list[float]]) -> list[tuple[int, bool, int]]:
    rule: list[tuple[int, bool, int]] = []
    while len(rule) < MAX_CONDITIONS:
        table = rows.where(_in_bins(rule)).select("bad", F.posexplode("bins").alias("f", "b")).groupBy("f", "b", "bad").count().collect()
        cells = {(r["f"], r["b"], r["bad"]): r["count"] for r in table}
        bad, good = (sum(n for (f, _, label), n in cells.items() if f == 0 and label is side) for side in (True, False))
        if not bad or not good:
            break
        best = (0.0, None)
        for f, feature_cuts in enumerate(cuts):
            low_bad = low_good = 0
            for b in range(len(feature_cuts)):
                low_bad += cells.get((f, b, True), 0)
                low_good += cells.get((f, b, False), 0)
                below, above = (low_bad, low_good), (bad - low_bad, good - low_good)
                for side, (p, n) in ((False, below), (True, above)):
                    if p >= LEAST_COVER and _gain(bad, good, p, n) > best[0] + 1e-9:
                        best = (_gain(bad, good, p, n), (f, side, b))
        if best[1] is None:
            break
        rule.append(best[1])
    return rule


def _prune(rows: DataFrame, rule: list[tuple[int, bool, int]]) -> tuple[list[tuple[int, bool, int]], int, int]:
    """The shortest beginning of the rule that does best on ``rows``, and what it covers there."""
    sums = []
    for k in range(1, len(rule) + 1):
        met = _in_bins(rule[:k])
        sums += [F.count(F.when(met & F.col("bad"), 1)), F.count(F.when(met & ~F.col("bad"), 1))]
    counted = list(rows.agg(*sums).first())
    ways = [(p / (p + n) if p + n else 0.0, -k, p, n) for k, (p, n) in enumerate(zip(counted[::2], counted[1::2]), 1)]
    _, k, p, n = max(ways)
    return rule[:-k], p, n


def learn(docs: DataFrame, labels: DataFrame, bad: Column, sample: int = LABELLED, id_col: str = "doc_id", text_col: str = "text") -> DecisionList:
    """A decision list from at most ``sample`` labelled documents; ``bad`` is a condition over ``labels``.

    The sample is the first by a hash of the identifier, so it is the same on every run and spread over
    the table. A document with several labels is bad if all of them say so. Null labels are left out;
    without labels the list is empty.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("label_id"), bad.alias("bad")).where("label_id IS NOT NULL AND bad IS NOT NULL")
    chosen = known.groupBy("label_id").agg(F.min("bad").alias("bad")).orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    # At most ``sample`` rows of nine bytes.
    texts = docs.select(F.col(id_col).cast("bigint").alias("label_id"), F.col(text_col).cast("string").alias("text"))
    labelled = texts.join(F.broadcast(stage(chosen, "quality-sample")), "label_id")
    values = stage(
        with_statistics(labelled)
        .where(~base_failed())
        .select("label_id", "bad", F.array(*features().values()).alias("values")),
        "labelled-statistics",
    )
    names = list(features())
    shares = [i / BINS for i in range(1, BINS)]
    found = values.agg(*(F.percentile_approx(F.get("values", F.lit(i)), shares, 10_000) for i in range(len(names)))).first()
    cuts = [sorted(set(x or [])) for x in found]
    if not any(cuts):
        return DecisionList(())
    bin_of = [_bin(c, F.get("values", F.lit(i))) for i, c in enumerate(cuts)]
    rows = stage(values.select("bad", F.array(*bin_of).alias("bins"), (F.pmod(F.xxhash64("label_id"), F.lit(3)) == 0).alias("held")), "labelled-bins")

    rules: list[list[tuple[int, bool, int]]] = []
    while len(rules) < MAX_RULES:
        left = reduce(DataFrame.where, (~_in_bins(r) for r in rules), rows)
        rule = _grow(left.where("NOT held"), cuts)
        if not rule:
            break
        rule, p, n = _prune(left.where("held"), rule)
        if p < LEAST_COVER or p / (p + n) < LEAST_PRECISION:
            break
        rules.append(rule)
    return DecisionList(tuple(tuple(Condition(names[f], above, float(cuts[f][b])) for f, above, b in rule) for rule in rules))


def quality(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """``docs`` with the base statistics, base_failed, rule (number of the learned rule met) and kept.

    Columns of ``docs`` with these names are replaced. A null or blank text has no words and fails.
    """
    own = {*BASE, "base_failed", "rule", "kept"}
    judged = with_statistics(docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in own)), text_col)
    return judged.withColumn("base_failed", base_failed()).withColumn("rule", rules.rule_number()).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )
