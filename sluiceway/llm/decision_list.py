"""Quality rules: decision lists learned from labelled statistics.

Sequential covering: a rule is a conjunction of thresholds on numeric statistics. It is grown on
two thirds of the labelled rows (each step adds the threshold with the best FOIL gain), pruned from
its end on the other third, and kept if it is precise on all of them and not refuted by the pruning third; the rows that it covers leave, and the
next rule is learned, until none is precise enough. The list is emitted as one ordered Spark conditional expression.

Every step is one aggregation over the labelled statistics: rows are counted per (statistic, bin of
its quantiles), a few hundred numbers whatever the number of rows, and every threshold is judged
from those counts. Quantiles come from a histogram with 64 steps an octave, whose counts don't depend on the order
of rows, so reruns learn the same list. Text statistics are array expressions within the row; no word leaves its row, so
nothing is shuffled but labels.

Defined results: a null text has no words; a null statistic meets no threshold; rows without a label
don't teach; without labelled rows of both kinds the list is empty and keeps everything; repeated
rows count as often as they stand; texts of any length are counted whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import settle, whole_text

WORD = r"[^\x20\x09-\x0D]+"


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and statistics of every whole text.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word that equal
    an earlier one), n_repeat_words (words in three-word windows found twice or more), and the
    counts n_upper, n_digits, n_ended (words that end a sentence), n_lines.

    Repeats are found by sorting the windows' hashes with their places inside the row, so the work
    is that of a sort of the row's words.
    """
    body = whole_text(text)
    rows = docs.select("doc_id", body.alias("body"))
    rows = rows.select(
        "doc_id", "body", F.regexp_extract_all("body", F.lit(WORD), F.lit(0)).alias("words")
    )
    n = F.size("words")
    filled = F.filter(F.split("body", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    window = F.when(
        n >= 3,
        F.expr(
            "transform(sequence(0, size(words) - 3), i -> struct("
            "xxhash64(words[i], words[i + 1], words[i + 2]) AS h, i AS at))"
        ),
    )
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        (F.length("body") - _count_of("body", " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        _count_of("body", "#*$%&|<>").alias("n_symbols"),
        _count_of("body", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _count_of("body", "0123456789").alias("n_digits"),
        F.regexp_count("body", F.lit(r"[.!?](?=[\x20\x09-\x0D]|\z)")).cast("long").alias("n_ended"),
        filled.alias("lines"),
        F.sort_array(window).alias("sorted"),
    )
    # Neighbours of equal hash are repeats; each place may stand twice, array_distinct settles it.
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("sorted") > 1,
            F.expr(
                "size(array_distinct(flatten(transform(flatten(zip_with(slice(sorted, 1, size(sorted) - 1),"
                " slice(sorted, 2, size(sorted) - 1), (a, b) -> if(a.h = b.h, array(a.at, b.at),"
                " cast(array() as array<int>)))), p -> array(p, p + 1, p + 2)))))"
            ),
        )
        .otherwise(0)
        .cast("long")
        .alias("n_repeat_words"),
        "n_upper",
        "n_digits",
        "n_ended",
        F.size("lines").cast("long").alias("n_lines"),
    )


def _count_of(text: str, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


@dataclass(frozen=True)
class Threshold:
    """``statistic`` <= or > ``at``."""

    statistic: str
    above: bool
    at: float

    def column(self) -> Column:
        here = F.col(self.statistic)
        return F.coalesce(here > self.at if self.above else here <= self.at, F.lit(False))


@dataclass(frozen=True)
class Rule:
    """A conjunction of thresholds; ``precision`` on the labelled rows that earlier rules left."""

    conditions: tuple[Threshold, ...]
    precision: float

    def column(self) -> Column:
        return _all(self.conditions)


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds decides."""

    rules: tuple[Rule, ...] = field(default=())

    def rejects(self) -> Column:
        """True where a rule holds, as one ordered conditional expression."""
        made = None
        for rule in self.rules:
            made = F.when(rule.column(), True) if made is None else made.when(rule.column(), True)
        return F.lit(False) if made is None else made.otherwise(False)

    def which(self) -> Column:
        """The place of the first rule that holds, from 1; null where none does."""
        made = F.lit(None).cast("int")
        for i in range(len(self.rules), 0, -1):
            made = F.when(self.rules[i - 1].column(), i).otherwise(made)
        return made


def _all(conditions: Sequence[Threshold]) -> Column:
    made = F.lit(True)
    for c in conditions:
        made = made & c.column()
    return made


def learn(
    labelled: DataFrame,
    statistics: Sequence[str],
    bad: str = "bad",
    key: str = "doc_id",
    bins: int = 32,
    min_precision: float = 0.9,
    min_covered: int = 10,
) -> DecisionList:
    """Learn a list that rejects rows with ``bad``.

    ``labelled`` holds the statistics and the boolean ``bad``. A rule stays if its precision among all
    rows that are left (with Laplace's correction) reaches ``min_precision``, its plain precision among the pruning ones does too, and it
    covers ``min_covered`` rows in all; the list ends at the first that doesn't. A rule has as many
    conditions as gain something.
    """
    third = F.pmod(F.xxhash64(key, F.lit("prune")), F.lit(3)) == 0
    rows = settle(
        labelled.where(F.col(bad).isNotNull()).select(
            *[F.col(s).cast("double").alias(s) for s in statistics],
            F.col(bad).cast("int").alias("bad"),
            third.alias("prunes"),
        ),
        "labelled-statistics",
    )
    cuts = _quantiles(rows, statistics, bins)
    seen = rows.agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("all")).first()
    if not seen["bad"] or seen["bad"] == seen["all"]:
        return DecisionList()
    rules: list[Rule] = []
    while True:
        left = rows.where(~DecisionList(tuple(rules)).rejects())
        grown = _grow(left.where("NOT prunes"), cuts)
        rule = grown and _prune(left, grown, min_covered, min_precision)
        if not rule or rule.precision < min_precision:
            return DecisionList(tuple(rules))
        # It covers rows, and they leave: the list comes to an end.
        rules.append(rule)


def _quantiles(rows: DataFrame, statistics: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Per statistic the values at ``bins`` equal shares of all rows and of the bad ones.

    From a histogram: values of one 64th of an octave share a step, whose largest value stands for it. Steps are
    few whatever the rows, and neither their counts nor their largest values depend on the order of rows.
    """
    value = F.col("value")
    octave = F.floor(F.log2(F.abs(value)) * 64)
    step = F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * (octave + F.lit(100_000)))
    entries = F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).alias("value")) for s in statistics])
    # Other than finite values set no threshold.
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    steps = (
        rows.select("bad", F.inline(entries))
        .where(finite)
        .groupBy("statistic", step.cast("long").alias("step"))
        .agg(F.max("value").alias("top"), F.count(F.lit(1)).alias("all"), F.sum("bad").alias("bad"))
        .collect()
    )
    cuts: dict[str, set[float]] = {s: set() for s in statistics}
    for s in statistics:
        own = sorted((r.top, r["all"], r.bad) for r in steps if r.statistic == s)
        for counts in ([n for _, n, _ in own], [n for _, _, n in own]):
            total, before, share = sum(counts), 0, 1
            for (top, _, _), n in zip(own, counts):
                before += n
                if share < bins and before * bins >= share * total and n:
                    cuts[s].add(top)
                    share = before * bins // total + 1
    return {s: sorted(c) for s, c in cuts.items()}


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, dict[int, tuple[int, int]]]:
    """(bad, good) rows per statistic and bin; bin i holds cuts[i - 1] < value <= cuts[i]."""
    places = [
        F.struct(
            F.lit(s).alias("statistic"),
            F.when(F.col(s).isNotNull(), sum((F.col(s) > c).cast("int") for c in at)).alias("bin"),
        )
        for s, at in cuts.items()
        if at
    ]
    counted = (
        rows.select("bad", F.explode(F.array(*places)).alias("p"))
        .groupBy("p.statistic", "p.bin")
        .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
        .where("bin IS NOT NULL")
        .collect()
    )
    made: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counted:
        made.setdefault(r.statistic, {})[r.bin] = (r.bad, r.good)
    return made


def _grow(rows: DataFrame, cuts) -> list[Threshold]:
    """Thresholds in the order of their adding, each the one of largest FOIL gain, while there is a gain."""
    grown: list[Threshold] = []
    while True:
        counts = _counts(rows.where(_all(grown)), cuts)
        totals = [(sum(b for b, _ in c.values()), sum(g for _, g in c.values())) for c in counts.values()]
        bad, good = max(totals, default=(0, 0))
        if not bad or not good:
            break
        start, best = math.log2(bad / (bad + good)), (0.0, None)
        for s in sorted(counts):
            for i, at in enumerate(cuts[s]):
                b = sum(n for k, (n, _) in counts[s].items() if k <= i)
                g = sum(n for k, (_, n) in counts[s].items() if k <= i)
                in_all = [sum(x) for x in zip(*counts[s].values())]
                for above, p, q in ((False, b, g), (True, in_all[0] - b, in_all[1] - g)):
                    if p:
                        gain = p * (math.log2(p / (p + q)) - start)
                        if gain > best[0] + 1e-9:
                            best = (gain, Threshold(s, above, at))
        if best[1] is None:
            break
        grown.append(best[1])
    return grown


def _prune(rows: DataFrame, grown: list[Threshold], min_covered: int, min_precision: float) -> Rule | None:
    """The prefix of ``grown`` that is best on the pruning rows, by (p - n) / (p + n), with its precision on all rows.

    Prefixes that cover too few rows, or that the pruning rows refute, don't count.
    """
    tests = []
    for k in range(1, len(grown) + 1):
        holds = _all(grown[:k])
        for name, part in (("p", F.col("bad")), ("n", 1 - F.col("bad"))):
            tests.append(F.sum(F.when(holds & F.col("prunes"), part).otherwise(0)).alias(f"{name}{k}"))
            tests.append(F.sum(F.when(holds, part).otherwise(0)).alias(f"all_{name}{k}"))
    seen, best = rows.agg(*tests).first(), None
    for k in range(1, len(grown) + 1):
        p, n = seen[f"p{k}"] or 0, seen[f"n{k}"] or 0
        all_p, all_n = seen[f"all_p{k}"] or 0, seen[f"all_n{k}"] or 0
        if p and all_p + all_n >= min_covered and p >= min_precision * (p + n):
            worth = (p - n) / (p + n)
            if best is None or worth > best[0]:
                best = (worth, Rule(tuple(grown[:k]), (all_p + 1) / (all_p + all_n + 2)))
    return best and best[1]


# Shares that rules may test, from the counts of text_statistics.
SHARES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "sentence_share": "n_ended / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def judge(docs: DataFrame, labels: DataFrame, **learning) -> DataFrame:
    """Statistics and verdict of every document; the list is learned from ``labels`` (doc_id, quality)."""
    counts = settle(text_statistics(docs), "text-statistics")
    shares = counts.select("*", *[F.expr(e).cast("double").alias(s) for s, e in SHARES.items()])
    good = labels.select(F.col("doc_id").alias("labelled"), (F.col("quality") == 0).alias("bad"))
    taught = shares.join(good, F.col("doc_id") == F.col("labelled"))
    made = learn(taught, list(SHARES), **learning)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return shares.withColumn("base_failed", failed).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~failed & ~made.rejects()).alias("kept"),
        made.which().alias("rule"),
    )
