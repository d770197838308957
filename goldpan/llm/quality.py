"""Operator 7, quality rules: counts of each text and a learned decision list over them.

Counts are DataFrame functions over whole texts. From labelled rows a list of rules is
learned by sequential covering: a rule grows one threshold at a time, by the gain in
information about low quality, on two thirds of the rows; it is pruned from its end on
the other third, and accepted while it is precise enough there. The list becomes one
conditional expression; the first rule that holds rejects, and a text that none rejects
is kept. Rules read as text, like ``symbol_share >= 0.21 and words >= 14``.

The list is fitted on at most ``FIT_ROWS`` labelled rows, chosen by a hash of the id; all
counts and verdicts are over all rows.

Defined results: a null text is read as empty: no words, so it fails the base rule;
rows without a label, or with a null label, are not learned from; with no labelled row
of either kind the list is empty and only the base rule rejects; repeated rows get equal
results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import hash_share, saved

FIT_ROWS = 20_000
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_RULES = 16
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_COVERED = 5
_THRESHOLDS = 64
_BLANKS = r"[\x20\x09-\x0D]"
FEATURES = (
    "words", "word_length", "symbol_share", "repeat_share", "dup_line_share", "upper_share",
    "digit_share", "end_mark_share", "distinct_share", "line_length", "bang_share",
)


# --- counts ---------------------------------------------------------------------


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def with_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` with the base counts and the features of rules, for every row.

    Windows of words are compared by 64-bit hashes. Only texts in which a hash repeats
    are sorted, to find the words that repeated windows cover.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>"))
    words = words.otherwise(F.split(trimmed, _BLANKS + "+", -1))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    step = docs.select(
        "doc_id",
        words.alias("w"),
        lines.alias("lines"),
        F.length(text).alias("chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("upper"),
        F.regexp_count(text, F.lit("[0-9]")).alias("digits"),
        F.regexp_count(text, F.lit("[.?!]")).alias("marks"),
        F.regexp_count(text, F.lit("!")).alias("bangs"),
    )
    size = F.size("w")
    at = F.col("w")

    def window(word: Column, i: Column) -> Column:
        return F.xxhash64(word, *(F.get(at, i + k) for k in range(1, WINDOW)))

    hashes = F.transform(F.slice(at, F.lit(1), F.greatest(size - (WINDOW - 1), F.lit(0))), window)
    step = step.select(
        "*",
        size.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct("w")).alias("distinct"),
        F.size(F.array_distinct("lines")).alias("distinct_lines"),
        F.size("lines").alias("n_lines"),
        hashes.alias("h"),
    ).drop("w", "lines")
    placed = F.array_sort(
        F.transform("h", lambda value, i: F.struct(value.alias("h"), i.alias("i")))
    )
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    step = step.withColumn("s", F.when(repeats, placed)).drop("h")
    s = F.col("s")

    def twin(each: Column, k: Column) -> Column:
        before, after = F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]
        same = F.coalesce(each["h"] == before, F.lit(False))
        same = same | F.coalesce(each["h"] == after, F.lit(False))
        return F.when(same, each["i"])

    places = F.array_sort(F.filter(F.transform(s, twin), lambda i: i.isNotNull()))
    step = step.withColumn("p", places).drop("s")
    p = F.col("p")

    def covered(place: Column, k: Column) -> Column:
        return F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - place, F.lit(WINDOW)))

    total = F.aggregate(F.transform(p, covered), F.lit(0), lambda a, b: a + b)
    step = step.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("p")
    n, chars = F.col("n_words"), F.col("chars")
    dup_lines = F.col("n_lines") - F.col("distinct_lines")
    return step.select(
        "doc_id",
        "n_words",
        "word_chars",
        F.col("symbols").cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        n.cast("double").alias("words"),
        _share(F.col("word_chars"), n).alias("word_length"),
        _share(F.col("symbols"), n).alias("symbol_share"),
        _share(F.col("n_repeat_words"), n).alias("repeat_share"),
        _share(dup_lines, F.col("n_lines")).alias("dup_line_share"),
        _share(F.col("upper"), chars).alias("upper_share"),
        _share(F.col("digits"), chars).alias("digit_share"),
        _share(F.col("marks"), n).alias("end_mark_share"),
        _share(F.col("distinct"), n).alias("distinct_share"),
        _share(n, F.col("n_lines")).alias("line_length"),
        _share(F.col("bangs"), n).alias("bang_share"),
    )


# --- decision list --------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        value = rows[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold


Rule = tuple[Condition, ...]


def _holds(rule: Rule, rows: dict[str, np.ndarray]) -> np.ndarray:
    covered = np.ones(len(next(iter(rows.values()))), bool)
    for condition in rule:
        covered &= condition.holds(rows)
    return covered


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: list[Condition] = []
    covered = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (covered & ~bad).any():
        share = bad[covered].mean()
        best, best_gain = None, 1e-9
        for feature, values in rows.items():
            # thresholds halfway between neighbours among the covered values
            levels = np.unique(np.quantile(values[covered], np.linspace(0, 1, _THRESHOLDS)))
            for threshold in (levels[1:] + levels[:-1]) / 2:
                for at_least in (True, False):
                    new = covered & (values >= threshold if at_least else values < threshold)
                    hits = int((new & bad).sum())
                    if hits < MIN_COVERED:
                        continue
                    gain = hits * np.log2(hits / int(new.sum()) / share)
                    if gain > best_gain:
                        best, best_gain = Condition(feature, at_least, float(threshold)), gain
        if best is None:
            break
        rule.append(best)
        covered &= best.holds(rows)
    return tuple(rule)


def _worth(rule: Rule, rows, bad) -> float:
    covered = _holds(rule, rows)
    hits, n = int((covered & bad).sum()), int(covered.sum())
    return (2 * hits - n) / n if n else -1.0


def learn_rules(rows: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray) -> list[Rule]:
    """Ordered rules that reject; ``fold`` marks the rows held back for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        grow, prune = left & ~fold, left & fold
        grow_rows = {f: v[grow] for f, v in rows.items()}
        prune_rows = {f: v[prune] for f, v in rows.items()}
        if bad[grow].sum() < MIN_COVERED:
            break
        rule = _grow(grow_rows, bad[grow])
        if not rule:
            break
        prefixes = [rule[:n] for n in range(1, len(rule) + 1)]
        rule = max(prefixes, key=lambda r: (_worth(r, prune_rows, bad[prune]), -len(r)))
        covered = _holds(rule, prune_rows)
        hits = int((covered & bad[prune]).sum())
        if hits < 1 or hits / covered.sum() < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~_holds(rule, rows)
    return rules


def fit_rules(counts: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> list[Rule]:
    """Rules from labelled rows: a label (``doc_id, quality``) of 0 is low quality."""
    known = labels.filter("quality is not null").select("doc_id", "quality")
    total = known.count()
    if not total:
        return []
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
    share = min(1.0, 0.95 * rows / total)
    chosen = known.filter(hash_share(F.xxhash64(F.col("doc_id").cast("string")), share))
    chosen = chosen.withColumn("place", place)
    chosen = counts.join(chosen, "doc_id").select(*FEATURES, "quality", "place")
    sample = chosen.limit(rows).collect()
    if not sample:
        return []
    table = np.array([tuple(row) for row in sample], float)
    features = {name: table[:, i] for i, name in enumerate(FEATURES)}
    return learn_rules(features, table[:, -2] == 0, table[:, -1].astype(int) % 3 == 0)


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """Whether a row is kept, and the rule that rejects it."""
    kept, why = F.when(F.lit(False), False), F.when(F.lit(False), "")
    for rule in rules:
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        kept = kept.when(holds, False)
        why = why.when(holds, " and ".join(map(str, rule)))
    return kept.otherwise(True), why


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and the deciding ``rule`` of every row."""
    counts = saved(spark, with_counts(docs), "quality")
    good, why = verdict(fit_rules(counts, labels))
    few = F.col("n_words") < MIN_WORDS
    failed = few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = counts.select("*", failed.alias("base_failed"), good.alias("good"), why.alias("why"))
    return judged.select(
        "doc_id",
        *base,
        "base_failed",
        (~F.col("base_failed") & F.col("good")).alias("kept"),
        F.when(F.col("base_failed"), "base").otherwise(F.col("why")).alias("rule"),
    )
