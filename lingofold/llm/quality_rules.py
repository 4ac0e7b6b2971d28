"""Quality rules: text statistics and a learned decision list over them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingofold.llm.common import BLANK_CHARS, labelled, map_batches
from lingofold.session import stage_table

#: Characters that count as symbols, and the bounds of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

#: At most so many labelled rows (those with the smallest id hashes) reach the learner.
LABELLED_ROWS = 20_000
CUTS = 48
MOST_CONDITIONS = 4
LEAST_PRECISION = 0.85
LEAST_COVER = 4

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_distinct long, n_upper long, n_letters long, n_digits long, n_marks long"
)
STAT_NAMES = [part.split()[0] for part in STATS.split(", ")]


def repeated_words(words: list[str]) -> tuple[int, int]:
    """(words in windows that occur twice or more, distinct words).

    Windows are numbered exactly, by doubling their width: ids of 1, 2, 4 and then 8 words.
    """
    ids: dict[str, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    count = len(ids)
    if len(words) <= WINDOW or count == len(words):
        return 0, count
    width, kinds = 1, count
    while width < WINDOW:
        pairs = codes[:-width] * kinds + codes[width:]
        found, codes = np.unique(pairs, return_inverse=True)
        kinds, width = len(found), 2 * width
        if kinds == len(codes):
            return 0, count
    again = np.bincount(codes, minlength=kinds)[codes] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(again)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum()), count


def text_stats(text: str | None) -> tuple:
    """The values of ``STATS`` for one text; null is a text without words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=128)
    lines = [line for line in text.split("\n") if line.strip(BLANK_CHARS)]
    repeated, distinct = repeated_words(words)
    upper = int(seen[65:91].sum())
    return (
        len(words), len(text) - sum(int(seen[ord(c)]) for c in BLANK_CHARS),
        sum(int(seen[ord(c)]) for c in SYMBOLS), len(lines) - len(set(lines)), repeated,
        len(lines), distinct, upper, upper + int(seen[97:123].sum()), int(seen[48:58].sum()),
        int(seen[33] + seen[63]),
    )


def with_stats(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()

    def measure(batch: dict) -> dict:
        rows = [text_stats(t) for t in batch[text_col]]
        return {id_col: batch[id_col]} | {n: [r[i] for r in rows] for i, n in enumerate(STAT_NAMES)}

    return map_batches(docs.select(id_col, text_col), measure, f"`{id_col}` {id_type}, {STATS}")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def features() -> dict[str, Column]:
    """Columns over the statistics on which the learner may set thresholds."""
    c = F.col
    return {
        "word_length": _share(c("word_chars"), c("n_words")),
        "symbols_per_word": _share(c("n_symbols"), c("n_words")),
        "marks_per_word": _share(c("n_marks"), c("n_words")),
        "dup_lines": _share(c("n_dup_lines"), c("n_lines")),
        "repeated": _share(c("n_repeat_words"), c("n_words")),
        "distinct": _share(c("n_distinct"), c("n_words")),
        "upper": _share(c("n_upper"), c("n_letters")),
        "digits": _share(c("n_digits"), c("word_chars")),
        "words_per_line": _share(c("n_words"), c("n_lines")),
        "words": c("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    bound: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        column = values[self.feature]
        return column >= self.bound if self.at_least else column <= self.bound

    def column(self) -> Column:
        column = features()[self.feature]
        return column >= F.lit(self.bound) if self.at_least else column <= F.lit(self.bound)


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, dtype=bool)
    for condition in rule:
        hit &= condition.holds(values)
    return hit


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition with the largest information gain until no good row is covered."""
    rule: list[Condition] = []
    hit = np.ones(len(bad), dtype=bool)
    while len(rule) < MOST_CONDITIONS and (hit & ~bad).any():
        p0, n0 = (hit & bad).sum(), (hit & ~bad).sum()
        best, best_gain = None, 0.0
        for name, column in values.items():
            inside = column[hit]
            for bound in np.unique(np.quantile(inside, np.linspace(0, 1, CUTS), method="nearest")):
                for at_least in (True, False):
                    now = hit & (column >= bound if at_least else column <= bound)
                    p, n = (now & bad).sum(), (now & ~bad).sum()
                    if p < LEAST_COVER // 2:
                        continue
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                    if gain > best_gain + 1e-12:
                        best, best_gain = Condition(name, at_least, float(bound)), gain
        if best is None:
            break
        rule.append(best)
        hit &= best.holds(values)
    return tuple(rule)


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """Drop final conditions while that raises (p - n) / (p + n) on the pruning rows."""
    best: tuple[float, int, Rule, int] = (-2.0, 0, rule, 0)
    for size in range(1, len(rule) + 1):
        hit = _covers(rule[:size], values, len(bad))
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0] + 1e-12:
            best = (worth, -size, rule[:size], p)
    return best[2], (best[0] + 1) / 2, best[3]


def learn_rules(values: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray) -> list[Rule]:
    """Ordered rules that name bad rows, by sequential covering.

    ``fold`` 0 and 1 grow a rule, fold 2 prunes it. Bad rows that a rule covers are taken out
    before the next one is grown; learning ends with the first rule that is right on less than
    ``LEAST_PRECISION`` of the rows it covers, in the pruning rows or in all rows.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while (left & bad).sum() >= LEAST_COVER:
        grow, prune = left & (fold < 2), left & (fold == 2)
        if not (grow & bad).any():
            break
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow])
        if not rule:
            break
        rule, precision, found = _prune(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        hit = _covers(rule, values, len(bad)) & left
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        if p < LEAST_COVER or p / (p + n) < LEAST_PRECISION or (found and precision < LEAST_PRECISION):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def as_column(rules: list[Rule]) -> Column:
    """True where no rule fires: an ordered conditional expression."""
    verdict = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        fires = rule[0].column()
        for condition in rule[1:]:
            fires = fires & condition.column()
        verdict = verdict.when(fires, F.lit(False))
    return verdict.otherwise(F.lit(True))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", rows: int = LABELLED_ROWS) -> list[Rule]:
    names = list(features())
    order = F.xxhash64(F.col(id_col).cast("string"))
    sample = (
        labelled(stats, labels, "quality", id_col)
        .select(order.alias("at"), "label", *[c.alias(n) for n, c in features().items()])
        .orderBy("at", *names)
        .limit(rows)
        .toPandas()
    )
    values = {n: sample[n].to_numpy(dtype=float) for n in names}
    return learn_rules(values, sample["label"].to_numpy() == 0, sample["at"].to_numpy() % 3)


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """One row per document: id, the statistics, base_failed, kept.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in repeated windows of 8
    words. ``kept`` is false for those and for rows that a learned rule rejects. Rules are learned
    from at most ``LABELLED_ROWS`` labelled rows; without labels there are none. Null and empty
    texts have no words and fail; repeated rows are judged alike; other columns are not read; an
    empty table gives no rows. Texts are read once, whole.
    """
    stats = stage_table(with_stats(docs, id_col, text_col), "quality-stats")
    rules = fit(stats, labels, id_col) if rules is None else rules
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return stats.select(
        id_col, *STAT_NAMES[:5], failed.alias("base_failed"), (~failed & as_column(rules)).alias("kept")
    )
