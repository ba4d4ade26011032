"""Quality rules: a decision list learned by sequential covering, run as Spark expressions.

1. ``text_statistics`` derives counts from each whole text with built-in functions only.
2. ``labelled_cells`` reduces all labelled rows to a contingency table: every feature is cut
   at a few thresholds (exact quantiles of each class, read from per-value counts), and rows
   are counted per combination of bins, apart for a growing and a pruning half. Its size is
   bounded by (thresholds + 1) ^ features, whatever the number of labelled rows.
3. ``learn_rules`` grows threshold conjunctions by information gain on the growing half, drops
   trailing conditions on the pruning half, keeps a rule only if it is precise enough, removes
   what it covers and goes on (sequential covering).
4. ``verdict`` turns the ordered rules into one ``CASE WHEN`` expression.

Defined results: a null text has no words and fails the base rule; without labels of both
classes no rule is learned and the base rule alone decides; null labels are ignored; repeated
label rows count as often as they occur; repeated documents are judged alike; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodstats.llm.common import WORD, let, materialise, text_of

#: Counts of the contract, then what only the learned rules use.
BASE_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA_COUNTS = ["n_lines", "n_upper"]
FEATURES = ["symbol_ratio", "upper_ratio", "repeat_ratio", "dup_line_ratio", "mean_word"]

_POSITION_BITS = 24


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def text(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"

    def column(self) -> Column:
        c, t = F.col(self.feature), F.lit(self.threshold)
        return c > t if self.above else c <= t


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects, with its counts over all labelled rows left to it."""

    conditions: tuple[Condition, ...]
    bad: int = 0
    good: int = 0

    def text(self) -> str:
        return " and ".join(c.text() for c in self.conditions)

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out


@dataclass(frozen=True)
class Settings:
    """Bounds of the learner; ``quantiles`` are taken from each class."""

    features: tuple[str, ...] = tuple(FEATURES)
    good_quantiles: tuple[float, ...] = (0.01, 0.5, 0.99, 0.999, 1.0)
    bad_quantiles: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75)
    max_rules: int = 12
    max_conditions: int = 3
    min_covered: int = 8
    min_precision: float = 0.97


# -- statistics of a text ---------------------------------------------------------------

def _repeat_words(words: Column) -> Column:
    """Word positions inside 3-word windows that occur twice or more (``words``: bound array).

    One 64-bit hash per window; most texts have no repeated one and end there. Else windows
    are sorted as one long each, hash bits above, position bits below, so that equal windows
    become neighbours, and the full hashes of neighbours are compared. Texts with more windows
    than the position bits can count sort (hash, position) pairs instead.
    """
    mask = (1 << _POSITION_BITS) - 1
    place = lambda k: k.bitwiseAND(F.lit(mask)).cast("int")

    def hashes(w: Column) -> Column:
        return F.when(F.size(w) >= 3, F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        ).otherwise(F.array().cast("array<bigint>"))

    def neighbours(s: Column, same: Callable[[Column, Column], Column]) -> Column:
        """Indexes i of the sorted array whose next element is the same."""
        return F.filter(F.sequence(F.lit(0), F.size(s) - 2),
                        lambda i: same(F.get(s, i), F.get(s, i + 1)))

    def packed(h: Column) -> Column:
        keys = F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))
        close = lambda a, b: F.shiftright(a, _POSITION_BITS) == F.shiftright(b, _POSITION_BITS)
        return let(F.sort_array(keys), lambda s: F.filter(
            F.transform(neighbours(s, close),
                        lambda i: F.array(place(F.get(s, i)), place(F.get(s, i + 1)))),
            lambda p: F.get(h, F.get(p, 0)) == F.get(h, F.get(p, 1))))

    def pairs(h: Column) -> Column:
        rows = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return let(F.sort_array(rows), lambda s: F.transform(
            neighbours(s, lambda a, b: a["h"] == b["h"]),
            lambda i: F.array(F.get(s, i)["i"], F.get(s, i + 1)["i"])))

    def covered(positions: Column) -> Column:
        """Words under windows of 3 that start at the sorted, distinct ``positions``."""
        zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            positions, zero,
            lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"),
                                  p.alias("last")),
            lambda a: a["n"])

    def count(h: Column) -> Column:
        same = F.when(F.size(h) <= F.lit(mask), packed(h)).otherwise(pairs(h))
        return let(F.sort_array(F.array_distinct(F.flatten(same))), covered)

    return let(hashes(words), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(count(h)))


def text_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, the counts and the ratio features; one row per input row.

    Everything stays in one narrow stage: no shuffle, no row per word. Arrays are bound once
    (``let``), and the counts pass through ``inline``, so a filter on them is not pushed below
    and worked out again.
    """
    words = F.array_remove(F.split("__text", r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD))
    left = lambda keep_class: F.length(
        F.regexp_replace("__text", f"[^{keep_class}]+", "")).cast("long")
    df = docs.withColumns({"__text": text_of()}).withColumns({
        "__w": let(words, lambda w: F.struct(
            F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"),
            _repeat_words(w).alias("repeat"))),
        "__l": let(lines, lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))),
    })
    counts = {"n_words": F.col("__w.n"), "word_chars": F.col("__w.chars"),
              "n_symbols": left("#*$%&|<>"), "n_dup_lines": F.col("__l.dup"),
              "n_repeat_words": F.col("__w.repeat"), "n_lines": F.col("__l.n"),
              "n_upper": left(r"\p{Lu}")}
    row = F.struct(*[counts[c].cast("long").alias(c) for c in BASE_COUNTS + EXTRA_COUNTS])
    return df.select(*keep, F.inline(F.array(row))).withColumns(ratio_features())


def ratio_features() -> dict[str, Column]:
    """Features on a grid of thousandths, so that their values can be counted exactly."""
    def ratio(a: str, b: str) -> Column:
        r = F.col(a) / F.when(F.col(b) > 0, F.col(b))
        return F.least(F.coalesce(F.round(r, 3), F.lit(0.0)), F.lit(1.0))
    mean = F.round(F.col("word_chars") / F.when(F.col("n_words") > 0, F.col("n_words")), 1)
    return {
        "symbol_ratio": ratio("n_symbols", "word_chars"),
        "upper_ratio": ratio("n_upper", "word_chars"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "mean_word": F.least(F.coalesce(mean, F.lit(0.0)), F.lit(100.0)),
    }


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


# -- labelled statistics ------------------------------------------------------------------

@dataclass(frozen=True)
class Cells:
    """Contingency table: bins per feature -> [grow good, grow bad, prune good, prune bad]."""

    thresholds: dict[str, list[float]] = field(default_factory=dict)
    counts: dict[tuple[int, ...], list[int]] = field(default_factory=dict)


def _quantiles(values: list[tuple[float, int]], at: tuple[float, ...]) -> list[float]:
    total, out = sum(n for _, n in values), []
    for q in at:
        need, seen = max(1, math.ceil(q * total)), 0
        for v, n in values:
            seen += n
            if seen >= need:
                out.append(v)
                break
    return out


def labelled_cells(stats: DataFrame, labels: DataFrame, settings: Settings) -> Cells:
    """Contingency table over every labelled row that passes the base rule.

    Labels of an id are counted before the join, and a document's row carries the two counts:
    an id with many rows and many labels weighs as all their pairs, without making them.
    Two aggregations; the first returns at most 1,001 values a feature and class, the second
    at most (thresholds + 1) ^ features combinations.
    """
    features = list(settings.features)
    wanted = labels.filter("quality is not null and doc_id is not null") \
        .groupBy(F.col("doc_id").alias("__id")).agg(
            F.count_if(F.col("quality") != 0).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
    rows = (stats.filter(~base_failed())
            .join(wanted, F.col("doc_id") == F.col("__id"))
            .select("good", "bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) < 2).alias("grow"),
                    *features))
    rows = materialise(rows, "labelled")
    values = (rows.select("good", "bad", F.posexplode(F.array(*features)).alias("f", "v"))
              .groupBy("f", "v").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect())
    thresholds = {}
    for i, name in enumerate(features):
        of = {b: sorted((r["v"], r[c]) for r in values if r["f"] == i and r[c])
              for b, c in ((False, "good"), (True, "bad"))}
        # A cut lies half way between an observed value and the next one that occurs, so a
        # rule leaves room on both sides; beyond the largest there is nothing to cut.
        cuts = {*_quantiles(of[False], settings.good_quantiles),
                *_quantiles(of[True], settings.bad_quantiles)}
        seen = sorted({v for x in of.values() for v, _ in x})
        thresholds[name] = [(a + b) / 2 for a, b in zip(seen, seen[1:], strict=False) if a in cuts]
    bins = [sum((F.when(F.col(f) > F.lit(t), 1).otherwise(0) for t in thresholds[f]),
                F.lit(0)).alias(f"b{i}") for i, f in enumerate(features)]
    names = [f"b{i}" for i in range(len(features))]
    when = lambda grow, count: F.sum(F.when(F.col("grow") == grow, F.col(count)).otherwise(0))
    counted = rows.select("good", "bad", "grow", *bins).groupBy(*names).agg(
        when(True, "good").alias("gg"), when(True, "bad").alias("gb"),
        when(False, "good").alias("pg"), when(False, "bad").alias("pb")).collect()
    return Cells(thresholds, {tuple(r[n] for n in names): [r["gg"], r["gb"], r["pg"], r["pb"]]
                              for r in counted})


# -- sequential covering --------------------------------------------------------------------

def _holds(bins: tuple[int, ...], rule: list[tuple[int, bool, int]]) -> bool:
    return all((bins[f] > t) if above else (bins[f] <= t) for f, above, t in rule)


def _total(cells: list[tuple[tuple[int, ...], list[int]]], k: int) -> tuple[int, int]:
    return sum(c[k] for _, c in cells), sum(c[k + 1] for _, c in cells)


def _grow(cells: list, n_cuts: list[int], settings: Settings) -> list[tuple[int, bool, int]]:
    rule: list[tuple[int, bool, int]] = []
    covered = cells
    while len(rule) < settings.max_conditions:
        good, bad = _total(covered, 0)
        if not bad or not good:
            break
        before, best = math.log2(bad / (bad + good)), (0.0, None)
        for f, cuts in enumerate(n_cuts):
            marginal = [[0, 0] for _ in range(cuts + 1)]
            for bins, c in covered:
                marginal[bins[f]][0] += c[0]
                marginal[bins[f]][1] += c[1]
            g = b = 0
            for t in range(cuts):  # bins <= t against bins > t
                g, b = g + marginal[t][0], b + marginal[t][1]
                for above, gg, bb in ((True, good - g, bad - b), (False, g, b)):
                    if bb >= settings.min_covered and gg + bb < good + bad:
                        gain = bb * (math.log2(bb / (bb + gg)) - before)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, above, t))
        if best[1] is None:
            break
        rule.append(best[1])
        covered = [x for x in covered if _holds(x[0], rule[-1:])]
    return rule


def _prune(cells: list, rule: list[tuple[int, bool, int]]) -> list[tuple[int, bool, int]]:
    def worth(r: list) -> float:
        good, bad = _total([x for x in cells if _holds(x[0], r)], 2)
        return (bad - good) / (bad + good) if bad + good else -1.0
    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn_rules(cells: Cells, settings: Settings | None = None) -> list[Rule]:
    """Ordered rejecting rules; deterministic for given counts."""
    settings = settings or Settings()
    names = list(cells.thresholds)
    n_cuts = [len(cells.thresholds[f]) for f in names]
    left, rules = sorted(cells.counts.items()), []
    while len(rules) < settings.max_rules:
        grown = _grow(left, n_cuts, settings)
        if not grown:
            break
        pruned = _prune(left, grown)
        for rule in (pruned, grown):  # the pruned form if it is precise enough, else the full one
            hit = [x for x in left if _holds(x[0], rule)]
            good, bad = (a + b for a, b in zip(_total(hit, 0), _total(hit, 2), strict=True))
            if bad >= settings.min_covered and bad >= settings.min_precision * (bad + good):
                break
        else:
            break
        rules.append(Rule(tuple(Condition(names[f], above, cells.thresholds[names[f]][t])
                                for f, above, t in rule), bad, good))
        left = [x for x in left if not _holds(x[0], rule)]
    return rules


def fired_rule(rules: list[Rule]) -> Column:
    """Number of the first rule that holds (from 1), else 0."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(rule.column(), i) if out is None else out.when(rule.column(), i)
    return F.lit(0) if out is None else out.otherwise(0)


def verdict(rules: list[Rule]) -> dict[str, Column]:
    fired = fired_rule(rules).cast("long")
    return {"base_failed": base_failed(), "rule": fired,
            "kept": ~base_failed() & (fired == 0)}


def fit(stats: DataFrame, labels: DataFrame, settings: Settings | None = None) -> list[Rule]:
    settings = settings or Settings()
    return learn_rules(labelled_cells(stats, labels, settings), settings)


def judge_documents(docs: DataFrame, labels: DataFrame,
                    settings: Settings | None = None) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the number of the rejecting rule."""
    stats = materialise(text_statistics(docs.select("doc_id", "text"), ["doc_id"]), "stats")
    rules = fit(stats, labels, settings)
    return stats.withColumns(verdict(rules)).select(
        "doc_id", *BASE_COUNTS, "base_failed", "kept", "rule")


def keep_documents(docs: DataFrame, labels: DataFrame,
                   settings: Settings | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    The rules are fitted on statistics of the same rows; the filter derives them again in the
    scan, which costs less than carrying the texts through a written copy.
    """
    own = docs.columns
    stats = materialise(text_statistics(docs.select("doc_id", "text"), ["doc_id"]), "stats")
    rules = fit(stats, labels, settings)
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("__row")
    judged = text_statistics(docs.select(row, F.col("text")), ["__row"])
    return judged.filter(verdict(rules)["kept"]).select("__row.*")
