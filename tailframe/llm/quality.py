"""Quality rules: text statistics and a learned decision list, all in DataFrame expressions.

Statistics are expressions over the whole text. The list is learned by sequential covering: a rule for the
rejected class is grown condition by condition on one part of the labelled rows (greatest information gain),
pruned on the other part, its rows are removed, and so on. What is learned is a short ordered list of threshold
conjunctions, and it runs as one ``CASE WHEN`` expression, so judging the corpus is a scan without a shuffle.

Edge cases: null and empty texts have all statistics 0 and fail the base rules; repeated rows are judged alike; very long texts are counted
whole, in memory in proportion to their words; of conditions of equal gain the first feature and the lowest threshold are taken, and of labels or statistics of one repeated id the least;
rows with a null id are judged like others but are never training rows; with no labels, or labels of one class
only, the list is empty and rejects nothing beyond the base rules; an empty table gives no rows. Extra columns are
kept unless they bear the name of an added column, which then replaces them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailframe.llm.common import SPACE, bounded_sample, let, words

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: What conditions of the list may test, of the struct of statistics.
FEATURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda q: q["n_words"].cast("double"),
    "mean_word_chars": lambda q: q["word_chars"] / F.greatest(q["n_words"], F.lit(1)),
    "symbols_per_word": lambda q: q["n_symbols"] / F.greatest(q["n_words"], F.lit(1)),
    "dup_lines": lambda q: q["n_dup_lines"].cast("double"),
    "repeat_share": lambda q: q["n_repeat_words"] / F.greatest(q["n_words"], F.lit(1)),
}


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice. Hashes only show that nothing repeats."""
    starts = F.sequence(F.lit(0), F.size(w) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    grams = F.array_sort(
        F.transform(starts, lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("at")))
    )

    def again(s: Column) -> Column:
        gram = lambda k: F.get(s, k)["g"]
        both = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: F.coalesce(gram(k) == gram(k - 1), F.lit(False)) | F.coalesce(gram(k) == gram(k + 1), F.lit(False)))
        return F.array_sort(F.transform(both, lambda k: F.get(s, k)["at"]))

    def covered(at: Column) -> Column:
        # A start covers its three words, less those that the next start covers anyway.
        own = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
        return F.aggregate(own, F.lit(0), lambda a, x: a + x)

    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(w) < 3, 0).when(repeats, let(let(grams, again), covered)).otherwise(0).cast("long")


def quality_stats(text: Column) -> Column:
    """The statistics as a struct of longs: words, code points in them, symbols, repeated lines and words.

    The words are bound once inside the expression, so that it stays linear in the text wherever the optimizer
    moves it, such as into a filter below.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(" \t\n\x0b\f\r")) != "")

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words"),
        )

    return let(words(text), of)


def with_quality_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the columns of ``STATS``."""
    kept = [c for c in df.columns if c not in STATS]
    return df.select(*kept, quality_stats(F.col(text_col)).alias("_stats")).select(*kept, *(F.col("_stats")[n].alias(n) for n in STATS))


def base_failed(q: Column) -> Column:
    """The fixed rules: under 50 words, or over half of the words in repeated windows."""
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, q: Column) -> Column:
        value = FEATURES[self.feature](q)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for c in rule:
        hit &= c.holds(x)
    return hit


def _best_condition(x: dict[str, np.ndarray], y: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    """The condition of the greatest FOIL gain among the rows that the rule still covers."""
    p0, n0 = int(y[inside].sum()), int((~y[inside]).sum())
    before = np.log2(p0 / (p0 + n0))
    best: tuple[float, Condition | None] = (1e-9, None)
    for name, column in x.items():
        v = column[inside]
        order = np.argsort(v, kind="stable")
        v, t = v[order], y[inside][order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        low_p, low_n = np.cumsum(t)[cuts], np.cumsum(~t)[cuts]
        for above, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / (p + n)) - before), -1.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = float(gain[k]), Condition(name, above, float((v[cuts[k]] + v[cuts[k] + 1]) / 2))
    return best


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 16, max_conditions: int = 4, min_precision: float = 0.95) -> list[Rule]:
    """Ordered rules for ``bad`` rows. Two thirds of the rows grow a rule, the others prune it and decide on its use."""
    x, bad = {k: np.asarray(v, float) for k, v in x.items()}, np.asarray(bad, bool)
    left, rules = np.ones(len(bad), bool), []
    prune_part = np.arange(len(bad)) % 3 == 2
    while len(rules) < max_rules:
        grow, prune = left & ~prune_part, left & prune_part
        if not bad[grow].any():
            break
        rule: Rule = ()
        while len(rule) < max_conditions:
            inside = grow & _covers(rule, x, len(bad))
            if not (~bad[inside]).any():
                break
            _, condition = _best_condition(x, bad, inside)
            if condition is None:
                break
            rule += (condition,)
        if not rule:
            break

        def worth(r: Rule) -> float:
            hit = prune & _covers(r, x, len(bad))
            p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
            return (p - n) / (p + n) if p + n else -1.0

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        hit = left & _covers(rule, x, len(bad))
        held = prune & hit
        judged = held if held.any() else hit
        if not bad[hit].any() or bad[judged].mean() < min_precision or bad[hit].mean() < min_precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def rejects(rules: list[Rule], q: Column) -> Column:
    """The list as one ordered conditional expression over the statistics: true for a rejected row."""
    verdict = None
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            test = test & c.column(q)
        verdict = F.when(test, True) if verdict is None else verdict.when(test, True)
    return F.lit(False) if verdict is None else verdict.otherwise(False)


def learn_decision_list(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = 20_000, **how) -> list[Rule]:
    """Learns from about ``max_labelled`` labelled documents at most (chosen by hash; label 0 is bad, 1 good).

    Only the sampled documents' statistics, a few numbers each, reach the driver. Statistics are computed here
    for the sampled documents alone; the sample's ids are broadcast, and ``max_labelled`` bounds them.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).where("_id is not null and _label in (0, 1)")
    known = F.broadcast(bounded_sample(known, "_id", max_labelled))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = (
        texts.join(known, "_id")
        .select("_id", "_label", quality_stats(F.col("_text")).alias("_stats"))
        .groupBy("_id", "_label")
        .agg(F.min(F.struct(*(f(F.col("_stats")).alias(n) for n, f in FEATURES.items()))).alias("_row"))  # one row of an id that repeats
        .select("_id", "_label", "_row.*")
        .collect()
    )
    rows.sort(key=lambda r: tuple(r))
    return learn_rules({n: np.array([r[n] for r in rows], float) for n in FEATURES}, np.array([r["_label"] == 0 for r in rows], bool), **how)


def keeps(text: Column, rules: list[Rule]) -> Column:
    """The whole verdict on a text as one expression, for filters: the base rules, then the list."""
    return let(quality_stats(text), lambda q: ~base_failed(q) & ~rejects(rules, q))


def judge_quality(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """Adds the statistics, ``base_failed`` and ``kept``. To filter only, ``keeps`` costs half."""
    others = [c for c in docs.columns if c not in (*STATS, "base_failed", "kept")]
    q = F.col("_stats")
    judged = docs.select(*others, quality_stats(F.col(text_col)).alias("_stats"))
    return judged.select(*others, *(q[n].alias(n) for n in STATS), base_failed(q).alias("base_failed"), (~base_failed(q) & ~rejects(rules, q)).alias("kept"))
