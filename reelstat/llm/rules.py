"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation estimates how often each rule votes bad on good
documents and on each kind of junk, from the counts of vote patterns (at most 3 ** rules, however many documents there are); the posterior
probability of good replaces the filter by which every rule must pass.

Scale: one scan; the measures of a document are computed within its row, so long or repeated texts shuffle nothing, and the
only shuffle is that of the pattern counts, combined map-side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.storage import materialise

SPACES = "[ \t\n\x0b\f\r]+"
MOST_FALSE, LEAST_FOUND = 0.005, 0.5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_distinct", "n_stops")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more. Windows are compared by 64-bit hashes."""

    def of_windows(windows: Column) -> Column:
        def equal(x: Column, j: Column) -> Column:
            return F.coalesce(F.get(windows, j)["h"] == x["h"], F.lit(False))

        again = F.filter(windows, lambda x, i: ((i > 0) & equal(x, F.greatest(i - 1, F.lit(0)))) | equal(x, i + 1))
        starts = F.sort_array(F.transform(again, lambda x: x["i"]))
        begin = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        # a window adds the words that the one before it does not cover
        return F.aggregate(
            starts,
            begin,
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    def of_words(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        window = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))
        return F.when(F.size(w) >= 3, _let(F.sort_array(F.transform(at, window)), of_windows)).otherwise(0)

    return _let(words, of_words)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of each whole text (null: no words): long columns ``MEASURES``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    worded = docs.withColumn("words", F.array_remove(F.split("text", SPACES), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \t\n\x0b\f\r]"))

    def count_of(pattern: str) -> Column:
        return F.length("text") - F.length(F.regexp_replace("text", pattern, F.lit("")))

    counted = worded.withColumn("lines", lines).select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        count_of("[#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        count_of(r"\p{Lu}+").alias("n_upper"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        count_of("[.?!]+").alias("n_stops"),
    )
    return counted.select("doc_id", *(F.col(c).cast("long").alias(c) for c in MEASURES))


def default_rules() -> dict[str, Column]:
    """Votes of the standard rules over the measures: 1 good, -1 bad, 0 abstains."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    symbols, upper = F.col("n_symbols") / words, F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))
    repeats, distinct = F.col("n_repeat_words") / words, F.col("n_distinct") / words
    doubled, stops = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("n_stops") / words
    length = F.col("word_chars") / words

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return {
        "length": vote(F.col("n_words") < 50, F.col("n_words") >= 100),
        "symbols": vote(symbols > 0.25, symbols < 0.05),
        "upper": vote(upper > 0.4, upper < 0.15),
        "repeats": vote(repeats > 0.45, repeats < 0.1),
        "doubled_lines": vote((doubled > 0.3) & (F.col("n_lines") >= 5), (doubled < 0.1) & (F.col("n_lines") >= 2)),
        "variety": vote(distinct < 0.2, distinct > 0.4),
        "word_length": vote((length < 2.5) | (length > 12), (length >= 3.5) & (length <= 9)),
        "stops": vote((stops < 0.01) | (stops > 0.5), (stops > 0.03) & (stops < 0.3)),
    }


class RuleModel:
    """Shares of the classes of documents, and for each class and rule the probability of a bad vote when the rule votes.

    Class 0 is good. Junk is of many kinds, each seen by a few rules only, so every rule has a class of junk of its own kind,
    in which the other rules vote bad as often as they turn out to.
    """

    def __init__(self, share: Sequence[float], bad: Sequence[Sequence[float]]):
        self.share, self.bad = list(share), [list(x) for x in bad]

    def log_joint(self, c: int, votes: Sequence[int]) -> float:
        terms = (math.log(b) if v < 0 else math.log(1 - b) if v > 0 else 0.0 for v, b in zip(votes, self.bad[c], strict=True))
        return math.log(self.share[c]) + sum(terms)

    def posterior(self, votes: Sequence[int]) -> list[float]:
        logs = [self.log_joint(c, votes) for c in range(len(self.share))]
        odds = [math.exp(x - max(logs)) for x in logs]
        return [x / sum(odds) for x in odds]

    @staticmethod
    def fit(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 50) -> RuleModel:
        """Expectation-maximisation over (votes, count). A rule is taken to be right when it votes bad: at most ``MOST_FALSE``
        of its votes on good documents are bad, and at least ``LEAST_FOUND`` of those on junk of its kind."""
        kinds = range(1, rules + 1)
        model = RuleModel([0.9] + [0.1 / rules] * rules, [[MOST_FALSE] * rules] + [[0.9 if j + 1 == k else 0.1 for j in range(rules)] for k in kinds])
        for _ in range(rounds):
            total = [1.0] * (rules + 1)
            votes_of, bad_of = ([[w] * rules for _ in total] for w in (1.0, 0.1))  # one vote in ten is bad, worth one vote
            for votes, n in patterns:
                for c, p in enumerate(model.posterior(votes)):
                    total[c] += p * n
                    for j, v in enumerate(votes):
                        votes_of[c][j] += p * n * (v != 0)
                        bad_of[c][j] += p * n * (v < 0)
            rate = [[b / n for b, n in zip(*x, strict=True)] for x in zip(bad_of, votes_of, strict=True)]
            rate[0] = [min(max(r, 1e-4), MOST_FALSE) for r in rate[0]]
            for k in kinds:
                rate[k] = [min(max(r, LEAST_FOUND if j + 1 == k else 1e-4), 0.999) for j, r in enumerate(rate[k])]
            model = RuleModel([t / sum(total) for t in total], rate)
        return model

    def quality(self, votes: Sequence[Column]) -> Column:
        """The posterior probability of class 0 as an expression over vote columns."""
        joint = []
        for share, bad in zip(self.share, self.bad, strict=True):
            log = F.lit(math.log(share))
            for v, b in zip(votes, bad, strict=True):
                log = log + F.when(v < 0, math.log(b)).when(v > 0, math.log(1 - b)).otherwise(0.0)
            joint.append(F.exp(log))
        return joint[0] / sum(joint[1:], joint[0])


def judged(docs: DataFrame, rules: dict[str, Column] | None = None, cut: float = 0.5) -> DataFrame:
    """Measures, votes, ``base_failed``, ``quality`` (posterior probability of good) and ``kept`` for each row of ``docs``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated three-word windows. ``kept``: not base_failed,
    and a posterior of ``cut`` or more. Null, empty and wordless texts have zero measures and fail. Equal rows are counted and
    judged alike; other columns are ignored; an empty table gives an empty result.
    """
    rules = default_rules() if rules is None else rules
    names = list(rules)
    measured = materialise(measures(docs).select("*", *(v.cast("int").alias(f"vote_{n}") for n, v in rules.items())), "measures")
    votes = [f"vote_{n}" for n in names]
    counts = measured.groupBy(*votes).agg(F.count("*").alias("n")).collect()  # at most 3 ** rules rows
    model = RuleModel.fit([(tuple(r[v] for v in votes), r["n"]) for r in sorted(counts)], len(names))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measured.withColumn("base_failed", failed)
        .withColumn("quality", model.quality([F.col(v) for v in votes]))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= cut))
    )
