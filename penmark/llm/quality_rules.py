"""Weak supervision of text quality.

Rules vote good (1), bad (-1) or abstain (0). Expectation-maximisation estimates
from the votes alone, without labels, how often documents are good and how often
each rule votes and is right on good and on bad documents. The posterior probability of
being good replaces the demand that all rules pass.

All of it is DataFrame code. EM runs on the table of distinct vote patterns, at
most 3 to the number of rules rows whatever the corpus; an iteration is one
aggregate over it, of which the driver gets the model's few parameters.

Defined results. A null or empty text has no words, fails the base rule and is not
kept. Repeated rows and ties are scored alike. An empty table gives an empty table.
Columns of any name can be carried along in ``row``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import BLANK, WORD, stored, words

MIN_WORDS = 50
WINDOW = 3
SYMBOLS = r"[#*$%&|<>]"
THRESHOLD = 0.5
ITERATIONS = 50
# EM ends when no parameter changes by more than this.
SETTLED = 1e-4
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_upper", "n_not_letters", "n_bare", "n_shouts")
NOT_LETTER = r"[^\p{L}\x20\x09-\x0D]"
# Words without a letter or digit.
BARE = r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])"


def _repeated_words(hashes: str = "_h", windows: str = "_w") -> Column:
    """Words inside windows that occur twice or more: neighbours after sorting the windows."""
    same = " and ".join(f"{windows}[i + {{0}}].`{k}` = x.`{k}`" for k in range(WINDOW))
    repeated = (
        f"filter({windows}, (x, i) -> (i > 0 and {same.format(-1)}) "
        f"or (i + 1 < size({windows}) and {same.format(1)}))"
    )
    starts = f"array_sort(transform({repeated}, x -> x.`{WINDOW}`))"
    return F.expr(
        f"aggregate({starts}, struct(-{WINDOW} as last, 0L as total), "
        f"(a, p) -> struct(p as last, a.total + least({WINDOW}, p - a.last) as total), a -> a.total)"
    )


def text_features(docs: DataFrame, text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Struct ``row`` of the columns ``carry``, and the counts of each text."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    has_word = lambda line: line.rlike(WORD)
    rows = docs.select(F.struct(*carry).alias("row"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.select("row", text.alias("_text"), words(text).alias("_words"))
    rows = rows.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), has_word))
    n = F.size("_words")
    many = n >= WINDOW
    spans = [F.slice("_h", k + 1, F.greatest(n - WINDOW + 1, F.lit(0))).alias(str(k)) for k in range(WINDOW)]
    windows = F.arrays_zip(*spans, F.sequence(F.lit(0), n - WINDOW).alias(str(WINDOW)))
    rows = rows.withColumn("_w", F.when(many, F.sort_array(windows)))
    count = lambda pattern: F.regexp_count("_text", F.lit(pattern)).cast("bigint")
    word_chars = F.length(F.regexp_replace("_text", BLANK, "")).cast("bigint")
    return rows.select(
        "row",
        n.cast("bigint").alias("n_words"),
        word_chars.alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(_repeated_words(), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        count(r"\p{Lu}").alias("n_upper"),
        count(NOT_LETTER).alias("n_not_letters"),
        count(BARE).alias("n_bare"),
        count(r"[!?]").alias("n_shouts"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Good up to ``good``, bad from ``bad`` on, no opinion between; both are shares."""

    name: str
    part: str
    whole: str
    good: float
    bad: float

    def vote(self) -> Column:
        share = F.col(self.part) / F.when(F.col(self.whole) > 0, F.col(self.whole))
        return (
            F.when(share <= self.good, 1).when(share >= self.bad, -1).otherwise(0).cast("tinyint")
        )


# Kinds of junk show in more than one rule, as EM learns from votes that agree.
RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.02, 0.10),
    Rule("not_letters", "n_not_letters", "word_chars", 0.12, 0.20),
    Rule("bare_symbols", "n_bare", "n_words", 0.02, 0.10),
    Rule("repeated_words", "n_repeat_words", "n_words", 0.20, 0.40),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.10, 0.30),
    Rule("capitals", "n_upper", "word_chars", 0.10, 0.25),
    Rule("shouting", "n_shouts", "n_words", 0.05, 0.20),
)


def _length_vote() -> Column:
    n = F.col("n_words")
    return F.when(n >= 2 * MIN_WORDS, 1).when(n < MIN_WORDS, -1).otherwise(0).cast("tinyint")


def _word_length_vote() -> Column:
    mean = F.col("word_chars") / F.when(F.col("n_words") > 0, F.col("n_words"))
    return F.when(mean.between(3, 10), 1).when((mean < 2) | (mean > 15), -1).otherwise(0).cast("tinyint")


def votes() -> dict[str, Column]:
    return {r.name: r.vote() for r in RULES} | {"length": _length_vote(), "word_length": _word_length_vote()}


OUTCOMES = (1, 0, -1)
# Before any data: how often a rule votes good, abstains and votes bad on a good
# and on a bad document. A bad document shows in some of the rules, not in all.
START = {"good": (0.85, 0.13, 0.02), "bad": (0.50, 0.20, 0.30)}
START_PRIOR = 0.8
# Weight of the values above, as a share of the documents.
SMOOTHING = 0.002


@dataclass(frozen=True)
class Model:
    """``prior``: share of good documents. ``rates``: per rule and class, how often
    the rule votes good, abstains and votes bad."""

    prior: float
    rates: dict[str, dict[str, tuple[float, ...]]]

    def accuracy(self, name: str) -> tuple[float, float]:
        """How often the rule is right on good and on bad documents, when it votes."""
        good, bad = self.rates[name]["good"], self.rates[name]["bad"]
        return good[0] / (good[0] + good[2]), bad[2] / (bad[0] + bad[2])

    def distance(self, other: Model) -> float:
        """The largest change of any parameter."""
        rates = [
            abs(a - b)
            for name, kinds in self.rates.items()
            for kind, mine in kinds.items()
            for a, b in zip(mine, other.rates[name][kind])
        ]
        return max(abs(self.prior - other.prior), *rates)

    def log_odds(self) -> Column:
        """Of good against bad, given the vote columns."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, rates in self.rates.items():
            voted_good, abstained, voted_bad = (math.log(g / b) for g, b in zip(rates["good"], rates["bad"]))
            total = total + F.when(F.col(name) == 1, voted_good).when(F.col(name) == 0, abstained).otherwise(voted_bad)
        return total

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def fit(patterns: DataFrame, names: list[str], iterations: int = ITERATIONS) -> Model:
    """EM on a table of distinct vote patterns with their ``count``."""
    model = Model(START_PRIOR, {name: START for name in names})
    for _ in range(iterations):
        weighed = patterns.select("*", (F.col("count") * model.posterior()).alias("_good"))
        weighed = weighed.withColumn("_bad", F.col("count") - F.col("_good"))
        sums = [F.sum("_good").alias("good"), F.sum("_bad").alias("bad")]
        for name in names:
            for outcome in OUTCOMES:
                chosen = F.col(name) == outcome
                for kind in ("good", "bad"):
                    part = F.sum(F.when(chosen, F.col(f"_{kind}")).otherwise(0.0))
                    sums.append(part.alias(f"{name} {outcome} {kind}"))
        got = weighed.agg(*sums).first().asDict()
        if got["good"] is None:
            return model
        extra = SMOOTHING * (got["good"] + got["bad"]) + 1

        def rate(name: str, kind: str, k: int, got: dict = got, extra: float = extra) -> float:
            seen = got[f"{name} {OUTCOMES[k]} {kind}"]
            return round((seen + extra * START[kind][k]) / (got[kind] + extra), 9)

        before = model
        model = Model(
            round((got["good"] + extra * START_PRIOR) / (got["good"] + got["bad"] + extra), 9),
            {
                name: {kind: tuple(rate(name, kind, k) for k in range(len(OUTCOMES))) for kind in ("good", "bad")}
                for name in names
            },
        )
        if model.distance(before) < SETTLED:
            break
    return model


def score(
    docs: DataFrame, text_col: str = "text", carry: Sequence[str] = ("doc_id",), threshold: float = THRESHOLD
) -> tuple[DataFrame, Model]:
    """``row``, text counts, votes, ``posterior``, ``base_failed`` and ``kept`` of every row, and the model."""
    rules = votes()
    names = list(rules)
    counted = stored(text_features(docs, text_col, carry), "text-counts")
    voted = counted.select("*", *[c.alias(name) for name, c in rules.items()])
    patterns = stored(voted.groupBy(*names).count(), "vote-patterns")
    model = fit(patterns, names)
    scored = voted.withColumn("posterior", model.posterior()).withColumn("base_failed", base_failed())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)), model


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    scored, _ = score(docs, text_col, docs.columns)
    return scored.where("kept").select("row.*")
