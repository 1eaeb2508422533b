"""Quality rules under weak supervision, in DataFrame functions only.

Each rule votes good or bad on a document, or abstains between its two bounds. How far a rule can be trusted is not given: expectation-
maximisation estimates, from the votes of all documents, the share of good documents and each rule's accuracy on good and on bad ones, taking
rules as independent within a class. A document's posterior probability of being good replaces a filter that all rules must pass.

Documents with equal votes are alike to the model, so its steps run over counted vote patterns: at most 3 ** rules of them (19,683), whatever the
number of documents. The posterior is an expression of the votes.

A word is a run outside the six blanks. Repeated words are those in windows of WINDOW words that occur twice or more in their text, first
occurrences included; windows are told apart by 64-bit hashes.

Defined cases: null text is empty: it has no words, all rules abstain but those on length, and the base fails it; texts of any length count whole; equal texts have
equal votes and verdicts; repeated rows are rows of their own and each is counted; a posterior of exactly THRESHOLD keeps; an empty table gives no
rows; extra columns are kept, and columns of the names added here are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import materialize

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WINDOW = 5
#: The base: texts of fewer words fail, and those with more than this share of repeated words, in hundredths.
LEAST_WORDS, MOST_REPEATED = 10, 20
THRESHOLD = 0.5
#: Steps of expectation-maximisation, and where it starts: the share of good documents and each rule's accuracy on good and on bad ones.
#: Rules seldom accuse a good document, and miss many bad ones, which are bad in different ways.
STEPS = 60
START = (0.8, 0.99, 0.5)
#: Counts added to each estimate, so that no rule becomes certain.
SMOOTH = 1.0


@dataclass(frozen=True)
class Rule:
    """A measure over `of` (both names of measures()): good up to `good`, bad from `bad` on, else no vote; with good above bad, the other way round."""

    name: str
    measure: str
    of: str
    good: float
    bad: float

    def vote(self) -> Column:
        """1 good, -1 bad, 0 abstain."""
        share = F.try_divide(F.col(self.measure), F.col(self.of))
        good, bad = (share <= self.good, share >= self.bad) if self.good < self.bad else (share >= self.good, share <= self.bad)
        return F.when(good, 1).when(bad, -1).otherwise(0)


#: What makes a text bad is seen by two rules or more, so that they can be found to agree.
RULES = (
    Rule("marks", "_marks", "word_chars", 0.05, 0.09),
    Rule("symbols", "n_symbols", "word_chars", 0.01, 0.08),
    Rule("repeats", "n_repeat_words", "n_words", 0.05, 0.2),
    Rule("lines", "n_dup_lines", "_lines", 0.05, 0.35),
    Rule("capitals", "_capitals", "word_chars", 0.15, 0.5),
    Rule("bangs", "_bangs", "n_words", 0.02, 0.2),
    Rule("vocabulary", "_kinds", "n_words", 0.35, 0.12),
    Rule("length", "n_words", "_one", 30.0, 9.0),
    Rule("stops", "_stops", "n_words", 0.03, 0.0),
)


def _count(text: Column, characters: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def _repeat_words(df: DataFrame) -> DataFrame:
    """df(_words) with n_repeat_words."""
    n = F.size("_words")
    # one hash for each window: of its words in order, each with its length
    at = F.sequence(F.lit(0), n - WINDOW)
    hashed = F.when(n >= WINDOW, F.transform(at, lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(WINDOW))))).otherwise(F.array().cast("array<bigint>"))
    told = df.withColumn("_hashes", hashed)
    again = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    places = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    told = told.withColumn("_sorted", F.when(again, places).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    same = lambda s, j: s["h"] == F.get("_sorted", j)["h"]
    twice = F.filter("_sorted", lambda s, k: F.coalesce((k > 0) & same(s, k - 1), F.lit(False)) | F.coalesce(same(s, k + 1), F.lit(False)))
    told = told.withColumn("_starts", F.array_sort(F.transform(twice, lambda s: s["i"])))
    # each window adds the words up to the next one's start
    size = F.size("_starts")
    after = F.slice("_starts", F.lit(2), F.greatest(size - 1, F.lit(0)))
    gaps = F.zip_with(F.slice("_starts", F.lit(1), F.greatest(size - 1, F.lit(0))), after, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.when(size > 0, F.aggregate(gaps, F.lit(WINDOW), lambda total, g: total + g)).otherwise(0)
    return told.withColumn("n_repeat_words", covered.cast("long")).drop("_hashes", "_sorted", "_starts")


def measures(texts: DataFrame) -> DataFrame:
    """texts(_row, _text) with the counts that rules and base use, without _text."""
    text = F.col("_text")
    words = F.array_remove(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    told = texts.withColumns({"_words": words, "_text_lines": lines})
    size = lambda c: F.size(c).cast("long")
    counted = told.withColumns({
        "n_words": size("_words"), "word_chars": F.char_length(F.translate(text, BLANKS, "")).cast("long"), "n_symbols": _count(text, SYMBOLS),
        "n_dup_lines": size("_text_lines") - size(F.array_distinct("_text_lines")), "_lines": size("_text_lines"), "_marks": _count(text, MARKS),
        "_capitals": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"), "_bangs": _count(text, "!"), "_kinds": size(F.array_distinct("_words")),
        "_stops": _count(text, ".?"), "_one": F.lit(1),
    })
    return _repeat_words(counted).drop("_text", "_words", "_text_lines")


@dataclass(frozen=True)
class Model:
    """The share of good documents, and each rule's accuracy on good and on bad ones where it votes."""

    share: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def evidence(self, vote: int, rule: int) -> float:
        """What a rule's vote adds to the log odds of a good document."""
        good, bad = self.on_good[rule], self.on_bad[rule]
        return 0.0 if vote == 0 else math.log(good / (1 - bad)) if vote > 0 else math.log((1 - good) / bad)

    def odds(self) -> float:
        return math.log(self.share / (1 - self.share))

    def posterior(self, votes: Sequence[Column]) -> Column:
        """The probability that a document with these votes is good."""
        total = F.lit(self.odds())
        for i, v in enumerate(votes):
            total = total + F.when(v == 1, F.lit(self.evidence(1, i))).when(v == -1, F.lit(self.evidence(-1, i))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(patterns: Sequence[tuple[tuple[int, ...], int]], rules: int) -> Model:
    """Expectation-maximisation over (votes, documents with these votes); without any it stays where it starts."""
    share, good, bad = START
    model = Model(share, (good,) * rules, (bad,) * rules)
    for _ in range(STEPS if patterns else 0):
        on_good, on_bad = [[SMOOTH, 2 * SMOOTH] for _ in range(rules)], [[SMOOTH, 2 * SMOOTH] for _ in range(rules)]
        weight, n = SMOOTH, 2 * SMOOTH
        for votes, count in patterns:
            p = 1 / (1 + math.exp(-(model.odds() + sum(model.evidence(v, i) for i, v in enumerate(votes)))))
            weight, n = weight + count * p, n + count
            for i, v in enumerate(votes):
                if v:
                    on_good[i][1] += count * p
                    on_bad[i][1] += count * (1 - p)
                    if v > 0:
                        on_good[i][0] += count * p
                    else:
                        on_bad[i][0] += count * (1 - p)
        model = Model(weight / n, tuple(a / b for a, b in on_good), tuple(a / b for a, b in on_bad))
    return model


def judged(docs: DataFrame, text_col: str = "text", carry: Sequence[str] = (), rules: Sequence[Rule] = RULES) -> DataFrame:
    """docs' columns named in carry, then n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, votes, p_good, base_failed and kept,
    which replace columns of these names. votes: 1 good, -1 bad, 0 none, in the rules' order."""
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "votes", "p_good", "base_failed", "kept")
    row = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)))
    counted = measures(docs.select(row.alias("_row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text")))
    voted = materialize(counted.select("_row", *added[:5], F.array(*(r.vote() for r in rules)).alias("votes")), "quality-votes")
    patterns = voted.groupBy("votes").count().collect()  # at most 3 ** rules
    model = fit(sorted((tuple(r["votes"]), r["count"]) for r in patterns), len(rules))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    told = voted.withColumn("p_good", model.posterior([F.get("votes", F.lit(i)) for i in range(len(rules))])).withColumn("base_failed", failed)
    told = told.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= THRESHOLD))
    return told.select(*(F.col(f"_row.c{i}").alias(c) for i, c in enumerate(carry) if c not in added), *added)
