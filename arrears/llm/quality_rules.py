"""Weak supervision: rules vote or abstain, EM weighs the rules.

Every rule looks at one measure of a text and votes good (1), bad (-1) or
abstains (0). Expectation-maximisation over the counts of vote patterns
estimates how often each rule is right when it votes, and a text's quality
probability is the posterior of its votes. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.frames import text_or_empty
from arrears.sources.scratch import stage

# What counts as a symbol, and what separates words.
SYMBOL = r"[#*$%&|<>]"
GAP = r"[ \t-\r]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Votes bad from ``bad`` on and good up to ``good``; abstains between.

    ``share`` is an SQL expression; where it is null (0 / 0) the rule abstains.
    """

    name: str
    share: str
    good: float
    bad: float

    def vote(self) -> Column:
        share = F.expr(self.share)
        return F.when(share >= self.bad, -1).when(share <= self.good, 1).otherwise(0).cast("tinyint")


# The limits are far apart, so that a rule abstains rather than guesses. Each
# kind of junk is looked at by several rules: agreement is what EM learns from.
RULES = (
    Rule("symbol_chars", "try_divide(n_symbols, word_chars)", good=0.02, bad=0.10),
    Rule("symbol_words", "try_divide(n_marked, n_words)", good=0.05, bad=0.25),
    Rule("symbol_rate", "try_divide(n_symbols, n_words)", good=0.10, bad=0.50),
    Rule("dup_lines", "try_divide(n_dup_lines, n_lines)", good=0.10, bad=0.35),
    Rule("repeats", "try_divide(n_repeat_words, n_words)", good=0.20, bad=0.40),
    Rule("sameness", "1 - try_divide(n_different, n_words)", good=0.70, bad=0.90),
    Rule("capitals", "try_divide(3 * n_capitals, word_chars)", good=0.10, bad=0.50),
    Rule("shouting", "try_divide(n_shouts, n_words)", good=0.05, bad=0.25),
    Rule("word_length", "abs(try_divide(word_chars, n_words) - 6)", good=3.0, bad=8.0),
)


@dataclass(frozen=True)
class LabelModel:
    """``prior``: share of good texts. ``on_good`` and ``on_bad``: how often each
    rule, when it votes, is right on good and on bad texts."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def weights(self) -> list[dict[int, float]]:
        """Per rule the log odds that each vote adds."""
        pairs = zip(self.on_good, self.on_bad)
        return [{1: math.log(g / (1 - b)), -1: math.log((1 - g) / b), 0: 0.0} for g, b in pairs]

    def posterior(self, rules: Sequence[Rule]) -> Column:
        """Probability that a text is good, from the columns ``vote_<rule>``."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, weight in zip(rules, self.weights()):
            vote = F.col(f"vote_{rule.name}")
            odds = odds + F.when(vote == 1, weight[1]).when(vote == -1, weight[-1]).otherwise(0.0)
        return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)), 9)


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``MEASURES`` and the inputs of the rules.

    A null text counts as empty, with zeros everywhere. ``n_repeat_words`` are
    the words in windows of three that occur twice or more in the text: window
    hashes are sorted with their places, so a long text costs n log n.
    """
    value = text_or_empty(text)

    def count(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)).cast("bigint")

    frame = docs.withColumns(
        {
            "_words": F.array_remove(F.split(value, f"{GAP}+"), ""),
            "_lines": F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^ \t-\r]")),
            "n_symbols": count(SYMBOL),
            "n_capitals": count(r"\p{Lu}{3}"),
            "n_shouts": (F.length(value) - F.length(F.replace(value, F.lit("!"), F.lit("")))).cast("bigint"),
        }
    )
    n = F.size("_words")
    frame = frame.withColumns(
        {
            "n_words": n.cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_different": F.size(F.array_distinct("_words")).cast("bigint"),
            "n_marked": F.when(F.col("n_symbols") > 0, count(rf"{SYMBOL}(?:{GAP}|\z)")).otherwise(0),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "_windows": F.sort_array(
                F.transform(
                    F.slice("_words", 1, F.greatest(n - 2, F.lit(0))),
                    lambda w, i: F.struct(
                        F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("at")
                    ),
                )
            ),
        }
    )
    repeated = F.filter(
        "_windows",
        lambda w, i: (w["h"] == F.get("_windows", i - 1)["h"]) | (w["h"] == F.get("_windows", i + 1)["h"]),
    )
    frame = frame.withColumn("_places", F.sort_array(F.transform(repeated, lambda w: w["at"])))
    covered = F.aggregate(
        "_places",
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, at: F.struct((acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n"), at.alias("last")),
        lambda acc: acc["n"],
    )
    return frame.withColumn("n_repeat_words", covered.cast("bigint")).drop("_words", "_lines", "_windows", "_places")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def vote_patterns(voted: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Texts per combination of votes: at most 3 ** len(rules) rows, whatever the input."""
    return voted.groupBy(*[f"vote_{rule.name}" for rule in rules]).agg(F.count("*").alias("n"))


def fit_label_model(
    patterns: DataFrame, rules: Sequence[Rule] = RULES, iterations: int = 25, tolerance: float = 1e-6
) -> LabelModel:
    """Expectation-maximisation over vote patterns.

    The start trusts a rule on good texts and half trusts it on bad ones. A
    rule that never fires on a kind of junk learns a low ``on_bad``, and its
    good votes then say little. A vote for good never counts against it, which
    keeps "good" the good class. The counts, at most 3 ** len(rules) whatever
    the input, come to the driver once. With no texts the start is returned.
    """
    votes = [f"vote_{rule.name}" for rule in rules]
    counts = [(tuple(row[v] for v in votes), row["n"]) for row in patterns.orderBy(*votes).collect()]
    model = LabelModel(0.8, (0.98,) * len(rules), (0.5,) * len(rules))
    total = sum(n for _, n in counts)
    for _ in range(iterations if total else 0):
        mass = [{(of, vote): 0.0 for of in ("good", "bad") for vote in (-1, 0, 1)} for _ in rules]
        odds, weights, good_texts = math.log(model.prior / (1 - model.prior)), model.weights(), 0.0
        for pattern, n in counts:
            good = 1 / (1 + math.exp(-odds - sum(w[v] for w, v in zip(weights, pattern))))
            good_texts += n * good
            for own, vote in zip(mass, pattern):
                own["good", vote] += n * good
                own["bad", vote] += n * (1 - good)
        on_good, on_bad = [], []
        for own in mass:
            up, down = own["good", 1], own["good", -1]
            on_good.append(_within((up + 9.8) / (up + down + 10), 0.5, 0.98))
            up, down = own["bad", 1], own["bad", -1]
            on_bad.append(_within((down + 0.5) / (up + down + 1), 1.01 - on_good[-1], 0.99))
        updated = LabelModel(_within(good_texts / total, 0.05, 0.95), tuple(on_good), tuple(on_bad))
        before = (model.prior, *model.on_good, *model.on_bad)
        after = (updated.prior, *updated.on_good, *updated.on_bad)
        model = updated
        if max(abs(x - y) for x, y in zip(before, after)) < tolerance:
            break
    return model


def grade(
    docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The columns ``carry`` with measures, ``base_failed``, ``kept``, ``quality`` and votes.

    The measures are computed once and stored. ``base_failed`` texts are never
    kept; of the others those of a quality of one half or more. An empty or
    null text fails the base, ties in votes are decided by the prior, repeated
    rows get equal results, and no rows give no rows. Columns of ``docs``
    outside ``carry`` and ``text`` are not read, so their names cannot clash.
    """
    graded = _graded(docs, text, carry, rules)
    return graded.select(
        *_carried(carry), *MEASURES, "base_failed", "kept", "quality", *[f"vote_{rule.name}" for rule in rules]
    )


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that ``grade`` keeps, with the same columns, whatever their names."""
    return _graded(docs, text, docs.columns, rules).filter("kept").select(*_carried(docs.columns))


def _carried(carry: Sequence[str]) -> list[Column]:
    return [F.col(f"_in{i}").alias(name) for i, name in enumerate(carry)]


def _graded(docs: DataFrame, text: str, carry: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    own = [F.col(name).alias(f"_in{i}") for i, name in enumerate(carry)]
    measured = with_measures(docs.select(F.col(text).alias("_text"), *own), "_text")
    names = [f"_in{i}" for i in range(len(carry))]
    voted = stage(
        measured.select(*names, *MEASURES, *[rule.vote().alias(f"vote_{rule.name}") for rule in rules]), "votes"
    )
    model = fit_label_model(vote_patterns(voted, rules), rules)
    quality, failed = model.posterior(rules), base_failed()
    return voted.withColumns({"base_failed": failed, "quality": quality, "kept": ~failed & (quality >= 0.5)})


def _within(value: float, low: float, high: float) -> float:
    return min(max(value, low), high)
