"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Nothing is shuffled, and no user function runs. Every measure is a column expression over the
text; a rule bounds one of them or a ratio of two; the verdict names the rules that fail.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import WORD, let

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the languages the corpus has.
STOP_WORDS = (
    "the be to of and that have with in is it for on as was by an are this from "
    "der die das und in zu den mit von ist für auf nicht ein eine dem des im sich als "
    "le la les de des et un une en que qui dans pour pas sur au du est par elle "
    "el los las y que en un una por con para del se no al lo es su "
).split()


class Rule(NamedTuple):
    """``low <= measure / per <= high`` must hold; an open end is None."""

    name: str
    measure: str
    per: str | None
    low: float | None
    high: float | None


# Fixed values of the base verdict.
BASE: tuple[Rule, ...] = (
    Rule("too_short", "n_words", None, 20, None),
    Rule("repeats", "n_repeat_words", "n_words", None, 0.30),
)

# The method's own rules, for texts that pass the base.
RULES: tuple[Rule, ...] = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.25),
    Rule("shouting", "n_exclaimed", "n_words", None, 0.25),
    Rule("stop_words", "n_stop_words", "n_words", 0.01, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.30),
    Rule("bullets", "n_bullet_lines", "n_lines", None, 0.90),
    Rule("ellipses", "n_ellipsis_lines", "n_lines", None, 0.30),
)


def _places(words: Column) -> Column:
    """Where windows of words start, from 1."""
    return F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)))


def _covered(words: Column) -> Column:
    """Words inside windows that occur twice or more: windows are sorted by their words and then
    by place, so equal ones are neighbours, and each adds what the next does not cover again."""

    def window(i: Column) -> Column:
        return F.struct(F.concat_ws(" ", F.slice(words, i, WINDOW)).alias("k"), i.alias("i"))

    def repeated(windows: Column) -> Column:
        def twice(w: Column, at: Column) -> Column:
            either = (F.get(windows, at - 1)["k"] == w["k"], F.get(windows, at + 1)["k"] == w["k"])
            return F.coalesce(either[0], F.lit(False)) | F.coalesce(either[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(windows, twice), lambda w: w["i"]))

    def lengths(places: Column) -> Column:
        step = lambda p, at: F.least(F.coalesce(F.get(places, at + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
        return F.aggregate(F.transform(places, step), F.lit(0), lambda acc, n: acc + n)

    return let(let(F.sort_array(F.transform(_places(words), window)), repeated), lengths)


def _repeated_words(words: Column) -> Column:
    """Hashes tell at once that nearly all texts repeat no window; the rest compare words."""

    def windows(hashes: Column) -> Column:
        return F.transform(_places(words), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(words) < WINDOW, 0).when(repeats, _covered(words)).otherwise(0)


def _measures(text: Column, words: Column, lines: Column) -> Column:
    stop = F.array(*[F.lit(x) for x in dict.fromkeys(STOP_WORDS)])
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated_words(words),
        "n_exclaimed": F.regexp_count(text, F.lit("!!")),
        "n_stop_words": F.size(F.filter(words, lambda w: F.array_contains(stop, F.lower(w)))),
        "n_lines": F.size(lines),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
    }
    return F.struct(*[count.cast("long").alias(name) for name, count in counts.items()])


def measures(text: Column) -> Column:
    """A struct of every measure of a text; a null text counts as empty."""
    some = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        lines = F.filter(F.split(some, "\n"), lambda line: line.rlike(WORD))
        return let(lines, lambda found: _measures(some, words, found))

    return let(F.regexp_extract_all(some, F.lit(WORD), F.lit(0)), of_words)


def failing(rule: Rule, of: Column) -> Column:
    """Whether a rule fails; a ratio over nothing does not. Bounds are compared multiplied out."""
    value = of[rule.measure]
    per = of[rule.per] if rule.per else F.lit(1)
    below = value < per * F.lit(rule.low) if rule.low is not None else F.lit(False)
    above = value > per * F.lit(rule.high) if rule.high is not None else F.lit(False)
    return below | above


def judge(
    docs: DataFrame, base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES, text: str = "text"
) -> DataFrame:
    """``docs`` with ``measures``, ``base_failed``, ``failed`` (names of failing rules) and ``kept``.

    A null or empty text has no words and fails for being short. Rows are judged each on its
    own, so repeated rows, null ids and extra columns change nothing; a column that
    already has one of the four names is replaced.
    """
    own = ("measures", "base_failed", "failed", "kept")
    rest = docs.drop(*[c for c in docs.columns if c.lower() in own and c != text])
    measured = rest.withColumn("measures", measures(F.col(text)))
    of = F.col("measures")
    by_base = F.array(*[F.when(failing(r, of), F.lit(r.name)) for r in base])
    by_rule = F.array(*[F.when(failing(r, of), F.lit(r.name)) for r in rules])
    failed = F.array_compact(F.concat(by_base, by_rule))
    base_failed = F.size(F.array_compact(by_base)) > 0
    judged = measured.withColumn("base_failed", base_failed).withColumn("failed", failed)
    return judged.withColumn("kept", F.size("failed") == 0)
