"""Quality rules: a threshold table compiled into one Spark projection.

Every rule names a measure, a comparison and a threshold. ``verdict`` turns the table into
one boolean column of integer comparisons, and ``measures`` gives all measures in one
projection over the text, without user functions and without a shuffle.

Null texts count as empty. Texts without words fail the word count; ratios compare products
and not quotients, so an empty text divides by nothing. Rows that repeat are judged alike.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import let

#: Java patterns: white space of the word rule, the symbols that count, list signs.
SPACE = r"[\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
BULLET = r"^[\x20\x09-\x0D]*([-*•])"
ELLIPSIS = r"(\.\.\.|…)[\x20\x09-\x0D]*$"

# Common function words of English, German, French and Spanish.
STOP_WORDS = (
    ["the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "on", "as", "was", "at", "by", "are"]
    + ["der", "die", "das", "und", "ist", "von", "zu", "den", "mit", "ein", "eine", "im", "nicht", "auf", "des", "dem", "für"]
    + ["le", "la", "les", "de", "du", "et", "est", "que", "qui", "un", "une", "dans", "pour", "par", "pas", "avec", "en"]
    + ["el", "los", "las", "y", "por", "con", "no", "una", "su", "se", "del", "al", "lo", "como", "más"]
)


class Rule(NamedTuple):
    """``part`` * 100 must be at least or at most ``percent`` of ``whole``; without ``whole``
    the measure itself is compared with ``percent``."""

    name: str
    part: str
    compare: str
    percent: int
    whole: str | None = None


#: The contract's base rules, and the rules of the method.
BASE_RULES = [
    Rule("words_least", "n_words", ">=", 50),
    Rule("repeated_words", "n_repeat_words", "<=", 50, "n_words"),
]
RULES = [
    Rule("word_length_least", "word_chars", ">=", 250, "n_words"),
    Rule("word_length_most", "word_chars", "<=", 1200, "n_words"),
    Rule("symbols", "n_symbols", "<=", 10, "n_words"),
    Rule("stop_words", "n_stop_words", ">=", 2),
    Rule("repeated_lines", "n_dup_lines", "<=", 50, "n_lines"),
    Rule("bullet_lines", "n_bullet_lines", "<=", 90, "n_lines"),
    Rule("ellipsis_lines", "n_ellipsis_lines", "<=", 30, "n_lines"),
]


def holds(rule: Rule) -> Column:
    if rule.whole is None:
        return F.expr(f"{rule.part} {rule.compare} {rule.percent}")
    return F.expr(f"100 * {rule.part} {rule.compare} {rule.percent} * {rule.whole}")


def verdict(rules: list[Rule]) -> Column:
    """True where every rule of the table holds."""
    found = F.lit(True)
    for rule in rules:
        found = found & holds(rule)
    return found


def _count(values: Column) -> Column:
    return F.size(values).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words inside a 3-word window that the text holds twice or more.

    Windows become structs of their hash, their words and their place; sorted, equal windows are
    neighbours, also where others have the same hash.
    """

    def window(i: Column) -> Column:
        own = [F.get(words, i + k) for k in range(3)]
        named = [word.alias(f"word{k}") for k, word in enumerate(own)]
        return F.struct(F.xxhash64(*own).alias("hash"), *named, i.alias("place"))

    def same(x: Column, y: Column) -> Column:
        agree = x["hash"] == y["hash"]
        for k in range(3):
            agree = agree & (x[f"word{k}"] == y[f"word{k}"])
        return agree

    def starts(found: Column) -> Column:
        twice = F.filter(
            found,
            lambda x, i: F.coalesce(same(x, F.get(found, i + 1)), F.lit(False))
            | F.coalesce(same(x, F.get(found, i - 1)), F.lit(False)),
        )
        return F.array_sort(F.transform(twice, lambda x: x["place"].cast("long")))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(3).cast("long"), F.get(at, i + 1) - p))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    windows = F.when(F.size(words) >= 4, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(
        F.array().cast("array<int>")
    )
    return let(F.sort_array(F.transform(windows, window)), lambda n: let(starts(n), covered))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one long column per measure; columns of these names are replaced."""
    whole = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.regexp_replace(whole, f"^{SPACE}+|{SPACE}+$", "")
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return F.struct(
            _count(w).alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
            _count(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).alias("n_stop_words"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            _count(x).alias("n_lines"),
            (_count(x) - _count(F.array_distinct(x))).alias("n_dup_lines"),
            _count(F.filter(x, lambda y: y.rlike(BULLET))).alias("n_bullet_lines"),
            _count(F.filter(x, lambda y: y.rlike(ELLIPSIS))).alias("n_ellipsis_lines"),
        )

    names = ["n_words", "word_chars", "n_repeat_words", "n_stop_words"]
    line_names = ["n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines"]
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in [*names, *line_names]]
    return (
        docs.select(
            *rest,
            let(words, of_words).alias("_words"),
            let(lines, of_lines).alias("_lines"),
            F.length(F.regexp_replace(whole, NOT_SYMBOL, "")).cast("long").alias("_symbols"),
        )
        .select(
            *rest,
            *[F.col(f"_words.{name}").alias(name) for name in names],
            *[F.col(f"_lines.{name}").alias(name) for name in line_names],
            F.col("_symbols").alias("n_symbols"),
        )
    )


def judged(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``measures`` with ``base_failed`` and ``kept``."""
    base = verdict(BASE_RULES)
    own = verdict(RULES if rules is None else rules)
    return (
        measures(docs, text)
        .withColumn("base_failed", ~base)
        .withColumn("kept", base & own)
    )
