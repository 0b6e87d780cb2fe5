"""Quality rules as one table of thresholds and one Spark projection.

Every measure is an integer count, every rule a pair of counts with least and
greatest percentages, so no rounding decides. All expressions run in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters that separate words, as a Java pattern class.
SEPARATORS = "[\\x20\\x09-\\x0D]+"
# Symbols counted by the contract.
SYMBOLS = "#*$%&|<>"
# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to in is that for it as was with be by on are this from at or an which have not but they",
    "fr": "le la les de des du et un une en est que qui dans pour par sur au avec pas ce se il elle sont",
    "de": "der die das und den von zu mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat",
    "es": "el la los las de del que y en un una por con para no se su al lo como es más pero sus le",
}


@dataclass(frozen=True)
class Rule:
    """100 * part must be between least and most times whole."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols_per_word", "n_symbols", "n_words", most=10),
    Rule("stop_words", "n_stop_words", "n_words", least=2),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=90),
)
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


def _passes(rule: Rule) -> Column:
    part, whole = F.col(rule.part) * 100, F.col(rule.whole)
    tests = []
    if rule.least is not None:
        tests.append(part >= whole * rule.least)
    if rule.most is not None:
        tests.append(part <= whole * rule.most)
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _count(array: Column) -> Column:
    return F.size(array).cast("bigint")


def repeated_words(words: Column) -> Column:
    """Words that stand in a window of three found twice or more in the array.

    The windows are sorted, those equal to a neighbour are kept, and from their
    positions in order each adds as many words as the one before left free.
    """
    last = F.size(words) - 3
    every = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(
        every,
        lambda i: F.struct(
            F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")
        ),
    )
    return F.sort_array(windows)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one column ``q`` that holds all counts as a struct; other columns stay as they are."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    step = docs.withColumn(
        "__words", F.filter(F.split(t, SEPARATORS), lambda w: w != "")
    ).withColumn(
        "__lines", F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    )
    step = step.withColumn("__sorted", repeated_words(F.col("__words")))
    s = F.col("__sorted")
    twins = F.filter(
        s, lambda x, j: (F.get(s, j - 1)["w"] == x["w"]) | (F.get(s, j + 1)["w"] == x["w"])
    )
    step = step.withColumn("__at", F.sort_array(F.transform(twins, lambda x: x["i"])))
    at = F.col("__at")
    gaps = F.transform(at, lambda p, j: F.least(F.lit(3), p - F.coalesce(F.get(at, j - 1), p - 3)))
    stops = sorted({w for line in STOP_WORDS.values() for w in line.split()})
    lines, words = F.col("__lines"), F.col("__words")
    counts = F.struct(
        _count(words).alias("n_words"),
        F.length(F.regexp_replace(t, SEPARATORS, "")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_repeat_words"),
        _count(F.filter(words, lambda w: F.lower(w).isin(stops))).alias("n_stop_words"),
        _count(lines).alias("n_lines"),
        _count(F.filter(lines, lambda x: x.rlike("(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$"))).alias("n_ellipsis_lines"),
        _count(F.filter(lines, lambda x: x.rlike("^[\\x20\\x09-\\x0D]*[-*•]"))).alias("n_bullet_lines"),
    )
    return step.withColumn("q", counts).select(*[F.col(f"`{c}`") for c in docs.columns if c != "q"], "q")


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the struct ``q``: all counts, ``base_failed``, ``kept`` and the names of failed rules.

    A null text counts as empty: no words, so the base rule fails. A column
    named ``q`` (or starting with two underscores) in the input is replaced;
    no other column is touched. Repeated rows are judged alike. No row is
    dropped here.
    """
    measured = measures(docs, text)
    flat = [f for f in measured.schema["q"].dataType.names]
    base = (F.col("q.n_words") < LEAST_WORDS) | (
        F.col("q.n_repeat_words") * 100 > F.col("q.n_words") * MOST_REPEATED_PERCENT
    )
    verdicts = [
        _passes(Rule(r.name, f"q.{r.part}", f"q.{r.whole}", r.least, r.most)) for r in rules
    ]
    ok = F.lit(True)
    for v in verdicts:
        ok = ok & v
    failed = F.array_compact(
        F.array(*[F.when(~v, F.lit(r.name)) for v, r in zip(verdicts, rules, strict=True)])
    )
    return measured.withColumn(
        "q",
        F.struct(
            *[F.col(f"q.{n}").alias(n) for n in flat],
            base.alias("base_failed"), (~base & ok).alias("kept"), failed.alias("failed_rules"),
        ),
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    slim = judge(docs.withColumnRenamed("q", "__q") if "q" in docs.columns else docs, text)
    # a filter on the verdict itself would be moved below the steps and repeat their work for every word;
    # one on a generated column stays where it is
    good = slim.withColumn("__kept", F.explode_outer(F.array("q.kept"))).filter("__kept").drop("q", "__kept")
    return good.withColumnRenamed("__q", "q") if "q" in docs.columns else good
