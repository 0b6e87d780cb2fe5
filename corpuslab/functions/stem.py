"""The published suffix-stripping algorithm (1980) as array expressions.

Each step is one ``transform`` over the word array, so the steps nest without
repeating one another and the whole stemmer runs in the JVM. A ``y`` that acts
as a consonant is written ``Y`` while the steps run; vowel tests are then plain
character classes.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shape tests on a stem: measure above 0, above 1, exactly 1; a vowel; the
# ending consonant-vowel-consonant that calls for a final e.
M_ABOVE_0 = "^[^aeiouy]*[aeiouy]+[^aeiouy]"
M_ABOVE_1 = "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]"
M_EQUALS_1 = "^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]*$"
HAS_VOWEL = "[aeiouy]"
ENDS_CVC = "[^aeiouy][aeiouy][^aeiouywxY]$"

# Suffix -> replacement, as published.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance",
    "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e",
    "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic",
    "ful": "", "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()
)


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _double_consonant(word: Column) -> Column:
    last = F.substring(word, -1, 1)
    return (F.length(word) > 1) & (last == F.substring(word, -2, 1)) & ~last.rlike(HAS_VOWEL)


def _longest_suffix(word: Column, table: dict[str, Callable[[Column], Column]]) -> Column:
    """Apply the rule of the longest suffix that matches; one rule at most."""
    chain = None
    for suffix in sorted(table, key=len, reverse=True):
        condition, result = word.endswith(suffix), table[suffix](word)
        chain = F.when(condition, result) if chain is None else chain.when(condition, result)
    return chain.otherwise(word)


def _replace_if(test: str, suffix: str, replacement: str, also: str | None = None):
    def rule(word: Column) -> Column:
        stem = _cut(word, len(suffix))
        condition = stem.rlike(test)
        if also is not None:
            condition = condition & stem.rlike(also)
        return F.when(condition, F.concat(stem, F.lit(replacement))).otherwise(word)

    return rule


def _mark_y(word: Column) -> Column:
    marked = F.regexp_replace(word, "^y", "Y")
    marked = F.regexp_replace(marked, "([aeiou])y", "$1Y")
    return F.regexp_replace(marked, "yy", "yY")


def _step_1a(word: Column) -> Column:
    return (
        F.when(word.endswith("sses") | word.endswith("ies"), _cut(word, 2))
        .when(word.endswith("ss"), word)
        .when(word.endswith("s"), _cut(word, 1))
        .otherwise(word)
    )


def _step_1b(word: Column) -> Column:
    """A removed -ed or -ing leaves a bar that the next step looks for."""
    return (
        F.when(
            word.endswith("eed"),
            F.when(_cut(word, 3).rlike(M_ABOVE_0), _cut(word, 1)).otherwise(word),
        )
        .when(
            word.endswith("ed") & _cut(word, 2).rlike(HAS_VOWEL),
            F.concat(_cut(word, 2), F.lit("|")),
        )
        .when(
            word.endswith("ing") & _cut(word, 3).rlike(HAS_VOWEL),
            F.concat(_cut(word, 3), F.lit("|")),
        )
        .otherwise(word)
    )


def _after_1b(word: Column) -> Column:
    stem = _cut(word, 1)
    return F.when(
        word.endswith("|"),
        F.when(
            stem.endswith("at") | stem.endswith("bl") | stem.endswith("iz"),
            F.concat(stem, F.lit("e")),
        )
        .when(_double_consonant(stem) & ~stem.rlike("[lsz]$"), _cut(stem, 1))
        .when(stem.rlike(M_EQUALS_1) & stem.rlike(ENDS_CVC), F.concat(stem, F.lit("e")))
        .otherwise(stem),
    ).otherwise(word)


def _step_1c(word: Column) -> Column:
    stem = _cut(word, 1)
    return F.when(
        word.rlike("[yY]$") & stem.rlike(HAS_VOWEL), F.concat(stem, F.lit("i"))
    ).otherwise(word)


def _step_2(word: Column) -> Column:
    return _longest_suffix(word, {s: _replace_if(M_ABOVE_0, s, r) for s, r in STEP_2.items()})


def _step_3(word: Column) -> Column:
    return _longest_suffix(word, {s: _replace_if(M_ABOVE_0, s, r) for s, r in STEP_3.items()})


def _step_4(word: Column) -> Column:
    rules = {
        s: _replace_if(M_ABOVE_1, s, "", also="[st]$" if s == "ion" else None) for s in STEP_4
    }
    return _longest_suffix(word, rules)


def _step_5a(word: Column) -> Column:
    stem = _cut(word, 1)
    drop = stem.rlike(M_ABOVE_1) | (stem.rlike(M_EQUALS_1) & ~stem.rlike(ENDS_CVC))
    return F.when(word.endswith("e") & drop, stem).otherwise(word)


def _step_5b(word: Column) -> Column:
    stem = _cut(word, 1)
    return F.when(word.endswith("ll") & stem.rlike(M_ABOVE_1), stem).otherwise(word)


_STEPS = (
    _mark_y, _step_1a, _step_1b, _after_1b, _step_1c,
    _step_2, _step_3, _step_4, _step_5a, _step_5b,
)


# Closes a word of one or two letters, which no rule may touch.
_SEAL = chr(2)


def stem_words(words: Column) -> Column:
    """Stem every word of an array of lower-case words."""
    words = F.transform(
        words, lambda w: F.when(F.length(w) > 2, w).otherwise(F.concat(w, F.lit(_SEAL)))
    )
    for step in _STEPS:
        words = F.transform(words, step)
    return F.transform(words, lambda w: F.rtrim(F.lower(w), F.lit(_SEAL)))


def stem_word(word: Column) -> Column:
    return F.element_at(stem_words(F.array(word)), 1)


# The same steps over one word, for rewriting arrays a batch at a time (see ``operators.rewrite``).

_SHAPE = {name: re.compile(name) for name in (M_ABOVE_0, M_ABOVE_1, M_EQUALS_1, HAS_VOWEL, ENDS_CVC, "[st]$")}


def _fits(pattern: str, stem: str) -> bool:
    return _SHAPE[pattern].search(stem) is not None


def _by_suffix(word: str, suffixes: tuple[str, ...], replacements: dict[str, str], test: str) -> str:
    """The rule of the longest suffix (``suffixes`` fall in length); one rule at most."""
    if not word.endswith(suffixes):
        return word
    for suffix in suffixes:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            fits = _fits(test, stem) and (suffix != "ion" or _fits("[st]$", stem))
            return stem + replacements.get(suffix, "") if fits else word
    return word


_SUFFIXES_2, _SUFFIXES_3, _SUFFIXES_4 = (
    tuple(sorted(t, key=len, reverse=True)) for t in (STEP_2, STEP_3, STEP_4)
)


def _restored(stem: str) -> str:
    """What follows a removed -ed or -ing."""
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    double = len(stem) > 1 and stem[-1] == stem[-2] and not _fits(HAS_VOWEL, stem[-1])
    if double and stem[-1] not in "lsz":
        return stem[:-1]
    return stem + "e" if _fits(M_EQUALS_1, stem) and _fits(ENDS_CVC, stem) else stem


# A worker keeps the stems of so many words from one batch to the next.
@lru_cache(1 << 17)
def stemmed(word: str) -> str:
    """What ``stem_word`` gives for a lower-case word."""
    if len(word) < 3:
        return word.lower()
    if "y" in word:
        word = re.sub("([aeiou])y", r"\1Y", re.sub("^y", "Y", word)).replace("yy", "yY")
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if _fits(M_ABOVE_0, word[:-3]) else word
    elif word.endswith("ed") and _fits(HAS_VOWEL, word[:-2]):
        word = _restored(word[:-2])
    elif word.endswith("ing") and _fits(HAS_VOWEL, word[:-3]):
        word = _restored(word[:-3])
    if word[-1:] in ("y", "Y") and _fits(HAS_VOWEL, word[:-1]):
        word = word[:-1] + "i"
    word = _by_suffix(word, _SUFFIXES_2, STEP_2, M_ABOVE_0)
    word = _by_suffix(word, _SUFFIXES_3, STEP_3, M_ABOVE_0)
    word = _by_suffix(word, _SUFFIXES_4, {}, M_ABOVE_1)
    stem = word[:-1]
    if word.endswith("e") and (_fits(M_ABOVE_1, stem) or (_fits(M_EQUALS_1, stem) and not _fits(ENDS_CVC, stem))):
        word = stem
    if word.endswith("ll") and _fits(M_ABOVE_1, word[:-1]):
        word = word[:-1]
    return word.lower()
