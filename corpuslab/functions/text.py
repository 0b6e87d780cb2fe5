"""String and token-array expressions.

Every function takes and returns Columns, stays in the JVM and needs no
shuffle: a document is one row, so its sentences and words are arrays in it.
Patterns avoid look-around so that the same pattern runs on other engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslab.functions.words import ENGLISH_STOP_WORDS, MASK_WORD

# Marks a cut between pieces of a text; never part of real text.
_CUT = chr(1)

NON_ASCII = r"[^\x00-\x7F]"
WORD_OR_PUNCTUATION = r"[A-Za-z0-9]+|[^\sA-Za-z0-9]"
SOCIAL_TOKEN = (
    r"https?://[^\s]+"                      # links
    r"|[@#][A-Za-z0-9_]+"                   # mentions and tags
    r"|[:;=8][-o*']?[)\](\[dDpP/:}{@|\\]"   # emoticons
    r"|\p{L}+(?:['\-]\p{L}+)+"              # words joined by ' or -
    r"|[0-9]+(?:[.,:][0-9]+)*"              # numbers
    r"|[\p{L}\p{N}_]+"                      # other words
    r"|\.\.+"                               # runs of dots
    r"|[^\s]"                               # anything else, one by one
)


def lowercase(text: Column) -> Column:
    return F.lower(text)


def split_whitespace(text: Column) -> Column:
    """Pieces between runs of whitespace, without empty pieces."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def split_space(text: Column) -> Column:
    """Pieces between single blanks; two blanks in a row give an empty piece."""
    return F.split(text, " ")


def letters_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-zA-Z]", " ")


def document_tokens(text: Column) -> Column:
    return split_whitespace(F.lower(text))


def sentences(text: Column) -> Column:
    """Cut after ``.``, ``!`` or ``?`` followed by whitespace."""
    return F.split(F.regexp_replace(text, r"([.!?])\s+", "$1" + _CUT), _CUT)


def period_sentences(text: Column) -> Column:
    """Cut at every full stop."""
    return F.split(text, r"\.")


def is_heading(sentence: Column) -> Column:
    return sentence.startswith("==")


def word_tokens(text: Column) -> Column:
    """Words, and punctuation marks as tokens of their own."""
    return F.regexp_extract_all(text, F.lit(WORD_OR_PUNCTUATION), F.lit(0))


def social_tokens(text: Column) -> Column:
    """Tokens of a short message without mentions, tags and links.

    Null text gives null, which marks the row as unusable.
    """
    tokens = F.regexp_extract_all(F.lower(text), F.lit(SOCIAL_TOKEN), F.lit(0))
    return F.filter(
        tokens,
        lambda t: ~(t.startswith("@") | t.startswith("#") | t.startswith("http")),
    )


def good_tokens(tokens: Column) -> Column:
    """Keep letters, digits, ``!`` and ``?`` of each token; drop what is left empty."""
    cleaned = F.transform(tokens, lambda t: F.regexp_replace(t, "[^0-9A-Za-z!?]+", ""))
    return F.filter(cleaned, lambda t: t != "")


def good_words(text: Column) -> Column:
    """``good_tokens`` of ``word_tokens`` in one pass over the text.

    A word token is a run of letters and digits or one other character, so what
    survives the tidying is the runs and the two kept marks.
    """
    return F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+|[!?]"), F.lit(0))


def plain_words(text: Column) -> Column:
    """``word_tokens`` of a lower-case text without the punctuation, in one pass."""
    return F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0))


def ascii_fold(text: Column) -> Column:
    return F.regexp_replace(text, NON_ASCII, "")


def mask_nonascii(text: Column, placeholder: str = MASK_WORD) -> Column:
    """Replace each blank-separated word that holds a non-ASCII character."""
    words = F.transform(
        split_space(text),
        lambda w: F.when(w.rlike(NON_ASCII), F.lit(placeholder)).otherwise(w),
    )
    return F.array_join(words, " ")


def drop_integers(text: Column) -> Column:
    """Words of ``text`` that do not read as an integer, joined by blanks."""
    kept = F.filter(split_whitespace(text), lambda w: ~w.rlike("^[+-]?[0-9]+$"))
    return F.array_join(kept, " ")


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def sanitize_name(name: Column, keep_spaces: bool = True) -> Column:
    return F.regexp_replace(name, "[^A-Za-z0-9 ]+" if keep_spaces else "[^A-Za-z0-9]+", "")


def is_phrase(token: Column) -> Column:
    return F.size(F.split(token, "_")) > 1


def without(tokens: Column, stops: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Tokens that are not in a fixed, short list."""
    listed = list(stops)
    return F.filter(tokens, lambda w: ~w.isin(listed))


def clean_words(
    sentence: Column,
    letters: bool = True,
    remove_stops: bool = True,
    stops: Sequence[str] = ENGLISH_STOP_WORDS,
) -> Column:
    """Letters only, lower case, split, stop words out. Headings become null."""
    body = letters_only(sentence) if letters else sentence
    words = split_whitespace(F.lower(body))
    if remove_stops:
        words = without(words, stops)
    return F.when(~is_heading(sentence), words)


def clean_utterance(text: Column, stops: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Lower case, split, stop words out; punctuation stays on its word."""
    return without(document_tokens(text), stops)


def simple_tokens(text: Column, shortest: int = 2, longest: int = 15) -> Column:
    """Lower-case runs of letters whose length lies within the bounds."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    return F.filter(runs, lambda w: F.length(w).between(shortest, longest))


def adjacent_pairs(words: Column) -> Column:
    """Array of (first, second, pos) for each two neighbours in ``words``."""
    n = F.size(words)
    return F.when(
        n > 1,
        F.transform(
            F.sequence(F.lit(1), n - 1),
            lambda i: F.struct(
                (i - 1).alias("pos"),
                F.element_at(words, i).alias("first"),
                F.element_at(words, i + 1).alias("second"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<pos:int,first:string,second:string>>"))
