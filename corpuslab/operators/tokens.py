"""Document, sentence and word tables.

A document is one row and its words are arrays inside that row, so cleaning is
narrow. Rows are exploded only where counts or joins need single words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.functions import text as tx
from corpuslab.functions.words import ENGLISH_STOP_WORDS
from corpuslab.operators import rewrite
from corpuslab.operators.unnest import each, each_at
from corpuslab.session import lookup


def sentence_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per sentence: key, sent_pos, sentence."""
    return each_at(docs, tx.sentences(F.col(text)), "sent_pos", "sentence", key)


def drop_headings(sentences: DataFrame) -> DataFrame:
    return sentences.filter(~tx.is_heading(F.col("sentence")))


def clean_sentences(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    letters: bool = True,
    stem: bool = False,
    lemmas: DataFrame | None = None,
    remove_stops: bool = True,
    stops: Sequence[str] = ENGLISH_STOP_WORDS,
    min_words: int = 0,
) -> DataFrame:
    """One row per cleaned sentence: key, sent_pos, words.

    Order of the steps: headings out, letters only, lower case, split, stem,
    lemma, stop words out. ``lemmas`` is a (word, lemma) table; without it no
    row leaves its task.
    """
    rows = drop_headings(sentence_rows(docs, key, text))
    words = tx.clean_words(F.col("sentence"), letters=letters, remove_stops=False)
    rows = rows.select(key, "sent_pos", words.alias("words"))
    if stem:
        rows = rewrite.stemmed(rows)
    if lemmas is not None:
        rows = map_words(rows, lemmas, [key, "sent_pos"])
    if remove_stops:
        rows = rows.withColumn("words", tx.without(F.col("words"), stops))
    if min_words:
        rows = rows.filter(F.size("words") >= min_words)
    return rows


def map_words(
    rows: DataFrame, mapping: DataFrame, keys: Sequence[str], words: str = "words"
) -> DataFrame:
    """Replace words by ``mapping`` (word, lemma), keeping their order.

    ``mapping`` holds only words that change; while it is small, arrays are
    rewritten inside their rows. Beyond that words meet it by a join, and the
    regrouping is by row of origin: a group is never larger than one row.
    """
    mapping, table = rewrite.whole(mapping.select("word", "lemma"))
    if table is not None:
        return rewrite.replaced(rows, table, keys, words)
    single = rows.select(*keys, F.posexplode_outer(words).alias("pos", "word"))
    mapped = single.join(lookup(mapping), "word", "left").select(
        *keys, "pos", F.coalesce("lemma", "word").alias("word")
    )
    gathered = mapped.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("pos", "word")))).alias(
            "_pairs"
        )
    )
    return gathered.select(*keys, F.transform("_pairs", lambda p: p["word"]).alias(words))


def document_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stops: Sequence[str] | None = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """One row per document: key, words (cleaned, headings left out)."""
    kept = F.filter(tx.sentences(F.col(text)), lambda s: ~tx.is_heading(s))
    words = F.flatten(
        F.transform(kept, lambda s: tx.split_whitespace(F.lower(tx.letters_only(s))))
    )
    if stops:
        words = tx.without(words, stops)
    return docs.select(key, words.alias("words"))


def topic_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stops: Sequence[str] = (*ENGLISH_STOP_WORDS, tx.MASK_WORD),
    lemmas: DataFrame | None = None,
    stem: bool = True,
) -> DataFrame:
    """Words for a topic model: mask, tokenise, tidy, stop words out, lemma, stem."""
    masked = F.lower(tx.mask_nonascii(F.col(text)))
    words = tx.without(tx.good_words(masked), stops)
    return _normalised(docs.select(key, words.alias("words")), key, lemmas, stem)


def _normalised(rows: DataFrame, key: str, lemmas: DataFrame | None, stem: bool) -> DataFrame:
    if lemmas is not None:
        rows = map_words(rows, lemmas, [key])
    return rewrite.stemmed(rows) if stem else rows


def tokenized_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sentence word lists for word vectors: mask, cut at full stops, tidy."""
    masked = F.lower(tx.mask_nonascii(F.col(text)))
    groups = F.transform(tx.period_sentences(masked), tx.good_words)
    return docs.select(key, groups.alias("all_sentences")).select(
        key,
        "all_sentences",
        F.filter("all_sentences", lambda s: F.size(s) > 0).alias("sentences"),
    )


def headline_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stops: Sequence[str] = ENGLISH_STOP_WORDS,
    shortest: int = 4,
    lemmas: DataFrame | None = None,
    stem: bool = True,
) -> DataFrame:
    """Headline words: base tokens, stop words and short words out, verb lemma, stem."""
    words = F.filter(
        tx.without(tx.simple_tokens(F.col(text)), stops), lambda w: F.length(w) >= shortest
    )
    return _normalised(docs.select(key, words.alias("words")), key, lemmas, stem)


def explode_words(rows: DataFrame, *keys: str, words: str = "words") -> DataFrame:
    return each(rows, words, "word", *keys)


def map_distinct(words: DataFrame, mapper: Column, name: str, word: str = "word") -> DataFrame:
    """(word, mapped) over the distinct words only."""
    return words.select(word).distinct().withColumn(name, mapper)
