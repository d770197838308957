"""Tokens, stop words and word-list labels as built-in column expressions.

The result is that of a regex tokenizer followed by a stop word filter; written
as plain expressions it stays in one projection over the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldpan.functions.stopwords import ENGLISH_STOP_WORDS

# Fixed value: anything but a to z separates words (D).
WORD_SEPARATOR = "[^a-z]+"


def words(text: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """Lower-case words of the whole text, in order, without stop words."""
    dropped = ["", *stop_words]
    return F.filter(F.split(F.lower(text), WORD_SEPARATOR), lambda word: ~word.isin(dropped))


def any_word_in(words: Column, lexicon: Iterable[str]) -> Column:
    """1 if a word is in the lexicon, else 0; null words count as none."""
    listed = [word.lower() for word in lexicon]
    hit = F.exists(words, lambda word: word.isin(listed))
    return F.when(hit, 1).otherwise(0)
