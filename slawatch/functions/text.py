"""Text cleaning and simple text features as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import ENGLISH

# Letters of any script survive cleaning; everything else becomes a space.
NON_LETTERS = r"[^\p{L}]+"
MIN_TOKEN_LETTERS = 2


def stop_words() -> tuple[str, ...]:
    """The stop-word list the Spark job and the SQL oracle both use."""
    return ENGLISH


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(text: Column | str) -> Column:
    """Lower-case, every run of non-letters to one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(_c(text)), NON_LETTERS, " "))


def words(clean: Column | str) -> Column:
    """Words of normalised text; empty array for empty text."""
    c = _c(clean)
    return F.when(c == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(c, " "))


def content_tokens(clean: Column | str, stop: tuple[str, ...] | None = None) -> Column:
    """Words of at least two letters that are not stop words."""
    stop_list = list(stop if stop is not None else stop_words())
    return F.filter(
        words(clean),
        lambda w: (F.length(w) >= MIN_TOKEN_LETTERS) & ~w.isin(stop_list),
    )


def clean_text(text: Column | str, stop: tuple[str, ...] | None = None) -> Column:
    """Lower-case, strip punctuation and digits, squeeze spaces, drop stop
    words (and one-letter words)."""
    return F.array_join(content_tokens(normalize_text(text), stop), " ")


def word_count(text: Column | str) -> Column:
    """Number of letter words in the text (0 for text with no letters)."""
    return F.size(words(normalize_text(text))).cast("long")


def text_len(text: Column | str) -> Column:
    """Length in characters."""
    return F.length(_c(text)).cast("long")
