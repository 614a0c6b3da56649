"""Text and word functions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordtide.fixed import LONG_WORD_OVER, POSITIVE_CODE_OVER

# Spelled out, so that another engine with a different ``\s`` can be given the same class.
WHITESPACE = r" \t\n\x0B\f\r"
ALNUM = string.ascii_letters + string.digits

# Written as single characters, not as ``A-Za-z0-9``: the JVM turns listed Latin-1 characters into
# one bit set but each range into one more chained predicate, and those chains stop scaling when
# many task threads of one executor match at the same time (measured: 8x slower on 8 threads).
PUNCTUATION = f"[^{ALNUM}{WHITESPACE}]+"
WORD_GAP = f"[{WHITESPACE}]+"


def strip_punctuation(text: Column) -> Column:
    """Delete (not blank out) everything but ASCII letters, digits and white space."""
    return F.regexp_replace(text, PUNCTUATION, "")


def word_array(text: Column) -> Column:
    """Lower-cased words of a text, cut at white space.

    A leading gap gives an empty first word, which counts as a word. A trailing gap gives an empty
    last one, which does not; ``operators.tokenize`` drops it after the explode, which is cheaper
    than another pass over the text.
    """
    return F.split(F.lower(strip_punctuation(text)), WORD_GAP)


def has_words(text: Column) -> Column:
    """False for a text that is only white space once stripped; true for any other, even ``''``.

    Asked of the raw text, where both tests stop at the first hit, so that the costly
    ``strip_punctuation`` is not evaluated a second time inside a filter.
    """
    return text.rlike(f"[{ALNUM}]") | ~text.rlike(f"[{WHITESPACE}]")


def is_long(word: Column) -> Column:
    return F.length(word) > LONG_WORD_OVER


def is_short(word: Column) -> Column:
    return F.length(word) <= LONG_WORD_OVER


def is_positive(word: Column) -> Column:
    """First code point above the limit: ``o``-``z`` and every non-ASCII letter; '' is not.

    Strings compare by code point, so that is the same as not sorting before the next code point:
    a plain comparison, with nothing cut out of the word, that a file scan takes as a filter.
    """
    return word >= F.lit(chr(POSITIVE_CODE_OVER + 1))


def is_long_positive(word: Column) -> Column:
    return is_long(word) & is_positive(word)


def is_long_negative(word: Column) -> Column:
    return is_long(word) & ~is_positive(word)
