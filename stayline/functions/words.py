"""Clean-up of free text into words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates segments, what is removed inside one, what separates words.
SEGMENT_BREAK = r"[-/_+]"
REMOVED = r"[\p{Nd}.,=!@#$%^&*(){}\[\];:\"\\|<>/?~`'-]"
WORD_BREAK = r"[\s\u00ab\u00bb\u2018\u2019\u201c\u201d\u201e]+"
# Words that read as numbers, and two-part contractions.
NUMBER_WORDS = ("nan", "inf", "infinity")
CONTRACTION = r"\b(?:(can)(not)|(gim|lem)(me)|(gon|wan)(na)|(got)(ta))\b"
CONTRACTION_PARTS = "$1$3$5$7 $2$4$6$8"


def words_of(text: Column) -> Column:
    """All words of a text, lower case, in order, repeated as often as they occur."""
    segments = F.regexp_replace(text, SEGMENT_BREAK, " ")
    plain = F.lower(F.regexp_replace(segments, REMOVED, ""))
    parted = F.regexp_replace(plain, CONTRACTION, CONTRACTION_PARTS)
    return F.filter(F.split(parted, WORD_BREAK), is_word)


def is_word(word: Column) -> Column:
    """Longer than one character and not read as a number."""
    return (F.length(word) > 1) & ~word.isin(*NUMBER_WORDS)
