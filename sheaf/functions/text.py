"""Text expressions. All of them stay inside the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from sheaf.fixed import WHITESPACE
from sheaf.functions.binding import let


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove Unicode white space from both ends.

    Trimming the end walks the whole value, character by character, so only values that
    end in white space are trimmed there. A regular expression anchored at the end would
    rescan every run of blanks inside.
    """
    def trimmed(t: Column) -> Column:
        ends_blank = reduce(or_, [t.endswith(w) for w in WHITESPACE])
        return F.when(ends_blank, F.btrim(t, F.lit(WHITESPACE))).otherwise(F.ltrim(t, F.lit(WHITESPACE)))

    return let(_col(c), trimmed)


def byte_slice(text: Column, start: Column | int, size: Column) -> Column:
    """Part of a text by its place in UTF-8: places in characters are found by walking the text."""
    start = F.lit(start) if isinstance(start, int) else start
    return text.cast("binary").substr(start, size).cast("string")


def at_most(text: Column, chars: int) -> Column:
    """Whether a text has so many characters at most; they are counted only where its bytes do not tell."""
    size = F.octet_length(text)
    return (size <= chars) | ((size <= 4 * chars) & (F.length(text) <= chars))


def is_filled(c: Column | str) -> Column:
    """True when the value is there and holds something other than white space."""
    return F.coalesce(strip(c) != "", F.lit(False))


def count_words(c: Column | str) -> Column:
    """Number of runs of non-blank characters: an approximate token count."""
    return F.size(F.regexp_extract_all(_col(c), F.lit(r"(\S+)"), F.lit(1)))
