"""Text functions: tokens, trimming, first line, sliding chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed value: runs of Unicode whitespace and the four separator controls, which
# are the blanks of Python's ``str.split``. The property test of (?U) is measured
# to be twice as fast as a class that lists the characters.
BLANKS = r"(?U)[\s\x1c-\x1f]+"

# Fixed value: the same characters as a string, for trimming.
WHITESPACE_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens; an empty array for null text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), BLANKS)
    return F.array_remove(words, "")


def strip(text: Column) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE_CHARACTERS))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def one_of(column: str, values: Sequence[str]) -> Column:
    """Whether a text column has one of many values; one parsed expression, as a Column for each takes a call each."""
    quoted = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"{column} IN ({quoted})") if values else F.lit(False)


def word_count(text: Column) -> Column:
    return F.size(tokens(text))


def distinct_matches(words: Column, text: Column) -> Column:
    """How many distinct words occur in the text as substrings, ignoring case."""
    haystack = F.lower(text)
    return F.size(F.filter(F.array_distinct(words), lambda word: F.contains(haystack, word)))


def chunk_count(text: Column, size: int, overlap: int) -> Column:
    """Number of windows of ``size`` characters needed to reach the end of the text."""
    step = size - overlap
    return F.greatest(F.lit(0), F.ceil((F.length(text) - size) / F.lit(step))).cast("int") + 1


def check_window(size: int, overlap: int) -> None:
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError(f"need size > 0 and 0 <= overlap < size, got {size} and {overlap}")


def step_pieces(text: Column, step: int) -> Column:
    """The text cut into consecutive pieces of ``step`` characters, in one pass."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))


def window_at(pieces: Column, index: Column, size: int, step: int) -> Column:
    """Window ``index`` rebuilt from its piece and the pieces that its overlap reaches."""
    reach = -(-size // step)
    joined = F.array_join(F.slice(pieces, index + 1, reach), "")
    return strip(F.substring(joined, 1, size))
