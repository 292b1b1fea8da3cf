"""Cleaning and chunking of text, as plain column expressions.

Both chunkers cut the text with one ``regexp_extract_all`` pass and then take
the overlap from the neighbouring piece, so the cost is linear in the length of
the text; ``substring`` at growing offsets would rescan it for every window.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewell.functions import let
from pagewell.settings import CHUNK_OVERLAP, CHUNK_SIZE, LOOKAHEAD, MIN_CHUNK_CHARS

# Printable ASCII, and the six ASCII blanks (TAB LF VT FF CR SPACE).
UNPRINTABLE = r"[^\x09-\x0D\x20-\x7E]+"
# Runs of blanks but for a single space, which most are.
BLANK_RUN = r"[\x09-\x0D][\x09-\x0D\x20]*|\x20[\x09-\x0D\x20]+"
FIRST_WORD_START = r"^[^\x09-\x0D\x20]*[\x09-\x0D\x20]*"


def clean_text(text: Column) -> Column:
    """Drop everything but printable ASCII, fold each blank run to one space.

    A dropped character does not break a run, hence the order.
    """
    return F.regexp_replace(F.regexp_replace(text, UNPRINTABLE, ""), BLANK_RUN, " ")


def _overlapping(pieces: Column, overlap: int, align) -> Column:
    """Each piece but the first gets the tail of the one before it, minus the
    part up to the first word start."""

    def with_tail(ps: Column) -> Column:
        def extend(piece: Column, i: Column) -> Column:
            widened = F.concat(F.right(F.get(ps, i - 1), F.lit(overlap)), piece)
            return F.when(i == 0, piece).otherwise(align(widened))

        return F.transform(ps, extend)

    return let(pieces, with_tail)


def chunk_clean_text(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows of cleaned text: ``array<string>``, short and empty ones included.

    Cleaned text holds no line break and no two blanks in a row, so windows are
    exactly ``size`` long and alignment means: drop through the first space, or
    everything if there is none.
    """
    pieces = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0))

    def align(widened: Column) -> Column:
        return let(widened, lambda w: F.when(
            F.contains(w, F.lit(" ")), F.substr(w, F.instr(w, " ") + 1)
        ).otherwise(F.lit("")))

    return _overlapping(pieces, overlap, align)


def chunk_raw_text(
    text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, lookahead: int = LOOKAHEAD
) -> Column:
    """Chunks of text that may still have line breaks: ``array<string>``.

    Pieces end after a blank line if the text has any, else after each line
    break. Where no separator starts within ``size + lookahead`` characters the
    text is cut hard after ``size``.
    """

    def cut(separator: str) -> Column:
        pattern = "(?s).{0,%d}?%s|.{1,%d}" % (size + lookahead, separator, size)
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    pieces = (
        F.when(F.contains(text, F.lit("\n\n")), cut(r"\n\n"))
        .when(F.contains(text, F.lit("\n")), cut(r"\n"))
        .otherwise(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0)))
    )
    return _overlapping(pieces, overlap, lambda w: F.regexp_replace(w, FIRST_WORD_START, ""))


def keep_long(chunks: Column, min_chars: int = MIN_CHUNK_CHARS) -> Column:
    """Chunks with at least ``min_chars`` characters."""
    return F.filter(chunks, lambda c: F.char_length(c) >= min_chars)


def page_chunks(
    text: Column,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    min_chars: int = MIN_CHUNK_CHARS,
) -> Column:
    """Raw page text to its kept chunks: clean, cut, drop short ones. A missing
    text has none."""
    cleaned = clean_text(F.coalesce(text, F.lit("")))
    return keep_long(let(cleaned, lambda t: chunk_clean_text(t, size, overlap)), min_chars)
