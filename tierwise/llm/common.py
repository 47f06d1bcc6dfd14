"""Column expressions shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[ \t-\r]+"
LINE_SPACE = " \t\x0b\f\r"


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Runs of anything but the six ASCII space characters, in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def text_keys(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that stand for a text; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole), F.xxhash64(F.lit("second"), whole)]


# Bytes of texts that can belong to a term, lower-cased; all others become a space.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
LETTERS_DIGITS = bytes(b if 48 <= b <= 57 else LETTERS[b] for b in range(256))
TERM_BYTES = 4_000_000


def term_lists(text: bytes | None, kept: bytes, most: int = TERM_BYTES) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists that cover about ``most`` bytes each.

    Terms are longest runs of the characters ``kept`` (a table of 256 bytes) leaves; characters
    beyond ASCII always belong to terms. Only A-Z are lower-cased. Null has no terms.
    """
    if not text:
        return
    plain = text.translate(kept)
    at = 0
    while len(plain) - at > most:
        to = plain.find(b" ", at + most)
        if to < 0:
            break
        yield plain[at:to].split()
        at = to
    yield plain[at:].split() if at else plain.split()
