"""Text expressions that agree with Python's and RE2's character classes on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.strip, str.split and \s take for white space.
WS_CHARS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = f"[{WS_CHARS}]"
# Python's \w, and the CJK block that ratios count as letters.
WORD_CHARS = r"\p{L}\p{N}_"
CJK_CHARS = r"\x{4e00}-\x{9fff}"
# RE2's ASCII \b and \s, spelled for engines whose own are Unicode-aware.
BOUNDARY = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"
RE2_SPACE = r"[\t\n\f\r ]"
#: A leading argument that turns xxhash64 (seed 42) into a hash with seed 0 (fixed value).
SEED_ZERO = -365884300664092260


def strip(c: Column) -> Column:
    """Python's ``str.strip()``."""
    return F.regexp_replace(c, rf"\A{WS}+|{WS}+\z", "")


def line_feeds(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def normalise(c: Column) -> Column:
    """One kind of line end, no outer white space, at most one blank line in a row; null becomes empty."""
    return F.regexp_replace(strip(line_feeds(F.coalesce(c, F.lit("")))), "\n{3,}", "\n\n")


def flatten_space(c: Column) -> Column:
    """``" ".join(text.split())``; null becomes empty."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), f"{WS}+", " "))


def fold(c: Column) -> Column:
    """Lower case and single spaces, as near-duplicate shingles are taken from."""
    return strip(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), f"{WS}+", " "))


def count_in(c: Column, chars: str) -> Column:
    """Code points of ``c`` in a character class."""
    return F.length(c) - F.length(F.regexp_replace(c, f"[{chars}]+", ""))


def xxh64(c: Column) -> Column:
    """xxh64 with seed 0 of the UTF-8 bytes, as the bit pattern of an unsigned value."""
    return F.xxhash64(F.lit(SEED_ZERO).cast("long"), c)


def unsigned_text(c: Column) -> Column:
    """Decimal text of a BIGINT read as an unsigned 64-bit value."""
    wide = c.cast("decimal(20,0)")
    return F.when(c < 0, wide + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide).cast("string")


def document_id(path: Column, url: Column, date: Column, record: Column) -> Column:
    """SHA-1 over the four parts, one a line; missing parts are empty lines."""
    return F.sha1(F.concat_ws("\n", *[F.coalesce(x, F.lit("")) for x in (path, url, date, record)]))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
