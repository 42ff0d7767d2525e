"""Text column helpers whose results match Python string rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() and \s treat as white space.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# The line ends Python's str.splitlines() knows, after newline normalising.
LINE_ENDS = "\n\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
LINE_END = r"[\n\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(SPACES))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(col(c), F.lit(SPACES))


def is_blank(c: Column | str) -> Column:
    """Null or without any character that is not white space; stops at the first such character."""
    return ~F.regexp_like(F.coalesce(col(c), F.lit("")), F.lit(f"[^{SPACE[1:]}"))


def nonempty(c: Column | str) -> Column:
    """Null for the empty string, else the value."""
    return F.nullif(col(c), F.lit(""))


def first_nonempty(*cs: Column | str) -> Column:
    """First value that is neither null nor empty, '' when there is none."""
    return F.coalesce(*[nonempty(c) for c in cs], F.lit(""))


def preview(c: Column | str, n: int) -> Column:
    return F.substring(col(c), 1, n)


def words(c: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(col(c)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def group(c: Column | str, pattern: str, n: int = 1) -> Column:
    """Regex group n of the first match; null without a match."""
    c = col(c)
    return F.when(F.regexp_like(c, F.lit(pattern)), F.regexp_extract(c, pattern, n))
