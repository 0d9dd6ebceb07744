"""Text cleaning expressions (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubjay.functions.stats import col_

# Company-name suffixes removed by ``strip_suffixes`` (every match).
COMPANY_SUFFIX_PATTERN = r" (Inc\.|Co\.|Corporation|Airlines|Air Lines)"


def collapse_ws(c: str | Column, repl: str = " ") -> Column:
    """Replace every run of whitespace with ``repl``."""
    return F.regexp_replace(col_(c), r"\s+", repl)


def squish(c: str | Column) -> Column:
    """Trim and collapse inner whitespace to single spaces."""
    return F.trim(collapse_ws(c))


def proper(c: str | Column) -> Column:
    """Title case of the squished text (Spark ``initcap`` splits on spaces)."""
    return F.initcap(squish(c))


def clean_email(c: str | Column) -> Column:
    return F.lower(F.trim(col_(c)))


def category_token(c: str | Column) -> Column:
    """Trim, then turn every whitespace run into ``_``."""
    return collapse_ws(F.trim(col_(c)), "_")


def strip_suffixes(c: str | Column, pattern: str = COMPANY_SUFFIX_PATTERN) -> Column:
    return F.trim(F.regexp_replace(col_(c), pattern, ""))
