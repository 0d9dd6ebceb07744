"""Column types from text, as a mergeable aggregate.

Every value is a set of types it can be read as, one bit each; the types of a column are the bits that all its values
share (``bit_and``), so partial results merge in any order and one pass serves all columns. The column gets the
narrowest type that is left. Outer white space does not count. Nulls and blank values say nothing.

Decided on purpose: a number with a leading zero ("007") is a code and stays text, a plain "0" or "0.5" is a number;
whole numbers beyond a bigint are text, not rounded doubles; "1" and "0" are numbers, never booleans; NaN and Infinity
are text; dates are ``yyyy-MM-dd`` that exist; a timestamp has a date and a time of day
(and perhaps a zone, else the session's); a column without values is text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The types from the narrowest to the widest with the form their texts have. Every int is also a bigint
# and a double, every date also a timestamp; text is what is left.
WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
NUMBER = r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
TRUTH = r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
TYPES = ("boolean", "int", "bigint", "double", "date", "timestamp")


def _bits(*names: str) -> int:
    return sum(1 << TYPES.index(name) for name in names)


def _trimmed_bits(text: Column) -> Column:
    """``type_bits`` of a text without outer spaces.

    No text has two of the forms (a whole number is a number, a day a moment), so each is tried only where those before it
    failed; digits, signs and the point sort before ``:``, the letters of truth values after it.
    """
    whole = F.when(text.try_cast("int").isNotNull(), _bits("int", "bigint", "double")).when(
        text.try_cast("bigint").isNotNull(), _bits("bigint", "double")).otherwise(0)
    number = F.when(F.abs(text.try_cast("double")) != float("inf"), _bits("double")).otherwise(0)
    moment = F.when(text.try_cast("timestamp").isNotNull(), _bits("timestamp")).otherwise(0) + F.when(
        text.rlike(DAY) & text.try_cast("date").isNotNull(), _bits("date")).otherwise(0)
    letters = F.when(text.rlike(TRUTH), _bits("boolean")).otherwise(0)
    return F.when(text == "", None).when(text >= ":", letters).when(text.rlike(WHOLE), whole).when(
        text.rlike(NUMBER), number).when(text.rlike(MOMENT), moment).when(text.isNotNull(), 0)


def type_bits(c: str | Column) -> Column:
    """The types that one text can be read as, as bits; null for a null or blank one."""
    return _trimmed_bits(F.trim(F.col(c) if isinstance(c, str) else c))


def type_bits_array(cols: Sequence[str]) -> Column:
    """``type_bits`` of several columns in their order, as one array.

    One function runs over the values, so the code that Spark generates does not grow with the columns. To share the bits
    of a column with ``observe``, select this first: what ``observe`` itself has to compute is evaluated row by row without
    generated code.
    """
    return F.transform(F.transform(F.array(*[F.col(c) for c in cols]), lambda text: F.trim(text)), _trimmed_bits)


def shared_bits(c: str | Column) -> Column:
    """Aggregate: the types that all values of a column share; null without a value."""
    return F.bit_and(type_bits(c))


def narrowest(bits: int | None) -> str:
    """The narrowest type among ``bits``, ``string`` if there is none."""
    return next((name for place, name in enumerate(TYPES) if bits and bits >> place & 1), "string")


def infer_types(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, str]:
    """The narrowest type that no value fails, per text column, from one pass; columns of other types keep theirs."""
    cols = list(df.columns if cols is None else cols)
    types = dict(df.dtypes)
    texts = [c for c in cols if types[c] == "string"]
    found = df.agg(*[shared_bits(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(texts)]).first() if texts else ()
    return {**{c: types[c] for c in cols}, **{c: narrowest(bits) for c, bits in zip(texts, found)}}


def cast_inferred(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``df`` with its text columns in their inferred types; blank values of a typed column become null."""
    return df.select(*[
        F.when(F.trim(f"`{c}`") != "", F.trim(f"`{c}`").try_cast(t)).alias(c)
        if kind == "string" and (t := types.get(c, "string")) != "string" else F.col(f"`{c}`")
        for c, kind in df.dtypes])
