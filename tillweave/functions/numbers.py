"""Number parsing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, StringType

from tillweave.functions.text import BLANKS
from tillweave.vocabulary import MEASURE

# The cast alone would take texts like "1d" or "NaN" as numbers.
_NUMBER = r"\A[{blanks}]*([+-]?(?:[0-9]+[{point}]?[0-9]*|[{point}][0-9]+)(?:[eE][+-]?[0-9]+)?)[{blanks}]*\z"
_PLAIN = r"\A[0-9]+(?:[{point}][0-9]+)?\z"


def text_to_number(text: Column, *, decimal_comma: bool = True) -> Column:
    """NUM-1 for text: bad numbers become null."""
    # Empty where the text is no number, which no cast accepts.
    point = ".," if decimal_comma else "."
    number = F.regexp_extract(text, _NUMBER.format(blanks=BLANKS, point=point), 1)
    # Most numbers are plain; a test takes a fraction of the time of an extraction.
    plain = F.when(text.rlike(_PLAIN.format(point=point)), text).otherwise(number)
    return F.replace(plain, F.lit(","), F.lit(".")).try_cast("double")


def to_number(column: Column, kind: DataType, *, decimal_comma: bool = True) -> Column:
    """Double value of a column of any type; never NaN."""
    if isinstance(kind, StringType):
        return text_to_number(column, decimal_comma=decimal_comma)
    if isinstance(kind, (DoubleType, FloatType)):
        number = column.cast("double")
        return F.when(~F.isnan(number), number)
    if isinstance(kind, DecimalType):
        return column.cast("double")
    return column.try_cast("double")


def null_as_zero_sum(columns: list[Column]) -> Column:
    """NUM-3, NUM-4: row-wise sum from left to right, null counts as 0."""
    total = F.lit(0.0)
    for column in columns:
        total = total + F.coalesce(column, F.lit(0.0))
    return total


def measure(column: Column) -> Column:
    return column.cast(MEASURE)


def exact_sum(column: Column) -> Column:
    return F.sum(measure(column))
