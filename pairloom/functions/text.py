"""Text column expressions: libsvm lines, model lines and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(x: Column) -> Column:
    """Whole numbers without a fraction (``1``), all others in full precision."""
    whole = (x == F.floor(x)) & (F.abs(x) < F.lit(1e15))
    return F.when(whole, x.cast("long").cast("string")).otherwise(x.cast("string"))


def libsvm_line(label: Column, indices: Column, values: Column) -> Column:
    pairs = F.zip_with(indices, values, lambda j, x: F.concat(j.cast("string"), F.lit(":"), number_text(x)))
    return F.concat_ws(" ", number_text(label), F.concat_ws(" ", pairs))


def double_text(x: Column, digits: int | None = None) -> Column:
    """A double as text: full precision, or ``digits`` fixed decimals."""
    if digits is None:
        return x.cast("string")
    return F.format_string(f"%.{digits}f", x)


def words(text: Column) -> Column:
    """Lower-cased words of a text, split at white space."""
    parts = F.split(F.lower(text), r"[ \t\n\r\f]+")
    return F.filter(parts, lambda w: w != F.lit(""))
