"""Column expressions for comparing values between engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DecimalType, StringType


def canonical(c: Column, kind: DataType) -> Column:
    """Text that is equal for equal values: null is empty, decimals lose trailing zeros after the point."""
    if isinstance(kind, BooleanType):
        text = F.when(c, "true").otherwise("false")
        return F.when(c.isNull(), "").otherwise(text)
    text = c.cast("string")
    if isinstance(kind, DecimalType):
        text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.coalesce(text, F.lit(""))


def epoch_seconds(c: Column, kind: DataType) -> Column:
    """Seconds of an instant. Text is read as ISO-8601, without a zone as UTC; other text is null."""
    if isinstance(kind, StringType):
        return F.unix_micros(F.try_to_timestamp(c)) / 1e6
    return F.unix_micros(c.cast("timestamp")) / 1e6


def number(c: Column) -> Column:
    """A decimal from anything that reads as one; else null."""
    return c.cast("string").try_cast("decimal(38,10)")


def row_hash(columns: list[str], *, null_marker: str | None = None) -> Column:
    """60 bits of the row's MD5 as a wide decimal, whose sum doesn't depend on the order of rows.

    Nulls are skipped, so rows that differ only in where a null stands are
    equal; ``null_marker`` writes it out instead.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if null_marker is not None:
        parts = [F.coalesce(p, F.lit(null_marker)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("decimal(38,0)")


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of numbers; null if either has no length."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))
