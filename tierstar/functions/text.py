"""Text cleaning as column expressions; all of it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unquoted(c: Column) -> Column:
    """Trim outer blanks and drop every double quote; blanks that stood inside the quotes stay."""
    return F.replace(F.trim(c), F.lit('"'), F.lit(""))


def filled(c: Column) -> Column:
    """NULL for text that is empty or all blank."""
    return F.when(F.rtrim(c) != "", c)


def present(c: Column) -> Column:
    """Whether raw text has anything left after cleaning: one look at it, instead of cleaning it to find out."""
    return c.rlike('[^ "]')


def clean_text(c: Column) -> Column:
    """The baseline for every text column: unquoted, and NULL where nothing but blanks is left."""
    return filled(unquoted(c))


def limited(c: Column, size: int) -> Column:
    """Variable-length text: the first ``size`` characters (Spark's own varchar cast does not cut)."""
    return F.left(c, F.lit(size))


def fixed(c: Column, size: int) -> Column:
    """Fixed-length text in its unpadded form, so that equal padded values compare equal."""
    return F.rtrim(limited(c, size))


def fixed_upper(c: Column, size: int) -> Column:
    return F.upper(fixed(c, size))
