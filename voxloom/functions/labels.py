"""Label keys: labels are compared without case and without white space at the ends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of Unicode white space.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"


def strip(text: Column) -> Column:
    """``text`` without Unicode white space at its ends; null stays null."""
    return F.trim(text, F.lit(WHITE_SPACE))


def label_key(label: Column, upper: bool = False) -> Column:
    """Comparison form of a label; null for a null or blank label."""
    key = strip(label)
    return F.when(F.length(key) > 0, F.upper(key) if upper else F.lower(key))
