"""Mask expressions for personal columns."""

from pyspark.sql import functions as F

from cutline import fixed_values as fixed


def masked(column, may_see):
    """The value for members, a fixed text for everyone else (NULL is masked too)."""
    return F.when(may_see, column).otherwise(F.lit(fixed.MASK_TEXT))
