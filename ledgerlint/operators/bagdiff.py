"""Missing count: expected elements not found in the available list.

This is a *bag* difference: every occurrence of an expected element that is
absent from the available list counts, so ``[1, 1, 2, 3]`` minus ``[2]`` is 3.
``array_except`` would deduplicate and is wrong here.  A missing available
list (no LEFT-join match) means everything is missing.

``missing_bits`` is the pipeline's form: bitmaps, with the multiplicity of a
bitmap beside it.  ``missing_count`` is the same on lists, for reports.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlint.functions.scalar import ColumnOrName, bigint, col


def missing_bits(expected: ColumnOrName, times: ColumnOrName, available: ColumnOrName) -> Column:
    """How many elements of ``times`` equal expected sets the available set lacks."""
    have = F.coalesce(col(available), F.lit(0).cast("bigint"))
    return col(times) * bigint(F.bit_count(col(expected).bitwiseAND(F.bitwise_not(have))))


def missing_count(expected: ColumnOrName, available: ColumnOrName) -> Column:
    exp, avail = col(expected), col(available)
    have = F.coalesce(avail, F.array().cast("array<bigint>"))
    return F.size(F.filter(exp, lambda x: ~F.array_contains(have, x))).cast("bigint")
