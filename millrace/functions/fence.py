"""A way to name an intermediate value once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fenced(value: Column) -> Column:
    """``value``, which the optimiser will not copy into the expressions that use it.

    Filters pushed below a projection and merged projections repeat an expression for each use;
    with several levels of regular expressions the generated code outgrows what the JVM compiles.
    The condition always holds, but counts as not deterministic, which keeps the projection whole.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)
