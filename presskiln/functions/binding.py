"""A name for a value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it.

    Spark shares equal parts of an expression only where they are sure to be needed, so a
    value used in the branches of a condition is worked out in each of them.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
