"""Name a value inside an expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row.

    A column used several times in one expression may be computed as often.
    As the only element of an array it is computed once and then passed on.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
