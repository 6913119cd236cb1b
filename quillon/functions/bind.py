"""Binding of a value that an expression uses more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once for each row however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
