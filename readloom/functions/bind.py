"""Binding of a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once however often it is used: as the variable of a one-item transform."""
    return F.get(F.transform(F.array(value), use), 0)
