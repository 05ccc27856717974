"""Helpers that shape the plan rather than the result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """The value through an explode of one element.

    A filter on a projected value is pushed below the projection, where its definition is repeated
    for every use. It is not pushed below an explode, so a costly value is computed once per row.
    """
    return F.explode(F.array(value))
