"""Binding a value to a name inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` written, and evaluated, once.

    Filters are pushed through projections by copying expressions. Where a chain of
    parsing steps uses each step several times, those copies multiply with every step;
    a bound variable keeps the copied expression as long as the chain.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_kept(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column and keep the rows where it is not null, computing it once.

    A filter on a computed column is pushed below the projection, which computes the
    column a second time. A filter on a generated column stays where it is.
    """
    return df.withColumn(name, F.explode_outer(F.array(value))).filter(F.col(name).isNotNull())
