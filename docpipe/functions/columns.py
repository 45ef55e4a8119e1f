"""Small column helpers shared by the function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once inside a larger expression, so it is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def struct_of(**fields: Column) -> Column:
    return F.struct(*[column.alias(name) for name, column in fields.items()])


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for a costly value that is filtered on later. The one-row generator keeps the
    optimizer from copying the expression into every filter it pushes down."""
    kept = [F.col(c) for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(value)).alias(name))
