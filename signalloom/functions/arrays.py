"""Exploding computed lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def explode_rows(df: DataFrame, name: str, items: Column | str) -> DataFrame:
    """One row per list element; rows with empty lists disappear.

    The outer form with a filter on its output is used because a plain explode of a computed list
    also filters on the list's size below the projection, which would compute the list twice.
    """
    return df.withColumn(name, F.explode_outer(items)).filter(F.col(name).isNotNull())


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row however often they are read.

    They come out of a generator, which the optimizer does not copy into later filters, lambdas and projections.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))
