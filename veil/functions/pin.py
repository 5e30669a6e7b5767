"""Columns that the optimizer must compute once.

Filters on a computed column are pushed below the projection that computes it,
with the whole expression written out in place of the column. For an array that
is read by position inside a lambda this would compute the array once per
element. A generator is a place through which no filter is pushed: exploding a
one-element array adds a column, keeps exactly one row per row, and pins its
value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns, each computed exactly once per row."""
    kept = [c for c in df.columns if c not in columns]
    box = F.struct(*[c.alias(name) for name, c in columns.items()])
    boxed = df.select("*", F.explode(F.array(box)).alias("_pinned"))
    return boxed.select(*kept, *[F.col("_pinned")[n].alias(n) for n in columns])
