"""Plan shaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def derive(df: DataFrame, keep: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """``keep`` plus computed columns, each computed once per row.

    A filter on a computed column would otherwise move below the projection
    and parse the same text again, and below a join, where it would parse rows
    that the join drops.  A one-element ``inline`` is not crossed by filters
    and stays in the generated stage.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
