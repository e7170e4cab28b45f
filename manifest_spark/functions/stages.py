"""Columns bound once, in compiled methods of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that one generator makes, so that its compiled method stays small.
GROUP = 3


def settled(df: DataFrame, columns: list, group: int = GROUP) -> DataFrame:
    """``df`` with ``columns``, ``group`` at a time passed through a one-row generator.

    Catalyst neither pushes later filters on them below a generator nor merges
    later projections into it, both of which would evaluate rules again and
    again.  Nothing is stored.
    """
    for i in range(0, len(columns), group):
        df = df.select("*", F.inline(F.array(F.struct(*columns[i:i + group]))))
    return df
