"""Broadcast behind a check of size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a catalogue-like table is broadcast.
SMALL = 100_000


def broadcast_if_small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """The frame with a broadcast hint if it has at most ``most`` rows, else as it is, for a shuffled join.

    Counting stops one row past the bound.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
