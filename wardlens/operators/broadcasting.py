"""Broadcast behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.session import cut_lineage

MAX_ROWS = 10_000


def checked_broadcast(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Compute a join side once, and mark it for broadcast only if it is small.

    The side is checkpointed first, so counting it costs nothing extra and the join reads the
    stored rows. A larger side is returned unmarked and joins by shuffle.
    """
    stored = cut_lineage(df)
    fits = stored.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(stored) if fits else stored
