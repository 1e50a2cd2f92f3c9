"""Latest-row-per-key reductions for tables whose rows change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def freshest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` values.

    ``max_by`` combines inside each input partition before the shuffle; a key with any number of
    versions therefore never gathers in one task. Put tie-breaking columns last in ``order`` so
    that the winner is the same on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    winner = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(winner).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )
