"""Join helpers that leave the strategy to measured sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

def null_safe_semi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows whose key is on the right, NULL being equal to NULL.

    No hint: the right side is broadcast only where its measured size allows it.
    """
    wanted = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(wanted, on, "left_semi")
