"""Set operations: UNION ALL by name across differing schemas (S3, S4, U1) and UNION."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def unir_por_nombre(frames: Sequence[DataFrame], drop: Sequence[str] = ()) -> DataFrame:
    """Append frames aligned by column name; a column missing from a frame is NULL there.

    Columns in ``drop`` are removed when present (a no-op otherwise). No shuffle.
    """
    if not frames:
        raise ValueError("no frames to union")
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.drop(*drop) if drop else out


def union_distinta(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL ``UNION``: rows of both, whole-row duplicates removed (a shuffle on all columns)."""
    return a.unionByName(b).distinct()
