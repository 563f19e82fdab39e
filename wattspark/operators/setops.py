"""Set operations: bag union by column name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Bag union matching columns by name; a column missing from a frame is
    null there; columns are ordered by first appearance."""
    if not frames:
        raise ValueError("need at least one DataFrame")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out
