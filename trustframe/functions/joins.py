"""Joins against derived tables whose size is checked before broadcasting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustframe.session import cut_lineage

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20
_NO_FIXED_WIDTH = {"string", "varchar", "char", "binary", "array", "map", "struct", "variant"}


def materialize_small(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Checkpoint a derived table (cuts lineage; reused without recomputing the
    scan behind it) and report whether it is small enough to broadcast, by rows
    and by bytes (8 a field, and those of its values written as strings where
    a type has no fixed width)."""
    small = cut_lineage(small, large=False)
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)).cast("long")
            for f in small.schema.fields if f.dataType.typeName() in _NO_FIXED_WIDTH]
    held = reduce(lambda x, y: x + y, wide, F.lit(8 * len(small.columns)).cast("long"))
    size = small.agg(F.count(F.lit(1)).alias("rows"), F.sum(held).alias("bytes")).first()
    return small, size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Put several one-row aggregates side by side without a join: union them
    (each contributes its own columns, NULL elsewhere) and take the first
    non-NULL value per column in one global aggregate."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols += [c for c in f.columns if c not in cols]
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
