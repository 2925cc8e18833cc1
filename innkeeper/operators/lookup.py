"""Key lookups, semi/anti joins and the broadcast policy (J-series, K3, U3).

Broadcast policy: a side is broadcast only after ``checked_broadcast`` has proved its
rows and bytes small, from a row count observed while it was written or by one
aggregation (a row per task).  Larger sides are left to Catalyst and adaptive execution:
a shuffle join with runtime skew splitting (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a lookup side may have at most to be broadcast.
DEFAULT_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20
# Memory of a row besides its texts: a slot per column and the row's own overhead.
_SLOT_BYTES, _ROW_BYTES = 8, 32


def side_size(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes of ``df``, by one aggregation."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    text_bytes = F.coalesce(F.sum(sum(texts, F.lit(0)).cast("long")), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), text_bytes).first()
    return rows, size + rows * (_ROW_BYTES + _SLOT_BYTES * len(df.columns))


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` if it is proved small in rows and bytes, else ``df`` unchanged.
    ``known_rows`` (e.g. observed while the table was written) skips the aggregation for sides without texts."""
    rows = known_rows
    if rows is not None and rows > max_rows:
        return df
    if rows is None or any(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in df.schema.fields):
        rows, size = side_size(df)
    else:
        size = rows * (_ROW_BYTES + _SLOT_BYTES * len(df.columns))
    return F.broadcast(df) if rows <= max_rows and size <= MAX_BROADCAST_BYTES else df


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    natural_key: str,
    surrogate_key: str,
    how: str = "inner",
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    dim_rows: int | None = None,
) -> DataFrame:
    """Add ``surrogate_key`` by equality on ``natural_key``.

    ``how='left'`` keeps unmatched rows with a NULL key; ``'inner'`` drops them.
    NULL natural keys never match (the dimension holds none).
    """
    side = dim.select(natural_key, surrogate_key)
    return df.join(checked_broadcast(side, max_broadcast_rows, dim_rows), natural_key, how)


def without_match(
    df: DataFrame, parent: DataFrame, keys: Sequence[str] | str, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """Rows of ``df`` whose key has no row in ``parent`` (left anti join)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ids = parent.select(*keys)
    return df.join(checked_broadcast(ids, max_broadcast_rows), keys, "left_anti")


def missing_parent_ids(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL ``key`` values of ``child`` absent from ``parent``."""
    ids = child.select(key).dropna().distinct()
    return ids.join(parent.select(key).dropna(), key, "left_anti")


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION (by column name) without duplicates."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
