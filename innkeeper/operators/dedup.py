"""Duplicate handling (D1-D3) and duplicate counting.

All of these are aggregations, never windows: the hash/sort aggregate combines
copies map-side before the shuffle, so a key that holds a third of all rows is
reduced to one row per map task before it moves.  A ``row_number`` window would
instead send every copy of the hot key to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Places of a bitmap per distinct key up to which it is smaller than the keys themselves (64 bits each).
DENSE_PLACES = 64


def drop_exact_duplicates(df: DataFrame, copies: str | None = None) -> DataFrame:
    """Keep one row per distinct full row (NULLs compare equal); with the number of rows it stands for as ``copies``."""
    if copies is None:
        return df.distinct()
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(copies))


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """One row per ``keys``; the kept row is the smallest by ``order_by``
    (default: the remaining columns in order), NULLs first; with the number of its key's rows as ``copies``.

    Files carry no row order, so "keep first" needs an explicit order; this one is
    deterministic.  Implemented as ``min(struct(order..., payload...))`` per key.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order_by = list(order_by) if order_by is not None else rest
    fields: list[Column] = []
    for i, c in enumerate(order_by):
        fields.append(F.col(c).isNotNull().alias(f"_nn{i}"))
        fields.append(F.col(c).alias(f"_ob{i}"))
    fields += [F.col(c).alias(c) for c in rest]
    first = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_first"), *([F.count(F.lit(1)).alias(copies)] if copies else []))
    more = [copies] if copies else []
    return first.select(*[F.col(k) for k in keys], *[F.col("_first")[c].alias(c) for c in rest], *more).select(
        *df.columns, *more
    )


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key (NULL keys count as equal), one row
    ``duplicates BIGINT``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def dense_distinct(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, Column] | None:
    """A3/A4 by bitmaps: one row per block of 32,768 neighbouring keys (``_rows`` and a bitmap of the keys met), and the
    aggregate over them that is the exact number of distinct keys.  A task ships a bitmap per block and
    never a row per key.  None if the keys aren't integers or lie too thinly.

    Several columns are packed into one number, the one of fewest values in front; a NULL is a value of a composite key, and
    none of a single one, as in ``COUNT(DISTINCT ...)``.  The ranges come from one aggregation without a shuffle of rows."""
    if not all(isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for c in cols):
        return None
    ranges = df.agg(F.count(F.lit(1)), *[x for c in cols for x in (F.min(c), F.max(c))]).first()
    rows, spans = ranges[0], []
    for i, c in enumerate(cols):
        low, high = ranges[1 + 2 * i], ranges[2 + 2 * i]
        spans.append((2 + high - low if low is not None else 1, low or 0, c))
    places = 1
    for span, _, _ in spans:
        places *= span
    if places > max(DENSE_PLACES * rows, 1 << 15) or places >= 1 << 62:
        return None
    packed = F.lit(0).cast("bigint")
    for span, low, c in sorted(spans):
        packed = packed * F.lit(span).cast("bigint") + F.coalesce(F.col(c).cast("bigint") - F.lit(low).cast("bigint") + 1, F.lit(0).cast("bigint"))
    packed = packed + 1  # blocks and places of positive numbers
    counted = F.lit(True) if len(cols) > 1 else F.col(cols[0]).isNotNull()
    place = F.when(counted, F.bitmap_bit_position(packed))
    blocks = df.groupBy(F.bitmap_bucket_number(packed).alias("_block")).agg(F.count(F.lit(1)).alias("_rows"), F.bitmap_construct_agg(place).alias("_bits"))
    return blocks, F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0))
