"""Surrogate keys (K1, K2).

Two numberings: ``dense_key`` in the order of a natural key, for dimensions, and
``layout_key`` in the order of the files that a fact is written to, so that the shuffle of the
numbering is that of the write.

``dense_key`` numbers rows 1..N in the order of a natural key, by one plan at every size and
without a single-partition window:

1. cut points of the sort value (``percentile_approx``, reads only that column) are
   collected once and become literals;
2. a bucket column is computed from those literals (``Bucketizer``, a JVM binary
   search over the splits), so it is deterministic in every later job and on
   every retry;
3. rows per bucket are counted (reads only the key columns), checked, and turned
   into offsets on the driver (one number per bucket);
4. ``repartitionById`` places each bucket in its own task (no sampling job, no two buckets
   hashed onto one task), and ``row_number()`` over ``partitionBy(bucket).orderBy(order...)`` plus the
   bucket's offset is the key.

Approximate bounds only change how balanced the buckets are, never the numbers.
A text key gets its sort value from the bytes behind the prefix that all its values share.
The input must be deterministic (true for Parquet scans and the expressions in
this package), or be written first (``checkpoint=True``).
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper.session import Scratch, ensure_checkpoint_dir

# A bucket is sorted by one task (it spills); more rows than this mean that the sort value has
# a hot value, which buckets of it can't split.
MAX_BUCKET_ROWS = 50_000_000
# Rows of a piece of a layout, which one task sorts and writes as one file: this many at most, and fewer (but not
# under the second number) while that keeps more tasks busy.
PIECE_ROWS, LEAST_PIECE_ROWS = 8_000_000, 50_000
# Bytes of a text key that make its sort value: as many as a double keeps exactly.
_TEXT_BYTES = 6


def _text_rank(df: DataFrame, name: str) -> Column:
    """A number that is non-decreasing in a text column: the bytes behind the prefix shared by
    the column's least and greatest value (and so by all between them)."""
    low, high = df.agg(F.min(name).cast("binary"), F.max(name).cast("binary")).first()
    shared = 0
    while low is not None and shared < min(len(low), len(high)) and low[shared] == high[shared]:
        shared += 1
    behind = F.hex(F.substring(F.col(name).cast("binary"), shared + 1, _TEXT_BYTES))
    return F.conv(F.rpad(behind, 2 * _TEXT_BYTES, "0"), 16, 10).cast("double")


def _bucketed(df: DataFrame, value: Column, cuts: list[float]) -> tuple[DataFrame, int]:
    """``df`` plus ``_bucket`` (0-based, non-decreasing in ``value``, NULL first)
    and the number of buckets."""
    # Doubles keep the order of any number (rounding is monotone); equal
    # roundings just share a bucket.  NULL -> -inf (first), NaN -> extra last bucket.
    splits = [float("-inf"), *cuts, float("inf")]
    v = F.coalesce(value.cast("double"), F.lit(float("-inf")))
    bucketizer = Bucketizer(splits=splits, inputCol="_v", outputCol="_b", handleInvalid="keep")
    out = bucketizer.transform(df.withColumn("_v", v))
    return out.withColumn("_bucket", F.col("_b").cast("int")).drop("_v", "_b"), len(splits)


def default_buckets(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def dense_key(
    df: DataFrame,
    order_by: Sequence[str],
    out_col: str,
    sort_value: Column | None = None,
    n_buckets: int | None = None,
    accuracy: int = 10000,
    checkpoint: bool = False,
    max_bucket_rows: int = MAX_BUCKET_ROWS,
) -> DataFrame:
    """K2: add ``out_col`` BIGINT numbered 1..N by ``order_by`` (ascending, NULLs first).

    ``checkpoint=True`` first writes ``df`` to the shared checkpoint folder, so an
    expensive input (a dedup and a join, say) is computed once instead of once
    per pass; use it when ``df`` is not a plain scan.

    ``sort_value`` is a numeric expression that is non-decreasing in ``order_by``
    and, ideally, close to unique (default: the first order column); it decides the
    buckets, so a single hot value of it makes one large bucket.  For a
    composite key pass a packed number, e.g. ``listing_key * 10**8 + date_key``.  A
    bucket of more than ``max_bucket_rows`` rows raises before any row is numbered.
    """
    order_by = list(order_by)
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    if sort_value is not None:
        value = sort_value
    elif isinstance(df.schema[order_by[0]].dataType, T.NumericType):
        value = F.col(order_by[0])
    else:
        value = _text_rank(df.select(order_by[0]), order_by[0])
    n = max(2, n_buckets or default_buckets(df))
    # quantile rank error 1/accuracy must stay well below one bucket (1/n)
    found = df.select(value.cast("double").alias("v")).agg(
        F.percentile_approx("v", [i / n for i in range(1, n)], max(accuracy, 10 * n)).alias("q")
    ).first()["q"]
    # a column without any number still has a cut, so that one plan serves every input
    cuts = sorted({c for c in found or [] if c == c and abs(c) != float("inf")}) or [0.0]
    with_bucket, n_found = _bucketed(df, value, cuts)
    counts = {
        r["_bucket"]: r["n"]
        for r in with_bucket.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if counts and max(counts.values()) > max_bucket_rows:
        raise ValueError(
            f"{out_col}: {max(counts.values())} rows share one bucket (limit {max_bucket_rows}); "
            "pass a sort_value closer to unique, or more buckets"
        )
    offsets, running = [], 0
    for b in range(n_found):
        offsets.append(running)
        running += counts.get(b, 0)
    offset = F.element_at(F.expr("array(" + ", ".join(f"{o}L" for o in offsets) + ")"), F.col("_bucket") + 1)
    w = Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    placed = with_bucket.repartitionById(n_found, F.col("_bucket"))
    return placed.withColumn(out_col, (F.row_number().over(w) + offset).cast("bigint")).drop("_bucket")


def _literal(values: Sequence[int], kind: str) -> Column:
    return F.expr("array(" + ", ".join(f"{kind}({v})" for v in values) + ")")


def layout_key(
    df: DataFrame,
    layout: str,
    day: str,
    order_by: Sequence[str],
    out_col: str,
    piece_rows: int = PIECE_ROWS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """K2 in file order: add ``out_col`` BIGINT numbered 1..N by ``day``, then ``order_by`` (NULLs first), and lay the rows
    out for a write partitioned by ``layout``, with no other shuffle or sort in that write.

    ``layout`` is a month (yyyyMM) and ``day`` its days (yyyyMMdd), both required; ``order_by`` starts with a numeric column.  A bucket
    is a month, or a quantile piece of a month of more than ``piece_rows`` rows, so no task holds more than about that many: a
    hot day is split by the first order column.  Months and pieces are consecutive in the key's order, so a bucket's
    offset is the number of rows in front of it.  Small buckets share a task.

    Passes over ``df`` (written first, so each reads only its columns): rows per month with the range of the first order column; cut points and then
    rows per piece, only if some month has to be cut; the numbering itself, whose ``repartitionById`` is the only shuffle of rows."""
    spark = df.sparkSession
    df = (scratch or Scratch(spark)).write(df, out_col)
    first, *_ = order_by = list(order_by)
    months = df.groupBy(layout).agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("low"), F.max(first).alias("high")).orderBy(layout).collect()
    counts = [r["n"] for r in months]
    piece_rows = min(piece_rows, max(LEAST_PIECE_ROWS, -(-sum(counts) // default_buckets(df))))
    lows, highs = [r["low"] for r in months if r["low"] is not None], [r["high"] for r in months if r["high"] is not None]
    # the day plus a fraction that grows with the first order column: doubles are monotone, equal ones share a piece
    part = F.lit(0.0)
    if lows and max(highs) > min(lows):
        part = F.coalesce((F.col(first).cast("double") - float(min(lows))) / (float(max(highs)) - float(min(lows)) + 1.0), F.lit(0.0))
    value = F.col(day).cast("double") + part
    cuts = {float(r[layout] * 100) for r in months[1:]}
    if large := {r[layout]: -(-r["n"] // piece_rows) for r in months if r["n"] > piece_rows}:
        pieces = max(large.values())
        marks = [i / pieces for i in range(1, pieces)]
        found = df.where(F.col(layout).isin(list(large))).groupBy(layout).agg(F.percentile_approx(value, marks, max(10_000, 10 * pieces)).alias("q"))
        for month, q in found.collect():
            cuts |= {q[round(i * pieces / large[month]) - 1] for i in range(1, large[month])}
    placed, n_buckets = _bucketed(df, value, sorted(cuts) or [0.0])
    if large or not cuts:
        rows = dict(placed.groupBy("_bucket").agg(F.count(F.lit(1))).collect())
    else:
        rows = dict(enumerate(counts))
    # a task holds consecutive buckets; a month's rows in a task are numbered on from the rows in front of them
    starts = [low * 100 for low in (r[layout] for r in months)]
    edges = [*starts[:1], *(sorted(cuts) or [0.0])]  # where the buckets begin
    offsets, tasks, running, task, held, group = [], [], 0, 0, 0, None
    for b in range(n_buckets):
        n = rows.get(b, 0)
        if held and held + n > piece_rows:
            task, held = task + 1, 0
        now = (task, bisect.bisect_right(starts, edges[min(b, len(edges) - 1)]))
        if now != group:
            group, offset = now, running
        offsets.append(offset)
        tasks.append(task)
        running, held = running + n, held + n
    at = F.col("_bucket") + 1
    placed = placed.withColumn("_task", F.element_at(_literal(tasks, "int"), at)).repartitionById(task + 1, F.col("_task"))
    order = [F.col(c).asc_nulls_first() for c in (day, *order_by)]
    number = F.row_number().over(Window.partitionBy(layout, "_task").orderBy(*order))
    numbered = placed.withColumn(out_col, (number + F.element_at(_literal(offsets, "bigint"), at)).cast("bigint"))
    # the order that the numbering left the rows in, stated for the write
    return numbered.sortWithinPartitions(layout, "_task", *order).drop("_bucket", "_task")
