"""Sharding by sampled splitters (operator 2).

1. Each record gets a sort key: the leading bits come from the grouping value (equal texts lie side
   by side), the trailing ``SPREAD_BITS`` bits from the record's id, so that a hot group can be
   cut anywhere.
2. A size-weighted sample of keys is drawn (chance proportional to a record's size, decided by a
   hash, so a retried task draws the same) and its quantiles cut the key space into
   ranges.  The sample has about ``ranges * samples_per_range`` keys, whatever the number of records.
3. Rows and bytes of every range are counted; an overfull range draws a sample of its own
   and is subdivided, until none is overfull or its records share one key.
4. Records are placed inside their range by a running sum.  Offset plus running sum is the record's exact
   position in the whole, and its shard is that position's share of the total: shards differ from the mean by less than
   one record's size (law ``bytes``) or by at most one record (law ``rows``).

Defined results: NULL texts count as empty; records with equal keys and repeated records each get their own
slot (ties in the id's order are between equal records only); an empty table gives no rows; a record larger than a shard's share
leaves the next shards emptier; extra columns are carried along, and those named like an output column are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeeper.llm.common import materialise

SPREAD_BITS = 20
RANGE_BYTES = 1 << 30
SAMPLES_PER_RANGE = 64
OVERFULL = 1.5
MAX_ROUNDS = 6
_OWN = ("shard", "slot", "range_id", "_key", "_weight", "_order")


def sort_key(group: Column, within: Column) -> Column:
    """Key that keeps equal ``group`` values together and spreads them by ``within``."""
    low = (1 << SPREAD_BITS) - 1
    return F.xxhash64(group).bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(within).bitwiseAND(F.lit(low)))


def _draw(keyed: DataFrame, chance: Column, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled keys and their weights: a record too large for its chance counts for more."""
    uniform = F.shiftrightunsigned(F.xxhash64("_key", "_order", F.lit(seed)), 11) / float(1 << 53)
    rows = keyed.withColumn("_p", chance).where(uniform < F.col("_p")).select("_key", F.greatest(F.lit(1.0), "_p")).toPandas()
    return rows.iloc[:, 0].to_numpy(np.int64), rows.iloc[:, 1].to_numpy(np.float64)


def _quantiles(keys: np.ndarray, weights: np.ndarray, parts: int) -> np.ndarray:
    """Keys that end the first parts - 1 of ``parts`` about equal ranges."""
    if not len(keys) or parts < 2:
        return np.empty(0, np.int64)
    order = np.argsort(keys, kind="stable")
    reach = np.cumsum(weights[order])
    at = np.searchsorted(reach, reach[-1] * np.arange(1, parts) / parts)
    return np.unique(keys[order][np.minimum(at, len(keys) - 1)])


def _in_range(keyed: DataFrame, cuts: np.ndarray) -> DataFrame:
    shared = keyed.sparkSession.sparkContext.broadcast(cuts)

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, key.to_numpy(np.int64), side="left").astype(np.int32))

    return keyed.withColumn("range_id", range_of("_key"))


def _totals(placed: DataFrame) -> pd.DataFrame:
    found = placed.groupBy("range_id").agg(
        F.sum("_weight").alias("size"), F.count(F.lit(1)).alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high")
    )
    return found.toPandas().sort_values("range_id", ignore_index=True)


def splitters(keyed: DataFrame, ranges: int, total: int, samples_per_range: int) -> tuple[np.ndarray, pd.DataFrame]:
    """Range boundaries over ``_key`` and the exact totals of the ranges they make."""
    want = ranges * samples_per_range
    cuts = _quantiles(*_draw(keyed, F.col("_weight") * (want / total), 0), ranges)
    mean = total / ranges
    for seed in range(1, MAX_ROUNDS):
        sizes = _totals(_in_range(keyed, cuts))
        over = sizes[(sizes["size"] > OVERFULL * mean) & (sizes["low"] < sizes["high"])]
        if over.empty:
            return cuts, sizes
        # every overfull range is sampled at the rate of its own pieces
        inside = _in_range(keyed, cuts).where(F.col("range_id").isin(over["range_id"].tolist()))
        keys, weights = _draw(inside, F.col("_weight") * (2 * samples_per_range / mean), seed)
        owner = np.searchsorted(cuts, keys, side="left")
        pieces = [_quantiles(keys[owner == r], weights[owner == r], int(-(-s // mean)) + 1) for r, s in zip(over["range_id"], over["size"], strict=True)]
        cuts = np.unique(np.concatenate([cuts, *pieces]))
    return cuts, _totals(_in_range(keyed, cuts))


def shard_records(
    records: DataFrame, shards: int, size: Column, group: Column, record_id: str, law: str = "bytes",
    range_bytes: int = RANGE_BYTES, samples_per_range: int = SAMPLES_PER_RANGE,
) -> DataFrame:
    """``records`` with ``shard`` (0 to shards - 1), ``slot`` (gapless from 0 in the shard)
    and ``range_id`` (its key range; ranges ascend with shard and slot)."""
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law: {law}")
    spark = records.sparkSession
    weight = (size if law == "bytes" else F.lit(1)).cast("long")
    own = records.withColumns({"_key": sort_key(group, F.col(record_id)), "_weight": weight, "_order": F.col(record_id)})
    keyed = materialise(own.drop("shard", "slot", "range_id"), "sharding-keyed")
    total, size_sum = keyed.agg(F.sum("_weight"), F.sum(size.cast("long")) if law == "bytes" else F.sum(F.lit(1))).first()
    kept = [c for c in keyed.columns if c not in _OWN]
    if not total:
        return keyed.select(*kept, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(0).alias("range_id"))
    ranges = shards * max(4, -(-int(size_sum) // (shards * range_bytes)))
    cuts, sizes = splitters(keyed, ranges, int(total), samples_per_range)
    # one line per range: bounded by the number of ranges, not of records
    offsets = pd.DataFrame({"range_id": sizes["range_id"].astype("int32"), "_size_before": sizes["size"].cumsum() - sizes["size"], "_rows_before": sizes["n"].cumsum() - sizes["n"]})
    offsets = spark.createDataFrame(offsets, "range_id int, _size_before long, _rows_before long")
    inside = Window.partitionBy("range_id").orderBy("_key", "_order")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = _in_range(keyed, cuts).withColumns(
        {"_before": F.sum("_weight").over(running) - F.col("_weight"), "_n": F.row_number().over(inside).cast("long") - 1}
    )
    placed = placed.join(F.broadcast(offsets), "range_id")
    # the share of the total that lies before the record, in exact decimal arithmetic
    share = F.expr(f"cast((cast({shards} as decimal(20,0)) * (_size_before + _before)) div {int(total)} as int)")
    placed = placed.select(*kept, "range_id", share.alias("shard"), (F.col("_rows_before") + F.col("_n")).alias("_at"))
    placed = materialise(placed, "sharding-placed")
    first = placed.groupBy("shard").agg(F.min("_at").alias("_first"))
    return placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("_at") - F.col("_first")).select(*kept, "shard", "slot", "range_id")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write shards as folders ``shard=N``, one file per key range, rows in slot order."""
    spread = sharded.repartition(F.col("shard"), F.col("range_id"))
    spread.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
