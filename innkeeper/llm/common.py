"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeeper.session import Scratch, scratch_path

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, scratch: Scratch | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back; with ``scratch`` until that ends.

    Later passes read the written rows, so a lost executor costs a re-read and never
    a recomputation that could order or number rows in another way."""
    spark = df.sparkSession
    path = scratch.path(name) if scratch else scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    # the shuffles of this write serve nothing else: their files go when it ends
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def byte_chunks(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into slices of at most ``limit`` bytes of ``column``
    (one row at the least), so that working arrays stay bounded."""
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0))
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges [start, start + length) for every pair."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)

def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
