"""Appending batches to a fact (S7, S9): keys go on from the committed maximum.

A batch is looked up, numbered in its file layout and written into a folder of its own; one commit then makes it part of the
table and says which keys it holds.  A batch that has been committed already is not loaded again, so a retried
load changes nothing; an interrupted one leaves files that no reader sees.  Of two writers one commits first; the other
one moves its keys behind the new maximum (a copy of its own written batch, not a new build) and commits then.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper.session import Scratch, delete_path
from innkeeper.sources import commits, files

FACT_PARTITION = ["month_key"]


@dataclass(frozen=True)
class Batch:
    name: str
    path: str
    rows: int
    last_key: int  # highest key of the table with this batch


def batches(spark: SparkSession, root: str) -> list[Batch]:
    """The committed batches, oldest first."""
    return [Batch(c.record["batch"], c.record["path"], c.record["rows"], c.record["last_key"]) for c in commits.history(spark, root)]


def append_batch(
    spark: SparkSession,
    root: str,
    name: str,
    rows: DataFrame,
    number: Callable[..., DataFrame],
    key: str,
    attempts: int = 10,
) -> Batch:
    """Append ``rows`` (a fact without its key) as batch ``name``; ``number(rows, scratch=...)`` keys and lays them out from 1.
    A committed batch of that name is returned as it is."""
    root = root.rstrip("/")
    base, seen = commits.head(spark, root), batches(spark, root)
    if found := next((b for b in seen if b.name == name), None):
        return found
    path, first = files.new_version(root), seen[-1].last_key if seen else 0
    with Scratch(spark) as scratch:
        count = _write(number(rows, scratch=scratch).withColumn(key, F.col(key) + F.lit(first)), path)
    for _ in range(attempts):
        record = {"batch": name, "path": path, "rows": count, "last_key": first + count}
        try:
            commits.commit(spark, root, record, base)
            return Batch(name, path, count, first + count)
        except commits.CommitConflict:
            base, seen = commits.head(spark, root), batches(spark, root)
            if found := next((b for b in seen if b.name == name), None):
                delete_path(spark, path)
                return found
            last = seen[-1].last_key if seen else 0
            if last != first:
                moved = files.new_version(root)
                _write(spark.read.parquet(path).withColumn(key, F.col(key) + F.lit(last - first)).sortWithinPartitions(*FACT_PARTITION, key), moved)
                delete_path(spark, path)
                path, first = moved, last
    raise commits.CommitConflict(f"{root}: batch {name} lost {attempts} commits")


def _write(df: DataFrame, path: str) -> int:
    observed = Observation(f"rows:{path}")
    files.write_parquet(df.observe(observed, F.count(F.lit(1)).alias("rows")), path, FACT_PARTITION)
    return int(observed.get["rows"])


def read_batches(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The table: all committed batches and nothing else."""
    paths = [b.path for b in batches(spark, root) if b.rows]
    if not paths:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/").parquet(*paths)
    return found.select(*schema.fieldNames())
