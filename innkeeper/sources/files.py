"""File sources and sinks.

* CSV extracts: ``sources.csv_files``.
* Staging and warehouse tables are Parquet (types survive between layers).
  Facts are written ``partitionBy("month_key")``.
* A full refresh writes a complete new version directory and only then commits
  it by the next numbered record (``sources.commits``), so readers never see a half-loaded
  warehouse, a failed or retried run leaves the previous version in place, and of two runs
  that overlap the first to commit wins.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper.session import delete_path
from innkeeper.sources import commits
from innkeeper.sources.csv_files import scan_csv, write_csv  # noqa: F401 - the sources of this layer in one place

def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet sink; ``mode='append'`` for incremental loads."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_parquet_counted(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """``write_parquet`` that also returns the number of rows written, observed
    during the write itself (no second pass)."""
    obs = Observation(f"rows:{path}")
    write_parquet(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, partition_by)
    return int(obs.get["rows"])


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; projections and filters are pushed into the scan.
    A known ``schema`` skips reading file footers to infer one."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_tables(
    spark: SparkSession, root: str, schemas: dict[str, T.StructType | None]
) -> dict[str, DataFrame]:
    """S11 + S5: open every ``root/<name>``; if any is missing, raise one
    ``FileNotFoundError`` naming all of them, before anything is written."""
    out, missing = {}, []
    for name, schema in schemas.items():
        path = f"{root.rstrip('/')}/{name}"
        try:
            out[name] = read_parquet(spark, path, schema)
        except AnalysisException:
            missing.append(path)
    if missing:
        raise FileNotFoundError(f"required input not found: {', '.join(missing)}")
    return out


def write_schemas(spark: SparkSession, version_dir: str, schemas: dict[str, T.StructType]) -> None:
    """Record the schemas of a version's tables beside them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{version_dir}/_schemas.json")
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(json.dumps({name: s.jsonValue() for name, s in schemas.items()}).encode("utf-8"))
    finally:
        stream.close()


def read_schemas(spark: SparkSession, version_dir: str) -> dict[str, T.StructType]:
    """The schemas recorded with a version; none if it has no record."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{version_dir.rstrip('/')}/_schemas.json")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return {}
    stream = fs.open(target)
    try:
        found = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()
    return {name: T.StructType.fromJson(s) for name, s in found.items()}


def new_version(root: str) -> str:
    return f"{root.rstrip('/')}/v={uuid.uuid4().hex}"


def publish_version(spark: SparkSession, root: str, version_dir: str, base: int | None = None) -> None:
    """Make a fully written version directory current by the next numbered commit.

    ``base`` is the number that the load started from (``commits.head``): if another load has published
    since, this one raises ``commits.CommitConflict`` and stays invisible.  Without it the newest state is taken as seen.  A
    load that dies before its commit leaves the previous version in force."""
    commits.commit(spark, root, {"version": version_dir}, commits.head(spark, root) if base is None else base)


def current_version(spark: SparkSession, root: str) -> str:
    """The most recently published version directory under ``root``."""
    found = commits.latest(spark, root)
    if found is None:
        raise FileNotFoundError(f"no published version under {root}")
    return found.record["version"]


def expire_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the version directories under ``root`` that were published before the last ``keep``
    ones; returns what was deleted.  The current version always stays, and so does
    a version that was never published (a load may be writing it)."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    published = list(dict.fromkeys(c.record["version"] for c in reversed(commits.history(spark, root))))
    return [version for version in published[keep:] if delete_path(spark, version)]
