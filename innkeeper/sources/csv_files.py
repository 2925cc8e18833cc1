"""CSV extracts (S1-S3): every column as STRING, bound by each file's own header.

Headers are read without a Spark job: the first bytes of every file, by its file system and codec, up to
the end of the first record (a quoted name may hold a newline).  Files of equal header are one scan.

A quoted field may hold newlines, so a file can't be cut at any newline, and Spark's multi-line reader gives a whole file to one
task.  ``quoted_records`` reads large uncompressed files in splits nevertheless: a quote opens or closes a
field and a doubled quote does both, so a line begins a record exactly where the number of quotes in front of it is
even.  Quotes are counted per split first (a scan that moves one row per split), a prefix sum over the splits of a file says how each one begins, and a
running sum inside the split finds its records; a record that runs over the end of a split is put together from its parts.
"""

from __future__ import annotations

import csv
import io
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper.operators.lookup import checked_broadcast
from innkeeper.sources.standin import as_read_from_csv, spread

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
HEADER_BYTES = 1 << 16
HEADER_THREADS = 32


@dataclass(frozen=True)
class CsvFile:
    path: str
    header: tuple[str, ...]
    size: int
    splittable: bool
    crlf: bool  # its header ends in CR LF, so its lines do


def _first_record(data: bytes) -> bytes | None:
    """The bytes of the first record that isn't empty; None if it doesn't end in ``data``."""
    start, quotes, at = 0, 0, 0
    while (end := data.find(b"\n", at)) >= 0:
        quotes += data.count(b'"', at, end)
        at = end + 1
        if quotes % 2 == 0:
            if data[start:end].strip(b"\r"):
                return data[start:end]
            start = at
    return None


def _names(record: bytes, case_sensitive: bool) -> tuple[str, ...]:
    """Column names of a header record, as Spark's reader makes them: an empty name gets its place, and a name that
    occurs more than once gets it as well."""
    text = record.decode("utf-8").removeprefix("﻿").rstrip("\r")
    if not text:
        return ()
    row = next(csv.reader(io.StringIO(text, newline="")))
    fold = [n if case_sensitive else n.lower() for n in row]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if fold.count(fold[i]) > 1 else n for i, n in enumerate(row))


def catalogue(spark: SparkSession, path: str | list[str]) -> list[CsvFile]:
    """Header, size and kind of every file under ``path``, in path order.  Listing is Spark's; of the files only the beginning
    is read, by threads on the driver (64 KB each, more only if the header is longer), and no job runs."""
    names = sorted(spark.read.text(path).inputFiles())
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    case_sensitive = spark.conf.get("spark.sql.caseSensitive", "false") == "true"

    def one(name: str) -> CsvFile:
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        fs = target.getFileSystem(conf)
        codec = codecs.getCodec(target)
        limit, record = HEADER_BYTES, None
        while True:
            stream = fs.open(target)
            stream = codec.createInputStream(stream) if codec is not None else stream
            try:
                data = bytes(stream.readNBytes(limit))
            finally:
                stream.close()
            record = _first_record(data)
            if record is not None or len(data) < limit:
                break
            limit *= 8
        record = data if record is None else record
        return CsvFile(name, _names(record, case_sensitive), fs.getFileStatus(target).getLen(), codec is None, record.endswith(b"\r"))

    with ThreadPoolExecutor(max_workers=HEADER_THREADS) as pool:
        return list(pool.map(one, names))


def quoted_records(spark: SparkSession, paths: list[str], crlf: bool = False) -> DataFrame:
    """``record``: the text of every record but the first one (the header) of the uncompressed files, newlines inside quotes included (as
    LF if ``crlf``, as Spark's reader has them); empty lines are skipped.  Lines move once, to the task of their split."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    per_split = lines.groupBy("file", "split").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    entry = per_split.select("file", "split", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("entry"))
    inside = Window.partitionBy("file", "split").orderBy("line")
    # lines of a split come in their order within a task
    placed = lines.withColumn("line", F.monotonically_increasing_id()).join(checked_broadcast(entry), ["file", "split"])
    counted = placed.withColumn("before", F.col("entry") + F.coalesce(F.sum(quotes).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    starts = (F.col("before") % 2 == 0).cast("int")
    numbered = counted.withColumn("record", F.sum(starts).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n")
    parts = numbered.groupBy("file", "split", "record").agg(text.alias("text"))
    last = F.max("record").over(Window.partitionBy("file", "split"))
    parts = parts.withColumn("open", (F.col("record") == 0) | (F.col("record") == last))
    # per split at most two open parts: what goes on from the split before, and the record that may go on
    owner = F.last(F.when(F.col("record") > 0, F.col("split")), ignorenulls=True).over(Window.partitionBy("file").orderBy("split", "record"))
    number = F.last(F.when(F.col("record") > 0, F.col("record")), ignorenulls=True).over(Window.partitionBy("file").orderBy("split", "record"))
    joined = (
        parts.where("open")
        .select("file", "split", "record", "text", owner.alias("owner"), number.alias("number"))
        .groupBy("file", "owner", "number")
        .agg(F.array_sort(F.collect_list(F.struct("split", "record", "text"))).alias("pieces"))
        .select("file", F.col("owner").alias("split"), F.col("number").alias("record"), F.array_join(F.transform("pieces", lambda x: x["text"]), "\n").alias("text"))
    )
    whole = parts.where("NOT open").select("file", "split", "record", "text").unionByName(joined)
    if crlf:
        whole = whole.withColumn("text", F.replace(F.concat("text", F.lit("\n")), F.lit("\r\n"), F.lit("\n")))
        whole = whole.withColumn("text", F.expr("substring(text, 1, length(text) - 1)"))
    header = (F.col("split") == 0) & (F.col("record") == F.lit(1))
    return whole.where(~header & (F.col("text") != "")).select(F.col("text").alias("record"))


def _scan_split(spark: SparkSession, header: tuple[str, ...], names: list[str], crlf: bool) -> DataFrame:
    """Large files of one header, parsed split by split."""
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in header)
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "multiLine")}
    return quoted_records(spark, names, crlf).select(F.from_csv("record", schema, options).alias("row")).select("row.*")


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    expected: T.StructType | list[str] | None = None,
    partitions: int | None = None,
    multiline: bool = True,
    split_bytes: int | None = None,
) -> DataFrame:
    """Read CSV (plain or ``.gz``) with every column as STRING, named by
    the header line of its own file (no schema inference pass, no positional binding: the
    files of an extract may hold their columns in any order, and more of them; a column that a file
    lacks is NULL there).  ``expected`` names the columns that
    every file must have; a missing one raises before any work.

    ``multiline=True`` is needed when quoted fields hold newlines (listings,
    reviews).  Files over ``split_bytes`` (default: the size of a scan's splits) that aren't compressed are then
    parsed in splits, which takes quotes as RFC 4180 has them (around a whole field, doubled inside); smaller and compressed ones are a task each.  An extract without free text
    (calendar) can pass ``False``: Spark then splits any uncompressed or bzip2 file at its newlines."""
    options = {**CSV_OPTIONS, "multiLine": str(multiline).lower(), "inferSchema": "false"}
    found = catalogue(spark, path)
    if not found:
        raise FileNotFoundError(f"no files under {path}")
    if split_bytes is None:
        split_bytes = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    groups: dict[tuple[tuple[str, ...], bool, bool], list[str]] = {}
    for f in found:
        if f.header:  # else an empty file
            split = multiline and f.splittable and f.size > split_bytes
            groups.setdefault((f.header, split, split and f.crlf), []).append(f.path)
    parts = []
    for (header, split, crlf), names in sorted(groups.items()):
        if expected is not None:
            wanted = expected.fieldNames() if isinstance(expected, T.StructType) else list(expected)
            if missing := [n for n in wanted if n not in header]:
                raise ValueError(f"{names[0]}: missing columns {missing}")
        if split:
            parts.append(_scan_split(spark, header, names, crlf))
            continue
        schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
        df = spark.read.options(**options).option("enforceSchema", "false").schema(schema).csv(names)
        parts.append(df if partitions else spread(df))
    if not parts:
        raise ValueError(f"{path}: no header line")
    df = parts[0]
    for more in parts[1:]:
        df = df.unionByName(more, allowMissingColumns=True)
    return as_read_from_csv(df.repartition(partitions) if partitions else df)


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write CSV that ``scan_csv`` reads back unchanged (quotes, newlines, edges)."""
    (
        df.write.mode("overwrite")
        .options(**{k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "mode")})
        .option("quoteAll", "true")
        .option("compression", compression)
        .csv(path)
    )
