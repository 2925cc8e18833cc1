"""A log of numbered commits, so that of two writers who saw the same state one wins.

A commit is a small record file ``_commits/<number>``, created only if it does not exist: the file system decides the race
(HDFS, local disks, and object stores with conditional writes).  A writer names the number it started from; if the next one is taken
by then, somebody else has committed and ``CommitConflict`` is raised before anything becomes visible.  Readers take what the
highest complete record says, so they never see a part of a write, nor parts of two.  A record that was created but never
filled (its writer died in between) is passed over.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

FOLDER = "_commits"


class CommitConflict(RuntimeError):
    """Another writer committed since this one read the log."""


@dataclass(frozen=True)
class Commit:
    number: int
    record: dict


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{FOLDER}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    path, fs = _folder(spark, root)
    if not fs.exists(path):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(path) if s.getPath().getName().isdigit())


def _read(spark: SparkSession, root: str, number: int) -> Commit | None:
    path, fs = _folder(spark, root)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(path, f"{number:012d}"))
    try:
        text = bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
    return Commit(number, json.loads(text)) if text.endswith("\n") else None


def head(spark: SparkSession, root: str) -> int:
    """The highest number taken (0: none): what a writer starts from."""
    return max(_numbers(spark, root), default=0)


def latest(spark: SparkSession, root: str) -> Commit | None:
    """The newest complete commit."""
    for number in reversed(_numbers(spark, root)):
        if (found := _read(spark, root, number)) is not None:
            return found
    return None


def history(spark: SparkSession, root: str) -> list[Commit]:
    """All complete commits, oldest first."""
    return [c for n in _numbers(spark, root) if (c := _read(spark, root, n)) is not None]


def commit(spark: SparkSession, root: str, record: dict, base: int) -> Commit:
    """Make ``record`` commit number ``base + 1``, or raise ``CommitConflict``."""
    path, fs = _folder(spark, root)
    fs.mkdirs(path)
    number = base + 1
    data = (json.dumps(record, sort_keys=True) + "\n").encode("utf-8")
    target = spark._jvm.org.apache.hadoop.fs.Path(path, f"{number:012d}")
    taken = CommitConflict(f"{root}: commit {number} was taken by another writer")
    if fs.getScheme() == "file":  # Hadoop's local file system checks and creates in two steps
        local = unquote(urlparse(fs.makeQualified(target).toString()).path)
        try:
            handle = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            raise taken from None
        with os.fdopen(handle, "wb") as out:
            out.write(data)
        return Commit(number, record)
    try:
        stream = fs.create(target, False)
    except Exception as error:
        if fs.exists(target):
            raise taken from error
        raise
    try:
        stream.write(data)
    finally:
        stream.close()
    return Commit(number, record)
