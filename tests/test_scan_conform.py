"""CSV bound by header, conforming casts that raise, integral ids, unpadded dates, version expiry."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper.functions import columns as C
from innkeeper.plans import warehouse as W
from innkeeper.sources import files


@pytest.mark.parametrize("multiline", [True, False])
def test_files_of_an_extract_bind_by_their_own_header(spark, tmp_path, multiline):
    (tmp_path / "a.csv").write_text("id,low,high\n1,3,30\n2,4,40\n")
    (tmp_path / "b.csv").write_text("high,id,low,extra\n50,3,5,x\n")
    (tmp_path / "c.csv").write_text("low,high,id\n6,60,4\n")
    df = files.scan_csv(spark, str(tmp_path), ["id", "low", "high"], multiline=multiline)
    got = sorted((r.id, r.low, r.high, r.extra) for r in df.collect())
    assert got == [("1", "3", "30", None), ("2", "4", "40", None), ("3", "5", "50", "x"), ("4", "6", "60", None)]


def test_a_file_without_a_needed_column_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,low\n1,3\n")
    (tmp_path / "b.csv").write_text("id\n1\n")
    with pytest.raises(ValueError, match=r"b\.csv: missing columns \['low'\]"):
        files.scan_csv(spark, str(tmp_path), ["id", "low"])


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("value, kind", [(4000.5, "decimal(9,6)"), (3_000_000_000, "int"), (12345.6, "decimal(4,1)"), (99.0, "decimal(2,1)")])
def test_conform_raises_when_a_value_does_not_fit(spark, ansi, value, kind):
    schema = T.StructType([T.StructField("x", T._parse_datatype_string(kind))])
    df = spark.createDataFrame([(value,), (None,)], "x double" if isinstance(value, float) else "x long")
    with pytest.raises(PySparkException, match="x: no "):
        W.conform(df, schema).collect()
    small = spark.createDataFrame([(1,), (None,)], "x long")
    assert sorted(str(r.x).rstrip("0").rstrip(".") for r in W.conform(small, schema).collect()) == ["1", "None"]


def test_integral_ids(spark, ansi):
    df = spark.createDataFrame([("12",), ("12.0",), ("1e3",), (None,), ("-7",), ("9223372036854775807",)], "t string")
    got = [r.v for r in df.select(C.strict_bigint("t").alias("v")).collect()]
    assert got == [12, 12, 1000, None, -7, 9223372036854775807]


def test_integral_ids_are_exact(spark, ansi):
    texts = ["9007199254740993.0", "9223372036854775807.000", "-9223372036854775808.", "1000e-3", "1.50e1", "0e3", "0.000", " +12.0 ", "123456789012345678.9e1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(C.strict_bigint("t").alias("v"))
    assert [r.v for r in df.collect()] == [9007199254740993, 2**63 - 1, -(2**63), 1, 15, 0, 0, 12, 1234567890123456789]


@pytest.mark.parametrize("text", ["12.0000000000000000000001", "1001e-3", "9223372036854775808.0", "1e19", ".", "e3", "1e99999999999"])
def test_inexact_ids_raise(spark, ansi, text):
    with pytest.raises(PySparkException, match="not an integer"):
        spark.createDataFrame([(text,)], "t string").select(C.strict_bigint("t")).collect()


@pytest.mark.parametrize("text", ["12.5", "abc", "", "1e30", "NaN", "inf", "9223372036854775808", "12d"])
def test_other_ids_raise(spark, ansi, text):
    with pytest.raises(PySparkException, match="not an integer"):
        spark.createDataFrame([(text,)], "t string").select(C.strict_bigint("t")).collect()


def test_unpadded_dates(spark, ansi):
    texts = ["2026-2-3", "2026-02-03", "2026-12-31", "2026-002-03", "2026-13-1", "26-2-3", "2026-2-30", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    day = datetime.date(2026, 2, 3)
    assert [r.v for r in df.select(C.parse_date("t").alias("v")).collect()] == [day, day, datetime.date(2026, 12, 31)] + [None] * 5


def test_expired_versions_go_and_the_current_one_stays(spark, tmp_path):
    root, versions = str(tmp_path / "wh"), []
    for n in range(4):
        version = files.new_version(root)
        spark.range(n + 1).write.parquet(f"{version}/t")
        files.publish_version(spark, root, version)
        versions.append(version)
    unpublished = files.new_version(root)
    spark.range(1).write.parquet(f"{unpublished}/t")
    assert set(files.expire_versions(spark, root, keep=2)) == set(versions[:2])
    assert files.current_version(spark, root) == versions[3]
    assert [spark.read.parquet(f"{v}/t").count() for v in (*versions[2:], unpublished)] == [3, 4, 1]
    with pytest.raises(PySparkException):
        spark.read.parquet(f"{versions[0]}/t")
    assert files.expire_versions(spark, str(tmp_path / "none"), keep=1) == []


def test_append_sink_adds_rows(spark, tmp_path):
    for part in (range(3), range(3, 5)):
        files.write_parquet(spark.createDataFrame([(i,) for i in part], "i long"), str(tmp_path / "t"), mode="append")
    assert files.read_parquet(spark, str(tmp_path / "t")).agg(F.sum("i")).first()[0] == 10
