"""Headers without jobs, and quoted files read in splits, against Spark's multi-line reader."""

import gzip
import random

import pytest

from innkeeper import catalog
from innkeeper.sources import csv_files as C
from tests.conftest import SF_SMALL
from tests.test_plans import plan_of


def quoted(rnd):
    text = "".join(rnd.choice('ab,\n"\r éx ') for _ in range(rnd.randint(0, 30)))
    return '"' + text.replace('"', '""') + '"' if rnd.random() < 0.9 else rnd.choice(["", "plain", " edge ", "NA"])


@pytest.fixture
def small_splits(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, ("1500", "100"), strict=True):
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("eol, header", [("\n", 'id,"na\nme",text'), ("\r\n", "id,name,text")])
def test_splits_give_the_rows_of_the_multiline_reader(spark, tmp_path, small_splits, eol, header):
    rnd = random.Random(len(eol))
    with open(tmp_path / "a.csv", "w", newline="") as f:
        f.write(header + eol)
        for i in range(400):
            # now and then a record over several splits, without and with a newline in it
            text = rnd.choice(['"' + "long\n" * 900 + '"', '"' + "y" * 4000 + '"']) if rnd.random() < 0.02 else quoted(rnd)
            f.write(f"{i},{quoted(rnd)},{text}" + (eol if i < 399 else ""))
            f.write(eol if rnd.random() < 0.05 and i < 399 else "")
    path = str(tmp_path / "a.csv")
    whole = C.scan_csv(spark, path, split_bytes=1 << 40)
    split = C.scan_csv(spark, path, split_bytes=1)
    assert split.columns == whole.columns
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    plan = plan_of(split)
    assert "Format: Text" in plan or "Scan text" in plan
    assert plan.count("Python") == 0


def test_lines_of_a_split_file_move_once(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("a,b\n" + "".join(f'{i},"x\ny"\n' for i in range(2000)))
    df = C.quoted_records(spark, [str(tmp_path / "a.csv")])
    assert len(df.collect()) == 2000
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # whole records and those over a split's end read the same shuffled lines
    assert "ReusedExchange" in plan


def test_unquoted_quotes_raise_and_can_be_read_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,size\n1,5" pipe\n2,6\n3,7" x\n4,8\n')
    whole = C.scan_csv(spark, str(tmp_path / "a.csv"))
    assert [r["size"] for r in sorted(whole.collect())] == ['5" pipe', "6", '7" x', "8"]
    with pytest.raises(Exception, match="(?i)malformed"):
        C.scan_csv(spark, str(tmp_path / "a.csv"), split_bytes=1).collect()


def test_headers_take_no_job(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i}.csv").write_text("id,low\n1,3\n" if i % 2 else "low,id,more\n3,1,x\n")
    spark.sparkContext.setJobGroup("headers", "catalogue")
    try:
        found = C.catalogue(spark, str(tmp_path))
        df = C.scan_csv(spark, str(tmp_path), ["id", "low"])
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0 and len(found) == 30
    assert {f.header for f in found} == {("id", "low"), ("low", "id", "more")}
    assert sorted((r["id"], r["low"], r["more"] or "") for r in df.collect()) == [("1", "3", "")] * 15 + [("1", "3", "x")] * 15


HEADERS = [
    b"a,b\n1,2\n", b'"a ""x"" y","b\nc",d\n1,2,3\n', b"\xef\xbb\xbfa,b\n1,2\n", b"a,,b,\n1,2,3,4\n", b"a,A,b\n1,2,3\n", b"\n\na,b\n1,2\n", b"only\n1\n",
    b" a , b\n1,2\n", b"a,b", b"a,b\r\n1,2\r\n", ("é" * 70_000 + ",b\n1,2\n").encode(),
]


@pytest.mark.parametrize("data", HEADERS)
@pytest.mark.parametrize("compress", [False, True])
def test_names_are_those_of_spark(spark, tmp_path, data, compress):
    path = tmp_path / ("a.csv.gz" if compress else "a.csv")
    path.write_bytes(gzip.compress(data) if compress else data)
    (found,) = C.catalogue(spark, str(path))
    assert list(found.header) == spark.read.options(**C.CSV_OPTIONS).option("maxCharsPerColumn", "-1").csv(str(path)).columns
    assert found.splittable is not compress


@pytest.mark.parametrize("data", [b"", b"\n\n", b"a,b\n"])
def test_empty_files_and_header_only(spark, tmp_path, data):
    (tmp_path / "a.csv").write_bytes(data)
    (tmp_path / "b.csv").write_bytes(b"a,b\n1,2\n")
    for split in (1, 1 << 40):
        assert [tuple(r) for r in C.scan_csv(spark, str(tmp_path), split_bytes=split).collect()] == [("1", "2")]


def test_registered_scans_read_in_splits(spark):
    rows = catalog.scan_csv_plain(spark, SF_SMALL)
    assert rows.count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert all(r["comments"].endswith('the "end",') for r in rows.select("comments").limit(20).collect())
