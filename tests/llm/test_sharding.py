import zlib

import pytest
from pyspark.sql import functions as F

from innkeeper.llm import sharding


def shard(docs, shards, law="bytes", **options):
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.withColumns({"size": F.octet_length(text) + 16, "shard": F.lit("clash")})
    return sharding.shard_records(sized, shards, F.col("size"), text, "doc_id", law=law, **options)


def slots_are_gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    return all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize("range_bytes", [1 << 30, 400])
def test_bytes_are_near_equal_with_a_hot_group(make_docs, prose, range_bytes):
    pairs = [(i, prose(i, 1 + i % 9)) for i in range(600)] + [(1000 + i, "the same text again") for i in range(300)]
    pairs += [(7, None), (7, None), (None, ""), (None, "x")]
    rows = shard(make_docs(pairs), 8, range_bytes=range_bytes, samples_per_range=8).collect()
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert len(rows) == len(pairs) and slots_are_gapless(rows)
    assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted((str(i), str(t)) for i, t in pairs)
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)
    # the order of the shards is the order of the key ranges
    order = [r.range_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_rows_law_counts_differ_by_one(make_docs):
    rows = shard(make_docs([(i, "x" * (i % 7)) for i in range(103)]), 10, law="rows").collect()
    counts = [sum(r.shard == s for r in rows) for s in range(10)]
    assert sum(counts) == 103 and max(counts) - min(counts) <= 1 and slots_are_gapless(rows)


def test_one_record_empty_table_and_bad_law(make_docs):
    assert [(r.shard, r.slot) for r in shard(make_docs([(1, "a")]), 40).collect()] == [(0, 0)]
    assert shard(make_docs([]), 40).collect() == []
    with pytest.raises(ValueError):
        shard(make_docs([]), 4, law="keys")


def test_written_shards(make_docs, spark, tmp_path):
    sharded = shard(make_docs([(i, f"text {i % 11}") for i in range(200)]), 4)
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(tuple, back.select("doc_id", "shard", "slot").collect())) == sorted(map(tuple, sharded.select("doc_id", "shard", "slot").collect()))


def test_query_columns(spark):
    from innkeeper.llm import queries

    rows = queries.op2_sharding(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32((docs[r.doc_id] or "").encode()) and r.law == "bytes" and r.grown_shard is None for r in rows)
    assert len(rows) == len(docs) and slots_are_gapless(rows)
