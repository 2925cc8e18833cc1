"""SimHash near-dedup by multi-index hashing (operator 7).

1. ``fingerprints``: words of the ASCII-lower-cased text, word shingles, XXH64 of each
   shingle, a bit is 1 when it is set in over half of the hashes (repeats counted).
2. Distinct fingerprints only from here on: any number of copies is one row.
3. ``links``: the fingerprint is cut into segments; every fingerprint is stored in one
   table per segment under that segment's value.  By the pigeonhole principle two fingerprints
   within the distance agree in some segment up to that segment's radius
   (``segment_radii``), so each fingerprint enumerates the Hamming ball of that radius
   around its own segment, fetches the table rows and verifies the complete distance.
4. A table bucket of more than ``crowded`` different fingerprints (a template with many variants) is
   not paired off.  Its members and its probes are split again by the points within
   half the distance of the whole fingerprint: two fingerprints are within distance d exactly when they share
   such a point for even d, so linking each to the smallest holder of the point loses no connection, in linear rows.
5. Connected components of the links.

Defined results: NULL, empty and blank texts have fingerprint zero and link like any
other; repeated rows and equal ids stay separate rows; a NULL doc_id keeps its row and its
component is the smallest non-NULL id reachable (NULL if none); an empty table gives no rows;
columns beyond the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeeper.llm.common import byte_chunks, materialise
from innkeeper.llm.components import connected_components

BITS = 64
SEED = 42
CHUNK_BYTES = 2 << 20
# byte -> its eight bits, one in each byte lane (lane 0: the lowest bit)
_LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], dtype=np.uint64)


def shingle_hashes(text: str, size: int) -> list[int]:
    """Unsigned XXH64 of each word shingle, in order."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - size] + 1).tolist()]
    ends = [*gaps[size - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[i:j], SEED) for i, j in zip(starts, ends, strict=True)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint (int64 bit pattern) per run of ``counts`` hashes."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        # runs cut into blocks of at most 255 hashes, so that a byte lane can't overflow
        blocks = -(-counts[some] // 255)
        first = np.cumsum(blocks) - blocks
        run_start = (np.cumsum(counts) - counts)[some]
        within = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
        starts = np.repeat(run_start, blocks) + 255 * within
        lanes = np.empty((len(starts), BITS), np.int64)
        for byte in range(8):
            part = _LANES[((hashes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.intp)]
            lanes[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(part, starts).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(lanes, first, axis=0)
        bits = (2 * ones > counts[some][:, None]).astype(np.uint64)
        out[some] = (bits << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp`` (the 64 bits as a signed long) for every row; the text's hash tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in byte_chunks(whole, "text", CHUNK_BYTES):
                each = [shingle_hashes(t, shingle) if t else [] for t in part.column("text").to_pylist()]
                counts = np.array([len(x) for x in each], np.int64)
                flat = np.fromiter((h for x in each for h in x), np.uint64, int(counts.sum()))
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(majority(flat, counts))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def segment_radii(distance: int, segments: int) -> list[int]:
    """Search radius of each segment: if every segment differed by more than its radius
    (-1: not searched), the whole would differ by more than ``distance`` bits."""
    base, extra = divmod(distance, segments)
    return [base if i <= extra else base - 1 for i in range(segments)]


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _longs(values: list[int]) -> Column:
    signed = [v - (1 << BITS) if v >> (BITS - 1) else v for v in values]
    return F.expr("array(" + ", ".join(f"{v}L" if v > -(1 << 63) else "-9223372036854775807L - 1L" for v in signed) + ")")


def links(fps: DataFrame, distance: int = 2, segments: int = 2, crowded: int = 64) -> DataFrame:
    """``a, b``: links between different fingerprints (column ``fp``, distinct) whose
    connected components are those of all pairs at ``distance`` or fewer differing bits.
    Every pair is listed, but for pairs that meet only in a crowded bucket."""
    if BITS % segments:
        raise ValueError("segments must divide 64")
    width = BITS // segments
    radii = segment_radii(distance, segments)

    def segment(i: int) -> Column:
        value = F.shiftrightunsigned("fp", i * width)
        return value.bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else value

    searched = [i for i in range(segments) if radii[i] >= 0]
    tables = F.array(*[F.struct(F.lit(i).alias("s"), segment(i).alias("v")) for i in searched])
    balls = F.array(
        *[F.struct(F.lit(i).alias("s"), segment(i).alias("v"), _longs(_ball(width, radii[i])).alias("masks")) for i in searched]
    )
    index = fps.select("fp", F.explode(tables).alias("t")).select("t.s", "t.v", "fp")
    probes = fps.select(F.col("fp").alias("q"), F.explode(balls).alias("t"))
    probes = probes.select("t.s", "t.v", "q", F.explode("t.masks").alias("mask"))
    probes = probes.select("s", F.col("v").bitwiseXOR(F.col("mask")).alias("v"), "q")

    full = materialise(index.groupBy("s", "v").count().where(F.col("count") > crowded).select("s", "v"), "simhash-crowded")
    # the planner takes exploded rows for as few as their source's and would broadcast them: merge joins
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= distance
    if full.isEmpty():
        return probes.join(index.hint("merge"), ["s", "v"]).where((F.col("q") < F.col("fp")) & near).select(F.col("q").alias("a"), F.col("fp").alias("b"))
    calm = index.join(full, ["s", "v"], "left_anti")
    pairs = probes.join(calm.hint("merge"), ["s", "v"]).where((F.col("q") < F.col("fp")) & near).select(F.col("q").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(_crowded_links(index, probes, full, distance))


def _crowded_links(index: DataFrame, probes: DataFrame, full: DataFrame, distance: int) -> DataFrame:
    """Links of the rows that meet in crowded buckets, in rows linear in those buckets."""
    members = index.join(full, ["s", "v"], "left_semi").select("fp").distinct()
    seekers = probes.join(full, ["s", "v"], "left_semi").select(F.col("q").alias("fp")).distinct()
    points = members.unionByName(seekers).distinct().select("fp", F.explode(_longs(_ball(BITS, (distance + 1) // 2))).alias("mask"))
    points = points.select(F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), "fp")
    if distance % 2 == 0:
        least = points.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z").select("point", "a")
        return points.join(least.hint("merge"), "point").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    # odd distance: one side takes the smaller ball, so that two holders of a point can't be farther apart
    inner = members.unionByName(seekers).distinct().select("fp", F.explode(_longs(_ball(BITS, distance // 2))).alias("mask"))
    inner = inner.select(F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), F.col("fp").alias("c"))
    least = inner.groupBy("point").agg(F.min("c").alias("a"))
    return points.join(least.hint("merge"), "point").where("fp <> a").select(F.least("a", "fp").alias("a"), F.greatest("a", "fp").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2, segments: int = 2, crowded: int = 64
) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` for every row: the smallest doc_id reachable over
    links of ``distance`` or fewer differing fingerprint bits, and the fingerprint that names the component."""
    each = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    fps = materialise(each.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = connected_components(links(fps.select("fp"), distance, segments, crowded), "a", "b")
    known = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = known.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id")
    return each.join(labels, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (NULL last), of rows that share it the smallest
    text hash, of equal rows one."""
    found = materialise(near_duplicates(docs, id_col, text_col, **options), "simhash-found")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = found.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = found.join(first, "root").select("doc_id", "text_hash", (order == F.col("first")).alias("stays"))
    # written, so that the join below can see its size
    counted = materialise(members.groupBy("doc_id", "text_hash").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n")), "simhash-members")
    gone = counted.where(~F.col("stays")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("_hash"))
    kept = docs.join(gone, same, "left_anti")
    repeated = counted.where("stays and n > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates([id_col, text_col])
