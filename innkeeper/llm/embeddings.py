"""Embedding near-dedup by product quantisation (operator 10).

1. Equal vectors of a label become one row with a multiplicity, so copies cost nothing.
2. Coarse centroids and residual codebooks are fitted on a bounded, hash-chosen sample
   (``train_rows``); every vector is indexed: its inverted list, the codes of its residual by subspace and the length of
   the part that the codes miss.
3. Every vector is a query into its ``probes`` nearest lists of its own label.  Lists and their queries are cut into
   blocks, so no list is gathered whole in a task.  Asymmetric distances come from lookup tables; with the
   missed length as error bound (Cauchy-Schwarz) no pair of a probed list is dismissed wrongly.
4. Survivors are compared by exact cosine in double precision.  A pair that is visited from both
   sides is counted in one visit only.  Blocks emit link counts and a spanning forest of their links: linear in
   the vectors, never the pairs.
5. Connected components of the forests.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components, and vectors without a label, link with
nothing; vectors of different lengths don't link; repeated rows are vectors of their own; a row with NULL vec_id takes part, its
component is the smallest id reachable (NULL if none) and it is not kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeeper.llm.common import materialise
from innkeeper.llm.components import connected_components

TRAIN_ROWS = 20_000
LIST_ROWS = 512
MAX_LISTS = 4096
PROBES = 12
SUBSPACES = 8
CODES = 256
BLOCK, QUERY_BLOCK = 1024, 2048
SLACK = 1e-6


def _kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Centroids by Lloyd's rounds from a random start; empty ones move to random points."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centroids, 1)[:, 0]
        counts = np.bincount(near, minlength=len(centroids))
        sums, used = np.zeros_like(centroids), np.flatnonzero(counts)
        sums[used] = np.add.reduceat(x[np.argsort(near, kind="stable")], (np.cumsum(counts) - counts)[used], axis=0)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[rng.integers(len(x), size=len(centroids))])
    return centroids


def nearest(x: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` nearest centroids, nearest first."""
    out = np.empty((len(x), min(n, len(centroids))), np.int64)
    for low in range(0, len(x), 2048):
        d = (centroids**2).sum(axis=1) - 2 * x[low : low + 2048] @ centroids.T
        out[low : low + 2048] = d.argmin(axis=1)[:, None] if n == 1 else np.argsort(d, axis=1, kind="stable")[:, : out.shape[1]]
    return out


def _unit(vectors: list, width: int) -> np.ndarray:
    """Unit vectors of the indexed width (longer ones cut, shorter ones filled with zeros): for
    choosing lists and codes only."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        m = min(width, len(v))
        out[i, :m] = v[:m]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


class Quantiser:
    """Coarse centroids and the residual codebook of every subspace."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.width = sample.shape[1]
        self.coarse = _kmeans(sample, lists)
        residual = sample - self.coarse[nearest(sample, self.coarse, 1)[:, 0]]
        self.parts = np.array_split(np.arange(self.width), min(SUBSPACES, self.width))
        self.books = [_kmeans(residual[:, p], CODES) for p in self.parts]

    def encode(self, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals and the length of what they miss."""
        left = x - self.coarse[cell]
        codes = np.empty((len(x), len(self.parts)), np.uint8)
        for m, (part, book) in enumerate(zip(self.parts, self.books, strict=True)):
            codes[:, m] = nearest(left[:, part], book, 1)[:, 0]
            left[:, part] -= book[codes[:, m]]
        return codes, np.linalg.norm(left, axis=1)

    def lookup(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Approximate cosine of every query with every coded vector of a list."""
        total = np.repeat((queries @ self.coarse[cell])[:, None], len(codes), axis=1)
        for m, (part, book) in enumerate(zip(self.parts, self.books, strict=True)):
            total += (queries[:, part] @ book.T)[:, codes[:, m]]
        return total


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges node - smallest node of its component, for links a - b among n nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


def _vectors(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.asarray(v.values, np.float64) for c in column.chunks for v in c]


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """One row per label and vector: ``gid, label, h1, h2, vec, n, first_id``."""
    usable = F.col("label").isNotNull() & F.expr("size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    some = F.expr("exists(vec, x -> x <> 0)")
    return (
        rows.where(usable & some).groupBy("label", "h1", "h2")
        .agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
        .withColumn("gid", F.monotonically_increasing_id())
    )


def build_index(distinct: DataFrame, train_rows: int = TRAIN_ROWS, probes: int = PROBES) -> tuple[DataFrame, Quantiser | None]:
    """Every distinct vector with its list, probes, codes and missed length."""
    total, width = distinct.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not total:
        return distinct.limit(0), None
    sample = distinct.select("gid", "vec")
    if total > train_rows:
        sample = sample.where(F.shiftrightunsigned(F.xxhash64("gid", F.lit("pq")), 11) < int(train_rows / total * (1 << 53)))
    # bounded by train_rows
    rows = sample.orderBy("gid").toArrow()
    quantiser = Quantiser(_unit(_vectors(rows.column("vec")), width), int(min(MAX_LISTS, max(1, total // LIST_ROWS), max(1, rows.num_rows // 16))))
    shared = distinct.sparkSession.sparkContext.broadcast(quantiser)

    def run(batches):
        own: Quantiser = shared.value
        for batch in batches:
            x = _unit(_vectors(pa.Table.from_batches([batch]).column("vec")), own.width)
            near = nearest(x, own.coarse, probes)
            codes, missed = own.encode(x, near[:, 0])
            flat = pa.array(np.arange(0, near.size + 1, near.shape[1]), pa.int32())
            more = [
                pa.array(near[:, 0]), pa.ListArray.from_arrays(flat, pa.array(near.ravel(), pa.int32())),
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "cell", "probes", "codes", "missed"])

    kept = distinct.select("gid", "label", "vec", "n", F.size("vec").alias("dim"))
    schema = "gid long, label long, vec array<double>, n long, dim int, cell long, probes array<int>, codes binary, missed double"
    return materialise(kept.mapInArrow(run, schema), "embeddings-index"), quantiser


def _blocks(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members and queries of every list, cut into blocks that meet each other exactly once."""
    key = ["label", "dim", "cell"]
    asked = index.select("*", F.explode(F.col("probes").cast("array<bigint>")).alias("probe"))
    sizes = index.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    asks = asked.groupBy("label", "dim", F.col("probe").alias("cell")).agg(F.count(F.lit(1)).alias("asks"))
    plan = sizes.join(asks, key).select(
        *key, F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("asks") / QUERY_BLOCK).cast("int").alias("query_blocks")
    )
    plan = materialise(plan, "embeddings-plan")
    members = index.join(plan, key)
    members = members.select(
        *key, F.pmod(F.xxhash64("gid"), "blocks").cast("int").alias("block"), F.explode(F.expr("sequence(0, query_blocks - 1)")).alias("query_block"),
        "gid", "vec", "n", "probes", "codes", "missed",
    )
    queries = asked.withColumn("own", F.col("cell")).drop("cell").withColumnRenamed("probe", "cell").join(plan, key)
    queries = queries.select(
        *key, F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.pmod(F.xxhash64("gid", F.lit(1)), "query_blocks").cast("int").alias("query_block"),
        "gid", "vec", "n", "own",
    )
    return members, queries.toDF(*queries.columns)  # columns of their own: both come from one index


def search(index: DataFrame, quantiser: Quantiser, threshold: float) -> DataFrame:
    """``gid, links, peer``: partial link counts (rows of linked vectors), and forest edges in ``peer``."""
    shared = index.sparkSession.sparkContext.broadcast(quantiser)
    schema = pa.schema([("gid", pa.int64()), ("links", pa.int64()), ("peer", pa.int64())])

    def meet(key, members: pa.Table, queries: pa.Table) -> pa.Table:
        own: Quantiser = shared.value
        cell = key[2].as_py()
        if not members.num_rows or not queries.num_rows:
            return schema.empty_table()
        y, x = np.stack(_vectors(members.column("vec"))), np.stack(_vectors(queries.column("vec")))
        y_gid, x_gid = members.column("gid").to_numpy(), queries.column("gid").to_numpy()
        y_n, x_n = members.column("n").to_numpy(), queries.column("n").to_numpy()
        y_probes = np.stack([np.asarray(p.values) for c in members.column("probes").chunks for p in c])
        x_cell = queries.column("own").to_numpy()
        codes = np.stack([np.frombuffer(c, np.uint8) for c in members.column("codes").to_pylist()])
        missed = members.column("missed").to_numpy()
        near = own.lookup(_unit(list(x), own.width), cell, codes) + missed[None, :] >= threshold - SLACK
        if x.shape[1] > own.width:  # longer than the sample's: the index can't bound its cosine
            near[:] = True
        i, j = np.nonzero(near)
        # a pair visited from both sides counts where the query has the smaller number
        once = (x_gid[i] < y_gid[j]) | ((x_gid[i] != y_gid[j]) & (y_probes[j] != x_cell[i][:, None]).all(axis=1))
        i, j = i[once], j[once]
        cosine = (x[i] * y[j]).sum(axis=1) / (np.linalg.norm(x, axis=1)[i] * np.linalg.norm(y, axis=1)[j])
        i, j = i[cosine >= threshold], j[cosine >= threshold]
        if not len(i):
            return schema.empty_table()
        gids = np.unique(np.r_[x_gid[i], y_gid[j]])
        a, b = np.searchsorted(gids, x_gid[i]), np.searchsorted(gids, y_gid[j])
        links = np.bincount(a, weights=y_n[j], minlength=len(gids)) + np.bincount(b, weights=x_n[i], minlength=len(gids))
        child, root = _forest(a, b, len(gids))
        return pa.table(
            [
                np.r_[gids, gids[child]], np.r_[links.astype(np.int64), np.zeros(len(child), np.int64)],
                pa.concat_arrays([pa.nulls(len(gids), pa.int64()), pa.array(gids[root])]),
            ],
            schema=schema,
        )

    members, queries = _blocks(index)
    key = ["label", "dim", "cell", "block", "query_block"]
    return members.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(meet, "gid long, links long, peer long")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    train_rows: int = TRAIN_ROWS, probes: int = PROBES,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vec")
    ).withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit("second"), "vec")})
    distinct = materialise(distinct_vectors(rows), "embeddings-distinct")
    index, quantiser = build_index(distinct, train_rows, probes)
    alone = [F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")]
    if quantiser is None:
        return rows.select("vec_id", *alone)
    found = materialise(search(index, quantiser, threshold), "embeddings-links")
    links = found.groupBy("gid").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where(F.col("peer").isNotNull()), "gid", "peer").withColumnRenamed("node", "gid")
    known = distinct.select("label", "h1", "h2", "gid", "n", "first_id").join(roots, "gid", "left").withColumn("root", F.coalesce("root", "gid"))
    known = known.join(links, "gid", "left")
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = known.join(smallest, "root").select(
        "label", "h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id", F.lit(True).alias("_found")
    )
    every = rows.select("vec_id", "label", "h1", "h2").join(known, ["label", "h1", "h2"], "left")
    component = F.when(F.col("_found"), F.col("component_id")).otherwise(F.col("vec_id"))
    return every.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
