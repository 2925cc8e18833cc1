"""Benchmark decontamination over a positional inverted index (operator 9).

``build_index`` stores, for every training document, its postings: the term ids of the benchmark
vocabulary in term order, each with its word position.  The index is partitioned by
document, so a task intersects whole posting lists without a shuffle.  ``search`` lays the postings of
a run of documents out as one sorted (term, position) list, starts every benchmark
window from the list of its locally rarest term and keeps those starts whose offset-adjusted
position is present in the list of each further term, rarest first.  With ``slop`` a further term may
stand up to that many words from its place (proximity match).

The benchmark is a query set: it is taken in blocks of at most ``block_bytes`` of text,
each broadcast in turn against all documents, so its size has no limit but one item per block.

Words are the runs of ASCII letters (lower-cased), digits and non-ASCII characters.  A
window is ``width`` consecutive words of an item; a shorter, not empty item is one window.

Defined results: a NULL or empty document or item has no words; repeated documents are
separate rows; repeated items count once by id; an item whose id is NULL marks words
but is not listed; an empty table gives no rows or no hits; columns beyond those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeeper.llm.common import byte_chunks, materialise, ragged

CHUNK_BYTES = 2 << 20
CHUNK_WORDS = 400_000
CHUNK_STARTS = 1_000_000
BLOCK_BYTES = 2 << 20
_POS = 40
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

KEYS = ["row_id", "doc_id", "text_hash"]
INDEX_SCHEMA = "row_id long, doc_id long, text_hash long, n_words long, terms array<int>, positions array<int>"
FOUND_SCHEMA = "row_id long, doc_id long, text_hash long, n_words long, starts array<int>, ends array<int>, items array<string>, near_items array<string>"


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split() if text else []


class Windows:
    """The windows of one block of the benchmark over its own vocabulary."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        number: dict[tuple[int, ...], int] = {}
        held: list[set[str]] = []
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                at = number.setdefault(tuple(ids[i : i + width]), len(number))
                if at == len(held):
                    held.append(set())
                if item is not None:
                    held[at].add(item)
        self.size = np.array([len(w) for w in number], np.int64)
        self.terms = np.full((len(number), width), -1, np.int64)
        for at, w in enumerate(number):
            self.terms[at, : len(w)] = w
        self.names = sorted({x for s in held for x in s})
        place = {x: i for i, x in enumerate(self.names)}
        self.item_counts = np.array([len(s) for s in held], np.int64)
        self.items = np.array([place[x] for s in held for x in sorted(s)], np.int64)

    def occurrences(self, keys: np.ndarray, counts: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Window numbers, starts and exactness of the matches in sorted (term, position)
        ``keys``; ``counts`` has the length of each term's list."""
        if not len(keys) or not len(self.size):
            return
        there = np.where(self.terms >= 0, counts[self.terms], np.int64(1) << 60)
        alive = np.flatnonzero(there.min(axis=1) > 0)
        order = np.argsort(there[alive], axis=1, kind="stable")
        rarest = self.terms[alive, order[:, 0]]
        amount = counts[rarest]
        first = (np.cumsum(counts) - counts)[rarest]
        cut = np.searchsorted(np.cumsum(amount), np.arange(CHUNK_STARTS, int(amount.sum()) + CHUNK_STARTS, CHUNK_STARTS), side="right")
        low = 0
        for high in [*np.unique(np.maximum(cut, 1)).tolist(), len(alive)]:
            if high <= low:
                continue
            which = np.repeat(np.arange(low, high), amount[low:high])
            start = (keys[ragged(first[low:high], amount[low:high])] & ((1 << _POS) - 1)) - order[which, 0]
            exact = np.ones(len(which), bool)
            for rank in range(1, self.terms.shape[1]):
                offset = order[which, rank]
                term = self.terms[alive[which], offset]
                want = (term << _POS) + start + offset
                at = np.minimum(np.searchsorted(keys, want - slop), len(keys) - 1)
                ok = (term < 0) | ((keys[at] >= want - slop) & (keys[at] <= want + slop))
                if slop:
                    point = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                    exact &= (term < 0) | (keys[point] == want)
                which, start, exact = which[ok], start[ok], exact[ok]
                if not len(which):
                    break
            if len(which):
                yield alive[which], start, exact
            low = high


def _index(docs: DataFrame, windows, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = windows.value.vocabulary
        for whole in batches:
            for part in byte_chunks(whole, "text", CHUNK_BYTES):
                found = []
                for text in part.column("text").to_pylist():
                    each = words(text)
                    found.append(np.fromiter(map(vocabulary.get, each, repeat(-1)), np.int64, len(each)))
                n_words = np.array([len(x) for x in found], np.int64)
                term = np.concatenate(found) if found else np.empty(0, np.int64)
                at = np.flatnonzero(term >= 0)
                doc = np.searchsorted(np.cumsum(n_words), at, side="right")
                order = np.lexsort((at, term[at], doc))
                at, doc = at[order], doc[order]
                ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(n_words)))]
                position = at - (np.cumsum(n_words) - n_words)[doc]
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (term[at], position)]
                columns = [*(part.column(c) for c in KEYS), pa.array(n_words), *lists]
                yield pa.RecordBatch.from_arrays(columns, [*KEYS, "n_words", "terms", "positions"])

    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    return rows.mapInArrow(run, INDEX_SCHEMA)


def _flat(column: pa.ListArray) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64)


def _search(index: DataFrame, windows, width: int, slop: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Windows = windows.value
        for whole in batches:
            ends = np.cumsum(np.asarray(whole.column("n_words")).astype(np.int64))
            low = 0
            while low < whole.num_rows:
                base = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, base + CHUNK_WORDS, side="right")))
                yield one(w, whole.slice(low, high - low))
                low = high

    def one(w: Windows, part: pa.RecordBatch) -> pa.RecordBatch:
        n_words = np.asarray(part.column("n_words")).astype(np.int64)
        held = np.asarray(part.column("terms").value_lengths()).astype(np.int64)
        # documents stand apart by more than a window reaches
        base = width + slop + np.cumsum(n_words + width + 2 * slop) - (n_words + width + 2 * slop)
        term, position = _flat(part.column("terms")), _flat(part.column("positions")) + np.repeat(base, held)
        keys = np.sort(term << _POS | position)
        counts = np.bincount(term, minlength=len(w.vocabulary))
        edge = np.zeros(int(base[-1] + n_words[-1] + 2 * (width + slop)), np.int64)
        pairs: list[np.ndarray] = []
        near: list[np.ndarray] = []
        for which, start, exact in w.occurrences(keys, counts, slop):
            doc = np.searchsorted(base, start + (0 if not slop else slop), side="right") - 1
            owners = np.repeat(doc, w.item_counts[which])
            items = w.items[ragged((np.cumsum(w.item_counts) - w.item_counts)[which], w.item_counts[which])]
            coded = owners * max(1, len(w.names)) + items
            sure = np.repeat(exact, w.item_counts[which])
            pairs.append(np.unique(coded[sure]))
            near.append(np.unique(coded[~sure]))
            np.add.at(edge, start[exact], 1)
            np.add.at(edge, start[exact] + w.size[which[exact]], -1)
        hit = np.r_[0, (np.cumsum(edge) > 0).astype(np.int8), 0]
        step = np.diff(hit)
        up, down = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        doc = np.searchsorted(base, up, side="right") - 1
        spans = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(base)))]

        def listed(parts: list[np.ndarray]) -> pa.ListArray:
            every = np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int64)
            owner, item = np.divmod(every, max(1, len(w.names)))
            at = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(base)))]
            return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array([w.names[i] for i in item.tolist()], pa.string()))

        lists = [pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pa.array(x - base[doc], pa.int32())) for x in (up, down)]
        columns = [*(part.column(c) for c in KEYS), part.column("n_words"), *lists, listed(pairs), listed(near)]
        return pa.RecordBatch.from_arrays(columns, [*KEYS, "n_words", "starts", "ends", "items", "near_items"])

    return index.mapInArrow(run, FOUND_SCHEMA)


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, slop: int = 0, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For every document: ``row_id, doc_id, text_hash, n_words, starts, ends`` (word ranges inside
    exact matches, merged, end exclusive), ``items`` (ids with an exactly matching window) and ``near_items``
    (ids with a window matched only in proximity)."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    # one numbering of the rows for all blocks
    rows = docs if blocks == 1 else materialise(docs.select(id_col, text_col), "decontaminate-docs")
    found = []
    for block in range(blocks):
        mine = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        windows = spark.sparkContext.broadcast(Windows([(r["item"], r["text"]) for r in mine.collect()], width))
        index = materialise(_index(rows, windows, id_col, text_col), "decontaminate-index")
        found.append(_search(index, windows, width, slop))
    if blocks == 1:
        return found[0]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    gathered = every.groupBy("row_id").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"),
    )
    merged = F.aggregate(
        "spans", F.expr("cast(array() as array<struct<starts:int,ends:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["ends"] >= x["starts"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["starts"].alias("starts"), F.greatest(F.element_at(done, -1)["ends"], x["ends"]).alias("ends"))),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    gathered = gathered.withColumn("spans", F.when(F.size("spans") > 0, merged).otherwise(F.expr("cast(array() as array<struct<starts:int,ends:int>>)")))
    return gathered.select(*KEYS, "n_words", F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"), "items", "near_items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold an exact benchmark window; rows of equal id and text share their fate."""
    found = find_overlaps(docs, benchmark, id_col=id_col, text_col=text_col, **options).where(F.size("starts") > 0)
    # written, so that the join below can see its size
    hit = materialise(found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "decontaminate-hit")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("_hash"))
    return docs.join(hit, same, "left_anti")
