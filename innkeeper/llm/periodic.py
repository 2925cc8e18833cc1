"""Periodic runs of words by sparse diagonal dynamic programming (operator 13).

A diagonal is a lag: place i matches on lag q if the words at i and i - q are the same.  Every place extends the active match
lengths of the lags at which its word occurred before; a lag whose match ends was long enough, or not, for a run: a match of M places
on lag q is a stretch of M + q words of period q.

The table of lags is sparse.  A run of at least ``least`` words and two periods matches on ``max(q, least - q)`` places in a row, so a lag becomes
active at once with the first ``width`` words of a match, where ``width`` is the least such length of its range of lags: lags below
``least`` first, then each range twice as wide as the one before, with windows as long as its smallest lag.  Windows are
told apart by hashes that are doubled from range to range; texts without any repeated window drop out.  In a range the earlier
occurrences of a window are few, unless the window itself is periodic: then those at multiples of that period in the same run are
passed over, because a lag that is a multiple of a run's period is never the smallest.  What is left, sorted by lag and place, is the table in the
order of its diagonals: neighbouring places extend a match, a gap ends it, and every match that ends long enough emits its run.
The lags of a range are worked off in parts when they have more than ``MATCHES`` matches, so memory stays bounded.  Emitted runs are compared word by word
once more; should a hash ever have joined different windows, the batch is done again with other hashes.

Texts are independent of each other: one pass of the table, no shuffle.

Defined results: a NULL or empty text has 0 words, no runs and an empty collapsed text; whole texts of any length are searched; overlapping
runs of other periods are all reported; repeated rows give equal results; an empty table gives no rows; extra columns are
carried along, and those named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper.llm.common import byte_chunks

LEAST = 12
CHUNK_BYTES = 2 << 20
MATCHES = 1 << 22
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    x = (x ^ (x >> np.uint64(29))) * _M1
    return x ^ (x >> np.uint64(32))


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two windows side by side."""
    return _mix(left * _M1 + _mix(right))


class _Windows:
    """Hashes of the windows of growing width at every place of some texts laid end to end."""

    def __init__(self, ids: np.ndarray, seed: int):
        self.one = _mix(ids.astype(np.uint64) + np.uint64(seed * int(_M2) % 2**64))

    def of(self, width: int) -> np.ndarray:
        """Of the windows of ``width`` words (too short an array has none): doubled up, then two overlapping halves."""
        h, size = self.one, 1
        while 2 * size <= width:
            h, size = _join(h[: max(0, len(h) - size)], h[size:]), 2 * size
        if size < width and (rest := width - size) <= len(h):
            h = _join(h[: len(h) - rest], h[rest:])
        return h


def _matches(pos: np.ndarray, group: np.ndarray, width: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Places and lags (from ``low`` to ``high``) of equal windows; None if there are more than ``MATCHES`` on several lags.
    ``pos`` are places sorted by window (``group``), then place."""
    n = len(pos)
    at = np.arange(n)
    begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    first = np.repeat(begin, np.diff(np.r_[begin, n]))  # of the same window
    gap = np.where(at > first, pos - np.r_[0, pos[:-1]], -1)
    # a chain: places at equal distance, no longer than a window, so all in one run of that period
    chain = (gap[1:] == gap[:-1]) & (gap[1:] > 0) & (gap[1:] <= width)
    head = np.maximum.accumulate(np.where(np.r_[True, ~chain], at, 0)) - 1  # the place in front of the chain's first gap
    places, lags, total = [], [], 0
    near = (gap >= low) & (gap <= high)
    places.append(pos[near])
    lags.append(gap[near])
    key = group * (int(pos.max(initial=0)) + 1) + pos
    k = at[(at > first + 1) | (gap > 0)]
    reach = np.searchsorted(key, group[k] * (int(pos.max(initial=0)) + 1) + pos[k] - low, side="right") - 1
    j = np.minimum(head[k] - 1, reach)
    while len(k):
        lag = pos[k] - pos[np.maximum(j, 0)]
        ok = (j >= first[k]) & (lag <= high)
        k, j, lag = k[ok], j[ok], lag[ok]
        places.append(pos[k])
        lags.append(lag)
        total += len(k)
        if total > MATCHES and low < high:
            return None
        j = j - 1
    return np.concatenate(places), np.concatenate(lags)


def _emit(place: np.ndarray, lag: np.ndarray, width: int, least: int) -> np.ndarray:
    """Start, length and period of the runs whose matches these are: places in a row on one lag are one match."""
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    new = np.r_[True, (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)]
    head = np.flatnonzero(new)
    tail = np.r_[head[1:], len(place)] - 1
    period = lag[head]
    start = place[head] - period
    length = place[tail] + width - start
    keep = length >= np.maximum(least, 2 * period)
    return np.stack([start[keep], length[keep], period[keep]], axis=1)


def find_runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST, seed: int = 1) -> np.ndarray:
    """All maximal runs of at least ``least`` (3 or more) words and two smallest periods in texts laid end to end: rows of start,
    length and period, starts counted over all texts.  ``bounds`` are the texts' first places and the end."""
    if least < 3:
        raise ValueError("least must be at least 3")
    found = [np.empty((0, 3), np.int64)]
    where, sizes = np.arange(len(ids)), np.diff(bounds)  # original places of the texts still in the search
    low, high, width = 1, least - 1, (least + 1) // 2
    while len(where):
        stop = np.repeat(np.cumsum(sizes), sizes)
        text = np.repeat(np.arange(len(sizes)), sizes)
        windows = _Windows(ids[where], seed)
        h = windows.of(width)
        fits = np.flatnonzero(np.arange(len(h)) + width <= stop[: len(h)])
        h = _join(h[fits], text[fits].astype(np.uint64))
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        if not same.any():
            break
        order = order[np.r_[same, False] | np.r_[False, same]]
        order = order[np.lexsort((order, h[order]))]
        pos = fits[order]
        group = np.cumsum(np.r_[0, h[order][1:] != h[order][:-1]])
        todo = [(low, high)]
        while todo:
            a, b = todo.pop()
            if (met := _matches(pos, group, width, a, b)) is None:
                todo += [(a, (a + b) // 2), ((a + b) // 2 + 1, b)]
            elif len(met[0]):
                runs = _emit(*met, width, least)
                runs[:, 0] = where[runs[:, 0]]  # texts stay whole, so lengths stay as they are
                found.append(runs)
        # the next range: twice as wide, for texts that have any repeated window and room for two periods
        low, high, width = high + 1, 2 * high + 1, max(width, high + 1)
        alive = np.zeros(len(sizes), bool)
        alive[text[pos]] = True
        alive &= sizes >= 2 * low
        where, sizes = where[alive[text]], sizes[alive]
    runs = np.concatenate(found)
    if len(runs):  # every word but those of the first period is the one a period before it
        size = runs[:, 1] - runs[:, 2]
        inside = np.repeat(runs[:, 0] + runs[:, 2], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        if (ids[inside] != ids[inside - np.repeat(runs[:, 2], size)]).any():
            return find_runs(ids, bounds, least, seed + 1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of_texts(texts: list[str | None], least: int) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """Number of words, runs and collapsed text of each text."""
    words = [(t or "").encode("utf-8").split() for t in texts]  # bytes are split at the six ASCII blanks
    number: dict[bytes, int] = {}
    for w in words:
        number.update(dict.fromkeys(w, 0))
    number = dict(zip(number, range(len(number)), strict=True))
    bounds = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
    ids = np.fromiter((number[x] for w in words for x in w), np.int64, bounds[-1])
    runs = find_runs(ids, bounds, least)
    owner = np.searchsorted(bounds, runs[:, 0], side="right") - 1
    begin, end = runs[:, 0] + runs[:, 2], runs[:, 0] + runs[:, 1]
    cover = np.cumsum(np.bincount(begin, minlength=len(ids) + 1) - np.bincount(end, minlength=len(ids) + 1)) if len(runs) else np.zeros(len(ids) + 1, np.int64)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i, w in enumerate(words):
        mine = runs[cuts[i] : cuts[i + 1]] - [bounds[i], 0, 0]
        if len(mine):
            w = [w[k] for k in np.flatnonzero(cover[bounds[i] : bounds[i + 1]] == 0).tolist()]
        yield len(words[i]), list(map(tuple, mine.tolist())), b" ".join(w).decode("utf-8")


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic_runs(docs: DataFrame, least: int = LEAST, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (an array of start word, length and smallest period, by start, then period) and ``collapsed``:
    the words joined by a blank, without those that any run contains after its first period."""
    names = ["n_words", "runs", "collapsed"]
    kept = docs.select(*[c for c in docs.columns if c not in names]).withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*kept.schema.fields, *T._parse_datatype_string(f"n_words bigint, runs array<{RUN}>, collapsed string").fields])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in byte_chunks(whole, text_col, CHUNK_BYTES):
                n, runs, text = zip(*runs_of_texts(part.column(text_col).to_pylist(), least), strict=True)
                flat = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
                items = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(kind.value_type))
                offsets = pa.array(np.r_[0, np.cumsum([len(r) for r in runs])].astype(np.int32))
                more = [pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, items).cast(kind), pa.array(text, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *names])

    return kept.mapInArrow(run, schema)
