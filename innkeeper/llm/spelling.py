"""Spelling variants by bidirectional FM-index search schemes (operator 12).

Two words are near if one inserted, deleted or replaced code point makes one the other.  A word of length L splits at h = L div 2; with one
error, either its left or its right half stands unchanged at the same end of the other word.  So a search matches the left half exactly from
the front, then goes on over the rest to the right with one error, and another one matches the right half exactly from the back, then goes on to
the left with one error; the second one reports only words that the first one can't (those whose left half differs).

``VocabularyIndex`` holds words as rotations around one delimiter each, sorted, so that the suffixes of all words
are ranks and a pattern is an interval of them.  Its rank tables over the preceding symbols (one of the words, one of the reversed words) let a pattern grow by a
symbol on either side; both intervals move together.  A pattern with a delimiter on both ends is a whole word, whose interval in
the first table is the word's own rank.  All searches of a batch take their next symbol together, in numpy.

On Spark every word is dealt by its two halves to the index of its shard, and asks in the shards of the halves that words of its length, one less and
one more would have: one probe per length, for replacements, deletions and insertions.  A shard is an index of bounded size (``SHARD_WORDS``
words on average).  A half that more words share is dealt over a grid of its own: each part of its words as index
meets each part as probes, so no task holds all of them and no pair is lost or met twice.  A shard returns per probe the number of near words
and the best of them, never the pairs.

Forms point to words at least ``ratio`` times as frequent, so chains of forms are short; pointer doubling follows them.

Defined results: NULL words are left out; a word's rows are added up; words shorter than ``min_length`` are no words; ties of the most frequent near word go to
the smallest in code-point order; an empty vocabulary gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeeper.llm.common import materialise, ragged
from innkeeper.operators.lookup import checked_broadcast

SHARD_WORDS = 20_000
BLOCK = 16
PREFIX, SUFFIX = 0, 1


class _Ranks:
    """Symbols in front of sorted rotations: how many of a symbol, and of smaller ones, stand before a rank."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.symbols, n = symbols, len(symbols)
        self.block = max(BLOCK, n_symbols // 4)  # tables stay within a few times the symbols
        n_blocks = n // self.block + 1
        padded = np.full(n_blocks * self.block, n_symbols, symbols.dtype)
        padded[:n] = symbols
        self.blocks = padded.reshape(n_blocks, self.block)
        per = np.bincount(np.arange(n) // self.block * (n_symbols + 1) + symbols, minlength=n_blocks * (n_symbols + 1)).reshape(n_blocks, -1)
        self.count = np.vstack([np.zeros((1, n_symbols + 1), np.int64), np.cumsum(per, axis=0)])[:-1].astype(np.int32)
        self.below = np.cumsum(self.count, axis=1, dtype=np.int32) - self.count
        self.lf = np.empty(n, np.int64)  # rank of the rotation that begins with the symbol in front
        self.lf[np.argsort(symbols, kind="stable")] = np.arange(n)
        self.first = np.cumsum(np.bincount(symbols, minlength=n_symbols + 1)) - np.bincount(symbols, minlength=n_symbols + 1)
        self.column = np.arange(self.block)

    def before(self, symbol: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, rest = np.divmod(rank, self.block)
        head, symbol = self.blocks[at], symbol.astype(self.symbols.dtype)
        inside = self.column < rest[:, None]
        same = ((head == symbol[:, None]) & inside).sum(axis=1)
        less = ((head < symbol[:, None]) & inside).sum(axis=1)
        return self.count[at, symbol] + same, self.below[at, symbol] + less


def _sorted_rotations(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places of all rotations of distinct delimited words in order, by doubling the compared length."""
    sizes = np.diff(bounds)
    start, size = np.repeat(bounds[:-1], sizes), np.repeat(sizes, sizes)
    place = np.arange(len(symbols)) - start
    rank, step = symbols.astype(np.int64), 1
    while True:
        later = rank[start + (place + step) % size]
        order = np.lexsort((later, rank))
        new = np.r_[0, np.cumsum((rank[order][1:] != rank[order][:-1]) | (later[order][1:] != later[order][:-1]))]
        rank = np.empty(len(symbols), np.int64)
        rank[order] = new
        if new[-1] == len(symbols) - 1:
            return order
        step *= 2


class VocabularyIndex:
    """Bidirectional index over distinct words; words have the numbers of their code-point order."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        flat = np.frombuffer("".join(self.words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.letters = np.unique(flat)
        self.n_symbols = len(self.letters) + 1  # 0 is the delimiter
        kind = np.uint8 if self.n_symbols < 256 else np.int32
        bounds = np.r_[0, np.cumsum(self.lengths + 1)]
        self.bounds, tables = bounds, []  # of the words with a delimiter each
        word = np.repeat(np.arange(len(self.words)), self.lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        for at in (bounds[word] + place, bounds[word] + self.lengths[word] - 1 - place):  # the words, then reversed
            symbols = np.zeros(bounds[-1], kind)
            symbols[at] = np.searchsorted(self.letters, flat) + 1
            order = _sorted_rotations(symbols, bounds)
            owner = np.searchsorted(bounds, order, side="right") - 1
            front = np.where(order > bounds[owner], order - 1, bounds[owner + 1] - 1)
            tables.append(_Ranks(symbols[front], self.n_symbols))
            if len(tables) == 1:
                self.symbols = symbols
        self.left, self.right = tables

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words end to end (those of no letter here match nothing) and the words' bounds."""
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.letters, flat), len(self.letters) - 1)
        return np.where(self.letters[at] == flat, at + 1, self.n_symbols), np.r_[0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]

    def _grow(self, table: _Ranks, symbol: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The patterns with a symbol more on the table's side: interval in the table, in the other one, and their size."""
        # a pattern of one place grows by the symbol in front of it or not at all
        one = size == 1
        new_a, new_b, new_size = table.lf[np.where(one, a, 0)], b.copy(), (table.symbols[np.where(one, a, 0)] == symbol).astype(np.int64)
        if len(many := np.flatnonzero(~one)):
            symbol, a, size = symbol[many], a[many], size[many]
            low, low_less = table.before(symbol, a)
            high, high_less = table.before(symbol, a + size)
            new_a[many], new_size[many] = table.first[symbol] + low, high - low
            new_b[many] += high_less - low_less
        return new_a, new_b, new_size

    def _next_symbols(self, table: _Ranks, a: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (interval, symbol) by which the patterns can grow on the table's side, but for the delimiter."""
        near = size <= 2 * self.n_symbols
        which = np.flatnonzero(near)
        row = np.repeat(which, size[which])
        key = np.unique(row * (self.n_symbols + 1) + table.symbols[ragged(a[which], size[which])])
        far = np.flatnonzero(~near)
        key = np.r_[key, (far[:, None] * (self.n_symbols + 1) + np.arange(1, self.n_symbols)).ravel()]
        row, symbol = np.divmod(key, self.n_symbols + 1)
        return row[symbol > 0], symbol[symbol > 0]

    def search(self, words: list[str], lengths: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``words``, number of an index word of the asked length) with exactly one error, none of it in the half of the
        index word at its front (``PREFIX``), or none in its other half and some in the front one (``SUFFIX``)."""
        codes, bounds = self.encode(words)
        m = np.diff(bounds)
        half = lengths // 2
        exact = half if side == PREFIX else lengths - half
        kind = lengths - m  # 0: replaced, 1: inserted, -1: deleted
        table = self.right if side == PREFIX else self.left

        def at(q: np.ndarray, k: np.ndarray | int) -> np.ndarray:  # the k-th symbol that a search takes
            return codes[bounds[q] + k if side == PREFIX else bounds[q + 1] - 1 - k]

        # the exact halves, each different one once; every pattern begins as the delimiter
        seen: dict[str, int] = {}
        halves = [w[:e] if side == PREFIX else w[len(w) - e :] for w, e in zip(words, exact.tolist(), strict=True)]
        pattern = np.fromiter((seen.setdefault(h, len(seen)) for h in halves), np.int64, len(halves))
        asks = np.unique(pattern, return_index=True)[1]
        whole = np.zeros((2, len(asks)), np.int64), np.full(len(asks), len(self.words))
        for k in range(int(exact.max(initial=0))):
            go = np.flatnonzero((exact[asks] > k) & (whole[1] > 0))
            whole[0][0, go], whole[0][1, go], whole[1][go] = self._grow(table, at(asks[go], k), *whole[0][:, go], whole[1][go])
        (all_a, all_b), all_size = whole
        waiting = np.flatnonzero(all_size[pattern] > 0)
        waiting = waiting[np.argsort(exact[waiting], kind="stable")]
        none = np.empty(0, np.int64)
        q, a, b, size = none, none, none, none
        spent = (none, none, none, none, none)  # word, interval, other interval, size, symbols taken
        found = [(none, none)]
        k = int(exact[waiting].min()) if len(waiting) else 0
        while len(q) or len(spent[0]) or len(waiting):
            born = [spent]
            join, waiting = np.split(waiting, [np.searchsorted(exact[waiting], k, side="right")])
            q, at_half = np.r_[q, join], pattern[join]
            a, b, size = np.r_[a, all_a[at_half]], np.r_[b, all_b[at_half]], np.r_[size, all_size[at_half]]
            free = np.arange(len(q))
            if len(free):
                grow = free[((kind[q[free]] == 0) & (k < m[q[free]])) | (kind[q[free]] == 1)]
                row, symbol = self._next_symbols(table, a[grow], size[grow])
                row = grow[row]
                more = k < m[q[row]]
                own = np.where(more, at(q[row], np.minimum(k, m[q[row]] - 1)), -1)
                row, symbol = row[symbol != own], symbol[symbol != own]
                if len(row):
                    born.append((q[row], *self._grow(table, symbol, a[row], b[row], size[row]), k + (kind[q[row]] == 0)))
                skip = free[(kind[q[free]] == -1) & (k < m[q[free]])]
                last = k + 1 >= m[q[skip]]
                # of equal symbols in a row the last one is left out
                skip = skip[last | (at(q[skip], np.minimum(k + 1, m[q[skip]] - 1)) != at(q[skip], k))]
                born.append((q[skip], a[skip], b[skip], size[skip], np.full(len(skip), k + 1)))
            go = np.flatnonzero(k < m[q])
            q, a, b, size = q[go], *self._grow(table, at(q[go], k), a[go], b[go], size[go])
            ok = size > 0
            q, a, b, size = q[ok], a[ok], b[ok], size[ok]
            w, c, d, s, taken = (np.concatenate(x) for x in zip(*born, strict=True))
            ok = s > 0
            w, c, d, s, taken = w[ok], c[ok], d[ok], s[ok], taken[ok]
            symbol = np.where(taken < m[w], at(w, np.minimum(taken, m[w] - 1)), 0)
            c, d, s = self._grow(table, symbol, c, d, s)
            over = (symbol == 0) & (s > 0)
            found.append((w[over], (d if side == PREFIX else c)[over]))
            on = (symbol != 0) & (s > 0)
            spent = (w[on], c[on], d[on], s[on], taken[on] + 1)
            k += 1
        query, word = (np.concatenate(x) for x in zip(*found, strict=True))
        if side == SUFFIX and len(query):
            h = half[query]
            ours = ragged(bounds[query], h)
            theirs = ragged(self.bounds[word], h)
            same = np.logical_and.reduceat(codes[ours] == self.symbols[theirs], np.cumsum(h) - h)
            query, word = query[~same], word[~same]
        return query, word


def _search_shard(table: pa.Table) -> pa.Table:
    """Number of near words and the best near word of each probe of a shard that has any."""
    side = table.column("side")[0].as_py()
    words, sizes = table.column("word").to_pylist(), np.asarray(table.column("size"))
    amounts = np.asarray(table.column("n"))
    is_index, is_probe = (np.asarray(table.column(c)) for c in ("is_index", "is_probe"))
    index_of = {words[i]: amounts[i] for i in np.flatnonzero(is_index).tolist()}
    probes = np.flatnonzero(is_probe)
    out: tuple[list, ...] = ([], [], [], [])
    if index_of and len(probes):
        index = VocabularyIndex(list(index_of))
        n = np.fromiter((index_of[w] for w in index.words), np.int64, len(index.words))
        asked = [words[i] for i in probes.tolist()]
        q, v = index.search(asked, sizes[probes], side)
        order = np.lexsort((v, -n[v], q))
        q, v = q[order], v[order]
        head = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, np.int64)
        out = ([asked[i] for i in q[head].tolist()], np.diff(np.r_[head, len(q)]), n[v[head]], [index.words[i] for i in v[head].tolist()])
    return pa.table([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())], ["word", "n_near", "best_n", "best"])


def _probes(word: Column, min_length: int) -> Column:
    """A word's parts in the search: per side and length of the words asked for, the half that decides the shard."""
    m, parts = F.char_length(word), []
    for d in (-1, 0, 1):
        size = m + d
        half = F.floor(size / 2).cast("int")
        for side, key in ((PREFIX, F.substring(word, F.lit(1), half)), (SUFFIX, F.substring(word, m - (size - half) + 1, size - half))):
            parts.append(F.when(size >= min_length, F.struct(F.lit(side).alias("side"), size.alias("size"), F.xxhash64(F.lit(side), size, key).alias("key"), F.lit(d == 0).alias("is_index"))))
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def near_words(vocabulary: DataFrame, min_length: int = 7, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n_near, best_n, best`` per side and length with any near word, from a written vocabulary ``word, n`` of distinct words."""
    shards = max(1, math.ceil(vocabulary.count() / shard_words))
    parts = vocabulary.select("word", "n", F.explode(_probes(F.col("word"), min_length)).alias("p")).select("word", "n", "p.*")
    hot = parts.where("is_index").groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > shard_words)
    hot = materialise(hot.select("key", F.ceil(F.col("rows") / shard_words).cast("int").alias("cells")), "spelling-hot")
    if hot.isEmpty():
        parts = parts.withColumn("cells", F.lit(None).cast("int"))
    else:
        parts = parts.join(checked_broadcast(hot), "key", "left")
    mine = F.pmod(F.xxhash64(F.lit(7), "word"), F.col("cells")).cast("int")
    ways = F.sequence(F.lit(0), F.col("cells") - 1)
    # a cell (i, j) of a hot half: its index words of part i, its probes of part j
    cells = F.flatten(
        F.array(
            F.when(F.col("is_index"), F.transform(ways, lambda j: F.struct(mine.alias("i"), j.alias("j"), F.lit(True).alias("is_index"), (j == mine).alias("is_probe")))).otherwise(F.array().cast("array<struct<i:int,j:int,is_index:boolean,is_probe:boolean>>")),
            F.transform(F.filter(ways, lambda i: ~F.col("is_index") | (i != mine)), lambda i: F.struct(i.alias("i"), mine.alias("j"), F.lit(False).alias("is_index"), F.lit(True).alias("is_probe"))),
        )
    )
    alone = F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.col("is_index").alias("is_index"), F.lit(True).alias("is_probe")))
    dealt = parts.withColumn("cell", F.explode(F.when(F.col("cells").isNull(), alone).otherwise(cells))).select(
        "side", F.when(F.col("cells").isNull(), F.pmod("key", F.lit(shards))).otherwise(F.col("key")).alias("shard"),
        "cell.*", "size", "word", "n",
    )
    return dealt.groupBy("side", "shard", "i", "j").applyInArrow(_search_shard, "word string, n_near long, best_n long, best string")


def follow_forms(links: DataFrame, longest: int) -> DataFrame:
    """``word, root`` of ``word, form`` links whose chains have at most ``longest`` links: the last word of each chain."""
    hops = materialise(links.select("word", F.col("form").alias("root")), "spelling-links")
    for _ in range(max(0, math.ceil(math.log2(max(1, longest))))):
        onward = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = materialise(hops.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-links")
    return hops


def group_variants(words: DataFrame, ratio: int = 10, min_length: int = 7, min_count: int = 2, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table ``word, n``: near words counted, the most frequent one as the word's form if it is at
    least ``ratio`` (2 or more) times as frequent, and the last word of the chain of forms."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    counted = words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    vocabulary = materialise(counted, "spelling-words")
    best = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    found = near_words(vocabulary, min_length, shard_words).select("word", F.lit(0).cast("long").alias("n"), "n_near", best.alias("best"))
    own = vocabulary.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    both = own.unionByName(found).groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    is_form = -F.col("best.n") >= ratio * F.col("n")
    near = both.select("word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"))
    near = materialise(near, "spelling-near")
    low, high = near.agg(F.min("n"), F.max("n")).first()
    longest = math.ceil(math.log(high / low, ratio) + 1) if low else 0  # every link multiplies the frequency
    roots = follow_forms(near.where("form is not null"), longest)
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
