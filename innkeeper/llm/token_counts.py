"""Token counts under a unigram model by trie-shared dynamic programming (operator 8).

The pieces are those of a public vocabulary file; a piece of rank r has the Zipf probability
proportional to 1 / (r + 1) (no tokenizer is trained).  A pre-token's segmentation is the cheapest one, of
equally cheap ones that of fewest pieces, so its token count is well defined.

The distinct pre-tokens of a batch form a trie: sorted, two neighbours share the nodes of their common
prefix.  All nodes of a depth are computed together in numpy: a node carries the partial pieces that end
at it (state in the vocabulary's trie, cost of the start), extended from its parent, and its forward score is
the cheapest completed piece.  A shared prefix is scored once; pre-tokens read their count off their
terminal node.  Counts are kept per Python worker within a bound.

Pre-tokens of more than ``LONG`` bytes are walked one by one instead, with a score for each byte that the longest piece
reaches, and their counts aren't kept.

Defined results: NULL and empty texts have 0 pre-tokens and 0 tokens; whole texts and whole pre-tokens of any length are
counted (the pattern must start a pre-token at a single blank, as the public one does);
``UnigramCounter`` alone cuts pre-tokens at ``MAX_PRETOKEN`` characters unless told otherwise, ``count_tokens`` never does; a byte outside the vocabulary is one token at a fixed cost; repeated rows
count alike; an empty table gives no rows; extra columns are carried along, and those named like an output column are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper.llm.common import byte_chunks, ragged

COST_SCALE = 10_000
UNKNOWN_COST = 25 * COST_SCALE
MAX_PRETOKEN = 4096
LONG = 4096  # bytes; its pieces fit the low bits of a score
CACHED = 200_000
CHUNK_BYTES = 2 << 20
_CUT = regex.compile(r"(?<=\S) (?=\S)")
_TOKENS = 20  # low bits of a score: pieces so far; above them: the cost


def pieces(text: str, limit: int) -> Iterator[str]:
    """Cut a text before single blanks between other characters, which start a pre-token, into
    pieces of about ``limit`` characters."""
    start = 0
    while len(text) - start > limit and (cut := _CUT.search(text, pos=start + limit)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class UnigramCounter:
    """The vocabulary's trie as sorted transitions, and forward scores of pre-tokens."""

    def __init__(self, path: str, pattern: str, max_pretoken: int | None = MAX_PRETOKEN):
        self.pattern, self.max_pretoken = regex.compile(pattern), max_pretoken
        with open(path, "rb") as f:
            found = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
        ranks = np.arange(1, len(found) + 1)
        cost = np.round(COST_SCALE * (np.log(ranks) + np.log((1 / ranks).sum()))).astype(np.int64)
        step: dict[int, int] = {}
        end: dict[int, int] = {}
        for (_, token), c in zip(found, cost.tolist(), strict=True):
            state = 0
            for b in token:
                state = step.setdefault(state << 8 | b, len(step) + 1)
            end.setdefault(state, c)
        self.step, self.end, self.longest = step, end, max((len(token) for _, token in found), default=0)
        keys = np.fromiter(step.keys(), np.int64, len(step))
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.fromiter(step.values(), np.int64, len(step))[order]
        self.cost = np.full(len(step) + 1, -1, np.int64)
        self.cost[list(end.keys())] = list(end.values())
        self.slot: dict[str, int] = {}
        self.values = np.empty((0, 2), np.int64)  # tokens and cost by slot

    def pretokens(self, text: str) -> list[str]:
        words, limit = self.pattern.findall(text), self.max_pretoken
        if limit and len(text) > limit and any(len(w) > limit for w in words):
            words = [w[i : i + limit] for w in words for i in range(0, len(w), limit)]
        return words

    def forward_long(self, word: bytes) -> tuple[int, int]:
        """Pieces and cost of one pre-token of any length."""
        step, end, size = self.step, self.end, self.longest + 1
        scores: list[tuple[int, int] | None] = [None] * size  # cost and pieces up to the next bytes, in turn
        scores[0] = (0, 0)
        for i in range(len(word)):
            cost, n = scores[i % size]
            scores[i % size] = None
            n += 1
            state, at = 0, i
            unknown = (cost + UNKNOWN_COST, n)
            if (old := scores[(i + 1) % size]) is None or unknown < old:
                scores[(i + 1) % size] = unknown
            while at < len(word) and (state := step.get(state << 8 | word[at])) is not None:
                at += 1
                if (c := end.get(state)) is not None and ((old := scores[at % size]) is None or (cost + c, n) < old):
                    scores[at % size] = (cost + c, n)
        cost, n = scores[len(word) % size]
        return n, cost

    def forward(self, words: list[bytes]) -> np.ndarray:
        """Final score (cost above, pieces in the low bits) of sorted distinct pre-tokens."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        out = np.zeros(len(words), np.int64)
        word = np.arange(len(words))  # pre-tokens that reach this depth
        node = np.zeros(len(words), np.int64)  # the node of each one's prefix
        best = np.zeros(1, np.int64)
        state, base, bounds = np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(2, np.int64)
        depth = 0
        while len(word):
            alive = lengths[word] > depth
            out[word[~alive]] = best[node[~alive]]
            word, up = word[alive], node[alive]
            if not len(word):
                break
            # sorted words: those of one prefix are neighbours, and so are those with one more byte in common
            byte = data[starts[word] + depth]
            split = np.r_[True, (byte[1:] != byte[:-1]) | (up[1:] != up[:-1])]
            node = np.cumsum(split) - 1
            parent, letter = up[split], byte[split]
            # partial pieces of the parent and a new one that starts behind it
            amount = bounds[parent + 1] - bounds[parent]
            rows = ragged(bounds[parent], amount)
            owner = np.r_[np.repeat(np.arange(len(parent)), amount), np.arange(len(parent))]
            key = np.r_[state[rows], np.zeros(len(parent), np.int64)] << 8 | letter[owner]
            from_cost = np.r_[base[rows], best[parent]]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = np.flatnonzero(self.keys[at] == key)
            ok = ok[np.argsort(owner[ok], kind="stable")]
            owner, state, base = owner[ok], self.next[at[ok]], from_cost[ok]
            best = best[parent] + (UNKNOWN_COST << _TOKENS) + 1
            done = self.cost[state] >= 0
            np.minimum.at(best, owner[done], base[done] + (self.cost[state[done]] << _TOKENS) + 1)
            bounds = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(parent)))]
            depth += 1
        return out

    def count_batch(self, texts: list[str | None]) -> np.ndarray:
        """Pre-tokens, tokens and cost of each text, one row per text."""
        sums = np.zeros((len(texts), 3), np.int64)
        which, words, ends, size = [], [], [], 0
        for i, text in enumerate(texts):
            for piece in pieces(text or "", CHUNK_BYTES):
                words += self.pretokens(piece)
                which.append(i)
                ends.append(len(words))
                size += len(piece)
                if size >= CHUNK_BYTES:
                    self._add(sums, which, words, ends)
                    which, words, ends, size = [], [], [], 0
        self._add(sums, which, words, ends)
        return sums

    def _add(self, sums: np.ndarray, which: list[int], words: list[str], ends: list[int]) -> None:
        if not which:
            return
        if len(self.values) > CACHED:
            self.slot, self.values = {}, np.empty((0, 2), np.int64)
        if missing := set(words) - self.slot.keys():
            by = sorted((w.encode("utf-8"), w) for w in missing)
            long = [(b, w) for b, w in by if len(b) > LONG]
            by = [(b, w) for b, w in by if len(b) <= LONG]
            scores = self.forward([b for b, _ in by])
            found = [self.forward_long(b) for b, _ in long]
            by += long
            self.slot.update(zip((w for _, w in by), range(len(self.values), len(self.values) + len(by)), strict=True))
            self.values = np.vstack([self.values, np.c_[scores & ((1 << _TOKENS) - 1), scores >> _TOKENS], np.array(found, np.int64).reshape(-1, 2)])
        slots = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
        for w in [w for w in missing if len(w) > LONG // 4]:  # their text would fill the memory
            del self.slot[w]
        reach = np.vstack([np.zeros((1, 2), np.int64), np.cumsum(self.values[slots], axis=0)])
        bounds = np.r_[0, ends]
        np.add.at(sums, which, np.c_[np.diff(bounds), np.diff(reach[bounds], axis=0)])


_LOADED: dict[tuple[str, str], UnigramCounter] = {}


def load(path: str, pattern: str) -> UnigramCounter:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = UnigramCounter(path, pattern, max_pretoken=None)
    return _LOADED[path, pattern]


def count_tokens(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_pretokens``, ``n_tokens`` and ``log_prob`` (natural logarithm of the
    segmentation's probability)."""
    names = ["n_pretokens", "n_tokens", "log_prob"]
    kept = docs.select(*[c for c in docs.columns if c not in names]).withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*kept.schema.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()), T.StructField(names[2], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path, pattern)
        for whole in batches:
            for part in byte_chunks(whole, text_col, CHUNK_BYTES):
                sums = counter.count_batch(part.column(text_col).to_pylist())
                more = [pa.array(sums[:, 0]), pa.array(sums[:, 1]), pa.array(0.0 - sums[:, 2] / COST_SCALE)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *names])

    return kept.mapInArrow(run, schema)
