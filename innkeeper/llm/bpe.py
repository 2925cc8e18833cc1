"""BPE encoding and decoding in batched numpy merge rounds (operator 3).

The symbols of many words lie in one flat array.  A round finds the rank of adjacent
pairs by binary search over the sorted pair keys, takes the lowest rank of every word and
merges all its occurrences (left to right, never overlapping); words without a known pair leave
the array.  Only pairs touching a merged symbol are searched again.  This equals merging one pair at a
time, since a pair that holds a merge's result always ranks behind that merge.

The tokenizer file is a parameter and is read inside the tasks (the file is installed on every
machine); words are split, normalised and marked as the file says for its kind: NFC, lower case,
white space dropped, end-of-word symbols, special tokens recognised in the raw text.

Defined results: a NULL or empty text encodes to no ids, and no ids decode to the empty text;
very long texts are cut at white space, which no word spans, so that working arrays stay bounded;
repeated rows are encoded one by one; an empty table gives no rows; extra columns are carried along by
``encode_documents``/``decode_documents`` and one that has the output column's name is replaced.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from innkeeper.llm.common import byte_chunks, ragged

CHUNK_BYTES = 2 << 20
CACHED_WORDS = 200_000
NO_RANK = np.int64(1 << 40)
_SHIFT = 32


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte used by byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class WordBpe:
    """A word-level BPE vocabulary with an end-of-word suffix, read from a tokenizer file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + suffix] for s in symbols], np.int64)
        left = np.array([vocab[a] for a, _ in model["merges"]], np.int64)
        right = np.array([vocab[b] for _, b in model["merges"]], np.int64)
        into = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)
        keys = left << _SHIFT | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.into = keys[order], order.astype(np.int64), into[order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self._words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.usual: set[str] = set()
        self._reset()

    def _reset(self) -> None:
        self.slot: dict[str, int] = {w: i for i, w in enumerate(self.special)}
        self.flat = np.array(list(self.special.values()), np.int64)
        self.lengths = np.ones(len(self.special), np.int64)

    def words(self, text: str) -> list[str]:
        """Normalised words of a text, special tokens among them."""
        if "<|" in text:
            parts = self._specials.split(text)
            return [w for p in parts for w in ([p] if p in self.special else self._plain(p))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii() and (strange := set(text) - self.usual):
            unassigned = {c for c in strange if unicodedata.category(c) == "Cn"}
            self.usual |= strange - unassigned
            if unassigned:
                return self._newer(text)
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # lower case goes character by character: no final form of sigma
        return self._words.findall(text.replace("Σ", "σ").lower())

    @cached_property
    def _library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def _newer(self, text: str) -> list[str]:
        """Words of a text with characters that Python's Unicode tables don't know: the
        splitter of the vocabulary's own library has later tables."""
        parts = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        byte = {s: b for b, s in enumerate(_byte_symbols())}
        return [bytes(byte[c] for c in part).decode("utf-8") for part, _ in parts]

    def _search(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of symbol pairs; NO_RANK if they don't merge."""
        key = left << _SHIFT | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), self.into[at]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each (not empty) word."""
        raw = [w.encode("utf-8") for w in words]
        if not raw:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym, last = self.inner[data], np.cumsum(lengths) - 1
        sym[last] = self.final[data[last]]
        word = np.repeat(np.arange(len(raw)), lengths)
        rank, into = np.full(len(sym), NO_RANK), np.zeros(len(sym), np.int64)
        rank[:-1], into[:-1] = self._search(sym[:-1], sym[1:])
        rank[last] = NO_RANK
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(sym)])
            best = np.repeat(lowest, size)
            if (over := best == NO_RANK).any():
                done.append((word[over], sym[over]))
                live = ~over
                sym, word, rank, into, best = sym[live], word[live], rank[live], into[live], best[live]
                if not len(sym):
                    break
            pick = rank == best
            if (pick[1:] & pick[:-1]).any():  # a run of equal symbols: every other pair of the run
                at = np.flatnonzero(pick)
                start = np.r_[True, np.diff(at) != 1]
                run = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
                pick[at[(np.arange(len(at)) - run) % 2 == 1]] = False
            sym = np.where(pick, into, sym)
            keep = np.r_[True, ~pick[:-1]]
            sym, word, rank, into, pick = sym[keep], word[keep], rank[keep], into[keep], pick[keep]
            again = pick.copy()
            again[:-1] |= pick[1:]
            again = np.flatnonzero(again)
            rank[again] = NO_RANK
            again = again[again + 1 < len(sym)]
            again = again[word[again] == word[again + 1]]
            rank[again], into[again] = self._search(sym[again], sym[again + 1])
        words_done, ids = np.concatenate([w for w, _ in done]), np.concatenate([s for _, s in done])
        return ids[np.argsort(words_done, kind="stable")], np.bincount(words_done, minlength=len(raw))

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of ids of each text."""
        ids, counts = [], np.zeros(len(texts), np.int64)
        for which, words, ends in self._groups(texts):
            if len(self.slot) > CACHED_WORDS:
                self._reset()
            if new := [w for w in dict.fromkeys(words) if w not in self.slot]:
                flat, lengths = self.encode_words(new)
                self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new)), strict=True))
                self.flat, self.lengths = np.r_[self.flat, flat], np.r_[self.lengths, lengths]
            slots = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
            size = self.lengths[slots]
            ids.append(self.flat[ragged((np.cumsum(self.lengths) - self.lengths)[slots], size)])
            np.add.at(counts, which, np.diff(np.r_[0, np.cumsum(size)][np.r_[0, ends]]))
        return (np.concatenate(ids) if ids else np.empty(0, np.int64)), counts

    def _groups(self, texts: list[str | None]) -> Iterator[tuple[list[int], list[str], list[int]]]:
        """Text numbers, words and the end of each text's words, for about CHUNK_BYTES at a time."""
        which, words, ends, size = [], [], [], 0
        for i, text in enumerate(texts):
            for piece in pieces(text or "", CHUNK_BYTES):
                words += self.words(piece)
                which.append(i)
                ends.append(len(words))
                size += len(piece)
                if size >= CHUNK_BYTES:
                    yield which, words, ends
                    which, words, ends, size = [], [], [], 0
        if which:
            yield which, words, ends

    def decode_batch(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """Each text's tokens joined by one space, special tokens kept."""
        tokens, out, start = self.tokens, [], 0
        for end in np.cumsum(counts).tolist():
            out.append(" ".join(map(tokens.__getitem__, flat[start:end].tolist())))
            start = end
        return out


def pieces(text: str, limit: int) -> Iterator[str]:
    """Cut a text behind white space into pieces of about ``limit`` characters."""
    start = 0
    while len(text) - start > limit:
        cut = max(text.rfind(" ", start, start + limit), text.rfind("\n", start, start + limit))
        if cut < start:
            found = regex.search(r"[ \n]", text, pos=start + limit)
            if not found:
                break
            cut = found.start()
        yield text[start : cut + 1]
        start = cut + 1
    yield text[start:]


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The vocabulary at ``path``, read once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``out_col``: the token ids of each whole text (array of int, never NULL)."""
    kept = docs.drop(out_col) if out_col in docs.columns else docs
    kept = kept.withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*kept.schema.fields, T.StructField(out_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path)
        for whole in batches:
            for part in byte_chunks(whole, text_col, CHUNK_BYTES):
                flat, counts = codec.encode_batch(part.column(text_col).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, out_col])

    return kept.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``out_col``: the decoded text of ``ids_col`` (NULL ids: empty)."""
    kept = encoded.drop(out_col) if out_col in encoded.columns else encoded
    schema = T.StructType([*kept.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path)
        for part in batches:
            rows = [x or [] for x in part.column(ids_col).to_pylist()]
            flat = np.array([i for x in rows for i in x], np.int64)
            texts = codec.decode_batch(flat, np.array([len(x) for x in rows], np.int64))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out_col])

    return kept.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode its ids in one pass: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256`` without moving ids or texts out of the task."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path)
        digits = [str(i) for i in range(len(codec.tokens))]
        for whole in batches:
            for part in byte_chunks(whole, "text", CHUNK_BYTES):
                flat, counts = codec.encode_batch(part.column("text").to_pylist())
                ids, start = [], 0
                for end in np.cumsum(counts).tolist():
                    ids.append(_sha256(" ".join(map(digits.__getitem__, flat[start:end].tolist()))))
                    start = end
                texts = [_sha256(t) for t in codec.decode_batch(flat, counts)]
                columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
