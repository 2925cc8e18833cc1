"""Language identification (operator 4): multinomial naive Bayes over hashed character n-grams.

Training counts come from a bounded sample of the labelled rows (``sample_rows``, chosen by a
hash of the id); tasks emit bucket counts, Spark sums them, and the log-probability matrix of
``2**bits`` rows by languages is broadcast: its size depends on neither the documents nor the sample.
Scoring is sparse: a text touches only the rows of its own n-grams, gathered and summed in numpy in bounded
pieces, over the whole text.

Characters are lower-cased, and everything that is not a letter becomes one blank, so n-grams see word starts and
ends but no digits or punctuation.

Defined results: a NULL text or one without a letter is ``und`` with score 0.0; so is every text when there is
nothing to learn from; ties go to the language first in alphabetical order; repeated rows are predicted alike; an empty table
gives no rows; extra columns are carried along, and those named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper.llm.common import byte_chunks

ORDERS = (1, 2, 3)
BITS = 17
SAMPLE_ROWS = 20_000
CHUNK_BYTES = 1 << 20
PIECE = 1 << 19
UNKNOWN = "und"
_NOT_LETTERS = regex.compile(r"\P{L}+")
_PAD = " " * (max(ORDERS) - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str | None) -> str:
    """Lower-cased letters, anything else as single blanks, and so many blanks at both ends
    that an n-gram reaching into the next text holds blanks alone."""
    return _PAD + _NOT_LETTERS.sub(" ", (text or "").lower()).strip() + _PAD


def buckets(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Hash bucket of the n-gram that starts at each code point but the padding at the end."""
    n = len(codes) - len(_PAD)
    key = np.full(n, np.uint64(order))
    for i in range(order):
        key = (key ^ codes[i : i + n]) * _MIX
        key ^= key >> np.uint64(29)
    return ((key * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def _texts_as_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all plain texts in one run, with padding at its end, and the start of each."""
    each = [plain(t) for t in texts]
    sizes = np.fromiter(map(len, each), np.int64, len(each))
    codes = np.frombuffer(("".join(each) + _PAD).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return codes, np.cumsum(sizes) - sizes


def train(labelled: DataFrame, id_col: str, text_col: str, label_col: str, bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and their matrix of log-probabilities; the last row has the log-priors.

    ``labelled`` rows with a NULL label are not used.  About ``sample_rows`` of them are,
    chosen by a hash of the id over all rows (all of them if there are no more)."""
    rows = labelled.where(F.col(label_col).isNotNull())
    total = rows.count()
    if total > sample_rows:
        rows = rows.where(F.shiftrightunsigned(F.xxhash64(id_col, F.lit("langid")), 11) < int(sample_rows / total * (1 << 53)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for part in byte_chunks(whole, "text", CHUNK_BYTES):
                by: dict[str, list[str | None]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    by.setdefault(lang, []).append(text)
                for lang, texts in by.items():
                    codes, _ = _texts_as_codes(texts)
                    mine = sums.setdefault(lang, np.zeros((1 << bits) + 1, np.int64))
                    for order in ORDERS:
                        mine[:-1] += np.bincount(buckets(codes, order, bits), minlength=1 << bits)
                    mine[-1] += len(texts)
        for lang, mine in sums.items():
            used = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(mine[used])], ["lang", "bucket", "n"])

    counted = rows.select(F.col(label_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    found = counted.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    sums = np.zeros(((1 << bits) + 1, len(langs)))
    if langs:
        sums[found["bucket"], found["lang"].map({x: i for i, x in enumerate(langs)})] = found["n"]
    grams, rows_of = sums[:-1] + 0.5, sums[-1]
    matrix = np.log(grams / grams.sum(axis=0))
    return langs, np.vstack([matrix, np.log(np.maximum(rows_of, 1) / max(1.0, rows_of.sum()))])


def log_likelihoods(texts: list[str | None], matrix: np.ndarray, bits: int) -> np.ndarray:
    """Sum of the log-probabilities of all n-grams of each text, priors included."""
    codes, starts = _texts_as_codes(texts)
    out = np.tile(matrix[-1], (len(texts), 1))
    for order in ORDERS:
        for low in range(0, len(codes) - len(_PAD), PIECE):
            found = matrix[buckets(codes[low : low + PIECE + len(_PAD)], order, bits)]
            high = low + len(found)
            first = int(np.searchsorted(starts, low, side="right")) - 1
            last = int(np.searchsorted(starts, high, side="left"))
            cuts = np.maximum(starts[first:last], low) - low
            out[first:last] += np.add.reduceat(found, cuts, axis=0)
    return out


def predict(
    docs: DataFrame, langs: list[str], matrix: np.ndarray, text_col: str = "text", bits: int = BITS
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior probability of that language)."""
    own = [c for c in docs.columns if c not in ("lang_pred", "score")]
    kept = docs.select(*own).withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for whole in batches:
            for part in byte_chunks(whole, text_col, CHUNK_BYTES):
                texts = part.column(text_col).to_pylist()
                pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                some = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if names else []
                if some:
                    sums = log_likelihoods([texts[i] for i in some], table, bits)
                    best = sums.argmax(axis=1)
                    score[some] = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                    for i, b in zip(some, best.tolist(), strict=True):
                        pred[i] = names[b]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred, pa.string()), pa.array(score)], [*part.schema.names, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)
