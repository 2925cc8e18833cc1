"""Toxicity scoring with noisy-channel deobfuscation (operator 6).

1. A character trigram model is counted over the letters of all documents: tasks emit symbol
   counts, Spark sums them; the table has ``SYMBOLS**3`` entries whatever the corpus.
2. Spans that look disguised (leetspeak, single letters spaced out, stretched letters) become
   character lattices: each run of a character may stand for the letters it can mean, one or two
   copies of a stretched letter, or nothing (separators).  Viterbi finds the most likely reading under
   the model and the channel costs; the rest of the text stays as it is.
3. The restored text is scored: features are its words and word beginnings; their document
   frequencies in a bounded, hash-chosen sample of labelled rows give log-odds, and a logistic curve over the two
   strongest words of a text gives the score.

Defined results: NULL, empty and wordless texts get the score of a text without any telling word; without toxic or
without clean training rows every score is the share of toxic rows (0.0 without labels); a document labelled more than once counts as toxic if
any label says so; repeated rows score alike; an empty table gives no rows; extra columns are carried along, and
those named like an output column are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper.llm.common import byte_chunks

SYMBOLS = 64
SAMPLE_ROWS = 10_000
CHUNK_BYTES = 1 << 20
CACHED_WORDS = 200_000
PREFIXES = (4, 5, 6)
FALSE_ALARM = 1e-5

# Letters that a character of leetspeak can stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
# Log costs of the channel.
COST_LEET, COST_SINGLE, COST_KEEP_STRETCHED, COST_DROP, COST_SPLIT = -0.7, -3.0, -1.0, -4.0, -1.0

_WORD = re.compile(r"[^\W\d_]+")
_LEET = re.compile(r"[0134578@$|+!](?=[^\W\d_])|(?<=[^\W\d_])[0134578@$|+!]")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_DOUBLED = re.compile(r"(.)\1+")
_SPACED = re.compile(r"(?<![\w@$])[\w@$]([ ._*-])[\w@$](?:\1[\w@$!|+]){2,}(?![\w@$])")
_EDGE = ".,;:!?\"'()[]"


# ---------------------------------------------------------------- character model


def symbols(codes: np.ndarray) -> np.ndarray:
    """Symbol of each lower-case code point: 0 for anything but letters, 1-26 for a-z, and the
    other letters folded onto the remaining symbols (all characters from U+00C0 on count
    as letters, but for the multiplication and division signs)."""
    folded = 27 + codes % (SYMBOLS - 27)
    return np.where(codes < len(_LATIN), _LATIN[np.minimum(codes, len(_LATIN) - 1)], folded)


_LATIN = np.zeros(0xC0, np.int64)
_LATIN[97:123] = np.arange(1, 27)
_LATIN = np.r_[_LATIN, [0 if c in (0xD7, 0xF7) else 27 + c % (SYMBOLS - 27) for c in range(0xC0, 0x100)]]


def letter_symbol(letter: str) -> int:
    return int(symbols(np.array([ord(letter)], np.int64))[0])


def count_trigrams(docs: DataFrame, text_col: str) -> np.ndarray:
    """Trigram counts over the whole texts of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(SYMBOLS**3, np.int64)
        for whole in batches:
            for part in byte_chunks(whole, "text", CHUNK_BYTES):
                text = "\n".join(["", *(t.lower() for t in part.column("text").to_pylist() if t), ""])
                s = symbols(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64))
                letter = s > 0
                letter[1:] |= letter[:-1]  # one boundary behind each word
                s = np.r_[0, s[letter], 0]
                sums += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["gram", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "gram long, n long")
    found = rows.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**3, np.int64)
    counts[found["gram"].to_numpy(np.int64)] = found["n"]
    return counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def language_model(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """Log P(third | first two), interpolated with the shorter contexts."""
    single = counts.sum(axis=(0, 1)) + 1.0
    single = single / single.sum()
    double = counts.sum(axis=0)
    double = (double + weight * single) / (double.sum(axis=1, keepdims=True) + weight)
    triple = (counts + weight * double[None]) / (counts.sum(axis=2, keepdims=True) + weight)
    return np.log(triple).astype(np.float32)


# ---------------------------------------------------------------- lattice and Viterbi


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Readings of each run of equal characters with their channel costs."""
    out = []
    for run in re.finditer(r"(.)\1*", span, re.S):
        c, k = run[1], len(run[0])
        if c.isalpha():
            letters, base = c, 0.0
        elif c in LEET:
            letters, base = LEET[c], COST_LEET
        else:
            # a separator is left out; a blank may also part two words
            out.append([("", 0.0 if c in " ._*-" else COST_DROP)] + [(" ", COST_SPLIT)] * (c == " "))
            continue
        if k == 1:
            options = [(a, base) for a in letters]
        elif k == 2:
            options = [x for a in letters for x in ((a + a, base), (a, base + COST_SINGLE))]
        else:
            options = [x for a in letters for x in ((a, base), (a + a, base + COST_KEEP_STRETCHED))]
        if c in "!|+$":  # may also be punctuation
            options.append(("", COST_DROP))
        out.append(options)
    return out


def viterbi(span: str, model: np.ndarray) -> str:
    """The most likely reading of a disguised span; of equal ones the first in lattice order."""
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for options in lattice(span):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (p, q), (score, path) in best.items():
            for letters, cost in options:
                a, b, total = p, q, score + cost
                for letter in letters:
                    x = letter_symbol(letter)
                    total += float(model[a, b, x])
                    a, b = b, x
                if (a, b) not in after or total > after[a, b][0]:
                    after[a, b] = (total, (path, letters))
        best = after
    path = max(((s + float(model[p, q, 0]), path) for (p, q), (s, path) in best.items()), key=lambda x: x[0])[1]
    out = []
    while path:
        path, letters = path
        out.append(letters)
    return "".join(reversed(out))


def _spaced_out(text: str) -> bool:
    """Whether two single characters in a row stand between blanks somewhere, as the inner ones of
    four letters spaced out do (a cheap test before the pattern that reads such spans)."""
    blank = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 32
    return bool((blank[:-4] & ~blank[1:-3] & blank[2:-2] & ~blank[3:-1] & blank[4:]).any())


class Restorer:
    """Replaces disguised spans of lower-case text by their readings; readings are kept, within a bound."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.known: dict[str, str] = {}

    def read(self, span: str) -> str:
        if span not in self.known:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[span] = viterbi(span, self.model)
        return self.known[span]

    def blanks(self, text: str) -> str:
        """Letters spaced out by blanks, read as words."""
        return _SPACED.sub(lambda m: self.read(m[0]) if m[1] == " " else m[0], text) if _spaced_out(text) else text

    def token(self, token: str) -> str:
        """A word between white space, read if it looks disguised; punctuation at its ends stays."""
        token = _SPACED.sub(lambda m: self.read(m[0]), token)
        core = token.strip(_EDGE)
        if core and (_LEET.search(core) or _STRETCHED.search(core)):
            at = token.index(core)
            return token[:at] + self.read(core) + token[at + len(core) :]
        return token

    def restore(self, text: str) -> str:
        parts = re.split(r"(\s+)", self.blanks(text))
        parts[::2] = map(self.token, parts[::2])
        return "".join(parts)


# ---------------------------------------------------------------- classifier


def features(word: str) -> list[str]:
    """The word, the word without doubled letters, its beginnings."""
    return ["=" + word, "~" + _DOUBLED.sub(r"\1", word), *("^" + word[:n] for n in PREFIXES if len(word) > n)]


@dataclass
class Model:
    """Log-odds of telling features, the curve over a text's two strongest words, the character model."""

    characters: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    constant: float | None = None  # the score of everything, if there was nothing to learn


class Scorer:
    def __init__(self, model: Model):
        self.model, self.restorer = model, Restorer(model.characters)
        self.known: dict[str, dict[str, float]] = {}

    def token(self, token: str) -> dict[str, float]:
        """Telling words of a word between white space, with their log-odds."""
        if len(self.known) >= CACHED_WORDS:
            self.known.clear()
        found = {}
        for word in _WORD.findall(self.restorer.token(token)):
            if weight := max(self.model.weights.get(f, 0.0) for f in features(word)):
                found[word] = weight
        self.known[token] = found
        return found

    def strongest(self, text: str | None) -> tuple[float, float]:
        """Log-odds of the two strongest different words of the restored text."""
        top: dict[str, float] = {}
        known = self.known
        for token in set(self.restorer.blanks((text or "").lower()).split()):
            found = known.get(token)
            if found is None:
                found = self.token(token)
            if found:
                top |= found
        best = sorted(top.values(), reverse=True)[:2]
        return (*best, 0.0, 0.0)[:2]

    def score(self, text: str | None) -> float:
        if self.model.constant is not None:
            return self.model.constant
        a, (x, y) = self.model.curve, self.strongest(text)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, a[0] + a[1] * x + a[2] * y))))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> tuple[float, float, float]:
    """Ridge-penalised logistic regression by Newton steps."""
    z, w = np.c_[np.ones(len(x)), x], np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(3), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The character model over all ``docs``; the classifier from about ``sample_rows`` of the
    labelled documents (all of them if there are no more), chosen by a hash of the id.

    A feature is telling when it is at least e times as frequent in toxic documents and would be
    so by chance with a probability under ``FALSE_ALARM``."""
    characters = language_model(count_trigrams(docs, text_col))
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_toxic"))
    total = known.count()
    if total > sample_rows:
        known = known.where(F.shiftrightunsigned(F.xxhash64("_id", F.lit("toxicity")), 11) < int(sample_rows / total * (1 << 53)))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    # the sample of ids is bounded by sample_rows
    sample = rows.join(F.broadcast(known), "_id").select("text", (F.col("_toxic") > 0).cast("int").alias("toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(characters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, toxic, clean = Restorer(shared.value), Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                tokens = set(restorer.blanks((text or "").lower()).split())
                words = {w for t in tokens for w in _WORD.findall(restorer.token(t))}
                (toxic if label else clean).update({f for w in words for f in features(w)} | {""})
        for label, counter in ((1, toxic), (0, clean)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counter), pa.string()), pa.array([label] * len(counter), pa.int32()), pa.array(list(counter.values()), pa.int64())],
                ["feature", "toxic", "n"],
            )

    counted = sample.mapInArrow(count, "feature string, toxic int, n long")
    counted = counted.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean")
    )
    counted = counted.where((F.col("toxic") >= 3) & (F.col("toxic") > F.col("clean") * 0.01) | (F.col("feature") == "")).toPandas().set_index("feature")
    sums = counted.loc[""] if "" in counted.index else {"toxic": 0, "clean": 0}
    n_toxic, n_clean = int(sums["toxic"]), int(sums["clean"])
    if not n_toxic or not n_clean:
        return Model(characters, constant=n_toxic / max(1, n_toxic + n_clean))
    counted = counted.drop("")
    p, q = (counted["toxic"] + 0.5) / (n_toxic + 1), (counted["clean"] + 0.5) / (n_clean + 1)
    odds = np.log(p / q)
    # Chernoff bound: chance of so many toxic holders if the feature told nothing
    seen, base = counted["toxic"] + counted["clean"], n_toxic / (n_toxic + n_clean)
    share = counted["toxic"] / seen
    rest = np.where(share < 1, (1 - share) * np.log(np.maximum(1 - share, 1e-300) / (1 - base)), 0.0)
    odds = odds[(odds >= 1) & (seen * (share * np.log(share / base) + rest) >= -math.log(FALSE_ALARM))]
    model = Model(characters, odds.to_dict())
    given = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(given.value)
        for batch in batches:
            found = [scorer.strongest(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.float64()), pa.array([y for _, y in found], pa.float64()), batch.column("toxic")], ["x", "y", "toxic"]
            )

    seen = sample.mapInArrow(measure, "x double, y double, toxic int").groupBy("x", "y", "toxic").count().orderBy("x", "y", "toxic").toPandas()
    seen = seen.loc[seen.index.repeat(seen["count"])]
    model.curve = _fit(seen[["x", "y"]].to_numpy(), seen["toxic"].to_numpy(np.float64))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", restored_col: str | None = None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` and, if asked for, the lower-case restored text."""
    own = [c for c in docs.columns if c not in ("score", "predicted", restored_col)]
    kept = docs.select(*own).withColumn(text_col, F.col(text_col).cast("string"))
    more = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    more += [T.StructField(restored_col, T.StringType())] if restored_col else []
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for part in byte_chunks(whole, text_col, CHUNK_BYTES):
                texts = part.column(text_col).to_pylist()
                scores = [scorer.score(t) for t in texts]
                columns = [*part.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
                columns += [pa.array([scorer.restorer.restore((t or "").lower()) for t in texts], pa.string())] if restored_col else []
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *(f.name for f in more)])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *more]))
