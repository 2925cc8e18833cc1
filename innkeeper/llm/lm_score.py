"""Language-model scores by subword lattices (operator 11).

A token is a word (lower-cased A-Z, no blanks) or the end of a text.  A word stands for its UTF-8 bytes behind a mark of
its start, and every way to write these bytes as pieces of an existing vocabulary is a path through the word's lattice; single
bytes are pieces too, so every word has a path.  A path has the product of its pieces' probabilities, the word their sum over
all paths (log-space forward recursion), and a document the product over its tokens: the marginal probability over all its
segmentations, because no piece reaches over the start of a word.  Pieces and the end have probabilities that add up to 1.

The existing scores weight the paths first: a piece of score -r has a probability proportional to 1 / (r + 1), the end as much
as the best piece.  The training texts then re-weight the same pieces (the vocabulary stays as it is): forward and backward
sums over all segmentations of all training words give the expected number of each piece, and the probabilities become these
numbers plus ``SMOOTHING`` times the existing ones; ``rounds`` times.

On Spark: word counts are combined in each task before they shuffle; the lattice of a distinct word is summed once, not once
per occurrence; the learned weights are one number per piece of the vocabulary file.  At most
``HEAD`` words, the most frequent ones, reach the documents by broadcast, all other words by a join on the word, so that no frequent word is a join key.

Defined results: a NULL or empty text is one token, its end; whole texts and words of any length count; a NULL id is a training
row; repeated rows count and are scored each; without training tokens the base is log10(1) for every token and the existing scores
alone weight the lattice; an empty table gives no rows.  Only the id and text columns are read; columns of other names are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeeper.llm.common import byte_chunks, materialise

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
CHUNK_BYTES = 1 << 18  # bytes of words whose lattices are summed together
TEXT_BYTES = 4 << 20
SMOOTHING = 1000.0
HEAD, HEAD_WORD_BYTES = 1 << 17, 256


def read_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a vocabulary file as bytes, the mark of a word's start as one blank, and their scores.  Left out are control
    pieces, those with a mark anywhere but in front (a word can't hold them) and those with A-Z (words are lower-cased)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: list[bytes] = []
    scores: list[float] = []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        text = model.id_to_piece(i)
        if model.is_byte(i):
            piece = bytes([int(text[1:-1], 16)])
        elif "▁" in text[1:] or any("A" <= c <= "Z" for c in text):
            continue
        else:
            piece = text.replace("▁", " ").encode("utf-8")
        found.append(piece)
        scores.append(model.get_score(i))
    return found, np.array(scores)


class Lattice:
    """Pieces as a trie with a table of transitions, and sums over all segmentations of a batch of words.

    The bytes of a batch lie place by place: first the first byte of every word, the longest word first, then the second
    of those that have one, so that a place is one slice and a node's next one is found by the place's offset."""

    def __init__(self, pieces: list[bytes]):
        step: dict[int, int] = {}
        ends: list[int] = []
        for piece in pieces:
            state = 0
            for b in piece:
                state = step.setdefault(state << 8 | b, len(step) + 1)
            ends.append(state)
        # pieces of equal bytes are parallel arcs of one span: they share a unit, which has the sum of their probabilities
        units, self.unit_of = np.unique(np.array(ends, np.int64), return_inverse=True)
        self.n_units = len(units)
        keys = np.fromiter(step.keys(), np.int64, len(step))
        used = np.unique(keys & 255)
        self.letter = np.zeros(256, np.int64)  # 0: a byte of no piece
        self.letter[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        self.next = np.full((len(step) + 1) * self.width, -1, np.int32)
        self.next[(keys >> 8) * self.width + self.letter[keys & 255]] = np.fromiter(step.values(), np.int64, len(step))
        self.unit = np.full(len(step) + 1, -1, np.int32)
        self.unit[units] = np.arange(len(units))

    def arcs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First node, last node and unit of all pieces in the words, which must be sorted by falling length; then the nodes
        at which the places begin and the words' lengths, the mark included (a word of n bytes has n + 2 nodes)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        flat = np.frombuffer(b"".join([b" " + w for w in words]), np.uint8)
        word = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        alive = np.bincount(place, minlength=1) if len(flat) else np.zeros(1, np.int64)  # words that have a byte there
        off = np.r_[0, np.cumsum(alive)]
        data = np.empty(len(flat), np.int64)
        data[off[place] + word] = self.letter[flat]
        alive, n_places = np.r_[alive, 0], len(alive)
        place = np.repeat(np.arange(n_places), alive[:-1])
        word = np.arange(len(data)) - off[place]
        # nodes: one more for each word, so the places of nodes begin elsewhere than those of bytes
        node_off = np.r_[0, np.cumsum(np.r_[len(words), alive[:n_places]])]
        state = self.next[data]
        sources, targets, units, depth = [], [], [], 1
        ok = state >= 0
        place, word, state = place[ok], word[ok], state[ok].astype(np.int64)
        while len(state):
            unit = self.unit[state]
            done = unit >= 0
            sources.append(node_off[place[done]] + word[done])
            targets.append(node_off[place[done] + depth] + word[done])
            units.append(unit[done])
            at = np.minimum(place + depth, n_places)
            ok = word < alive[at]
            place, word, state, at = place[ok], word[ok], state[ok], at[ok]
            state = self.next[state * self.width + data[off[at] + word]].astype(np.int64)
            ok = state >= 0
            place, word, state = place[ok], word[ok], state[ok]
            depth += 1
        cat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (sources, targets, units)]
        return *cat, node_off, lengths

    @staticmethod
    def _sweep(score: np.ndarray, source: np.ndarray, target: np.ndarray, weight: np.ndarray, node_off: np.ndarray, backward: bool) -> None:
        """Log sums into the targets, place by place (from the last place to the first one if ``backward``)."""
        order = np.argsort(target, kind="stable")  # runs of one depth are in order already
        source, target, weight = source[order], target[order], weight[order]
        if not len(target):
            return
        heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        cuts = np.searchsorted(target, node_off)
        at = np.searchsorted(heads, cuts)
        places = range(len(cuts) - 1)
        for i in reversed(places) if backward else places:
            a, b = cuts[i], cuts[i + 1]
            if a == b:
                continue
            group = heads[at[i] : at[i + 1]] - a
            value = score[source[a:b]] + weight[a:b]
            top = np.maximum.reduceat(value, group)
            value -= np.repeat(top, np.diff(np.r_[group, b - a]))
            score[target[a:b][group]] = top + np.log(np.add.reduceat(np.exp(value), group))

    def forward(self, words: list[bytes], log_prob: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's probability over all its segmentations (words by falling length)."""
        source, target, unit, node_off, lengths = self.arcs(words)
        score = np.zeros(node_off[-1])
        self._sweep(score, source, target, log_prob[unit], node_off, False)
        return score[node_off[lengths] + np.arange(len(words))]

    def expected(self, words: list[bytes], amount: np.ndarray, log_prob: np.ndarray) -> np.ndarray:
        """Expected number of each unit over all segmentations of the words (by falling length), each ``amount`` times."""
        source, target, unit, node_off, lengths = self.arcs(words)
        weight = log_prob[unit]
        there = np.zeros(node_off[-1])
        self._sweep(there, source, target, weight, node_off, False)
        last = node_off[lengths] + np.arange(len(words))
        back = np.zeros(node_off[-1])
        self._sweep(back, target, source, weight, node_off, True)
        word = target - node_off[np.searchsorted(node_off, target, side="right") - 1]
        share = np.exp(there[source] + weight + back[target] - there[last][word])
        return np.bincount(unit, share * amount[word], minlength=self.n_units)


_LOADED: dict[str, tuple[Lattice, np.ndarray]] = {}


def load(path: str) -> tuple[Lattice, np.ndarray]:
    """The lattice of a vocabulary file and the probabilities of its units and, last, the end by the existing scores."""
    if path not in _LOADED:
        pieces, scores = read_pieces(path)
        lattice = Lattice(pieces)
        existing = np.append(np.bincount(lattice.unit_of, 1 / (1 - scores), minlength=lattice.n_units), 1.0)
        _LOADED[path] = lattice, existing / existing.sum()
    return _LOADED[path]


def words_of(text: str | None) -> list[bytes]:
    """The words of a text: A-Z lower-cased, split at the six ASCII blanks (those that bytes are split at)."""
    return (text or "").encode("utf-8").translate(LOWER).split()


def _chunks(words: list[bytes]) -> Iterator[np.ndarray]:
    """Places of the words by falling length, in runs of about ``CHUNK_BYTES``."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-lengths, kind="stable")
    group = np.cumsum(lengths[order] + 1) // CHUNK_BYTES
    return iter(np.split(order, np.flatnonzero(np.diff(group)) + 1)) if len(words) else iter([])


def count_words(docs: DataFrame, text_col: str, train_col: str) -> DataFrame:
    """``word, n``: all distinct words and how often the training rows hold them; combined in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        other: set[bytes] = set()

        def flush() -> pa.RecordBatch:
            rest = other - seen.keys()
            words = [*seen, *rest]
            numbers = np.r_[np.fromiter(seen.values(), np.int64, len(seen)), np.zeros(len(rest), np.int64)]
            seen.clear()
            other.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(numbers)], ["word", "n"])

        size = 0
        for whole in batches:
            for part in byte_chunks(whole, text_col, TEXT_BYTES):
                for text, train in zip(part.column(text_col).to_pylist(), part.column(train_col).to_pylist(), strict=True):
                    (seen if train else other).update(words_of(text))
                    size += len(text or "")
                if size > 4 * TEXT_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    found = docs.select(F.col(text_col).cast("string").alias(text_col), train_col).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _expected_units(vocabulary: DataFrame, path: str, prob: np.ndarray) -> np.ndarray:
    """Expected number of each unit in the counted words: one row per unit and task, then one per unit of the vocabulary file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, _ = load(path)
        total, log_prob = np.zeros(lattice.n_units), np.log(prob[:-1])
        for batch in batches:
            words = batch.column("word").cast(pa.binary()).to_pylist()
            amounts = np.asarray(batch.column("n")).astype(float)
            for rows in _chunks(words):
                total += lattice.expected([words[i] for i in rows.tolist()], amounts[rows], log_prob)
        unit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(total[unit])], ["unit", "amount"])

    found = vocabulary.where("n > 0").mapInArrow(run, "unit long, amount double").groupBy("unit").agg(F.sum("amount").alias("amount"))
    out = np.zeros(len(prob) - 1)
    for unit, amount in found.collect():
        out[unit] = amount
    return out


def _score_words(vocabulary: DataFrame, path: str, prob: np.ndarray) -> DataFrame:
    """``word, n, score``: log10 of the word's probability over all its segmentations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, _ = load(path)
        log_prob = np.log(prob[:-1])
        for batch in batches:
            words = batch.column("word").cast(pa.binary()).to_pylist()
            score = np.empty(len(words))
            for rows in _chunks(words):
                score[rows] = lattice.forward([words[i] for i in rows.tolist()], log_prob) / math.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], ["word", "n", "score"])

    return vocabulary.select("word", "n").mapInArrow(run, "word string, n long, score double")


def _head_from(vocabulary: DataFrame) -> int:
    """The least count from which on there are at most ``HEAD`` words: from a histogram whose bins are an eighth of a doubling wide, so
    every task sends a few hundred numbers and no words."""
    scale = F.floor(F.log2("n") * 8)
    bins = vocabulary.where("n > 0").groupBy(scale.alias("bin")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).orderBy(F.desc("bin")).collect()
    least, words = 1 << 62, 0
    for _, n, low in bins:
        words += n
        if words > HEAD:
            break
        least = low
    return least


def score_texts(docs: DataFrame, path: str, train: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3) -> DataFrame:
    """Every row of ``docs`` as ``id_col, train, n_tokens, n_known, train_tokens, base_score, score``, learned from the rows of which
    ``train`` holds (a NULL of it counts as true: such a row has no id to hold it out by).  ``base_score`` adds log10((c + 1) / (N + V + 1)) over the tokens; ``score`` is the lattice's log10 probability."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col), F.coalesce(train, F.lit(True)).alias("train"))
    vocabulary = materialise(count_words(rows, text_col, "train"), "lm-words")
    n_words, n_kinds = vocabulary.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_ends = rows.where("train").count()
    n_all, n_kinds = n_words + n_ends, n_kinds + (n_ends > 0)

    _, existing = load(path)
    prob = existing
    for _ in range(rounds if n_all else 0):
        prob = np.append(_expected_units(vocabulary, path, prob), float(n_ends)) + SMOOTHING * existing
        prob /= prob.sum()
    scored = materialise(_score_words(vocabulary, path, prob), "lm-scores")

    below = math.log10(n_all + n_kinds + 1)
    top = scored.where(F.col("n") >= _head_from(scored)).where(F.octet_length("word") <= HEAD_WORD_BYTES)
    head = {w.encode("utf-8"): (math.log10(n + 1) - below, s) for w, n, s in top.collect()}
    shared = spark.sparkContext.broadcast(head)
    end = (int(n_ends > 0), math.log10(n_ends + 1) - below, math.log10(prob[-1]))
    names = ["row", id_col, "train", "n_tokens", "n_known", "base", "score", "words", "numbers"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for whole in batches:
            for part in byte_chunks(whole, text_col, TEXT_BYTES):
                out = []
                for text in part.column(text_col).to_pylist():
                    found = Counter(words_of(text))
                    n_known, base, score = end
                    rest: list[bytes] = []
                    for word, n in found.items():
                        if (at := known.get(word)) is None:
                            rest.append(word)
                        else:
                            n_known += n
                            base += n * at[0]
                            score += n * at[1]
                    out.append((found.total() + 1, n_known, base, score, rest, [found[w] for w in rest]))
                cols = list(zip(*out, strict=True)) if out else [[]] * 6
                words = pa.array(cols[4], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
                more = [*(pa.array(cols[i], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))), words, pa.array(cols[5], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column(id_col), part.column("train"), *more], names)

    id_type = rows.schema[id_col].dataType.simpleString()
    schema = f"row long, `{id_col}` {id_type}, train boolean, n_tokens long, n_known long, base double, score double, words array<string>, numbers array<long>"
    split = materialise(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, schema), "lm-documents")
    rest = split.select("row", F.explode(F.arrays_zip("words", "numbers")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.numbers").alias("k"))
    met = rest.join(scored.hint("merge"), "word").select(
        "row", F.when(F.col("n") > 0, F.col("k")).otherwise(0).alias("n_known"), (F.col("k") * (F.log10(F.col("n") + 1) - below)).alias("base"),
        (F.col("k") * F.col("score")).alias("score"), *[F.lit(None).cast(t).alias(c) for c, t in ((id_col, id_type), ("train", "boolean"), ("n_tokens", "long"))],
    )
    both = split.drop("words", "numbers").unionByName(met)
    # a document's own row and its rare words meet by the row's number; only the own row has the other columns
    return (
        both.groupBy("row")
        .agg(*[F.max(c).alias(c) for c in (id_col, "train", "n_tokens")], F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
        .select(id_col, "train", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")
    )
