"""Chat formatting by token-level assembly (operator 5).

Every turn is a few segments, each encoded on its own: the reserved id that opens a turn, the role, a
line end, the content, the reserved id that closes it, a line end.  Contents are encoded as ordinary
text, so a reserved id never comes from them; control strings in them are also escaped, so that the
formatted text can be taken apart again.  Loss masks are prefix sums over +1/-1 marks at the ends of the
trained contents.

Turns are range-partitioned by (conversation, turn) and laid out in chunks of at most
``chunk_tokens``; a conversation with any number of turns is spread over tasks and rows, and its
chunks in ``chunk`` order are the formatted conversation.  A chunk holds whole turns.

Escaping: ``<``, any backslashes, ``|`` gets one more backslash, which is undone without
loss; in roles, backslashes and line ends are escaped as well.

Defined results: NULL roles and texts are empty; turns are ordered by turn (NULL first), then role and
text, and repeated rows stay; a NULL conv_id is a conversation of its own; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeeper.llm.common import byte_chunks, materialise

# The control strings of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"
CHUNK_TOKENS = 20_000
CHUNK_BYTES = 2 << 20

_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_ROLE_UNESCAPE = re.compile(r"\\(.)")

CHUNK_SCHEMA = "conv_id long, chunk long, n_turns int, token_ids array<int>, loss_mask array<boolean>"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE_UNESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class ChatCodec:
    """The vocabulary with two reserved ids behind its last one."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.plain = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.open, self.close = len(ranks) + 1, len(ranks) + 2
        self.line = self.plain.encode_ordinary("\n")

    def encode(self, text: str) -> list[int]:
        return self.plain.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        """Formatted text of ids, control strings included; a run of ordinary ids is whole text."""
        out, start = [], 0
        for i, x in enumerate(ids):
            if x in (self.open, self.close):
                out += [self.plain.decode(ids[start:i]), OPEN if x == self.open else CLOSE]
                start = i + 1
        return "".join([*out, self.plain.decode(ids[start:])])


_LOADED: dict[tuple[str, str], ChatCodec] = {}


def load(path: str, pattern: str) -> ChatCodec:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ChatCodec(path, pattern)
    return _LOADED[path, pattern]


def encode_turns(turns: DataFrame, path: str, pattern: str) -> DataFrame:
    """``conv_id, turn, role, text`` with the ids of both segments, turn by turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path, pattern)
        for whole in batches:
            for part in byte_chunks(whole, "text", CHUNK_BYTES):
                roles = [codec.encode(escape_role(r)) for r in part.column("role").to_pylist()]
                texts = [codec.encode(escape(t)) for t in part.column("text").to_pylist()]
                ids = [pa.array(x, pa.list_(pa.int32())) for x in (roles, texts)]
                yield pa.RecordBatch.from_arrays([*part.columns, *ids], [*part.schema.names, "role_ids", "text_ids"])

    empty = F.lit("")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, role_ids array<int>, text_ids array<int>")


def format_conversations(
    turns: DataFrame, path: str, pattern: str, trained_role: str = TRAINED_ROLE, chunk_tokens: int = CHUNK_TOKENS
) -> DataFrame:
    """Formatted conversations as chunks ``conv_id, chunk, n_turns, token_ids, loss_mask``."""
    order = ["conv_id", "turn", "role", "text"]
    # written first: the range boundaries are sampled, and both passes must see the same rows
    encoded = materialise(encode_turns(turns, path, pattern), "chat-turns")
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    laid = encoded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    laid = laid.select("conv_id", (F.col("role") == trained_role).alias("trained"), "role_ids", "text_ids", F.spark_partition_id().alias("part"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path, pattern)
        done, held, tokens, serial, owner, part = [], [], 0, 0, object(), 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "trained", "role_ids", "text_ids", "part")]
            for conv, trained, role, text, part in zip(*columns, strict=True):
                size = len(role) + len(text) + 2 + 2 * len(codec.line)
                if held and (conv != owner or tokens + size > chunk_tokens):
                    done.append(chunk(codec, owner, part, serial, held))
                    held, tokens, serial = [], 0, serial + 1
                    if len(done) >= 256:
                        yield pa.RecordBatch.from_pylist(done, SCHEMA)
                        done = []
                owner, tokens = conv, tokens + size
                held.append((trained, role, text))
        if held:
            done.append(chunk(codec, owner, part, serial, held))
        if done:
            yield pa.RecordBatch.from_pylist(done, SCHEMA)

    def chunk(codec: ChatCodec, conv, part: int, serial: int, held: list) -> dict:
        pieces, starts, ends, at = [], [], [], 0
        for trained, role, text in held:
            head = [codec.open, *role, *codec.line]
            pieces += [head, text, [codec.close, *codec.line]]
            if trained:
                starts.append(at + len(head))
                ends.append(at + len(head) + len(text))
            at += len(head) + len(text) + 1 + len(codec.line)
        marks = np.zeros(at + 1, np.int32)
        np.add.at(marks, starts, 1)
        np.add.at(marks, ends, -1)
        return {
            "conv_id": conv, "chunk": (part << 32) + serial, "n_turns": len(held),
            "token_ids": np.concatenate([np.asarray(p, np.int32) for p in pieces]), "loss_mask": np.cumsum(marks[:-1]) > 0,
        }

    SCHEMA = pa.schema(
        [("conv_id", pa.int64()), ("chunk", pa.int64()), ("n_turns", pa.int32()), ("token_ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_()))]
    )
    return laid.mapInArrow(assemble, CHUNK_SCHEMA)


def parse(codec: ChatCodec, ids: np.ndarray, mask: np.ndarray) -> Iterator[tuple[str, str, str, int]]:
    """Turns read back from a chunk: role, text, the text under the loss mask, formatted length."""
    opens = np.flatnonzero(ids == codec.open)
    closes = np.flatnonzero(ids == codec.close)
    ends = np.r_[opens[1:], len(ids)]
    for start, close, end in zip(opens.tolist(), closes.tolist(), ends.tolist(), strict=True):
        body = codec.plain.decode(ids[start + 1 : close].tolist())
        role, _, content = body.partition("\n")
        under = mask[start:end]
        loss = unescape(codec.plain.decode(ids[start:end][under].tolist())) if under.any() else ""
        yield unescape_role(role), unescape(content), loss, len(codec.decode(ids[start:end].tolist()))


def conversation_digests(chunks: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per conversation, read back from its chunks: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars``.  Chunks of a conversation are streamed in order through a running
    digest, which is sequential by nature; nothing of the conversation is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path, pattern)
        owner, state, done = object(), None, []
        for batch in batches:
            for i in range(batch.num_rows):
                conv = batch.column("conv_id")[i].as_py()
                if state is None or conv != owner:
                    if state is not None:
                        done.append(finished(owner, state))
                    owner, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.asarray(batch.column("token_ids")[i].values)
                mask = np.asarray(batch.column("loss_mask")[i].values)
                for role, text, loss, length in parse(codec, ids, mask):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                    state[4] += length
            if len(done) >= 1024:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(done, columns=names), preserve_index=False, schema=schema)
                done = []
        if state is not None:
            done.append(finished(owner, state))
        if done:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(done, columns=names), preserve_index=False, schema=schema)

    def finished(owner, state: list) -> tuple:
        return owner, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    return (
        chunks.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
        .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    )
