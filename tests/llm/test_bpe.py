import hashlib
import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from innkeeper.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", "  \n", "a", "Hello, WORLD's 123!", "aaaaaaaaaaaaaaaa", "x<|endoftext|>y<|startoftext|>", "<|ENDOFTEXT|>", "ΑΣ ΣΑΣ. İ ẞ",
    "é Å 가", "🙂🙂 é b", "abᲉx ՘r", "don't we'll", "z" * 5000, "word " * 3000,
]


def reference(text, tokenizer):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_ids_and_texts_as_the_library(make_docs):
    rnd = random.Random(3)
    noise = ["".join(rnd.choice("aabbcdeß é'strve \n\t01Σ..-_<|>") for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    texts = TEXTS + noise
    tokenizer = Tokenizer.from_file(PATH)
    rows = bpe.round_trip_digests(make_docs(list(enumerate(texts))), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, decoded = reference(texts[r.doc_id], tokenizer)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_documents_keep_their_columns(make_docs):
    docs = make_docs([(1, "ab cd"), (1, "ab cd"), (None, None)]).withColumn("token_ids", F.lit("clash"))
    encoded = bpe.encode_documents(docs, PATH)
    assert encoded.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids"]
    decoded = bpe.decode_documents(encoded, PATH)
    tokenizer = Tokenizer.from_file(PATH)
    for r in decoded.collect():
        assert (r.token_ids, r.decoded) == reference(r.text, tokenizer)


def test_pieces_of_a_long_text_are_encoded_alike(monkeypatch):
    codec, text = bpe.WordBpe(PATH), "some words, and\nmore of them " * 40 + "q" * 300 + " end"
    whole, _ = codec.encode_batch([text, "", text])
    for limit in (7, 64, 1000):
        monkeypatch.setattr(bpe, "CHUNK_BYTES", limit)
        monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
        ids, counts = codec.encode_batch([text, "", text])
        assert (ids == whole).all() and counts.tolist() == [len(whole) // 2, 0, len(whole) // 2]
    assert "".join(bpe.pieces(text, 50)) == text


def test_empty_batches(make_docs):
    codec = bpe.WordBpe(PATH)
    assert [x.tolist() for x in codec.encode_batch([])] == [[], []]
    assert codec.decode_batch(np.empty(0, np.int64), np.zeros(2, np.int64)) == ["", ""]
    assert bpe.round_trip_digests(make_docs([]), PATH).collect() == []
