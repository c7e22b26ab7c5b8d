import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from pricegrid.llm import bpe as X

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    b = X.load(PATH, P.PATTERN)
    return b, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=b.ranks, special_tokens={})


PARTS = ["a", "the", " ", "  ", "\n", "é", "漢", "🙂", "1", "23", "'s", "!", "###", "\x00", "ing", "er", "ñ", " un", "\t", "ſ", "<|endoftext|>"]


def text_of(rng):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))


def test_encode_and_decode_as_the_library(both):
    b, enc = both
    rng = random.Random(1)
    for text in [text_of(rng) for _ in range(1500)] + ["ab" * 20_000, "é" * 3000, " " * 5000, ""]:
        ids = b.encode(text)
        assert ids == enc.encode_ordinary(text)
        assert b.decode(ids) == text.encode()


def test_memos_that_overflow_change_nothing(both):
    _, enc = both
    small, rng = X.Bpe(X.read_ranks(PATH), P.PATTERN, memo=50), random.Random(2)
    for text in [text_of(rng) for _ in range(200)]:
        assert small.encode(text) == enc.encode_ordinary(text)


def test_edits_and_appends(both):
    b, enc = both
    rng = random.Random(3)
    for _ in range(300):
        text = text_of(rng)
        doc = X.Document(b, text)
        for _ in range(3):
            i = rng.randint(0, len(text))
            j, new = rng.randint(i, min(len(text), i + 6)), text_of(rng)[:4]
            doc.replace(i, j, new)
            text = text[:i] + new + text[j:]
            doc.append("ing s")
            text += "ing s"
            assert doc.text == text and doc.tokens() == enc.encode_ordinary(text)
    long = X.Document(b, "one two three " * 500)
    assert long.replace(3000, 3003, "abc") < 12  # only matches near the edit


def test_query_columns(docs, both):
    _, enc = both
    rows = [(1, "Hello the world's 12"), (2, None), (3, ""), (4, "x" * 100_000), (4, "again"), (None, "n")]
    found = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in X.digests(docs(rows), PATH, P.PATTERN).collect()}
    ids = [enc.encode_ordinary(t or "") for _, t in rows]
    assert found == {(i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for (i, t), x in zip(rows, ids)}
    assert X.digests(docs([]), PATH, P.PATTERN).count() == 0


def test_columns_there_and_back(docs):
    rows = [(1, "Hello the world"), (2, None), (3, "é\x00")]
    back = X.decode(X.encode(docs(rows), PATH, P.PATTERN), PATH, P.PATTERN)
    assert {r.doc_id: bytes(r.bytes) for r in back.collect()} == {i: (t or "").encode() for i, t in rows}
