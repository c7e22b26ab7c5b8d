import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from pricegrid.llm import packing as X

PATH = P.path("byte_bpe_50k.tiktoken")


def test_hilbert_curve_visits_each_cell_once_and_steps_by_one():
    for dims, bits in ((2, 4), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = X.hilbert(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_neighbours_on_the_curve():
    ids = np.concatenate([np.arange(100), np.arange(100), np.arange(100), np.arange(20_000, 20_100)])
    a, b, c, d = X.curve_keys(ids, np.array([0, 100, 200, 300]), 50_257)
    assert a == b == c != d


def test_pieces_hold_every_id_once(docs, writing):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = [(i, writing(1 + i * 7 % 300, i)) for i in range(60)] + [(100, None), (101, ""), (102, "é🙂<|endoftext|>"), (103, writing(6000, 1)), (104, "z" * 50_000)]
    found = X.pieces(docs(rows).repartition(3), PATH, P.PATTERN).collect()
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
    for spans, total in [(sorted(v), len(ids[k])) for k, v in by_doc.items()] + [(sorted(v), None) for v in by_sequence.values()]:
        ends = np.cumsum([n for _, n in spans])
        assert [a for a, _ in spans] == [0, *ends[:-1]] and all(n > 0 for _, n in spans)
        assert total is None or ends[-1] == total
        if total is None:
            assert ends[-1] <= X.LENGTH and ends[-1] & (ends[-1] - 1) == 0  # full, or a power of two
    assert set(by_doc) == set(ids)


def test_added_tokens_as_the_contract_loads_them(docs):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>\n\n y<|endoftext|", "<|ENDOFTEXT|> plain", "é <|endoftext|>'s"]
    special = X.added_tokens(P.path("byte_bpe_50k.json"))
    found = {r.doc_id: r for r in X.pieces(docs(list(enumerate(texts))).coalesce(1), PATH, P.PATTERN, special=special, length=1 << 20).where("start = 0").collect()}
    ids = {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4") for i, t in enumerate(texts)}
    assert ids[0].tolist() == [64, 220, 50256, 275, 0]
    assert all(found[i].doc_tokens == len(ids[i]) for i in ids)
    assert all(found[i].ids_crc32 == zlib.crc32(ids[i][:found[i].length].tobytes()) for i in ids)


def test_repeated_rows_and_empty_table(docs):
    found = X.pieces(docs([(1, "a b")] * 3 + [(None, "x")]), PATH, P.PATTERN)
    assert sorted(r.doc_tokens for r in found.where("start = 0").collect()) == [2, 3, 3, 3]
    assert X.pieces(docs([]), PATH, P.PATTERN).count() == 0
