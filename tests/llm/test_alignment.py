import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pricegrid.llm import alignment as L

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole():
    """Groups of a text, both tokenizers run over the whole of it: [(a ids, b ids)], None without tokens."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {v: k for k, v in L._byte_letters().items()}
    back = {v: k for k, v in letters.items()}

    def groups(text):
        if not text:
            return None
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_raw = [bytes(back[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in a_ids]
        pieces = [b.id_to_piece(i) for i in b_ids]
        b_raw = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, pieces)]
        raw = (" " + text).encode()
        if b"".join(a_raw) != raw or b"".join(b_raw) != raw:
            return None
        ends = lambda parts: [sum(map(len, parts[:i + 1])) for i in range(len(parts))]
        a_ends, b_ends, out = ends(a_raw), ends(b_raw), []
        a_from = b_from = 0
        for end in sorted(set(a_ends) & set(b_ends)):
            a_to, b_to = a_ends.index(end) + 1, b_ends.index(end) + 1
            out.append((a_ids[a_from:a_to], b_ids[b_from:b_to]))
            a_from, b_from = a_to, b_to
        return out
    return groups


def written(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups or [])


def brute(rows, whole):
    found = [(doc, whole(t) or []) for doc, t in rows]
    counts = Counter((a[-1], b[-1]) for _, gs in found for a, b in gs)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc, gs in found:
        links = [(a[-1], b[-1]) for a, b in gs]
        out.append((doc, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(written(gs).encode()).hexdigest() if gs else ""))
    return sorted(out, key=str), counts


ODD = ["Aé 日本 \U0001F600\U0001F469‍\U0001F469 \n x  y", "<s> </s> <|endoftext|> [INST]", " lead and trail ", "  ", " ", "\n \n  a\t b", "a\x00b \x1c c\x85 d  e　 f",
       "low▁line", "It's they'll 's 'S", "x" * 300, "é ́ ﬁ Å", "﻿ bom", "    z", "1234 5678,90", "\\u0000 ��", "\U0010FFFF͸", "a  b   c    d", "Ａ ｂ"]


def rows_of(writing):
    texts = [*ODD, None, "", writing(300, 1), writing(40, 2), writing(40, 2), "the", "the"]
    return [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(0, "again"), (0, "again")]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_digests_against_whole_texts(docs, writing, whole):
    rows = rows_of(writing)
    want, counts = brute(rows, whole)
    assert got(L.digests(docs(rows), A, B)) == want
    assert got(L.digests(docs(rows).repartition(5), A, B, size=16)) == want  # small chunks, long documents split over them
    found = {(r.a_id, r.b_id): r.n for r in L.pair_counts(docs(rows), A, B, size=64).collect()}
    assert found == counts


def test_align_gives_groups_and_their_ends(docs, writing, whole):
    rows = rows_of(writing)
    for r, (doc, text) in zip(sorted(L.align(docs(rows), A, B).collect(), key=lambda r: (str(r.doc_id), r.groups)),
                              sorted(rows, key=lambda x: (str(x[0]), written(whole(x[1]))))):
        groups = whole(text) or []
        assert (r.doc_id, r.groups, r.n_a) == (doc, written(groups), sum(len(a) for a, _ in groups))
        assert len(r.ends) == len(groups) and (not groups or r.ends[-1] == len((" " + text).encode()))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "a", "The", "é", "日", "\U0001F600", "\n", "\t", "\x1c", "\x85", " ", "'s", "_", "1", "▁", "<s>", "́", ".", ",", "(", "-", "\r\n", "ing"]), max_size=14).map("".join))
def test_stretches_are_tokens_of_the_whole_text(whole, text):
    tool = L.aligner(A, B)
    numbers, _ = tool.documents([text, None])
    assert tool.written(numbers).decode() == written(whole(text))


def test_forgetting_and_a_very_long_text(docs, whole, monkeypatch):
    monkeypatch.setattr(L, "CACHED", 3)
    tool = L.Aligner(A, B)
    for text in ("one two three", "four five", "six", "one"):
        assert tool.written(tool.documents([text])[0]).decode() == written(whole(text))
    r = L.digests(docs([(1, "of the é日 " * 100_000)]), A, B, size=1 << 16).first()
    assert r.n_groups > 300_000 and r.n_best == r.n_links


def test_empty_table(docs):
    assert L.digests(docs([]), A, B).count() == 0
    assert L.pair_counts(docs([]), A, B).count() == 0
