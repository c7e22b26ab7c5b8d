"""Alignment of two tokenizers' tokens by the bytes they end at.

Tokenizer A (a ``tokenizers`` file of a byte-level BPE) encodes space+text, tokenizer B
(a ``sentencepiece`` model) encodes the text and adds that space itself. Byte offsets at
which a token of A and one of B both end cut a document's tokens into groups; the two
tokens that end there are linked.

Where a token ends is taken from the libraries' spans as coarse cuts: character offsets
of A, byte spans of the immutable proto of B. Where a span isn't as long as the token's
decoded bytes (several tokens inside one multibyte character, byte fallback), the
decoded bytes refine it. A text whose joined bytes of A or B differ from space+text has
no tokens.

Texts are encoded in *stretches*: space+text is cut before white space that follows
another character (but a last space) and before an ASCII mark, apart from the
apostrophe, that follows a Latin letter. Neither tokenizer joins anything across such a
place: A's pattern has a boundary there whatever surrounds it, and marks and white space
that some piece of B has after a letter don't cut (read from the model). So the tokens
are those of the whole text, and a stretch that comes again is encoded once (about
``CACHED`` are remembered, then all are forgotten).

Link counts over the corpus:

1. Tasks align their documents and write rows whose links are coded by a dictionary of
   the *chunk* (about ``CHUNK`` links of neighbouring documents; a longer document is
   split over chunks), and a row of that dictionary.
2. Dictionaries, not links, are exchanged: they are summed by pair, the highest count of
   a B id is a window over at most |A's vocabulary| pairs, and the counts are joined back
   to the dictionaries.
3. Each chunk's rows and counts meet by chunk number and are summed up by document.

Edge cases: null and empty texts have no tokens (zeros, digest ''); special tokens'
strings are plain text; rows that repeat a doc_id are separate documents; ids can be
null; extra columns are ignored; an empty table gives an empty result. A very long text
is encoded stretch by stretch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricegrid.llm import words as W
from pricegrid.session import cut_lineage

CHUNK = 1 << 21
CACHED = 400_000
_LETTER = "[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")

Batches = Iterator[pa.RecordBatch]


@cache
def _byte_letters() -> dict[str, int]:
    """The letter that byte-level BPE vocabularies write for each byte: printable Latin-1
    bytes stand for themselves, the others for U+0100 and up in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers and the stretches they have encoded. Each remembered stretch has
    its numbers of tokens (``n_a << 32 | n_b``), its groups as text with a ``;`` before
    each, their byte ends in it and its links (``a << 32 | b``)."""

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters, added = _byte_letters(), self.a.get_added_tokens_decoder()
        a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            a_bytes[i] = token.encode() if i in added else bytes(letters[c] for c in token)
        b_bytes, joined = [], set()  # the pairs of neighbouring characters inside B's pieces
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE.fullmatch(piece)
            b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
            joined |= set() if byte else {(x, y) for x, y in zip(piece, piece[1:]) if (x, y) != ("▁", "▁")}
        if any(y == "▁" for _, y in joined):
            raise ValueError("a piece of the second tokenizer joins words")
        white = "".join(c for c in "\t\n\v\f\r" if not any(y == c for _, y in joined))
        after = {y for x, y in joined if re.match(_LETTER, x)}
        marks = "".join(re.escape(c) for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'" and c not in after)
        self.cut = re.compile(rf"(?<=\S)(?= .|[{white}])" + (rf"|(?<={_LETTER})(?=[{marks}])" if marks else ""), re.S)
        self.bytes = a_bytes, b_bytes
        self.sizes = tuple(np.array([len(x) for x in side], np.int64) for side in self.bytes)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.n: list[int] = []
        self.groups: list[bytes | None] = []  # None: not the stretch's bytes
        self.ends: list[bytes] = []
        self.links: list[bytes] = []
        self.wrong: set[int] = set()

    def learn(self, stretches: list[str]) -> None:
        """Encodes the stretches, many in one text; one that ends in white space is a
        text of its own, as it would be joined with the space that follows."""
        together = [s for s in stretches if not s[-1].isspace()]
        for start in range(0, len(together), 4096):
            self._learn(together[start:start + 4096])
        for stretch in stretches:
            if stretch[-1].isspace():
                self._learn([stretch])

    def _learn(self, stretches: list[str]) -> None:
        # a stretch without a space goes on after a letter, which is a unit of its own
        units = [u for s in stretches for u in ((s,) if s[0] == " " else (" a", s))]
        own = np.array([k for s in stretches for k in ((True,) if s[0] == " " else (False, True))])
        text = "".join(units)
        raw = text.encode()
        chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
        byte_at = np.concatenate([[0], np.cumsum(1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF))])
        last = byte_at[np.cumsum([len(u) for u in units])]  # where each unit ends
        start = np.concatenate([[0], last[:-1]])
        a = self.a.encode(text, add_special_tokens=False)
        found = [(p.id, p.end) for p in self.b.encode(text[1:], return_type="proto", num_threads=1).pieces]
        b_ids, b_ends = np.array(found, np.int64).reshape(-1, 2).T
        ids = np.array(a.ids, np.int64), b_ids
        coarse = byte_at[np.array([end for _, end in a.offsets], np.int64)], b_ends + 1
        of = [np.minimum(np.searchsorted(last, c), len(last) - 1) for c in coarse]  # the unit of each token
        right = np.ones(len(units), bool)
        for side in (0, 1):
            if b"".join([self.bytes[side][i] for i in ids[side].tolist()]) != raw:
                cut = np.searchsorted(of[side], np.arange(len(units) + 1)).tolist()
                for k in range(len(units)):
                    right[k] &= b"".join([self.bytes[side][i] for i in ids[side][cut[k]:cut[k + 1]].tolist()]) == raw[start[k]:last[k]]
        if not right.all():
            wrong = {u for u, r in zip(units, right) if not r}
            if others := [s for s in stretches if s not in wrong]:
                self._learn(others)
            if len(stretches) > 1:  # alone, one that only stood beside a wrong one comes out right
                for s in wrong.intersection(stretches):
                    self._learn([s])
            return
        ends = [_refined(*x, start) for x in zip(coarse, of, (n[i] for n, i in zip(self.sizes, ids)))]
        common = [_among(x, y) for x, y in (ends, ends[::-1])]
        written, sizes = _written(ids, common)
        n = len(units)
        text_at = np.concatenate([[0], np.cumsum(np.bincount(np.concatenate(of), sizes, n))]).astype(np.int64)
        unit = of[0][common[0]]
        links = (ids[0][common[0]] << 32 | ids[1][common[1]]).tobytes()
        at = (ends[0][common[0]] - start[unit]).tobytes()
        cut_at = 8 * np.concatenate([[0], np.cumsum(np.bincount(unit, minlength=n))])
        counts = np.bincount(of[0], minlength=n) << 32 | np.bincount(of[1], minlength=n)
        own = np.flatnonzero(own)
        for s, c, x, y, i, j in zip(stretches, counts[own].tolist(), text_at[own].tolist(), text_at[own + 1].tolist(),
                                    cut_at[own].tolist(), cut_at[own + 1].tolist()):
            k = self.number[s]
            self.n[k], self.groups[k], self.ends[k], self.links[k] = c, written[x:y], at[i:j], links[i:j]

    def documents(self, texts: list[str | None]) -> list[list[int]]:
        """For each text the numbers of its stretches, in order; empty without tokens."""
        if len(self.n) > CACHED:
            self.forget()
        number, known = self.number, len(self.number)
        found = [[number.setdefault(s, len(number)) for s in self.cut.split(" " + t)] if t else [] for t in texts]
        if len(number) > known:
            new = list(islice(number, known, None))
            for kept, nothing in ((self.n, 0), (self.groups, None), (self.ends, b""), (self.links, b"")):
                kept.extend([nothing] * len(new))
            self.learn(new)
            self.wrong.update(i for i in range(known, len(number)) if self.groups[i] is None)
        return [n if not self.wrong or self.wrong.isdisjoint(n) else [] for n in found]

    def written(self, numbers: list[int]) -> bytes:
        return b"".join([self.groups[i] for i in numbers])[1:]

    def counts(self, numbers: list[int]) -> tuple[int, int]:
        n = sum([self.n[i] for i in numbers])
        return n >> 32, n & 0xFFFFFFFF


def _refined(coarse: np.ndarray, of: np.ndarray, sizes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: the library's, where the span is as long as the decoded token;
    otherwise counted from the start of the unit in decoded bytes."""
    total = np.cumsum(sizes)
    before = np.concatenate([[0], total])[np.searchsorted(of, np.arange(len(start)))]
    return np.where(np.diff(coarse, prepend=0) == sizes, coarse, start[of] + total - before[of])


def _among(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the ascending ``x`` are in the ascending ``y``."""
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def _written(ids: tuple[np.ndarray, np.ndarray], common: list[np.ndarray]) -> tuple[bytes, np.ndarray]:
    """The groups of all tokens as one text, and how much of it each token takes (A's
    tokens, then B's): a mark and the decimal id."""
    group = [np.cumsum(c) - c for c in common]  # number of the group that each token is in
    first = [np.concatenate([[True], g[1:] != g[:-1]]) for g in group]
    mark = np.concatenate([np.where(f, ord(m), ord(",")) for f, m in zip(first, ";|")])
    place = np.concatenate([g * 2 + side for side, g in enumerate(group)])
    order = np.argsort(place, kind="stable")
    both = np.concatenate(ids)
    powers = 10 ** np.arange(len(str(int(both.max()))) - 1, -1, -1)
    digits = both[order, None] // powers
    letters = np.concatenate([mark[order, None], digits % 10 + ord("0")], axis=1).astype(np.uint8)
    used = np.concatenate([np.ones((len(both), 1), bool), (digits > 0) | (powers == 1)], axis=1)
    sizes = np.empty(len(both), np.int64)
    sizes[order] = used.sum(axis=1)
    return letters[used].tobytes(), sizes


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, groups (``a1,a2|b1;a3|b2,b3``: ids of A and B) and ends (byte
    offsets in space+text at which the groups end) of every document."""
    def run(batches: Batches) -> Batches:
        tool = aligner(a_path, b_path)
        for whole in batches:
            for batch in W.slices(whole, 1, 1 << 20):
                n_a, n_b, groups, ends = [], [], [], []
                for numbers in tool.documents(batch.column(1).to_pylist()):
                    start, at = 0, []
                    for i in numbers:
                        at.extend((np.frombuffer(tool.ends[i], np.int64) + start).tolist())
                        start = at[-1]
                    n = tool.counts(numbers)
                    n_a.append(n[0])
                    n_b.append(n[1])
                    groups.append(tool.written(numbers).decode())
                    ends.append(at)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(groups, pa.string()),
                                                  pa.array(ends, pa.list_(pa.int64()))], ["doc_id", "n_a", "n_b", "groups", "ends"])
    return _rows(docs, doc_id, text).mapInArrow(run, "doc_id long, n_a long, n_b long, groups string, ends array<long>")


_CODED = "kind int, chunk long, rid long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, codes binary, pairs array<long>, times array<long>"
_CODED_TYPES = [pa.int32(), *[pa.int64()] * 6, pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def _coded(a_path: str, b_path: str, size: int) -> Callable[[Batches], Batches]:
    """(doc_id, text) to rows of documents (kind 0) and of the chunks' dictionaries (kind 1)."""
    def run(batches: Batches) -> Batches:
        tool, task = aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        chunk = rid = task
        held: list[tuple] = []  # rid, doc_id, n_a, n_b, n_groups, digest, links
        links_held = 0

        def closed() -> pa.RecordBatch:
            nonlocal chunk, held, links_held
            coded = pa.array(np.concatenate([h[-1] for h in held])).dictionary_encode()
            codes, pairs = coded.indices.to_numpy().astype("<u4"), coded.dictionary.to_pylist()
            ends = np.cumsum([len(h[-1]) for h in held])
            rows = [(0, chunk, *h[:-1], c.tobytes(), None, None) for h, c in zip(held, np.split(codes, ends[:-1]))]
            if pairs:
                rows.append((1, chunk, *[None] * 7, pairs, np.bincount(codes, minlength=len(pairs)).tolist()))
            chunk, held, links_held = chunk + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _CODED_TYPES)],
                                              [f.split()[0] for f in _CODED.split(", ")])

        for whole in batches:
            for batch in W.slices(whole, 1, 1 << 20):
                for doc, numbers in zip(batch.column(0).to_pylist(), tool.documents(batch.column(1).to_pylist())):
                    links, digest = np.empty(0, np.int64), ""
                    if numbers:
                        links = np.frombuffer(b"".join([tool.links[i] for i in numbers]), np.int64)
                        digest = hashlib.sha256(tool.written(numbers)).hexdigest()
                    counts = tool.counts(numbers)
                    for start in range(0, max(1, len(links)), size):  # a very long document goes on in further chunks
                        part = links[start:start + size]
                        held.append((rid, doc, *(counts if not start else (0, 0)), len(part), digest, part))
                        links_held += len(part)
                        if links_held >= size:
                            yield closed()
                    rid += 1
        if held:
            yield closed()
    return run


def _weighed(counts: pa.Table, rows: pa.Table) -> pa.Table:
    """Rows of one chunk with n_best and count_sum from the counts of its dictionary."""
    n, best = (np.zeros(counts.num_rows, np.int64) for _ in range(2))
    n[counts["pos"].to_numpy()] = counts["n"].to_numpy()
    best[counts["pos"].to_numpy()] = counts["best"].to_numpy()
    sums = []
    for raw in rows["codes"]:
        codes = np.frombuffer(raw.as_buffer(), "<u4")
        sums.append((best[codes].sum(), n[codes].sum()))
    n_best, count_sum = (pa.array([int(s[i]) for s in sums], pa.int64()) for i in (0, 1))
    kept = rows.select(["rid", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])
    return kept.append_column("n_best", n_best).append_column("count_sum", count_sum)


def _tables(docs: DataFrame, a_path: str, b_path: str, doc_id: str, text: str, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The written rows, the dictionaries (chunk, pos, pair, times) and the counts (pair, n, best)."""
    coded = cut_lineage(_rows(docs, doc_id, text).mapInArrow(_coded(a_path, b_path, size), _CODED), "aligned")
    parts = (coded.where("kind = 1").select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("pos", "x"))
             .select("chunk", "pos", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")))
    summed = parts.groupBy("pair").agg(F.sum("times").alias("n"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    counts = cut_lineage(summed.withColumn("best", (F.col("n") == F.max("n").over(of_b)).cast("int")), "links")
    return coded, parts, counts


def pair_counts(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", size: int = CHUNK) -> DataFrame:
    """(a_id, b_id, n, best): how many links of the corpus hold each pair of ids, and
    whether that is the highest count of its B id."""
    _, _, counts = _tables(docs, a_path, b_path, doc_id, text, size)
    return counts.select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id"),
                         "n", (F.col("best") == 1).alias("best"))


def digests(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", size: int = CHUNK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    coded, parts, counts = _tables(docs, a_path, b_path, doc_id, text, size)
    of_chunk = parts.select("chunk", "pos", "pair").join(counts, "pair").select("chunk", "pos", "n", "best")
    kept = ["chunk", "rid", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "codes"]
    rows = coded.where("kind = 0").select(*kept).toDF(*kept)  # columns apart from those of ``of_chunk``
    weighed = of_chunk.groupBy("chunk").cogroup(rows.groupBy("chunk")).applyInArrow(
        _weighed, "rid long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long")
    total = {c: F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_best", "count_sum")}
    found = weighed.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), *total.values(), F.max("groups_sha256").alias("groups_sha256"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
