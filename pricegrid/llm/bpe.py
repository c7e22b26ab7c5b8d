"""Byte-level BPE by prefix dynamic programming.

Fact used: a token sequence is what BPE makes of its bytes exactly when every two
neighbours are what BPE makes of theirs. So each byte prefix has one valid last
token: of the tokens that end the prefix, the one whose neighbour (the last token of
the prefix before it) accepts it. ``Bpe.last`` stores that token for each prefix
seen. Appending a byte looks only at tokens that end there; words that share a
prefix share its work; walking back from the end gives the ids. ``Document``
keeps the ids per match of the pattern and re-encodes only the matches next to an
edit.

Whether two tokens may stand side by side is found by merging their bytes by rank,
once for each pair. A match that is itself a token is that token, as in tiktoken.

Both tables are memos of a pure function, cleared when they outgrow ``MEMO``
entries, so memory is bounded whatever the text; long matches are walked in one
pass with a list as long as the match.

Edge cases: null text is empty (no ids, the digest of no bytes); white space and
texts of one very long match take the same path; repeated rows are encoded each;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMO = 500_000
LONG = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken rank file: base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Bpe:
    """Encoder and decoder for one rank table and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.longest = max(map(len, ranks))
        self.memo = memo
        self.last: dict[bytes, int] = {}  # prefix of a match: its valid last token
        self.fits: dict[tuple[int, int], bool] = {}
        self.packed: dict[str, bytes] = {}  # match: its ids as little-endian uint32
        self._ends()

    def _ends(self) -> None:
        """By last three bytes of a token: the lengths tokens with that end have."""
        found: dict[bytes, set[int]] = {}
        for t in self.ranks:
            found.setdefault(t[-3:], set()).add(len(t))
        self.lengths = {end: sorted(n | ({2} if end[1:] in self.ranks else set()), reverse=True) for end, n in found.items()}

    def _whole(self, piece: bytes, cut: int = 0) -> bool:
        """Whether BPE by its definition (merge the leftmost pair of lowest rank until
        none is left) makes one token of piece; with a cut, whether it makes one token
        of each side and never merges across."""
        get, none = self.ranks.get, 1 << 31
        parts = [piece[i:i + 1] for i in range(len(piece))]
        found = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while found and (rank := min(found)) < none:
            i = found.index(rank)
            if i + 1 == cut:
                return False
            cut -= i + 1 < cut
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i:
                found[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(found):
                found[i] = get(parts[i] + parts[i + 1], none)
        return len(parts) == 1 + (cut > 0)

    def _fits(self, a: int, b: int) -> bool:
        """Whether b may follow a, itself a valid token; a is -1 at the start of a match."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > 2 * self.memo:
                self.fits.clear()
            if a < 0:
                known = self._whole(self.bytes[b])
            else:
                known = self._fits(-1, b) and self._whole(self.bytes[a] + self.bytes[b], len(self.bytes[a]))
            self.fits[a, b] = known
        return known

    def _last(self, piece: bytes, end: int, before: Callable[[int], int]) -> int:
        """The valid last token of piece[:end]; before(i) is that of piece[:i], -1 at 0."""
        ranks, fits = self.ranks, self.fits
        if end > 1:
            for n in self.lengths.get(piece[max(0, end - 3):end], (2,)):
                if n <= end and (token := ranks.get(piece[end - n:end])) is not None:
                    pair = before(end - n), token
                    ok = fits.get(pair)
                    if ok or ok is None and self._fits(*pair):
                        return token
        return ranks[piece[end - 1:end]]

    def encode_match(self, piece: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        tokens: list[int] = []
        if len(piece) > LONG:
            last = [-1]
            for end in range(1, len(piece) + 1):
                last.append(self._last(piece, end, last.__getitem__))
            end = len(piece)
            while end:
                tokens.append(last[end])
                end -= len(self.bytes[last[end]])
            return tokens[::-1]
        memo = self.last
        if len(memo) > self.memo:
            memo.clear()
        end = len(piece)
        while end and piece[:end] not in memo:  # the longest prefix already known
            end -= 1
        before = lambda i: memo[piece[:i]] if i else -1
        for end in range(end + 1, len(piece) + 1):
            memo[piece[:end]] = self._last(piece, end, before)
        end = len(piece)
        while end:
            token = memo[piece[:end]]
            tokens.append(token)
            end -= len(self.bytes[token])
        return tokens[::-1]

    def packed_match(self, match: str) -> bytes:
        found = self.encode_match(match.encode())
        ids = pack(f"<{len(found)}I", *found)
        if len(match) <= LONG:
            if len(self.packed) > self.memo:
                self.packed.clear()
            self.packed[match] = ids
        return ids

    def packed_text(self, text: str) -> bytes:
        """The text's ids as little-endian uint32."""
        get, make = self.packed.get, self.packed_match
        return b"".join([get(m) or make(m) for m in self.pattern.findall(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed_text(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Document:
    """A text with its ids that follows edits: only matches that an edit changes
    are encoded again."""

    def __init__(self, bpe: Bpe, text: str = ""):
        self.bpe, self.matches, self.ids = bpe, [], []
        self.replace(0, 0, text)

    @property
    def text(self) -> str:
        return "".join(self.matches)

    def tokens(self) -> list[int]:
        return [t for ids in self.ids for t in ids]

    def append(self, text: str) -> None:
        n = sum(map(len, self.matches))
        self.replace(n, n, text)

    def replace(self, start: int, end: int, new: str) -> int:
        """Replace text[start:end]; returns how many matches were encoded anew.
        Matches that begin alike before and after the edit keep their ids."""
        old = self.text
        text = old[:start] + new + old[end:]
        kept = at = 0
        while kept < len(self.matches) and at + len(self.matches[kept]) < start:
            at += len(self.matches[kept])
            kept += 1
        kept = max(0, kept - 1)  # white space before an edit may be split otherwise
        at = sum(map(len, self.matches[:kept]))
        ends, where = {}, len(text)
        for i in range(len(self.matches) - 1, kept - 1, -1):  # places from which the old matches go on alike
            where -= len(self.matches[i])
            if where < start + len(new):
                break
            ends[where] = i
        fresh: list[str] = []
        tail = len(self.matches)
        for m in self.bpe.pattern.finditer(text, at):
            if m.start() in ends and m.start() > start + len(new):
                tail = ends[m.start()]
                break
            fresh.append(m[0])
        self.ids[kept:tail] = [self.bpe.encode_match(m.encode()) for m in fresh]
        self.matches[kept:tail] = fresh
        return len(fresh)


@cache
def load(path: str, pattern: str) -> Bpe:
    """One encoder for each worker process."""
    return Bpe(read_ranks(path), pattern)


def _digests(path: str, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = bpe.packed_text(text.as_py() or "")
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(np.frombuffer(ids, "<u4").tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, the number of ids, sha256 of the ids (little-endian
    uint32) and of the bytes that decoding them gives back."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_digests(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as an array<int> column."""
    @F.pandas_udf("array<int>")
    def encoded(texts):
        bpe = load(path, pattern)
        return texts.map(lambda t: np.frombuffer(bpe.packed_text(t or ""), "<u4").astype(np.int32))

    return docs.withColumn(ids, encoded(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``rows`` with the bytes that an array<int> column of ids stands for."""
    @F.pandas_udf("binary")
    def decoded(column):
        bpe = load(path, pattern)
        return column.map(lambda found: bpe.decode([] if found is None else list(found)))

    return rows.withColumn(out, decoded(F.col(ids)))
