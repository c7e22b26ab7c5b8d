"""Packing token sequences along a Hilbert curve.

Each text is tokenized and closed by one end id. Its hashed token vector (every
token id has a fixed pseudo-random direction) is summed, projected to ``DIMS``
dimensions and reduced to its direction; the cell of that point on a Hilbert curve
of ``BITS`` bits per dimension is the document's key, so documents with like
vocabulary get nearby keys. The rows are range-partitioned and sorted by (key,
hash of doc_id), which also splits a key that many copies share, and each task
fills sequences of ``LENGTH`` ids in that order. A document is cut where a
sequence is full, so every sequence is full but for a task's last one; that rest
is cut into sequences whose lengths are powers of two, which need no padding.

The tokenized rows are one Parquet table in the shared checkpoint folder (16-bit
ids where the vocabulary allows), read by the range sampling and the packing; a
task holds one Arrow batch and one open sequence.

Added tokens of the vocabulary (``special``) are found in the text first, as by
``tokenizers``; without them such strings are ordinary text.

Edge cases: null or empty text is the end id alone; a very long text runs
through as many sequences as it needs; repeated rows are packed each; a null
doc_id is packed like any other; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.llm import words as W
from pricegrid.llm.bpe import read_ranks
from pricegrid.session import scratch_path

LENGTH = 1024
END_ID = 0
DIMS, BITS = 4, 12

Batches = Iterator[pa.RecordBatch]


Special = tuple[tuple[str, int], ...]


def added_tokens(path: str) -> Special:
    """The added tokens of a ``tokenizers`` file and their ids."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    for t in tokens:
        if any(t[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {t['content']!r} has a flag that tiktoken can't follow")
    return tuple((t["content"], t["id"]) for t in tokens)


@cache
def encoding(path: str, pattern: str, special: Special = ()) -> tiktoken.Encoding:
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens=dict(special))


@cache
def directions(vocabulary: int) -> np.ndarray:
    """A fixed point in [-1, 1)**DIMS for each token id."""
    cells = np.arange(vocabulary * DIMS, dtype=np.uint64).reshape(vocabulary, DIMS)
    return (W.mix(cells + np.uint64(5)) >> np.uint64(11)).astype(np.float64) / 2.0**52 - 1.0


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer cells (n, dims) along the Hilbert curve of ``bits`` bits per
    dimension: neighbours on the curve are neighbouring cells."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):  # undo the turns of the curve, coarse to fine
        low = (1 << b) - 1
        for i in range(dims):
            high = (x[i] >> b & 1).astype(bool)
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | x[i] >> b & 1
    return key


def curve_keys(ids: np.ndarray, starts: np.ndarray, vocabulary: int) -> np.ndarray:
    """Hilbert keys of documents whose ids begin at ``starts``; none is empty."""
    sums = np.add.reduceat(directions(vocabulary)[ids], starts, axis=0)
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)
    top = (1 << BITS) - 1
    return hilbert(np.rint((unit + 1) / 2 * top).astype(np.int64), BITS)


def _tokenized(path: str, pattern: str, special: Special, end_id: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        enc = encoding(path, pattern, special)
        kind = "<u2" if enc.n_vocab <= 1 << 16 else "<u4"
        for whole in batches:
            for batch in W.slices(whole, 1):
                found = [np.append(enc.encode_to_numpy(t.as_py() or "", allowed_special="all"), end_id).astype(kind) for t in batch.column(1)]
                starts = np.concatenate([[0], np.cumsum([len(f) for f in found])])[:-1]
                keys = curve_keys(np.concatenate(found), starts, enc.n_vocab)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys), pa.array([f.tobytes() for f in found], pa.binary())],
                                                 ["doc_id", "key", "ids"])
    return run


def _packed(length: int, kind: str) -> Callable[[Batches], Batches]:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Batches) -> Batches:
        sequence = TaskContext.get().partitionId() << 33
        held: list[tuple] = []  # pieces of the open sequence: doc_id, start, ids, doc_tokens
        filled = 0

        def closed() -> list[tuple]:
            nonlocal sequence, held, filled
            rows, offset = [], 0
            for doc, start, ids, total in held:
                rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, sequence, offset))
                offset += len(ids)
            sequence, held, filled = sequence + 1, [], 0
            return rows

        for batch in batches:
            out = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, start = np.frombuffer(raw.as_buffer(), kind), 0
                while start < len(ids):
                    piece = ids[start:start + length - filled]
                    held.append((doc, start, piece, len(ids)))
                    start, filled = start + len(piece), filled + len(piece)
                    if filled == length:
                        out.extend(closed())
            if out:
                yield batch_of(out)
        rest, out = held, []
        held, filled, left = [], 0, sum(len(p[2]) for p in rest)
        while left:  # the largest power of two first
            room = 1 << left.bit_length() - 1
            left -= room
            while room:
                doc, start, ids, total = rest.pop(0)
                held.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    rest.insert(0, (doc, start + room, ids[room:], total))
                room -= min(room, len(ids))
            out.extend(closed())
        if out:
            yield batch_of(out)
    return run


def _with_crc(batches: Batches) -> Batches:
    for batch in batches:
        crc = [zlib.crc32(x.as_buffer()) for x in batch.column(3)]
        yield batch.set_column(3, "ids_crc32", pa.array(crc, pa.int64()))


def pack(docs: DataFrame, path: str, pattern: str, end_id: int = END_ID, length: int = LENGTH,
         doc_id: str = "doc_id", text: str = "text", special: Special = ()) -> DataFrame:
    """One row per piece: doc_id, start and length in the document's ids, ids
    (little-endian uint32), doc_tokens, sequence_id and offset in the sequence.
    ``path`` is a rank file, ``pattern`` splits texts, ``special`` are added tokens."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    place = scratch_path(spark, "tokens")
    (rows.mapInArrow(_tokenized(path, pattern, special, end_id), "doc_id long, key long, ids binary")
     .write.option("compression", "zstd").parquet(place))
    kind = "<u2" if encoding(path, pattern, special).n_vocab <= 1 << 16 else "<u4"
    order = ["key", F.xxhash64("doc_id")]
    return (spark.read.parquet(place).repartitionByRange(*order).sortWithinPartitions(*order, "doc_id")
            .select("doc_id", "ids")
            .mapInArrow(_packed(length, kind), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"))


def pieces(docs: DataFrame, path: str, pattern: str, **options) -> DataFrame:
    """``pack`` with the crc32 of each piece's ids in place of the ids."""
    return pack(docs, path, pattern, **options).mapInArrow(
        _with_crc, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
