"""Words of Arrow text batches as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows in this session: whole texts of Spark's
    default 10,000 rows, held by the JVM and Python, would fill a small executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def positional(docs: DataFrame, *names: str) -> tuple:
    """``docs`` with its columns named by their place (c0, c1, ...), which clashes with no
    inner name, and the new names of ``names``."""
    placed = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*placed), *(placed[docs.columns.index(n)] for n in names)


def split(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts, dictionary-encoded, and the
    offsets of each text's words. Null is empty; ``lower`` maps A-Z only."""
    if texts.offset:  # Arrow's string kernels misread long arrays that start inside a buffer
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, offsets = words.flatten(), words.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # white space at either end leaves empty strings
    before = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)).dictionary_encode(), before[offsets]


def split_on(texts: pa.Array, separators: str) -> tuple[pa.Array, np.ndarray]:
    """Parts of all texts, A-Z lower-cased, between runs that match ``separators`` (RE2),
    dictionary-encoded, and the offsets of each text's parts. Null is empty."""
    if texts.offset:  # as in split
        texts = texts.take(pa.array(np.arange(len(texts))))
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    parts = pc.split_pattern_regex(texts, separators)
    flat, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # a text that starts or ends with a separator
    before = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)).dictionary_encode(), before[offsets - offsets[0]]


def hashes(words: pa.Array) -> np.ndarray:
    """xxh3 of each distinct word, as uint64."""
    distinct = words.cast(pa.large_binary()).to_pylist()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64); a bijection."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batch: pa.RecordBatch, column: int, limit: int = 2 << 20):
    """The batch in zero-copy slices of about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)
