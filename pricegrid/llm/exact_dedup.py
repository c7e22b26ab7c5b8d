"""Exact dedup by deterministic block naming.

A text is normalised (every run of ``[\\x20\\x09-\\x0D]`` becomes one space) and
cut into blocks of ``BLOCK`` bytes. Equal blocks are brought together, sorted and
numbered: the number is the block's *name*. Names of adjacent blocks are then
paired and the pairs are named the same way, halving the sequence each round,
until a document has one name. Two texts with the same number of rounds have the
same last name exactly when they are equal: a name stands for one byte string,
never for a hash of it.

How it runs: the text crosses the network once. A task collapses the equal blocks of
every ``WINDOW`` bytes of text into one row with a list of places, which is written.
Only the block and the row's number are dealt by block and sorted inside their
partition; the numbering streams over them with one block in memory and gives each row
its name. The places, which hold a row per document, never move by block: they take
their names by row number, so a block that a third of the corpus shares costs its task
one row per window and its places stay spread. All later rounds move integers.
Every round is a Parquet table in the shared checkpoint folder, so names never
change when an executor is lost.

Edge cases: null text is empty text (one empty block, so all empty documents are
one group); a null doc_id loses ties to any other; rows that repeat a doc_id are
separate documents, of which one stays; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.llm import words as W
from pricegrid.session import cut_lineage

BLOCK = 4096
WINDOW, WINDOW_ROWS = 4 << 20, 1 << 14

_TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_PLACE = "rid long, pos long, n long, doc_id long, sha binary"
_PLACE_ARROW = pa.struct([("rid", pa.int64()), ("pos", pa.int64()), ("n", pa.int64()),
                          ("doc_id", pa.int64()), ("sha", pa.binary())])


def normalise(text: bytes) -> bytes:
    """Every run of white space as one space."""
    text = text.translate(_TO_SPACE)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def _collapsed(keys: pa.Array, places: pa.StructArray, first: int) -> pa.RecordBatch:
    """One row per distinct key with the list of its places, numbered from ``first``."""
    coded = keys.dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), places.take(pa.array(order)))
    numbers = pa.array(np.arange(first, first + len(coded.dictionary)))
    return pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.binary()), numbers, lists], ["key", "row", "places"])


def _windows(parts: Iterator[tuple[pa.Array, pa.StructArray]]) -> Iterator[pa.RecordBatch]:
    """Collapses the (keys, places) of a task, as many at a time as fill a window."""
    row, keys, places = TaskContext.get().partitionId() << 33, [], []
    for part, end in itertools.chain(((p, False) for p in parts), [(None, True)]):
        if part is not None:
            keys.append(part[0])
            places.append(part[1])
        if keys and (end or sum(k.nbytes for k in keys) >= WINDOW or sum(map(len, keys)) >= WINDOW_ROWS):
            batch = _collapsed(pa.concat_arrays(keys), pa.concat_arrays(places), row)
            row, keys, places = row + batch.num_rows, [], []
            yield batch


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, doc_id, text) rows to block rows."""
    def blocks(batch: pa.RecordBatch) -> tuple[pa.Array, pa.StructArray]:
        keys, rows = [], []
        texts = batch.column(2).cast(pa.binary())
        for rid, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            text = normalise(text.as_py() or b"")
            n = max(1, -(-len(text) // BLOCK))
            keys.extend(text[i * BLOCK:(i + 1) * BLOCK] for i in range(n))
            rows.append((rid, 0, n, doc, hashlib.sha256(text).digest()))
            rows.extend((rid, i, n, None, None) for i in range(1, n))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _PLACE_ARROW)]
        return pa.array(keys, pa.binary()), pa.StructArray.from_arrays(columns, fields=list(_PLACE_ARROW))
    return _windows(blocks(b) for b in batches if b.num_rows)


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rid, pos, n, doc_id, sha) rows to one row per distinct key of a window."""
    return _windows((b.column(0), pa.StructArray.from_arrays([b.column(i).cast(f.type) for i, f in enumerate(_PLACE_ARROW, 1)],
                                                             fields=list(_PLACE_ARROW))) for b in batches if b.num_rows)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, row) sorted by key to (name, row); equal keys get equal names."""
    name, last = (TaskContext.get().partitionId() << 33) - 1, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0)
        new = np.ones(len(keys), dtype=np.int64)
        new[0] = keys[0].as_py() != last
        if len(keys) > 1:
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        names = name + np.cumsum(new)
        name, last = int(names[-1]), keys[-1].as_py()
        yield pa.RecordBatch.from_arrays([pa.array(names), batch.column(1)], ["name", "row"])


def _named(collapsed: DataFrame, label: str) -> DataFrame:
    """(name, place) rows of (key, row, places)."""
    rows = cut_lineage(collapsed, f"{label}_rows")
    names = (rows.select("key", "row").repartition("key").sortWithinPartitions("key")
             .mapInArrow(_number, "name long, row long"))
    return cut_lineage(rows.select("row", "places").join(names, "row").select("name", F.inline("places")), label)


def identities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(rid, doc_id, sha, rounds, name): one row per input row. Rows have equal
    (rounds, name) exactly when their normalised texts are equal."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"),
                       F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks = f"key binary, row long, places array<struct<{_PLACE.replace(' ', ':').replace(',:', ',')}>>"
    level = _named(rows.mapInArrow(_cut_blocks, blocks), "blocks")
    rounds, done = 0, level.where("n = 1").select("rid", "doc_id", "sha", F.lit(0).alias("rounds"), "name")
    longest = level.agg(F.max("n")).first()[0] or 1
    while longest > 1:
        # adjacent names side by side; a last odd one is paired with -1
        odd = F.col("pos") % 2 == 1
        pairs = (level.where("n > 1")
                 .groupBy("rid", F.shiftright("pos", 1).alias("pos"))
                 .agg(F.max(F.when(~odd, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("b"),
                      F.max(F.shiftright(F.col("n") + 1, 1)).alias("n"),
                      F.max("doc_id").alias("doc_id"), F.max("sha").alias("sha")))
        key = F.unhex(F.concat(F.lpad(F.hex("a"), 16, "0"), F.lpad(F.hex("b"), 16, "0"))).alias("key")
        level = _named(pairs.select(key, "rid", "pos", "n", "doc_id", "sha").mapInArrow(_collapse, blocks), "pairs")
        rounds, longest = rounds + 1, (longest + 1) // 2
        done = done.unionByName(level.where("n = 1").select("rid", "doc_id", "sha", F.lit(rounds).alias("rounds"), "name"))
    return done


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id (the smallest doc_id among equal
    texts), group_size, kept, text_sha256 of the normalised text."""
    ids = identities(docs, doc_id, text)
    by = ["rounds", "name"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    found = cut_lineage(ids.groupBy(*by).agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")), "groups")
    return (ids.join(found, by)
            .select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (F.col("rid") == F.col("first.rid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns. Rows are matched
    by doc_id and text; of rows that repeat both, one stays."""
    names = docs.columns
    docs, doc_id, text = W.positional(docs, doc_id, text)
    stay = groups(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    flat = F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[ \t-\r]+", " ")
    rows = docs.withColumns({"_id": F.col(doc_id).cast("long"), "_sha": F.sha2(flat, 256)})
    one = F.row_number().over(Window.partitionBy("_id", "_sha").orderBy("_sha"))
    rows = rows.alias("r").join(stay.alias("s"), F.col("r._sha").eqNullSafe(F.col("s._sha"))
                                & F.col("r._id").eqNullSafe(F.col("s._id")), "left_semi")
    return rows.withColumn("_nth", one).where("_nth = 1").select(*docs.columns).toDF(*names)
