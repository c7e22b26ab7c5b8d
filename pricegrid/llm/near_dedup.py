"""Near-duplicate documents by MinHash and a multi-index Hamming join.

A text, A-Z lower-cased, gives its set of distinct ``words``-word shingles. A
signature holds ``CHUNKS * WIDTH`` MinHash values of 16 bits each; the distance of
two signatures is the number of values that differ, about ``1 - similarity`` of
them. Signatures are split into ``CHUNKS`` chunks. By the pigeonhole principle two
signatures at most ``2 * CHUNKS - 1`` apart agree on some chunk with one error at
most, so each signature is indexed under every chunk with each one value left out
(``CHUNKS * WIDTH`` keys): all pairs under that distance meet under a key. A pair
of similarity 0.8 meets in none with probability 0.263**14, below 1e-8.

Links are always confirmed on the full sets. Equal sets are one class from the
start, so copies are never expanded. Within a key the pairs are not enumerated:

1. each class is compared with the smallest class that it meets most often;
2. in buckets that still span components, pairs of different components are compared
   by a finer signature (``FINE`` MinHash values of one bit, made for these classes
   alone) inside blocks of about ``BLOCK_ROWS`` rows and ``BLOCK_BYTES`` of sets a side.
   A first pass, without the sets, finds the rows of a block that any pair needs; a
   second one, with the sets of these rows, confirms the pairs and gives out only links
   that join two components, so fewer than a block has rows. Left out are pairs whose
   ``FINE`` bits lie ``sigmas`` standard deviations further apart than the least
   similarity leaves (fewer than one linked pair in 10**6 at 5, and it must be the only
   link between two components; None leaves out none). Of buckets with the same
   members one is compared, and a pair is taken in the lowest key it shares.

Whatever is left unconfirmed lies inside one component or is too far apart, so
components equal those of the full graph.

Edge cases: null, empty and blank texts have no shingle and are linked with
nothing; fewer words than a shingle needs make one shingle of the whole sequence;
rows that repeat a doc_id are separate documents, and one row of each component is
kept, whatever its ids; a null doc_id never names a component unless nothing else
is in it; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.llm import words as W
from pricegrid.llm.graph import components
from pricegrid.session import cut_lineage

CHUNKS, WIDTH = 14, 5
FINE, SIGMAS = 4096, 5
BLOCK_ROWS, BLOCK_BYTES = 8192, 16 << 20

Batches = Iterator[pa.RecordBatch]

_random = np.random.default_rng(9)
_MULTIPLY = _random.integers(0, 1 << 32, CHUNKS * WIDTH, dtype=np.uint32) | np.uint32(1)
_ADD = _random.integers(0, 1 << 32, CHUNKS * WIDTH, dtype=np.uint32)


def shingle_sets(texts: pa.Array, n: int = 2) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit hashes."""
    coded, at = W.split(texts)
    h = W.hashes(coded.dictionary)[coded.indices.to_numpy()]
    rolled = W.mix(h[: max(0, len(h) - n + 1)])
    for k in range(1, n):
        rolled = W.mix(rolled * np.uint64(0x9E3779B97F4A7C15) + h[k: len(h) - n + 1 + k])
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= n:
            out.append(np.unique(rolled[a:b - n + 1]))
        else:
            whole = np.zeros(min(1, b - a), np.uint64)
            for k, x in enumerate(h[a:b]):
                whole[0] = W.mix(whole * np.uint64(0x9E3779B97F4A7C15) + x + np.uint64(k + 1))[0]
            out.append(whole)
    return out


def _fingerprint(s: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    two = W.mix(s + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64), W.mix(s ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return np.array(two, np.uint64).tobytes() + len(s).to_bytes(4, "little")


def signature(s: np.ndarray) -> np.ndarray:
    """CHUNKS * WIDTH MinHash values of 16 bits."""
    x = (s >> np.uint64(32)).astype(np.uint32)[:, None]
    lowest = np.min([(x[i:i + 4096] * _MULTIPLY + _ADD).min(axis=0) for i in range(0, len(x), 4096)], axis=0)
    return (lowest * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16)


def _fine(batches: Batches) -> Batches:
    """(cid, set) to (cid, bits, n): FINE MinHash values of one bit, and the set's size."""
    rng = np.random.default_rng(99)
    multiply, add = (rng.integers(0, 1 << 32, FINE, dtype=np.uint32) for _ in range(2))
    multiply |= np.uint32(1)
    for batch in batches:
        bits, n = [], []
        for s in batch.column(1):
            n.append(len(s.as_buffer()) // 8)
            x = (np.frombuffer(s.as_buffer(), np.uint64) >> np.uint64(32)).astype(np.uint32)[:, None]
            lowest = np.min([(x[i:i + 256] * multiply + add).min(axis=0) for i in range(0, len(x), 256)], axis=0)
            bits.append(np.packbits(lowest * np.uint32(0x9E3779B1) >> np.uint32(31)).tobytes())
        if bits:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary()), pa.array(n, pa.int64())], ["cid", "bits", "n"])


def _signatures(n: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in W.slices(whole, 2):
                sets = shingle_sets(batch.column(2), n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(3), batch.column(4), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                    ["doc_id", "row", "rid", "sha", "n_shingles", "mark", "sig"])
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), CHUNKS * WIDTH)


def _key_matrix(sig: np.ndarray) -> np.ndarray:
    """All keys of signatures (n, CHUNKS * WIDTH): each chunk with each one value left out."""
    sig = sig.reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
    keys = np.empty(sig.shape, np.uint64)
    for left_out in range(WIDTH):
        packed = np.zeros((len(sig), CHUNKS), np.uint64)
        for k in range(WIDTH):
            if k != left_out:
                packed = packed << np.uint64(16) | sig[:, :, k]
        place = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(left_out + 1)
        keys[:, :, left_out] = W.mix(W.mix(packed) + place)
    return keys.reshape(len(sig), -1).view(np.int64)


def _keys(batches: Batches) -> Batches:
    """(cid, sig) to (key, cid)."""
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            batch = whole.slice(start, 2000)
            keys = _key_matrix(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)),
                                              pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))], ["key", "cid"])


def _sets(n: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in W.slices(whole, 2):
                sets = shingle_sets(batch.column(2), n)
                mine = np.array([m == _fingerprint(s) for m, s in zip(batch.column(1).to_pylist(), sets)], bool)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["cid", "set"]).filter(pa.array(mine))
    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _linked(percent: int) -> Callable[[Batches], Batches]:
    """(u, v, set_u, set_v) to (u, v, linked), on the full sets."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            yes = [_similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent)
                   for a, b in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(yes, pa.bool_())], ["u", "v", "linked"])
    return run


def _blocks(compare: Callable[..., pa.RecordBatch | None], *options) -> Callable[[Batches], Batches]:
    """Rows sorted by block (first column) to compare's result of each block."""
    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1), len(blocks)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if held and blocks[a] != last:
                    if found := compare(pa.concat_batches(held), *options):
                        yield found
                    held = []
                held.append(batch.slice(a, b - a))
                last = blocks[a]
        if held and (found := compare(pa.concat_batches(held), *options)):
            yield found
    return run


def _most_apart(bits: int, percent: int, sigmas: float | None) -> float:
    """Bits apart that a pair of similarity ``percent`` doesn't exceed: ``sigmas`` above the mean."""
    p = (100 - percent) / 200
    return bits if sigmas is None else bits * p + sigmas * (bits * p * (1 - p)) ** 0.5


def _pairs(rows: pa.RecordBatch, percent: int, sigmas: float | None):
    """For each row of a block its index and the later rows of other components that it
    may be linked with and shares no key with below the block's. Sides 0 and 1 are
    compared across, 2 among themselves. Rows: block, key, side, cid, comp, bits, n, sig."""
    side, comp, n = (rows.column(i).to_numpy() for i in (2, 4, 6))
    key, keys = rows.column(1)[0].as_py(), _key_matrix(_matrix(rows.column(7)))
    bits = np.frombuffer(b"".join(rows.column(5).to_pylist()), np.uint64).reshape(len(n), -1)
    most = _most_apart(64 * bits.shape[1], percent, sigmas)
    for i in range(len(n) - 1):
        later = slice(i + 1, None)
        j = i + 1 + np.flatnonzero((comp[later] != comp[i]) & ((side[later] != side[i]) | (side[i] == 2))
                                   & (100 * np.minimum(n[later], n[i]) >= percent * np.maximum(n[later], n[i])))
        j = j[np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64) <= most]
        yield i, j[~((keys[j] == keys[i]) & (keys[i] < key)).any(axis=1)]


def _needed(rows: pa.RecordBatch, percent: int, sigmas: float | None) -> pa.RecordBatch | None:
    """block, key, side, cid and comp of the rows that a pair needs."""
    needed = np.zeros(rows.num_rows, bool)
    for i, j in _pairs(rows, percent, sigmas):
        needed[j] = True
        needed[i] |= len(j) > 0
    return rows.select(range(5)).filter(pa.array(needed)) if needed.any() else None


def _joining(rows: pa.RecordBatch, percent: int, sigmas: float | None) -> pa.RecordBatch | None:
    """(u, v) of confirmed links, each of which joins two components that none before
    it in the block did. Rows as of ``_pairs``, then set."""
    cid, comp = rows.column(3).to_numpy(), rows.column(4).to_pylist()
    sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column(8)]
    root = {c: c for c in comp}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    found = []
    for i, j in _pairs(rows, percent, sigmas):
        for k in j.tolist():
            a, b = find(comp[i]), find(comp[k])
            if a != b and _similar(sets[i], sets[k], percent):
                root[a] = b
                found.append((max(cid[i], cid[k]), min(cid[i], cid[k])))
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["u", "v"]) if found else None


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v, linked) of distinct pairs, written."""
    rows = (pairs.join(sets.select(F.col("cid").alias("u"), F.col("set").alias("set_u")), "u")
            .join(sets.select(F.col("cid").alias("v"), F.col("set").alias("set_v")), "v")
            .select("u", "v", "set_u", "set_v"))
    return cut_lineage(rows.mapInArrow(_linked(percent), "u long, v long, linked boolean"), "links")


def _spanning(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(key, cid, comp, low, size) of the buckets that hold more than one component;
    of buckets with the same members (128 bits of their ids) the lowest key stands for all."""
    placed = members.select("key", "cid").join(comps.withColumnRenamed("id", "cid"), "cid", "left")
    placed = placed.select("key", "cid", F.coalesce("comp", "cid").alias("comp"))
    same = [F.bit_xor(F.xxhash64("cid", F.lit(i))).alias(f"same{i}") for i in range(2)]
    open_ = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("size"), *same).where("low < high")
    open_ = open_.groupBy("low", "size", "same0", "same1").agg(F.min("key").alias("key"))
    return cut_lineage(placed.join(open_.select("key", "low", "size"), "key"), "spanning")


def _met(candidates: DataFrame) -> DataFrame:
    """Distinct pairs (u, v) and how often they meet."""
    return candidates.groupBy("u", "v").agg(F.count(F.lit(1)).alias("met"))


def _best(met: DataFrame) -> DataFrame:
    """Of each u's candidates, the one it meets most often."""
    top = met.groupBy("u").agg(F.max(F.struct("met", (-F.col("v")).alias("low"))).alias("top"))
    return top.select("u", (-F.col("top.low")).alias("v"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 2, percent: int = 80,
                    sigmas: float | None = SIGMAS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and
    kept (one row of each component), one row per input row. ``words`` per shingle;
    linked from ``percent`` of intersection over union up. ``sigmas`` as above; None is exact."""
    return _grouped(docs, doc_id, text, words, percent, F.lit(None).cast("binary"), sigmas).drop("sha")


def _grouped(docs: DataFrame, doc_id: str, text: str, words: int, percent: int, sha: Column, sigmas: float | None = SIGMAS) -> DataFrame:
    """doc_id, sha (as given), n_shingles, component_id and kept, one row per input row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text)).alias("row"), F.col(text).cast("string").alias("_text"))
    seen = rows.select("*", F.monotonically_increasing_id().alias("rid"), sha.alias("sha"))
    seen = cut_lineage(seen.mapInArrow(_signatures(words), "doc_id long, row long, rid long, sha binary, n_shingles long, mark binary, sig binary"),
                       "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("first")
    classes = cut_lineage(seen.where("mark is not null").groupBy("mark")
                          .agg(first, F.min("row").alias("row"), F.any_value("sig").alias("sig"))
                          .select(F.monotonically_increasing_id().alias("cid"), "*"), "classes")

    keys = classes.select("cid", "sig").mapInArrow(_keys, "key long, cid long")
    shared = keys.groupBy("key").agg(F.min("cid").alias("lead"), F.max("cid").alias("last")).where("lead < last").select("key", "lead")
    members = cut_lineage(keys.join(shared, "key"), "members")
    met = members.select("cid").distinct().join(classes.select("cid", "row", "mark"), "cid")
    sets = cut_lineage(rows.join(met, "row").select("cid", "mark", "_text").mapInArrow(_sets(words), "cid long, set binary")
                       .dropDuplicates(["cid"]), "sets")

    first = members.where("cid > lead").select(F.col("cid").alias("u"), F.col("lead").alias("v"))
    links = _confirm(_best(_met(first)), sets, percent)
    spanning = _spanning(members, components(links.where("linked")))
    sets = cut_lineage(sets.join(spanning.select("cid").distinct(), "cid"), "sets")  # all that is still open
    fine = sets.mapInArrow(_fine, "cid long, bits binary, n long")
    fine = cut_lineage(fine.join(classes.select("cid", "sig"), "cid"), "fine")
    row = "block long, key long, side int, cid long, comp long"
    needed = cut_lineage(_dealt(spanning, fine).mapInArrow(_blocks(_needed, percent, sigmas), row), "needed")
    joined = (_sorted(needed.join(fine, "cid").join(sets, "cid"), "bits", "n", "sig", "set")
              .mapInArrow(_blocks(_joining, percent, sigmas), "u long, v long"))
    links = links.unionByName(cut_lineage(joined.withColumn("linked", F.lit(True)), "joined"))

    comps = components(links.where("linked")).withColumnRenamed("id", "cid")
    of_class = (classes.select("cid", "mark", "first").join(comps, "cid", "left")
                .select("mark", "first", F.coalesce("comp", "cid").alias("comp")))
    first = of_class.groupBy("comp").agg(F.min("first").alias("first"))
    named = cut_lineage(of_class.select("mark", "comp").join(first, "comp")
                        .select("mark", F.col("first.doc_id").alias("component_id"), F.col("first.rid").alias("first_rid")), "components")
    found = (seen.where("mark is not null").select("doc_id", "sha", "n_shingles", "rid", "mark").join(named, "mark")
             .select("doc_id", "sha", "n_shingles", "component_id", (F.col("rid") == F.col("first_rid")).alias("kept")))
    alone = seen.where("mark is null").select("doc_id", "sha", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return found.unionByName(alone)


def _dealt(spanning: DataFrame, fine: DataFrame) -> DataFrame:
    """(block, key, side, cid, comp, bits, n, sig) of the open buckets, dealt and sorted
    by block. A bucket over BLOCK_ROWS or BLOCK_BYTES is dealt block against block."""
    weight = F.sum("n").alias("sum_n")
    heavy = spanning.join(fine.select("cid", "n"), "cid").groupBy("key").agg(weight)
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_ROWS, 8 * F.col("sum_n") / BLOCK_BYTES)).cast("int")
    mine = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    rows = (spanning.join(heavy, "key").select("key", "cid", "comp", blocks.alias("blocks")).withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .join(fine, "cid"))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(low == high, 2).when(F.col("mine") == low, 0).otherwise(1)
    return _sorted(rows.withColumns({"block": F.xxhash64("key", low, high), "side": side}), "bits", "n", "sig")


def _sorted(rows: DataFrame, *more: str) -> DataFrame:
    return (rows.select("block", "key", "side", "cid", "comp", *more)
            .repartition("block").sortWithinPartitions("block", "key"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 2, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: one of each component.
    Rows are matched by doc_id and text; of rows that repeat both, one stays."""
    names = docs.columns
    docs, doc_id, text = W.positional(docs, doc_id, text)
    sha = F.unhex(F.sha2("_text", 256))
    found = _grouped(docs, doc_id, text, words, percent, sha)
    gone = cut_lineage(found.groupBy("doc_id", "sha").agg(F.bool_and("kept").alias("all"), F.bool_or("kept").alias("_one")).where("not all")
                       .select(F.col("doc_id").alias("_gone"), F.col("sha").alias("_sha"), "_one"), "gone")
    same = (F.col(doc_id).cast("long").eqNullSafe(F.col("_gone"))
            & F.unhex(F.sha2(F.col(text).cast("string"), 256)).eqNullSafe(F.col("_sha")))
    stay = docs.join(gone, same, "left_anti")
    repeated = gone.where("_one")
    if repeated.isEmpty():
        return stay.toDF(*names)
    nth = F.row_number().over(Window.partitionBy("_gone", "_sha").orderBy("_sha"))
    one = docs.join(repeated, same).withColumn("_nth", nth).where("_nth = 1")
    return stay.unionByName(one.select(*docs.columns)).toDF(*names)
