"""Nearest neighbours by multi-index hashing.

Vectors are centred, turned to their principal axes and rotated by a learned
rotation (ITQ: alternate the signs and the rotation that fits them best); the signs
are a code of at most 64 bits. A code is split into substrings of ``SUB`` bits and
indexed under each. If two codes are at most ``radius`` bits apart, some substring
pair is at most ``radius // substrings`` apart (pigeonhole), so probing each
substring table at that distance retrieves every code within the radius; those are
ranked by the cosine of the original vectors in double precision.

Queries widen outwards. For each ring of ``RINGS`` a query looks up, in every substring
table, the substrings exactly that many bits from its own: one equi-join on (table,
substring). After a ring every code within ``substrings * (ring + 1) - 1`` bits has been
retrieved, and a query whose k-th neighbour lies at an angle at which a code falls
outside that distance with probability ``MISS`` at most is closed; only the others widen.
Those still open after the last ring are searched once at ``radius``, where the
substrings to look up outnumber the rows of most tables: there a table's rows and queries
meet in cells.

The rotation is fitted on at most ``SAMPLE`` vectors, the first by a hash of their
id; every vector is indexed. For the last search a table is dealt in cells: substring number, its first
``PREFIX`` bits, and as many slices as its measured rows ask for at ``CELL_ROWS``
each, so a crowded cell is split. A query goes to the cells its probes can touch,
in groups of ``CELL_QUERIES``. A candidate counts in the first table that retrieves
it, so none is ranked twice, and a cell returns at most ``k`` rows for a query.

Copies of a vector are collapsed to their ``k + 1`` smallest ids beforehand: no
query can need another one. Queries that find fewer than ``k`` within the radius
are probed again with the radius at the code's length, which retrieves all.

``RADIUS`` 31 of 64 bits is the widest that probes at distance 7 in 16 bits cover. It
was measured at recall 0.99 or more on the given tables, whose unclustered vectors
have neighbours at cosine 0.4; such probes reach most of a table. With a radius of the
whole code nothing is closed early and the result is exact.

Edge cases: vectors that are null, zero, of another length than the sample's most
common one, or hold null or non-finite components take no part; a query's own row
is never its neighbour (repeated ids are one row's copies, and a row that repeats id
and vector counts once, in the table and among the queries); ties go to the smaller
id; with fewer than ``k`` candidates all are returned; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.session import cut_lineage

SAMPLE = 8192
RADIUS = 31
SUB, PREFIX = 16, 4
RINGS, MISS = (0, 1, 2, 3), 0.01
CELL_ROWS, CELL_QUERIES = 8192, 4096
K = 5

_COLUMNS = ("query_id", "rank", "vec_id", "score")
_RESULT = "query_id long, vec_id long, score double"


@dataclass
class Rotation:
    """Signs of ``(x / |x| - mean) @ axes``."""

    mean: np.ndarray
    axes: np.ndarray

    @property
    def bits(self) -> int:
        return self.axes.shape[1]

    @property
    def substrings(self) -> int:
        return -(-self.bits // SUB)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        signs = np.zeros((len(vectors), 64), np.uint8)
        signs[:, :self.bits] = (unit - self.mean) @ self.axes > 0
        return np.packbits(signs, axis=1, bitorder="little").view("<u8")[:, 0]


def learn(vectors: np.ndarray, rounds: int = 40, seed: int = 7) -> Rotation:
    """ITQ: principal axes, then the rotation that brings them nearest to their signs."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    centred = unit - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :64]
    flat = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
        turn = (u @ vt).T
    return Rotation(mean, axes @ turn)


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) as array<double>, of rows that take part."""
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    out = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return out.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(finite).where(F.exists(x, lambda v: v != 0))


def fit(rows: DataFrame, sample: int = SAMPLE) -> Rotation | None:
    """The rotation of at most ``sample`` usable vectors; None without any."""
    found = [r["vector"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()]
    if not found:
        return None
    dims = Counter(map(len, found)).most_common(1)[0][0]
    return learn(np.array([v for v in found if len(v) == dims], float))


def _coded(rotation: Rotation):
    @F.pandas_udf("long")
    def code(vectors):
        if not len(vectors):
            return vectors.astype("int64")
        return type(vectors)(rotation.codes(np.stack(vectors.to_numpy()).astype(float)).view(np.int64), index=vectors.index)
    return code


def _substring(code: str, j) -> F.Column:
    return F.expr(f"shiftrightunsigned({code}, {SUB} * cast({j} as int))").bitwiseAND((1 << SUB) - 1)


def _angle(bits: int, reach: int, miss: float = MISS) -> float:
    """The widest angle at which a code of ``bits`` signs is more than ``reach`` bits
    away with probability ``miss`` at most; each sign differs with probability angle / pi."""
    low, high = 0.0, 0.5
    for _ in range(40):
        p = (low + high) / 2
        beyond = 1 - sum(math.comb(bits, i) * p ** i * (1 - p) ** (bits - i) for i in range(min(reach, bits) + 1))
        low, high = (p, high) if beyond <= miss else (low, p)
    return math.pi * low


def _look_up(index: DataFrame, queries: DataFrame, rotation: Rotation, ring: int, radius: int) -> DataFrame:
    """(query_id, vec_id, score, angle) of every row with a substring exactly ``ring`` bits
    from the query's in the same table and a code within ``radius``; angle is that between
    the centred vectors."""
    masks = F.lit([m for m in range(1 << SUB) if m.bit_count() == ring])
    part = F.explode(F.array(*[F.lit(j) for j in range(rotation.substrings)]))
    entries = index.withColumn("part", part).select("part", _substring("code", "part").cast("int").alias("substring"), "rid", "code")
    probes = (queries.withColumn("part", part).withColumn("mask", F.explode(masks))
              .select("part", _substring("code", "part").cast("int").bitwiseXOR(F.col("mask")).alias("substring"),
                      F.col("rid").alias("q"), F.col("code").alias("asked")))
    near = F.bit_count(F.col("code").bitwiseXOR(F.col("asked"))) <= radius
    # both sides grow with the table: never sent to the driver to be broadcast
    pairs = entries.hint("merge").join(probes, ["part", "substring"]).where(near).select("rid", "q").distinct()
    mine = queries.select(F.col("rid").alias("q"), F.col("vec_id").alias("query_id"), F.col("vector").alias("v"), F.col("along").alias("w"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    middle = float(rotation.mean @ rotation.mean)
    off = lambda a: F.sqrt(F.greatest(1 - 2 * F.col(a) + F.lit(middle), F.lit(1e-300)))
    turned = (F.col("score") - F.col("along") - F.col("w") + F.lit(middle)) / (off("along") * off("w"))
    return (pairs.join(index, "rid").join(mine, "q").where("vec_id <> query_id")
            .withColumn("score", dot("vector", "v") / (F.sqrt(dot("vector", "vector")) * F.sqrt(dot("v", "v"))))
            .select("query_id", "vec_id", "score", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), turned))).alias("angle")))


def _search(rotation: Rotation, radius: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One cell: its queries against its rows."""
    parts, each = rotation.substrings, radius // rotation.substrings

    def matrix(t: pa.Table) -> np.ndarray:
        lists = t.column("vector").combine_chunks()
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if queries.num_rows and rows.num_rows:
            j = rows.column("part")[0].as_py()
            x, y = matrix(rows), matrix(queries)
            ids, codes = rows.column("vec_id").to_numpy(), rows.column("code").to_numpy().view(np.uint64)
            size = np.sqrt((x * x).sum(axis=1))
            mask = np.uint64((1 << SUB) - 1)
            for q, code, v in zip(queries.column("vec_id").to_numpy(), queries.column("code").to_numpy().view(np.uint64), y):
                apart = codes ^ code
                near = np.bitwise_count(apart >> np.uint64(SUB * j) & mask) <= each
                i = np.flatnonzero(near & (np.bitwise_count(apart) <= radius) & (ids != q))
                for earlier in range(j):  # retrieved by an earlier table
                    i = i[np.bitwise_count(apart[i] >> np.uint64(SUB * earlier) & mask) > each]
                score = (x[i] * v).sum(axis=1) / (size[i] * np.sqrt((v * v).sum()))
                best = np.lexsort((ids[i], -score))[:k]
                out.append((np.full(len(best), q), ids[i][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.array([], np.int64)] * 2 + [np.array([], float)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    assert parts * (each + 1) > radius
    return run


def _probe(index: DataFrame, queries: DataFrame, rotation: Rotation, radius: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k nearest of every code within the radius, per cell."""
    each = radius // rotation.substrings
    part = F.explode(F.array(*[F.lit(j) for j in range(rotation.substrings)]))
    prefix = F.shiftright(_substring("code", "part"), SUB - PREFIX).cast("int")
    by = ["part", "prefix"]
    rows = index.withColumn("part", part).withColumn("prefix", prefix)
    asked = (queries.withColumn("part", part).withColumn("mine", prefix)
             .withColumn("prefix", F.explode(F.sequence(F.lit(0), F.lit((1 << PREFIX) - 1))))
             .where(F.bit_count(F.col("mine").bitwiseXOR(F.col("prefix"))) <= each))
    # both have at most substrings * 2**PREFIX rows
    slices = F.broadcast(rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("slices")))
    groups = F.broadcast(asked.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("groups")))
    each_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = (rows.join(slices, by).join(groups, by).withColumn("slice", F.pmod(F.xxhash64("vec_id"), "slices").cast("int"))
            .withColumn("group", each_of("groups")))
    asked = (asked.join(slices, by).join(groups, by).withColumn("group", F.pmod(F.xxhash64("vec_id"), "groups").cast("int"))
             .withColumn("slice", each_of("slices")))
    cell = [*by, "slice", "group"]
    keep = [*cell, "vec_id", "code", "vector"]
    return (asked.select(*keep).groupBy(*cell).cogroup(rows.select(*keep).groupBy(*cell))
            .applyInArrow(_search(rotation, radius, k), _RESULT))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K,
            radius: int = RADIUS) -> DataFrame:
    """query_id, rank, vec_id, score: up to k nearest rows of ``vectors`` for each
    row of ``queries``, largest cosine first. A row with the query's id is its own."""
    rows = usable(vectors, vec_id, vector)
    rotation = fit(rows)
    if rotation is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    fits = F.size("vector") == len(rotation.mean)
    copies = Window.partitionBy("vector").orderBy("vec_id")
    code = _coded(rotation)
    once = lambda df: df.where(fits).dropDuplicates(["vec_id", "vector"])
    index = (once(rows).withColumn("nth", F.row_number().over(copies)).where(F.col("nth") <= k + 1).drop("nth"))
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    along = F.aggregate(F.zip_with("vector", F.lit(rotation.mean.tolist()), lambda x, m: x * m), F.lit(0.0), lambda a, x: a + x) / size
    coded = lambda df, name: cut_lineage(df.withColumns(
        {"code": code("vector"), "along": along, "rid": F.monotonically_increasing_id()}), name)
    index, asked = coded(index, "codes"), coded(once(usable(queries, vec_id, vector)), "queries")
    radius = min(radius, rotation.bits)
    if radius == rotation.bits:
        return _wide(index, asked, rotation, radius, k).select(*_COLUMNS)
    done, best, still = [], None, asked
    covered = lambda ring: rotation.substrings * (ring + 1) - 1
    rings = [r for r in RINGS if covered(r) < radius]
    for ring in rings:
        # a code that a ring meets beyond its own distance counts for the later ones
        found = _look_up(index, still, rotation, ring, covered(rings[-1]))
        # a pair that several rings retrieve counts once
        found = found if best is None else best.drop("rank").unionByName(found).dropDuplicates(["query_id", "vec_id", "score"])
        best = cut_lineage(_ranked(found, k), "nearest")
        closed = best.where((F.col("rank") == k) & (F.col("angle") <= F.lit(_angle(rotation.bits, covered(ring))))).select("query_id")
        done.append(best.join(closed, "query_id", "left_semi"))
        best = best.join(closed, "query_id", "left_anti")
        still = still.join(closed.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    still = cut_lineage(still, "open")
    return reduce(DataFrame.unionByName, [d.select(*_COLUMNS) for d in [*done, _wide(index, still, rotation, radius, k)]])


def _wide(index: DataFrame, asked: DataFrame, rotation: Rotation, radius: int, k: int) -> DataFrame:
    """One search at ``radius``; queries that find fewer than k are searched again at the code's length."""
    first = cut_lineage(_ranked(_probe(index, asked, rotation, radius, k), k), "nearest")
    short = asked.join(first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti")
    if radius < rotation.bits and not short.isEmpty():
        again = _ranked(_probe(index, short, rotation, rotation.bits, k), k)
        first = first.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    return first
