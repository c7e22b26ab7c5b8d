"""Source divergence audit: how far each source of a language is from the others.

Terms are runs of A-Z, a-z and code points from U+0080 up, A-Z lower-cased. A language
keeps the terms in at least ``MIN_DOCS`` of its documents. Every source of it, and the
language itself, gives each kept term a smoothed share, in whole billionths:
``1 + floor(10**9 * (count + 5) / (N + 5 * V))`` with N the counts' sum and V the number
of kept terms. All arithmetic is on integers (exact while N + 5 * V is below 9.2e15).

1. Inside ``mapInArrow`` each batch is lower-cased (``ascii_lower``), split
   (``split_pattern_regex``), coded (``dictionary_encode``) and counted (``group_by``);
   a task merges its partial counts until ``HELD`` distinct ones are held.
2. One exchange by (lang, term) merges the partial counts into columnar shards; there a
   term's documents and occurrences in the language come from a window over its sources.
   Hot sources and terms arrive as one row per task and ``HELD`` counts.
3. Pairs of sources: the kept cells are dealt by (lang, shard of about ``TERMS`` terms,
   two blocks of ``SOURCES`` sources); each such group fills a dense matrix of shares and
   gives the partial distances of its pairs, which are summed. Terms that neither block
   holds add the distance of the two shares of count 0, once for each.
4. Terms of a source: those above the language's share, ``TOP`` by the difference.

Edge cases: null text, lang and source are empty strings; a group without terms has
shares of count 0; a language without kept terms has pairs of value 0 and no term rows;
a language of one source has no pairs; rows that repeat a doc_id are documents each;
doc_id and extra columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.llm import words as W
from pricegrid.session import cut_lineage

MIN_DOCS, TOP = 30, 50
HELD = 1 << 19
TERMS, SOURCES = 8192, 256
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

Batches = Iterator[pa.RecordBatch]
_KEYS = ["lang", "source", "term"]


def _partial(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, text) to (lang, source, term, n, docs) of the batch."""
    terms, at = W.split_on(batch.column(2), SEPARATORS)
    row = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(at)))
    by_row = pa.table({"row": row, "code": terms.indices, "n": pa.array(np.ones(len(row), np.int64))}).group_by(["row", "code"]).aggregate([("n", "sum")])
    lang, source = (batch.column(i).dictionary_encode() for i in (0, 1))
    rows = by_row["row"].combine_chunks()
    coded = pa.table({"lang": lang.indices.take(rows), "source": source.indices.take(rows), "term": by_row["code"], "n": by_row["n_sum"]})
    found = coded.group_by(_KEYS).aggregate([("n", "sum"), ("n", "count")])
    columns = [d.dictionary.cast(pa.large_string()).take(found[k]) for k, d in zip(_KEYS, (lang, source, terms))]
    return pa.table([*columns, found["n_sum"], found["n_count"]], [*_KEYS, "n", "docs"])


def _merged(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by(_KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return found.select([*_KEYS, "n_sum", "docs_sum"]).rename_columns([*_KEYS, "n", "docs"])


def _counted(batches: Batches) -> Batches:
    """All partial counts of a task, merged while at most HELD distinct ones are held."""
    held: list[pa.Table] = []
    for whole in batches:
        for batch in W.slices(whole, 2, 4 << 20):
            held.append(_partial(batch))
            if sum(t.num_rows for t in held) > HELD:
                held = [_merged(held)]
                if held[0].num_rows > HELD // 2:
                    yield from held[0].to_batches(max_chunksize=1 << 16)
                    held = []
    if held:
        yield from _merged(held).to_batches(max_chunksize=1 << 16)


def share(count: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(10**9 * (count + 5) / (total + 5 * vocabulary)) by long division, three
    digits a step, so that nothing overflows."""
    rest, whole, over = count + 5, F.lit(0).cast("long"), total + 5 * vocabulary
    for _ in range(3):
        whole = whole * 1000 + F.call_function("div", rest * 1000, over)
        rest = rest * 1000 % over
    return whole + 1


def _distances(groups: pa.Table, cells: pa.Table) -> pa.Table:
    """Partial distances of the pairs of one dealt group: (lang, a, b, value, seen)."""
    idx = np.sort(groups["idx"].to_numpy())
    order = np.argsort(groups["idx"].to_numpy(), kind="stable")
    zero = groups["zero"].to_numpy()[order]
    terms = cells["term"].combine_chunks().dictionary_encode()
    shares = np.tile(zero, (len(terms.dictionary), 1))
    shares[terms.indices.to_numpy(), np.searchsorted(idx, cells["idx"].to_numpy())] = cells["p"].to_numpy()
    low, high = groups["low"][0].as_py(), groups["high"][0].as_py()
    block = idx // SOURCES
    found = []
    for i in np.flatnonzero(block == low):
        j = np.flatnonzero((block == high) & (idx > idx[i]))
        value = np.abs(shares[:, j] - shares[:, i:i + 1]).sum(axis=0)
        found.append((np.full(len(j), idx[i]), idx[j], value))
    a, b, value = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    return pa.table({"lang": pa.array([groups["lang"][0].as_py()] * len(a), pa.string()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                     "value": pa.array(value, pa.int64()), "seen": pa.array(np.full(len(a), len(shares)), pa.int64())})


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row once for every block that its own is compared with."""
    block = F.call_function("div", F.col("idx"), F.lit(SOURCES))
    blocks = F.call_function("div", F.col("sources") + (SOURCES - 1), F.lit(SOURCES))
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return other.withColumns({"low": F.least(block, "other"), "high": F.greatest(block, "other")})


def _counts(docs: DataFrame, lang: str, source: str, text: str, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """The kept cells (lang, source, term, n, in_lang) and the groups (lang, source, idx,
    sources, total, lang_total, vocabulary, zero), written."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("text"))
    partial = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    of_term = Window.partitionBy("lang", "term")
    cells = (partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
             .withColumns({"in_docs": F.sum("docs").over(of_term), "in_lang": F.sum("n").over(of_term),
                           "once": F.row_number().over(of_term.orderBy("source")) == 1})
             .where(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n", "in_lang", "once"))
    cells = cut_lineage(cells, "cells")
    of_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = cells.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("once").alias("vocabulary"))
    by_lang = Window.partitionBy("lang")
    zero = F.lit(0).cast("long")
    groups = (rows.select("lang", "source").distinct()
              .withColumns({"idx": (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long"), "sources": F.count(F.lit(1)).over(by_lang)})
              .join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
              .withColumns({c: F.coalesce(c, zero) for c in ("total", "lang_total", "vocabulary")})
              .withColumn("zero", F.when(F.col("vocabulary") > 0, share(zero, F.col("total"), F.col("vocabulary"))).otherwise(0)))
    return cells.drop("once"), cut_lineage(groups, "groups")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item (the other source, or the term), value
    (billionths) and rank."""
    cells, groups = _counts(docs, lang, source, text, min_docs)
    shares = cells.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("vocabulary")))
    above = F.col("p") - share(F.col("in_lang"), F.col("lang_total"), F.col("vocabulary"))
    by_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(by_group))
    terms = ranked(shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), above.alias("value"))
                   .where("value > 0")).where(F.col("rank") <= top)

    shards = F.greatest(F.lit(1).cast("long"), F.call_function("div", F.col("vocabulary") + (TERMS - 1), F.lit(TERMS)))
    shard = F.pmod(F.xxhash64("term"), shards)
    dealt = _dealt(shares.withColumn("shard", shard)).select("lang", "shard", "low", "high", "idx", "term", "p")
    every = groups.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)))
    by = ["lang", "shard", "low", "high"]
    every = _dealt(every).select(*by, "idx", "zero").toDF(*by, "idx", "zero")  # columns apart from those of ``dealt``
    parts = (every.groupBy(*by).cogroup(dealt.groupBy(*by))
             .applyInArrow(_distances, "lang string, a long, b long, value long, seen long"))
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    one, two = (groups.select("lang", F.col("idx").alias(i), F.col("source").alias(f"source_{i}"), F.col("zero").alias(f"zero_{i}")) for i in "ab")
    unseen = (F.col("vocabulary") - F.col("seen")) * F.abs(F.col("zero_a") - F.col("zero_b"))
    named = (sums.join(one, ["lang", "a"]).join(two, ["lang", "b"]).join(groups.where("idx = 0").select("lang", "vocabulary"), "lang")
             .select("lang", "source_a", "source_b", (F.col("value") + unseen).alias("value")))
    pairs = named.select("lang", "value", F.inline(F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item"))
                                                             for x, y in (("source_a", "source_b"), ("source_b", "source_a"))))))
    pairs = ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    return pairs.unionByName(terms)
