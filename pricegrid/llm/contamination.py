"""Benchmark decontamination by a generalised suffix automaton of the test items.

Words are runs of 0-9, a-z and code points from U+0080 up after A-Z are lower-cased.
A window is ``WINDOW`` consecutive words of an item, or a whole item of fewer words. A
document word inside any occurrence of a window is hit.

The automaton of all items' word sequences says for each document word how long the
longest run of words ending there is that some item holds. From ``WINDOW`` up that run
is hit; the state of its last ``WINDOW`` words names the items that hold them. Whole
short items hang on their states and are met on the suffix links. Before the walk,
words that no item has and word pairs that are adjacent in no item cut the document
into stretches (no match crosses such a cut); stretches shorter than the shortest
window are passed over.

Automata are built on the executors from at most about ``AUTOMATON`` words each: items
are cut into pieces of ``PIECE`` words that overlap by a window less one word, and the
pieces are dealt by hash. Only one automaton at a time is held by the driver and sent
to the tasks; a benchmark of up to that size needs one, and the documents are then read
in one narrow pass without a shuffle. A larger one takes a pass for each, whose marks
travel with the rows.

Edge cases: null, empty and wordless texts have no words and no hits; a wordless item
has no window; rows that repeat an item_id are one item, and of a null item_id the words
are hit but no id is listed; rows that repeat a doc_id are marked each; ids can be null;
extra columns stay as they are; without items nothing is hit; an empty table gives an
empty result. A very long text is read whole, in one task.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.llm import words as W
from pricegrid.session import cut_lineage

WINDOW = 10
AUTOMATON, PIECE = 1 << 18, 1 << 16
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

Batches = Iterator[pa.RecordBatch]


@dataclass
class Automaton:
    """Suffix automaton of word sequences (lists of small ints), each with an item id."""
    window: int = WINDOW
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    top: list[int] = field(default_factory=list)
    holders: dict[int, set] = field(default_factory=lambda: defaultdict(set))
    whole: dict[int, list] = field(default_factory=lambda: defaultdict(list))
    near: list[int] = field(default_factory=list)
    shortest: int = 0
    vocabulary: list[str] = field(default_factory=list)
    pairs: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def _split(self, before: int, word: int) -> int:
        """The state of the longest run of ``before`` followed by ``word``, parted from
        longer runs where it shares a state with them."""
        there = self.step[before][word]
        if self.length[there] == self.length[before] + 1:
            return there
        twin = self._state(self.length[before] + 1, self.link[there], dict(self.step[there]))
        self.link[there] = twin
        while before >= 0 and self.step[before].get(word) == there:
            self.step[before][word] = twin
            before = self.link[before]
        return twin

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:  # another sequence has been here
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def finish(self, sequences: list[tuple[list[int], str | None]]) -> Automaton:
        """Adds all sequences and notes which items hold each window."""
        for ids, _ in sequences:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        self.top, self.near = list(range(len(self.length))), [0] * len(self.length)
        by_length = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for state in by_length:  # the state of the last ``window`` words of a longer run
            if self.length[self.link[state]] >= self.window:
                self.top[state] = self.top[self.link[state]]
        for ids, item in sequences:
            state = 0
            for i, word in enumerate(ids):
                state = self.step[state][word]
                if i + 1 >= self.window:
                    self.holders[self.top[state]].add(item)
            if len(ids) < self.window:
                self.whole[state].append((len(ids), item))
        for state in by_length:  # the nearest state up the links at which a short item ends
            self.near[state] = state if state in self.whole else self.near[self.link[state]]
        self.shortest = min((min(len(ids), self.window) for ids, _ in sequences), default=self.window)
        n = max(1, len(self.vocabulary))
        self.pairs = np.unique(np.array([a * n + b for ids, _ in sequences for a, b in zip(ids, ids[1:])], np.int64))
        return self

    def stretches(self, words: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item word numbers of dictionary-encoded words, and the starts and ends of the
        stretches in which every pair of neighbours is adjacent in some item."""
        known = pc.fill_null(pc.index_in(words.dictionary, pa.array(self.vocabulary, words.dictionary.type)), -1).to_numpy()
        ids = known[words.indices.to_numpy()].astype(np.int64) if len(words) else np.empty(0, np.int64)
        joined = np.zeros(len(ids) + 1, bool)  # joined[i]: words i - 1 and i
        both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        if len(both) and len(self.pairs):
            key = ids[both] * max(1, len(self.vocabulary)) + ids[both + 1]
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined[both[self.pairs[place] == key] + 1] = True
        joined[at] = False
        cuts = np.flatnonzero(~joined)
        starts, ends = cuts[:-1], cuts[1:]
        long = (ends - starts >= self.shortest) & (ids[starts] >= 0)
        return ids, starts[long], ends[long]

    def walk(self, ids: list[int]) -> tuple[list[tuple[int, int]], set]:
        """The hit word ranges of one stretch and the items that the windows are of."""
        spans, items, tops = [], set(), set()
        state = matched = 0
        for i, word in enumerate(ids):
            while state and word not in self.step[state]:
                state = self.link[state]
                matched = self.length[state]
            if word not in self.step[state]:
                continue
            state, matched = self.step[state][word], matched + 1
            if matched >= self.window:
                tops.add(self.top[state])
                spans.append((i + 1 - matched, i + 1))
            short = self.near[state]
            while short:
                for n, item in self.whole[short]:
                    if n <= matched:
                        items.add(item)
                        spans.append((i + 1 - n, i + 1))
                short = self.near[self.link[short]]
        return spans, items.union(*(self.holders[t] for t in tops))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _pieces(window: int, piece: int) -> Callable[[Batches], Batches]:
    """(item, text) to (item, words) of at most ``piece`` words, neighbours overlapping."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words, _ = W.split_on(pa.array([text.as_py()], pa.large_string()), SEPARATORS)
                for start in range(0, max(1, len(words) - window + 1), piece):
                    if found := words.slice(start, piece + window - 1).to_pylist():
                        yield pa.RecordBatch.from_arrays([pa.array([item], pa.string()), pa.array([found], pa.list_(pa.string()))], ["item", "words"])
    return run


def _built(window: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        coded = rows["words"].combine_chunks().flatten().dictionary_encode()
        ends = np.cumsum(pc.list_value_length(rows["words"]).to_numpy())
        ids = np.split(coded.indices.to_numpy(), ends[:-1])
        automaton = Automaton(window, vocabulary=coded.dictionary.to_pylist())
        automaton.finish([(i.tolist(), item) for i, item in zip(ids, rows["item"].to_pylist())])
        return pa.table({"automaton": pa.array([pickle.dumps(automaton)], pa.binary())})
    return run


def automata(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, size: int = AUTOMATON) -> DataFrame:
    """(shard, automaton): pickled automata of about ``size`` words of the items each, written."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    pieces = cut_lineage(rows.mapInArrow(_pieces(window, min(PIECE, size)), "item string, words array<string>"), "pieces")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = -(-2 * total // size) if total > size else 1
    built = (pieces.withColumn("shard", F.pmod(F.xxhash64("item", "words"), F.lit(shards)))
             .groupBy("shard").applyInArrow(_built(window), "automaton binary"))
    return cut_lineage(built.withColumn("shard", F.monotonically_increasing_id()), "automata")


_MARKS = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _marked(automaton: bytes) -> Callable[[Batches], Batches]:
    """(row, text, n_words, spans, items) with the marks of one more automaton."""
    def run(batches: Batches) -> Batches:
        found = pickle.loads(automaton)
        for whole in batches:
            for batch in W.slices(whole, 1, 8 << 20):
                words, at = W.split_on(batch.column(1), SEPARATORS)
                ids, starts, ends = found.stretches(words, at)
                spans, items = [[(s["start"], s["end"]) for s in x] for x in batch.column(3).to_pylist()], [set(x) for x in batch.column(4).to_pylist()]
                for a, b, row in zip(starts, ends, np.searchsorted(at, starts, "right") - 1):
                    hit, of = found.walk(ids[a:b].tolist())
                    spans[row].extend((s + int(a - at[row]), e + int(a - at[row])) for s, e in hit)
                    items[row] |= of
                merged = [[{"start": s, "end": e} for s, e in _merge(x)] for x in spans]
                listed = [sorted(x - {None}) for x in items]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.diff(at)), pa.array(merged, _SPANS), pa.array(listed, pa.list_(pa.string()))],
                    ["row", "text", "n_words", "spans", "items"])
    return run


def _mark(docs: DataFrame, keep: list[str], text: str, built: DataFrame) -> DataFrame:
    """(row struct of ``keep``, text, n_words, spans, items) of every document."""
    rows = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), F.col(text).cast("string").alias("text"),
                       F.lit(0).cast("long").alias("n_words"), F.lit([]).cast("array<struct<start:long,end:long>>").alias("spans"),
                       F.lit([]).cast("array<string>").alias("items"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, {_MARKS}"
    shards = [r["shard"] for r in built.select("shard").collect()]  # one long for each automaton
    for i, shard in enumerate(shards or [None]):
        one = built.where(F.col("shard") == shard).first()["automaton"] if shards else pickle.dumps(Automaton().finish([]))
        rows = rows.mapInArrow(_marked(one), schema)
        if i + 1 < len(shards):
            rows = cut_lineage(rows, "marked")
    return rows


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, size: int = AUTOMATON) -> DataFrame:
    """doc_id, n_words, spans (hit ranges of words, end exclusive, apart from each other)
    and items (ids, sorted as strings) of every document."""
    marked = _mark(docs, [doc_id], text, automata(items, item_id, item_text, window, size))
    return marked.select(F.col("row")[doc_id].alias("doc_id"), "n_words", "spans", "items")


def digests(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``find`` with counts and a digest in place of the lists."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return find(docs, items, **options).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def _cut(min_span: int, max_coverage: float) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts, stay = [], []
            for text, n, spans in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                hit = sum(s["end"] - s["start"] for s in spans)
                stay.append(hit <= max_coverage * n)
                text = text.as_py()
                long = [s for s in spans if s["end"] - s["start"] >= min_span] if stay[-1] else []
                if long:
                    raw = text.encode()
                    at = [m.span() for m in _WORD.finditer(raw)]
                    kept, start = [], 0
                    for s in long:
                        kept.append(raw[start:at[s["start"]][0]])
                        start = at[s["end"] - 1][1]
                    text = b"".join([*kept, raw[start:]]).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"]).filter(pa.array(stay, pa.bool_()))
    return run


def remove(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
           window: int = WINDOW, min_span: int = WINDOW, max_coverage: float = 0.5, size: int = AUTOMATON) -> DataFrame:
    """``docs`` with their own columns, hit ranges of ``min_span`` words or more cut out
    of the texts; documents of which more than ``max_coverage`` is hit are dropped."""
    others = [c for c in docs.columns if c != text]
    marked = _mark(docs, others, text, automata(items, item_id, item_text, window, size))
    kind = marked.schema["row"].dataType.simpleString()
    cut = marked.mapInArrow(_cut(min_span, max_coverage), f"row {kind}, text string")
    return cut.select(*(F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))
