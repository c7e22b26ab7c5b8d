"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

A text is split on white space; each word gives its lower-cased form, its *form*
(every run of letters or digits as one letter, so ``He%%%`` and ``of%%%`` share
``a%%%``) and its case pattern; adjacent words give pairs of forms, a mark when a
word repeats its neighbour, and the word pair. Each is hashed into ``2**BITS``
weights. The score is ``sigmoid(bias + x . w)`` with ``x`` the relative frequency
of each feature, so long and short texts compare.

Fitting takes the first labelled rows by a hash of doc_id, at most ``MAX_ROWS`` of them
and no more after ``MAX_BYTES`` of features (documented bounds, whatever the corpus).
All candidates are featurised by Spark; the sparse vectors of the sample go, sorted by
that hash, to one task, which holds them and makes ``EPOCHS`` FTRL passes. Only the
weights (4 MB) come to the driver; they go to the executors as a closure and scoring is
one narrow pass over whole texts.

Edge cases: null or empty text has no features and scores sigmoid(bias); labels
that are null or neither 0 nor 1 are ignored; of repeated labels of a document the
smallest is used; repeated document rows are scored each; with no usable label the
model is all zeros and every score 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid.llm import words as W

BITS = 20
MAX_ROWS, MAX_BYTES = 8192, 256 << 20
EPOCHS = 3
THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01

_RUN = re.compile(rb"[A-Za-z0-9\x80-\xff]+")
_KINDS = tuple(np.uint64(xxhash.xxh3_64_intdigest(k)) for k in ("word", "form", "case", "forms", "repeat", "pair"))


def _case(word: str) -> bytes:
    letters = [c for c in word if c.isalpha()]
    return b"-" if not letters else b"U" if len(letters) > 1 and word.isupper() else b"T" if word[0].isupper() else b"l"


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of all texts, one entry per occurrence: indices, their
    values (1 / number of words) and the offsets of each text."""
    coded, at = W.split(texts, lower=False)
    codes = coded.indices.to_numpy().astype(np.int64)
    distinct = coded.dictionary.to_pylist()
    hashed = lambda found: np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(distinct))
    word = hashed(w.lower() for w in distinct)
    form = hashed(_RUN.sub(b"a", w.encode()) for w in distinct)
    case = hashed(map(_case, distinct))
    n, first = len(codes), np.zeros(len(codes) + 1, bool)
    first[at[:-1]] = True
    follows = ~first[:n]  # this word has one before it in its text
    columns = np.zeros((n, 6), np.uint64)
    columns[:, 0] = W.mix(word + _KINDS[0])[codes]
    columns[:, 1] = W.mix(form + _KINDS[1])[codes]
    columns[:, 2] = W.mix(case + _KINDS[2])[codes]
    if n > 1:
        a, b = codes[:-1], codes[1:]
        columns[1:, 3] = W.mix(W.mix(form)[a] * np.uint64(3) + form[b] + _KINDS[3])
        columns[1:, 4] = W.mix((word[a] == word[b]).astype(np.uint64) + _KINDS[4])
        columns[1:, 5] = W.mix(W.mix(word)[a] * np.uint64(3) + word[b] + _KINDS[5])
    used = np.ones((n, 6), bool)
    used[:, 3:] = follows[:, None]
    index = (columns >> np.uint64(64 - bits)).astype(np.int32)[used]
    per_word = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
    value = np.repeat(1.0 / np.maximum(1, np.diff(at)), np.diff(per_word[at]))
    return index, value, per_word[at]


@dataclass
class Model:
    weights: np.ndarray  # float32
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        index, value, at = features(texts, int(len(self.weights)).bit_length() - 1)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[index] * value)])
        z = self.bias + sums[at[1:]] - sums[at[:-1]]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """FTRL-proximal over sparse rows (indices, values, label), in the given
    order; classes are weighted to count alike. The last slot is the bias."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weight(i):
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    ones = sum(label for *_, label in rows)
    if 0 < ones < len(rows):
        share = (len(rows) / (2 * (len(rows) - ones)), len(rows) / (2 * ones))
        for _ in range(epochs):
            for index, value, label in rows:
                i, x = np.append(index, 1 << bits), np.append(value.astype(float), 1.0)
                w = weight(i)
                p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -30, 30)))
                g = (p - label) * x * share[label]
                s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
                z[i] += g - s * w
                n[i] += g * g
    w = weight(np.arange(len(z)))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def _sparse(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, 2):
                index, value, at = features(batch.column(2), bits)
                ii, vv = [], []
                for a, b in zip(at[:-1], at[1:]):
                    distinct, inverse = np.unique(index[a:b], return_inverse=True)
                    ii.append(distinct.astype(np.int32).tobytes())
                    vv.append(np.bincount(inverse, value[a:b], len(distinct)).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ii, pa.binary()), pa.array(vv, pa.binary())],
                                                 ["doc_id", "label", "index", "value"])
    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, a multiple of 5: never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _fitted(bits: int, epochs: int, max_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sample's rows, in order, to one row of weights and bias."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for label, index, value in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if held < max_bytes:
                    rows.append((np.frombuffer(index.as_py(), np.int32), np.frombuffer(value.as_py(), np.float32), label))
                    held += rows[-1][0].nbytes + rows[-1][1].nbytes
        if rows:
            model = ftrl(rows, bits, epochs)
            yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        max_rows: int = MAX_ROWS, bits: int = BITS, epochs: int = EPOCHS, max_bytes: int = MAX_BYTES) -> Model:
    """A model from at most ``max_rows`` labelled rows that aren't held out."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id))
             .groupBy(F.col(doc_id).cast("long").alias("_id")).agg(F.min(label).cast("int").alias("_label")))
    order = F.xxhash64(F.col("_id"), F.lit(8))
    chosen = known.orderBy(order, "_id").limit(max_rows)
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    found = (rows.join(F.broadcast(chosen), "_id")  # max_rows rows of 12 bytes
             .select("_id", "_label", "_text")
             .mapInArrow(_sparse(bits), "doc_id long, label int, index binary, value binary")
             .dropDuplicates(["doc_id"]).repartition(1).sortWithinPartitions(F.xxhash64("doc_id", F.lit(8)), "doc_id")
             .mapInArrow(_fitted(bits, epochs, max_bytes), "weights binary, bias double").first())
    if found is None:
        return ftrl([], bits, epochs)
    return Model(np.frombuffer(found["weights"], np.float32), found["bias"])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
          keep: list[str] | None = None) -> DataFrame:
    """doc_id, score and predicted (1 from the threshold up) of every row; with
    ``keep`` those columns of docs instead of doc_id."""
    cols = keep or [doc_id]
    shape = docs.select(*cols, F.col(text).cast("string").alias("_text"))
    schema = docs.select(*cols).schema.add("_score", "double").add("_predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, len(cols)):
                s = model.score(batch.column(len(cols)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(cols)], pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                 [*cols, "_score", "_predicted"])

    return shape.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with their own columns."""
    plain, doc_id, text = W.positional(docs, doc_id, text)
    kept = score(plain, model, doc_id, text, threshold, keep=plain.columns).where("_predicted = 1")
    return kept.select(*plain.columns).toDF(*docs.columns)
