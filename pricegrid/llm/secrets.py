"""Secret scan: fixed patterns plus a battery of randomness tests.

Patterns (kinds ``assign``, ``access``, ``hex``) find the well-known forms. Beyond
them every run of 16 or more of ``[A-Za-z0-9+/_-]``, with closing ``=``, is a candidate;
of a run that no alphabet holds (``+`` or ``/`` beside ``-`` or ``_``) it is the parts that
base64 or base64url hold. Its encoding is the smallest of ``ALPHABETS`` that holds it,
and three tests ask whether it could be
random text in that encoding: chi-squared uniformity of the alphabet, the runs test
about the alphabet's middle, and lag-1 serial correlation. One that any test rejects
(Bonferroni, level ``REJECT``) is no secret.

The others get a p-value against the opposite hypothesis, ordinary writing. With
``q`` the frequency of each character in the whole corpus (letters of either case
together) and ``u`` the uniform distribution, ``prod(q/u)`` over the token bounds the
probability that writing looks this uniform (Markov's inequality on the likelihood
ratio), and shrinks with length. Within each length class the Benjamini-Hochberg
step holds the share of false alarms at ``FDR`` over all candidates of the corpus.
It works on p-values rounded up to ``BINS_PER_NAT`` steps, so what reaches the driver
is one count per class and bin, whatever the corpus.

``fit`` makes two passes of counting; ``scan`` and ``redact`` are narrow passes
over whole texts.

Edge cases: null text is empty (no span); offsets are code points, end exclusive; a
candidate inside a pattern's span adds nothing; runs of digits alone are never
secrets of this kind; repeated rows are scanned each; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.llm import words as W
from pricegrid.session import cut_lineage

FDR = 0.001
REJECT = 0.001
BINS_PER_NAT, MOST_NATS = 4, 200
LENGTH_CLASSES = (16, 20, 24, 32, 48, 64)  # least lengths
MASK = "[SECRET]"

Batches = Iterator[pa.RecordBatch]

#: Fixed patterns: kind, expression, least length and the group it holds for.
PATTERNS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 8, 2),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 16, 0),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 32, 0),  # the runs [0-9a-f]+ that are long enough
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:=++(?![A-Za-z0-9+/_-]))?")
PARTS = (re.compile(r"[A-Za-z0-9+/]{16,}=*"), re.compile(r"[A-Za-z0-9_-]{16,}=*"))

_LOW, _UP, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Fixed alphabets of encodings, smallest first.
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UP + "234567",
    "base36": _DIGITS + _LOW,
    "BASE36": _DIGITS + _UP,
    "base62": _UP + _LOW + _DIGITS,
    "base64": _UP + _LOW + _DIGITS + "+/",
    "base64url": _UP + _LOW + _DIGITS + "-_",
}
_CODES = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}
_SETS = [(name, frozenset(a)) for name, a in ALPHABETS.items()]


def encoding(token: str) -> str | None:
    """The smallest alphabet that holds the token (without padding ``=``)."""
    if token.isdigit():
        return None
    used = set(token)
    return next((name for name, alphabet in _SETS if used <= alphabet), None)


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each candidate, by start. Parts of one run can overlap."""
    for m in CANDIDATE.finditer(text):
        if any(part.fullmatch(m[0]) for part in PARTS):
            yield m.span()
        else:
            yield from sorted({(m.start() + p.start(), m.start() + p.end()) for part in PARTS for p in part.finditer(m[0])})


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str, name: str) -> tuple[float, float, float]:
    """p-values of chi-squared uniformity, runs and serial correlation, under the
    hypothesis of random text in that encoding."""
    codes, k, n = _CODES[name], len(ALPHABETS[name]), len(token)
    x = [codes[c] for c in token]
    stat = k / n * sum(c * c for c in Counter(x).values()) - n
    uniform = 0.5 * math.erfc((stat - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n) / math.sqrt(2))
    high = [c * 2 >= k for c in x]
    a = sum(high)
    b = n - a
    if not a or not b:
        runs = 2.0 ** (1 - n)
    else:
        found = 1 + sum(p != q for p, q in zip(high, high[1:]))
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs = _two_sided((found - mean) / math.sqrt(var)) if var > 0 else 1.0
    mid = sum(x) / n
    spread = sum((c - mid) ** 2 for c in x)
    r = sum((p - mid) * (q - mid) for p, q in zip(x, x[1:])) / spread if spread else 1.0
    return uniform, runs, _two_sided((r + 1 / n) * math.sqrt(n))


def length_class(n: int) -> int:
    return sum(n >= least for least in LENGTH_CLASSES) - 1


@dataclass
class Detector:
    """What the corpus teaches: nats of each character in ordinary writing, and
    the least evidence (in bins) that counts in each length class."""

    cost: dict[str, float]  # -ln q, for A-Z and a-z alike
    least: dict[int, int]

    def evidence(self, token: str) -> tuple[int, int] | None:
        """Length class and evidence in bins, rounded down; None if not random."""
        token = token.rstrip("=")
        name = encoding(token) if len(token) >= LENGTH_CLASSES[0] else None
        if name is None:
            return None
        nats = sum(map(self.cost.__getitem__, token)) - len(token) * math.log(len(ALPHABETS[name]))
        if len(ALPHABETS[name]) >= 62:  # either case of a letter may stand in writing
            nats += math.log(2) * sum(map(str.isalpha, token))
        if nats <= 0 or min(battery(token, name)) * 3 < REJECT:
            return None
        return length_class(len(token)), int(min(nats, MOST_NATS) * BINS_PER_NAT)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then kind as listed, ``random`` last."""
        found = []
        for order, (kind, pattern, least, group) in enumerate(PATTERNS):
            for m in pattern.finditer(text):
                if m.end(group) - m.start(group) >= least:
                    found.append((m.start(), order, kind, m.end()))
        random: list[tuple[int, int]] = []
        base, at, reach = sorted(found), 0, 0  # reach: where the furthest base span that starts by now ends
        for start, end in candidates(text):
            while at < len(base) and base[at][0] <= start:
                reach, at = max(reach, base[at][3]), at + 1
            if end <= reach:
                continue
            if (e := self.evidence(text[start:end])) and e[1] >= self.least.get(e[0], MOST_NATS * BINS_PER_NAT + 1):
                if random and start < random[-1][1]:  # overlapping parts are one span
                    start, end = random[-1][0], max(end, random.pop()[1])
                random.append((start, end))
        found.extend((start, len(PATTERNS), "random", end) for start, end in random)
        return [(kind, start, end) for start, _, kind, end in sorted(found)]


_COUNTED = _LOW + _DIGITS + "+/_-="


def _candidates(batches: Batches) -> Batches:
    """Texts to candidate tokens; the first row of each batch has its character counts."""
    for whole in batches:
        for batch in W.slices(whole, 0):
            counts, tokens = np.zeros(256, np.int64), []
            for text in batch.column(0):
                text = text.as_py()
                counts += np.bincount(np.frombuffer(text.encode().lower(), np.uint8), minlength=256)
                tokens.extend(text[a:b] for a, b in candidates(text))
            letters = [counts[[ord(c) for c in _COUNTED]].tolist()] + [None] * len(tokens)
            yield pa.RecordBatch.from_arrays([pa.array([None, *tokens], pa.string()), pa.array(letters, pa.list_(pa.int64()))], ["token", "counts"])


def _evidence(detector: Detector) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = Counter()
            for token in batch.column(0).to_pylist():
                found[detector.evidence(token) or (length_class(len(token)), 0)] += 1
            rows = [(c, b, n) for (c, b), n in found.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["length_class", "bin", "n"])
    return run


def fit(docs: DataFrame, text: str = "text", fdr: float = FDR) -> Detector:
    """Character costs and thresholds from all texts."""
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")))
    found = cut_lineage(rows.mapInArrow(_candidates, "token string, counts array<long>"), "candidates")
    sums = {r["pos"]: r["n"] for r in found.where("counts is not null").select(F.posexplode("counts"))
            .groupBy("pos").agg(F.sum("col").alias("n")).collect()}  # a row for each counted character
    total = sum(sums.values()) + len(_COUNTED)
    cost = {c: -math.log((sums.get(i, 0) + 1) / total) for i, c in enumerate(_COUNTED)}
    cost |= {c.upper(): cost[c] for c in _LOW}
    detector = Detector(cost, {})
    bins = (found.where("token is not null").select("token")
            .mapInArrow(_evidence(detector), "length_class long, bin long, n long")
            .groupBy("length_class", "bin").agg(F.sum("n").alias("n")).collect())  # at most 6 * 801 rows
    for k in range(len(LENGTH_CLASSES)):
        mine = sorted(((r["bin"], r["n"]) for r in bins if r["length_class"] == k), reverse=True)
        tested, seen = sum(n for _, n in mine), 0
        for b, n in mine:  # Benjamini-Hochberg: the last bin whose p is under fdr * rank / tests
            seen += n
            if b and math.exp(-b / BINS_PER_NAT) <= fdr * seen / tested:
                detector.least[k] = b
    return detector


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _scanned(detector: Detector) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in W.slices(whole, 1):
                rows = []
                for text in batch.column(1):
                    spans = detector.spans(text.as_py())
                    kinds = Counter(kind for kind, _, _ in spans)
                    base = _joined([s for s in spans if s[0] != "random"])
                    rows.append((kinds["assign"], kinds["access"], kinds["hex"], kinds["random"],
                                 hashlib.sha256(base.encode()).hexdigest(), _joined(spans)))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()] * 2)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns],
                                                 ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])
    return run


def scan(docs: DataFrame, detector: Detector, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, spans found per kind, digest of the pattern spans, all spans."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_scanned(detector), "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")


def _masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, detector: Detector, text: str = "text") -> DataFrame:
    """``docs`` with every span, or run of overlapping spans, replaced by ``MASK``;
    null texts stay null."""
    at = docs.columns.index(text)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = [t and _masked(t, detector.spans(t)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, text, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
