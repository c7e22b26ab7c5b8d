import re
from collections import Counter, defaultdict

import pytest

from pricegrid.llm import divergence as D


def brute(rows, min_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = [("".join(c.lower() if "A" <= c <= "Z" else c for c in t), g, s) for t, g, s in rows]
    terms = [(g, s, re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t)) for t, g, s in lower]
    groups, out = defaultdict(set), []
    for g, s, _ in terms:
        groups[g].add(s)
    for g, sources in groups.items():
        docs = Counter(w for x, _, ws in terms if x == g for w in set(ws))
        kept = {w for w, n in docs.items() if n >= min_docs}
        counts = {s: Counter(w for x, y, ws in terms if (x, y) == (g, s) for w in ws if w in kept) for s in sources}
        whole = sum(counts.values(), Counter())
        share = lambda c, w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept))
        for s in sources:
            pairs = sorted((-sum(abs(share(counts[s], w) - share(counts[o], w)) for w in kept), o.encode(), o) for o in sources - {s})
            out += [(g, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            over = sorted((share(whole, w) - share(counts[s], w), w.encode(), w) for w in kept if counts[s][w] and share(counts[s], w) > share(whole, w))
            out += [(g, s, "term", w, -v, i + 1) for i, (v, _, w) in enumerate(over[:top])]
    return sorted(out)


@pytest.fixture()
def table(spark):
    def make(rows):
        return spark.createDataFrame([(7, *r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, term string, n int")
    return make


def rows_of(writing):
    rows = [(writing(3 + i % 30, i) + " Ünï-Ä the2THE_of", f"l{i % 2}", f"s{i % 5}") for i in range(200)]
    return rows + [(None, "l0", "s9"), ("", "l0", None), ("lone word", "l7", "s0"), ("", "l8", "a"), (None, "l8", "b"), (None, None, None), rows[0], rows[0]]


def got(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def test_against_brute_force(table, writing):
    rows = rows_of(writing)
    assert got(D.audit(table(rows), min_docs=4, top=6)) == brute(rows, 4, 6)


def test_small_blocks_shards_and_merges_change_nothing(table, writing, monkeypatch):
    """Sources in blocks of 2, terms in shards of 16, partial counts given out early."""
    rows = rows_of(writing)
    want = brute(rows, 4, 6)
    for name, value in (("SOURCES", 2), ("TERMS", 16), ("HELD", 40)):
        monkeypatch.setattr(D, name, value)
    distances, counted = D._distances, D._counted

    def small(groups, cells):  # the workers import the module anew
        D.SOURCES = 2
        return distances(groups, cells)

    def early(batches):
        D.HELD = 40
        return counted(batches)
    monkeypatch.setattr(D, "_distances", small)
    monkeypatch.setattr(D, "_counted", early)
    assert got(D.audit(table(rows).repartition(5), min_docs=4, top=6)) == want


def test_share_of_counts_beyond_long_products(spark):
    rows = spark.createDataFrame([(10**13, 3 * 10**14, 10**6), (0, 0, 1), (7, 7, 1)], "c long, n long, v long")
    found = [r[0] for r in rows.select(D.share(rows.c, rows.n, rows.v)).collect()]
    assert found == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in [(10**13, 3 * 10**14, 10**6), (0, 0, 1), (7, 7, 1)]]


def test_long_text_and_empty_table(table):
    assert got(D.audit(table([("of the " * 200_000, "en", "a"), ("the", "en", "b")]), min_docs=1)) == brute([("of the " * 200_000, "en", "a"), ("the", "en", "b")], 1, 50)
    assert D.audit(table([])).count() == 0
