import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pricegrid.llm import graph
from pricegrid.llm import near_dedup as X


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*(words[k:] for k in range(n)))) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute(rows, n=2, percent=80):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        members[find(i)].append(d)
    low = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return sorted(((d, len(s), low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(text, changes, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("words", [2, 5])
def test_families_against_brute_force(docs, writing, words):
    rows = []
    for f in range(6):
        base = writing(120, f)
        rows += [(len(rows) + k, edited(base, k, 100 * f + k)) for k in range(14)]
    rows += [(900 + k, writing(40, 900 + k)) for k in range(20)]
    assert got(X.near_duplicates(docs(rows), words=words)) == brute(rows, words)


def test_a_family_just_under_the_threshold_makes_rows_in_proportion(docs, writing, monkeypatch):
    """200 texts about 0.77 alike, where nearly all pairs meet: neither pairs looked at
    between tasks nor links given out grow with their number."""
    base = writing(300, 77)
    rows = [(k, edited(base, 20, 500 + k)) for k in range(200)]
    made, cut = defaultdict(int), X.cut_lineage

    def counted(df, name):
        out = cut(df, name)
        made[name] += out.count()
        return out

    monkeypatch.setattr(X, "cut_lineage", counted)
    exact = got(X.near_duplicates(docs(rows), sigmas=None))
    assert exact == brute(rows) == got(X.near_duplicates(docs(rows)))
    n = len(rows)
    assert made["links"] <= 2 * n and made["joined"] <= 2 * n and made["needed"] <= 2 * X.CHUNKS * X.WIDTH * n


def test_heavy_buckets_are_dealt_block_against_block(docs, writing, monkeypatch):
    monkeypatch.setattr(X, "BLOCK_ROWS", 5)
    monkeypatch.setattr(X, "BLOCK_BYTES", 4000)
    base = writing(150, 78)
    rows = [(k, edited(base, 3 + k % 9, 900 + k)) for k in range(60)]
    assert got(X.near_duplicates(docs(rows))) == brute(rows)


def test_chains_that_need_several_leaders(docs, writing):
    """Neighbours in the chain are linked, ends are far apart."""
    words, rows = writing(200, 5).split(), []
    for k in range(40):
        rows.append((1000 - k, " ".join(words)))
        for i in range(4):
            words[(k * 4 + i) % 200] = f"n{k}x{i}"
    assert got(X.near_duplicates(docs(rows))) == brute(rows)


def test_edge_cases(docs):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "word"), (5, "WORD"), (6, "a b"), (7, "A  B"), (8, "É b"), (9, "é b"), (10, "a\x0bb"),
            (None, "a b"), (None, "lonely row"), (6, "some other text"), (6, "a b"), (11, "x " * 30_000), (12, "x x")]
    assert got(X.near_duplicates(docs(rows))) == brute(rows)
    assert X.near_duplicates(docs([])).count() == 0


def test_deduplicate(docs, writing):
    base = writing(100, 3)
    df = docs([(5, base), (6, edited(base, 1, 1)), (7, "other text here"), (8, None)])
    out = X.deduplicate(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [5, 7, 8]


def test_deduplicate_keeps_one_row_of_each_component_whatever_its_ids(docs, writing):
    a, b, c, d, e = (writing(100, 40 + k) for k in range(5))
    near = lambda t, k: edited(t, 1, k)
    rows = [(5, a), (None, near(a, 1)), (None, "unique and clean"),  # a null id goes, another one's text stays
            (7, b), (9, near(b, 2)), (9, "text of its own"),  # the same with a repeated id
            (11, c), (11, near(c, 3)), (None, d), (None, near(d, 4)),  # near copies under one id
            (13, e), (13, e), (13, e), (None, None), (None, None)]
    df = docs(rows)
    out = X.deduplicate(df)
    stay = [(r.doc_id, r.text) for r in out.collect()]
    assert out.columns == df.columns and len(stay) == 9
    assert all(r in stay for r in [(5, a), (None, "unique and clean"), (7, b), (9, "text of its own"), (13, e)])
    assert stay.count((13, e)) == 1 and stay.count((None, None)) == 2
    assert len({(11, c), (11, near(c, 3))} & set(stay)) == len({(None, d), (None, near(d, 4))} & set(stay)) == 1
    assert X.near_duplicates(df).where("kept").count() == 9


def test_equal_texts_have_equal_sets_wherever_they_stand(writing):
    text = pa.array([writing(50, i % 7) for i in range(4000)])
    whole = X.shingle_sets(text)
    part = X.shingle_sets(text.slice(2900, 60))
    assert all(np.array_equal(a, b) for a, b in zip(whole[2900:], part))


def test_pigeonhole_guarantee():
    """Signatures up to 2 * CHUNKS - 1 values apart share a key, however the errors lie."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (200, X.CHUNKS * X.WIDTH)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(len(row), 2 * X.CHUNKS - 1, replace=False)] ^= 1
    keys = lambda m: next(iter(X._keys(iter([pa.RecordBatch.from_arrays([pa.array(range(len(m))), pa.array([r.tobytes() for r in m])], ["c", "s"])])))).column(0).to_numpy().reshape(len(m), -1)
    assert all(set(x) & set(y) for x, y in zip(keys(a), keys(b)))


def test_components_against_brute_force(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    alone = {u for u, v in edges if u == v} - {x for u, v in edges if u != v for x in (u, v)}
    found = {r.id: r.comp for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: r for x, r in root.items() if x not in alone}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_columns_named_like_inner_ones_stay(docs, writing):
    from pyspark.sql import functions as F

    from pricegrid.llm import exact_dedup, quality
    text = writing(60, 1)
    df = docs([(1, text), (2, text + " x"), (3, writing(50, 2)), (2, text + " x")]).select(
        "*", *(F.lit(i).alias(c) for i, c in enumerate(["_sha", "_gone", "_one", "_nth", "_id", "_score", "c0", "cid", "mark", "row"])))
    want = {c: i for i, c in enumerate(["_sha", "_gone", "_one", "_nth", "_id", "_score", "c0", "cid", "mark", "row"])}
    model = quality.ftrl([], 8)
    for out, ids in ((X.deduplicate(df), [1, 3]), (exact_dedup.deduplicate(df), [1, 2, 3]), (quality.accepted(df, model), [1, 2, 2, 3])):
        rows = out.collect()
        assert out.columns == df.columns and sorted(r.doc_id for r in rows) == ids
        assert all(r[c] == i for r in rows for c, i in want.items())
