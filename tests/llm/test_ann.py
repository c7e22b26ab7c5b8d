import numpy as np
import pytest

from pricegrid.llm import ann as X


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, code int")


def brute(rows, queries, k=X.K):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i in queries:
            scored = sorted((-(w @ v) / np.sqrt((w @ w) * (v @ v)), j) for j, w in good if j != i)[:k]
            out[i] = [(j, -s) for s, j in scored]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def vectors(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return [(i, (centres[i % 12] * (i % 3) + rng.normal(size=dims)).tolist()) for i in range(n)]


def test_recall_and_scores(table):
    rows = vectors(1500, 64)
    df = table(rows)
    found, want = got(X.nearest(df, df.where("vec_id % 50 = 0"))), brute(rows, set(range(0, 1500, 50)))
    hits = [len({j for j, _ in found[q]} & {j for j, _ in want[q]}) for q in want]
    assert set(found) == set(want) and sum(hits) >= 0.95 * 5 * len(want)
    assert all(len(f) == 5 for f in found.values())
    exact = {q: dict(brute(rows, {q}, len(rows))[q]) for q in list(want)[:5]}
    assert all(abs(exact[q][j] - s) < 1e-12 for q in exact for j, s in found[q])


def test_radius_of_the_whole_code_is_exact(table, monkeypatch):
    monkeypatch.setattr(X, "CELL_ROWS", 60)
    monkeypatch.setattr(X, "CELL_QUERIES", 7)
    rows = vectors(400, 40, 1)
    df = table(rows)
    found, want = got(X.nearest(df, df.where("vec_id % 10 = 0"), radius=64)), brute(rows, set(range(0, 400, 10)))
    assert {q: [j for j, _ in v] for q, v in found.items()} == {q: [j for j, _ in v] for q, v in want.items()}


def test_copies_ties_and_rows_that_take_no_part(table):
    one, two = [1.0, 2.0, 3.0, 4.0], [4.0, -1.0, 0.5, 2.0]
    rows = [(i, one) for i in range(0, 40)] + [(i, two) for i in range(40, 43)]
    bad = [(50, None), (100, [0.0] * 4), (150, [1.0, None, 2.0, 3.0]), (200, [float("nan")] * 4), (250, [float("inf"), 1.0, 1.0, 1.0]), (300, [1.0]), (350, [])]
    df = table(rows + bad)
    found = got(X.nearest(df, df))
    assert set(found) == set(range(43))
    want = brute(rows, set(range(43)))
    assert {q: [j for j, _ in v] for q, v in found.items()} == {q: [j for j, _ in v] for q, v in want.items()}


def test_few_and_no_candidates(table):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.3, 1.0])]
    df = table(rows)
    assert {q: [j for j, _ in v] for q, v in got(X.nearest(df, df)).items()} == {q: [j for j, _ in v] for q, v in brute(rows, {0, 1, 2}).items()}
    assert X.nearest(table([(0, [1.0, 0.0])]), table([(0, [1.0, 0.0])])).count() == 0
    empty = table([])
    assert X.nearest(empty, empty).columns == ["query_id", "rank", "vec_id", "score"] and X.nearest(empty, empty).count() == 0


def test_a_row_repeated_seven_times_counts_once(table):
    one = [1.0, 2.0, 3.0, 4.0]
    df = table([(0, one)] * 7 + [(i, one) for i in range(1, 10)] + [(50, one)] * 2 + vectors(30, 4, 2)[20:])
    found = got(X.nearest(df, df.where("vec_id % 50 = 0")))
    assert [j for j, _ in found[0]] == [1, 2, 3, 4, 5] and [j for j, _ in found[50]] == [0, 1, 2, 3, 4]


def clustered(n, dims, seed=4):
    """Tight clusters of 20 around far points, all moved by one long vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 20, dims)) + 0.5
    return [(i, (centres[i // 20] + 0.1 * rng.normal(size=dims)).tolist()) for i in range(n)]


def test_queries_in_tight_clusters_are_closed_by_look_ups(table, monkeypatch):
    rows = clustered(2000, 64) + [(2000 + i, v) for i, v in vectors(100, 64, 5)]
    df, open_ = table(rows), []
    wide = X._wide
    monkeypatch.setattr(X, "_wide", lambda index, asked, *a: (open_.append(asked.count()), wide(index, asked, *a))[1])
    found, want = got(X.nearest(df, df.where("vec_id % 50 = 0"))), brute(rows, set(range(0, 2100, 50)))
    assert set(found) == set(want) and 2 <= open_[0] <= 12  # 42 queries, 2 of them outside the clusters
    hits = [len({j for j, _ in found[q]} & {j for j, _ in want[q]}) for q in want]
    assert sum(hits) >= 0.97 * 5 * len(want)
    exact = {q: dict(brute(rows, {q}, len(rows))[q]) for q in list(want)[:5]}
    assert all(abs(exact[q][j] - s) < 1e-12 for q in exact for j, s in found[q])


def test_rings_retrieve_every_code_within_the_distance_they_cover(spark):
    rng = np.random.default_rng(6)
    rows = clustered(300, 64, 7)
    rotation = X.learn(np.array([v for _, v in rows]))
    codes = rotation.codes(np.array([v for _, v in rows]))
    flips = [int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 14), replace=False))) for _ in rows]
    codes = np.array([int(c) ^ f for c, f in zip(codes[np.arange(300) // 20 * 20], flips)], np.uint64)
    df = spark.createDataFrame([(i, i, v, int(c), 0.0) for (i, v), c in zip(rows, codes.view(np.int64))],
                               "vec_id long, rid long, vector array<double>, code long, along double")
    got = {e: {(r.query_id, r.vec_id) for r in X._look_up(df, df, rotation, e, 11).collect()} for e in range(3)}
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    parts = np.stack([np.bitwise_count((codes[:, None] ^ codes[None, :]) >> np.uint64(16 * j) & np.uint64(65535)) for j in range(4)])
    off = ~np.eye(300, dtype=bool)
    for e in range(3):
        assert got[e] == {(int(a), int(b)) for a, b in np.argwhere((parts == e).any(0) & (apart <= 11) & off)}
    within = {(int(a), int(b)) for a, b in np.argwhere((apart <= 11) & off)}
    assert got[0] | got[1] | got[2] == within and len(within) > 1000
