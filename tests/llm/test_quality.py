import zlib

import numpy as np
import pyarrow as pa
import pytest

from pricegrid.llm import quality as X


def corpus(writing, n=500):
    rows, labels = [], []
    for i in range(n):
        text, bad = writing(40 + i % 50, i), i % 4 == 0
        if bad:
            words = text.split()
            text = (" ".join(w + "***" for w in words) if i % 8 else " ".join([words[0]] * 60)) if i % 3 else text.upper().replace(" ", "!! ")
        rows.append((i, text))
        labels.append((i, int(not bad)))
    return rows, labels


@pytest.fixture(scope="module")
def labelled(spark):
    return lambda labels: spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(docs, labelled, writing):
    rows, labels = corpus(writing)
    df = docs(rows)
    model = X.fit(df, labelled(labels))
    scored = {r.doc_id: r for r in X.score(df, model).withColumn("held", X.held_out()).collect()}
    assert all(r.held == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in scored.items())
    held = [i for i, r in scored.items() if r.held]
    assert np.mean([scored[i]._predicted == labels[i][1] for i in held]) >= 0.95
    assert all(0 <= r._score <= 1 and r._predicted == (r._score >= X.THRESHOLD) for r in scored.values())


def test_held_out_labels_teach_nothing(docs, labelled, writing):
    rows, labels = corpus(writing, 200)
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    a, b = X.fit(docs(rows), labelled(labels)), X.fit(docs(rows), labelled(other))
    assert a.bias == b.bias and np.array_equal(a.weights, b.weights)


def test_ftrl_against_plain_loops():
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 16, 5)), None, int(rng.integers(0, 2))) for _ in range(40)]
    rows = [(i, rng.random(len(i)), y) for i, _, y in rows]
    ones = sum(y for *_, y in rows)
    z, n = [0.0] * 17, [0.0] * 17

    def w(i):
        if abs(z[i]) <= X.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * X.L1) / ((X.BETA + n[i] ** 0.5) / X.ALPHA + X.L2)

    for _ in range(2):
        for index, value, y in rows:
            at, x = [*index, 16], [*value, 1.0]
            now = [w(i) for i in at]
            g = (1 / (1 + np.exp(-sum(a * b for a, b in zip(now, x)))) - y) * len(rows) / (2 * (ones if y else len(rows) - ones))
            for i, v, old in zip(at, x, now):
                s = ((n[i] + (g * v) ** 2) ** 0.5 - n[i] ** 0.5) / X.ALPHA
                z[i] += g * v - s * old
                n[i] += (g * v) ** 2
    model = X.ftrl(rows, bits=4, epochs=2)
    assert np.allclose([*model.weights, model.bias], [w(i) for i in range(17)], atol=1e-6)


def test_scores_do_not_depend_on_the_batch(docs, writing):
    model = X.Model(np.random.default_rng(2).normal(size=1 << 12).astype(np.float32), 0.1)
    texts = [writing(30 + i, i) for i in range(30)] + ["", None, "one", "\n a\tb "]
    one = [model.score(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(model.score(pa.array(texts)), one)
    assert one[30] == one[31] == pytest.approx(1 / (1 + np.exp(-0.1)))


def test_edge_cases(docs, labelled):
    none = X.fit(docs([(1, "a b")]), labelled([(1, None), (2, 7)]))
    assert {r._score for r in X.score(docs([(1, "a b"), (1, "a b"), (2, None)]), none).collect()} == {0.5}
    assert X.score(docs([]), none).count() == 0
    df = docs([(1, "a b"), (1, None)])
    assert X.accepted(df, none).columns == df.columns and X.accepted(df, none).count() == 2
    long = X.score(docs([(1, "word " * 200_000)]), none).first()
    assert long._predicted == 1


def test_the_sample_is_bounded_in_bytes(docs, labelled, writing):
    rows, labels = corpus(writing, 100)
    one = X.fit(docs(rows), labelled(labels), max_bytes=1)  # one row: one class, nothing to learn
    assert not one.weights.any() and X.fit(docs(rows), labelled(labels), max_bytes=1 << 30).weights.any()
