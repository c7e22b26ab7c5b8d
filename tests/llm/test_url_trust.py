import duckdb
import numpy as np
import pandas as pd

from pricegrid.llm import url_trust as X


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string")


def test_rules(spark):
    rows = [("http://a.com/x", "allow", "com/"), ("http://a.com", "allow", None), ("https://Example.COM/en/1", "block", "example.com/en/"),
            ("https://sub.example.com/en/1?q#f", "block", "example.com/en/"), ("https://www.example.com/en/1", "allow", "www.example.com/en/"),
            ("https://m.www.example.com/en/1", "allow", "www.example.com/en/"), ("http://x.net/es/1", "block", "net/es/"), ("http://x.net/es", None, None),
            ("http://notexample.com/en/", "allow", "com/"), ("nothing", "allow", None), (None, "allow", None), ("http://com/", "allow", "com/"),
            ("a://b://c.com/", "allow", None), ("http://É.com/", "allow", "com/"), ("http://x.net?a/es/", None, None), ("", "allow", None)]
    found = {r.page_id: r for r in X.judge(pages(spark, [(u, None) for u, *_ in rows])).collect()}
    assert len(found) == len(rows)
    for i, (u, verdict, rule) in enumerate(rows):
        assert found[i].rule == rule, u
        assert verdict is None or found[i].verdict == verdict, u
    assert (found[3].host, found[3].path) == ("sub.example.com", "/en/1") and (found[9].host, found[9].path) == ("", "")
    assert found[13].host == "É.com"


def graph():
    link = lambda *to: " ".join(f'<a href="{t}">x</a>' for t in to)
    return [("http://good.com/", link("http://friend.org/a", "//second.org/b", "/local")), ("http://friend.org/", link("https://second.org/")),
            ("http://second.org/", link("http://bad.net/es/")), ("http://bad.net/es/1", link("http://friend.org/")), ("http://bad.net/en/1", None),
            ("http://fan.org/", link("http://bad.net/es/1", "http://bad.net/", "mailto:x@y")), ("http://far.org/", link("http://fan.org/")),
            ("http://lonely.org/", "no links"), ("http://x.com/", link("HTTP://FRIEND.org:80/")), (None, link("http://bad.net")), ("http://y.org/", link("http://gone.org/"))]


def test_trust_follows_links_and_distrust_goes_back(spark):
    verdict = {r.host + r.path: r.verdict for r in X.judge(pages(spark, graph())).collect()}
    assert verdict["friend.org/"] == "allow" and verdict["second.org/"] == "allow" and verdict["lonely.org/"] == "allow"
    assert verdict["fan.org/"] == verdict["far.org/"] == verdict["bad.net/en/1"] == "block"


def test_against_sql(spark):
    rows = graph() * 2 + [("http://good.com/", "")] * 3
    got = sorted(map(str, X.judge(pages(spark, rows)).toPandas().astype(object).where(lambda d: d.notna(), None).to_dict("records")))
    con = duckdb.connect()
    con.register("pages", pd.DataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], columns=["page_id", "url", "html"]))
    want = con.execute(X.oracle_sql()).df()[["page_id", "host", "path", "rule", "verdict"]]
    want = want.astype(object).where(lambda d: d.notna(), None)
    assert got == sorted(map(str, want.to_dict("records")))


def test_a_small_share_of_distrust_decides_as_a_large_one(spark):
    """Four steps back from one blocked page of a thousand, each among 400 hosts that link."""
    link = lambda to: f'<a href="http://{to}/">x</a>'
    rows = [("http://big.net/es/", None)] * 999 + [("http://b0.net/es/", None)]
    for step in range(4):
        rows += [(f"http://{'b' if k == 0 else 'c' + str(k) + 'b'}{step + 1}.net/", link(f"b{step}.net")) for k in range(400)]
    verdict = {r.host: r.verdict for r in X.judge(pages(spark, rows)).where("rule is null").collect()}
    assert len(verdict) == 1600 and set(verdict.values()) == {"block"}


def test_scores_against_a_dense_solve(spark):
    """A chain of 30 hosts that leads to a blocked one, a ring, and hosts without links in or out."""
    links = [(k, k + 1, 1) for k in range(30)] + [(31, 32, 2), (32, 33, 1), (33, 31, 1), (33, 34, 3), (35, 31, 1), (35, 5, 1), (20, 36, 1), (32, 30, 1)]
    n, starts = 37, {35: (0.75, 0.0), 0: (0.25, 0.0), 30: (0.0, 0.5), 34: (0.0, 0.5)}
    found = {int(r.host): (r.trust, r.distrust) for r in X.propagate(
        spark.createDataFrame([(str(h), *v) for h, v in starts.items()], "host string, trust0 double, distrust0 double"),
        spark.createDataFrame([(str(a), str(b), w) for a, b, w in links], "src string, dst string, pages long")).collect()}
    weights = np.zeros((n, n))
    for a, b, w in links:
        weights[a, b] = w
    for side, w in enumerate((weights, weights.T)):
        seed = np.array([starts.get(h, (0.0, 0.0))[side] for h in range(n)])
        moves = np.array([row / row.sum() if row.sum() else seed for row in w])  # without links: back to the seeds
        want = np.linalg.solve(np.eye(n) - X.DAMPING * moves.T, (1 - X.DAMPING) * seed)
        got = np.array([found[h][side] for h in range(n)])
        assert np.allclose(got, want, rtol=1e-9, atol=0)
        assert np.isclose(got.sum(), 1)
    assert found[0][1] > 0  # 30 links from the next blocked host


def test_long_ways_against_sql(spark):
    """Chains of 30 hosts, rings and random links, with hosts that only one side reaches."""
    rng, link = np.random.default_rng(3), lambda to: f'<a href="http://{to}/">x</a>'
    name = lambda k: f"h{k}." + ("com" if k % 9 == 0 else "net" if k % 2 else "org")
    rows = [(f"http://{name(k)}/" + ("fr/" if k in (29, 61) else ""), link(name(k + 1)) if k not in (29, 59) else None) for k in range(90)]
    rows += [(f"http://{name(a)}/", link(name(b)) * 2) for a, b in rng.integers(30, 140, (160, 2)).tolist()]
    got = {r.page_id: r.verdict for r in X.judge(pages(spark, rows)).collect()}
    con = duckdb.connect()
    con.register("pages", pd.DataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], columns=["page_id", "url", "html"]))
    want = dict(con.execute(f"SELECT page_id, verdict FROM ({X.oracle_sql()})").fetchall())
    assert got == want and 30 < sum(v == "block" for v in want.values()) < len(rows) - 30


def test_html_is_parsed_once(spark, monkeypatch):
    plans = []
    cut = X.cut_lineage
    monkeypatch.setattr(X, "cut_lineage", lambda df, name: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), cut(df, name))[1])
    X.judge(pages(spark, graph()))
    assert [n for n, p in plans if "regexp_extract_all" in p] == ["links"]


def test_empty_table(spark):
    assert X.judge(pages(spark, [])).count() == 0
