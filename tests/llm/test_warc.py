import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pricegrid.llm import warc as X

SCHEMA = "record_id long, kind string, uri string, date timestamp, status int, headers map<string,string>, digest string, full string"
T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture()
def records(spark):
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def at(n):
    return T0 + timedelta(seconds=n)


def brute(rows):
    out = []
    for i, kind, uri, date, _, headers, _ in rows:
        if kind != "revisit":
            continue
        mine = {k.lower(): v for k, v in sorted((headers or {}).items())}
        before = [r for r in rows if r[1] == "response" and r[4] == 200 and uri and date and r[2] == uri and r[3] and (r[3], r[0]) < (date, i)]
        if not before:
            out.append((i, "missing", None, None))
            continue
        best = max(before, key=lambda r: (r[3], r[0]))
        its = {k.lower(): v for k, v in sorted((best[5] or {}).items())}
        weak = lambda t: t[2:] if t.startswith("W/") else t
        if "etag" in mine and "etag" in its:
            agrees = weak(mine["etag"]) == weak(its["etag"])
        elif "last-modified" in mine and "last-modified" in its:
            agrees = mine["last-modified"] == its["last-modified"]
        else:
            agrees = None
        merged = its | {k: v for k, v in mine.items() if k in X.PERMITTED} if agrees else None
        out.append((i, {True: "resolved", False: "mismatch", None: "unverified"}[agrees], best[0], merged))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.record_id, r.state, r.source_id, r.headers) for r in X.resolve(df).collect()), key=str)


def test_against_brute_force_with_a_hot_url(records, spark):
    rng, rows = random.Random(1), []
    for i in range(600):
        kind = "response" if rng.random() < 0.3 else "revisit"
        headers = {k: rng.choice(v) for k, v in {"ETag": ['"a"', 'W/"a"', '"b"'], "Last-Modified": ["1", "2"], "Date": ["d1", "d2"], "Content-Length": ["0", "9"]}.items() if rng.random() < 0.7}
        uri = "hot.org/x" if rng.random() < 0.4 else f"h{rng.randrange(40)}.org/p"
        rows.append((i, kind, uri, at(rng.randrange(200)), 200 if rng.random() < 0.9 else 404, headers or None, f"s{i}"))
    rows += [(1000, "revisit", None, at(5), 304, {"ETag": '"a"'}, None), (1001, "revisit", "hot.org/x", None, 304, None, None), (1002, "revisit", "hot.org/x", at(9999), 304, {"etag": '"a"', "ETAG": '"b"'}, None)]
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the hot url spans partitions
    try:
        assert got(records(rows)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)


def test_repeated_revisits_and_digest(records):
    rows = [(1, "response", "a.org/", at(1), 200, {"ETag": '"x"', "Content-Type": "t"}, "sha")] + [(2, "revisit", "http://WWW.a.org:80/#f", at(2), 304, {"ETag": 'W/"x"', "Expires": "e", "Content-Length": "0"}, None)] * 2
    found = X.resolve(records(rows)).collect()
    assert [(r.state, r.source_id, r.digest, r.headers) for r in found] == [("resolved", 1, "sha", {"etag": 'W/"x"', "content-type": "t", "expires": "e"})] * 2


def test_canonical(spark):
    cases = {"HTTP://WWW.Example.org:443/A/?b=1&utm_source=x&a=2#f": "example.org/A?b=1&a=2", "https://e.org": "e.org", "e.org/?": "e.org", "ftp://e.org/x//": "e.org/x/",
             "http://e.org?utm_a=1": "e.org", "": "", None: None}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.c for r in df.select("u", X.canonical(F.col("u")).alias("c")).collect()} == cases


def test_empty_table(records):
    assert X.resolve(records([])).count() == 0
