import hashlib
import re
from collections import defaultdict

from pricegrid.llm import exact_dedup as X


def brute(rows):
    flat = [re.sub("[ \t-\r]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), t in zip(rows, flat):
        groups[t].append(i)
    out = []
    for (i, _), t in zip(rows, flat):
        ids = [x for x in groups[t] if x is not None]
        out.append((i, min(ids) if ids else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def test_blocks_and_rounds_against_brute_force(docs, writing):
    long = writing(9000, 1)  # many blocks, several rounds
    rows = [(1, long), (2, long + "x"), (3, long.replace(" ", "\n \t", 50)), (4, "x" + long), (5, long[:X.BLOCK]), (6, long[:2 * X.BLOCK]),
            (7, long[:X.BLOCK] * 3), (8, long[:X.BLOCK] * 4), (9, long[:X.BLOCK] * 3), (10, "a b"), (11, "a  b"), (12, "a b "),
            (13, None), (14, ""), (15, " "), (16, " "), (17, "é" * 5000), (18, "é" * 5000), (None, "a b"), (None, "only"), (10, "a\tb"), (10, "other")]
    found = X.groups(docs(rows))
    assert got(found) == brute(rows)
    kept = [(r.keep_id, r.text_sha256) for r in found.where("kept").collect()]
    assert len(kept) == len(set(kept)) == len({t for *_, t in brute(rows)})


def test_every_task_layout_gives_the_same_groups(docs, writing):
    rows = [(i, writing(3 + i % 40, i % 60)) for i in range(300)]
    assert got(X.groups(docs(rows).repartition(7))) == got(X.groups(docs(rows).coalesce(1))) == brute(rows)


def test_deduplicate_keeps_columns_and_one_of_repeated_rows(docs):
    df = docs([(2, "a b"), (1, "a\nb"), (1, "a\nb"), (3, None), (4, ""), (1, "c"), (None, "n")])
    out = X.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, "a\nb"), (1, "c"), (3, None), (None, "n")], key=str)


def test_empty_table(docs):
    assert X.groups(docs([])).count() == 0
    assert X.deduplicate(docs([])).count() == 0


def test_a_block_of_a_third_of_the_rows_is_numbered_once_a_window(docs, writing, monkeypatch):
    """The rows dealt by block are the distinct blocks of each task's windows, not the documents."""
    tables = {}
    cut = X.cut_lineage

    def kept(df, name):
        written = cut(df, name)
        tables.setdefault(name, written)  # of the rounds of pairs the first
        return written

    monkeypatch.setattr(X, "cut_lineage", kept)
    long = writing(2500, 7)
    rows = [(i, long if i % 3 == 0 else writing(5, i)) for i in range(900)]
    found = X.groups(docs(rows).repartition(4))
    assert got(found) == brute(rows)
    blocks = -(-len(long) // X.BLOCK)
    dealt, places = tables["blocks_rows"], tables["blocks"]
    assert places.count() == 600 + 300 * blocks and dealt.count() <= 600 + 4 * blocks
    assert tables["pairs_rows"].count() <= 4 * 8 * blocks  # one a task and pair, not 300
