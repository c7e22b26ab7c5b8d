import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pricegrid.llm import contamination as C


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, window=10):
    windows = set()
    for item, t in items:
        ws = words(t)
        n = min(window, len(ws))
        windows |= {(tuple(ws[i:i + n]), item) for i in range(len(ws) - n + 1) if n}
    out = []
    for doc, t in rows:
        ws, hit, found = words(t), set(), set()
        for w, item in windows:
            for i in range(len(ws) - len(w) + 1):
                if tuple(ws[i:i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    found.add(item)
        ids = sorted(str(i) for i in found - {None})
        out.append((doc, len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def tables(docs, spark, writing):
    items = [(i, writing(8 + i, i)) for i in range(20)] + [(100, "One two Three"), (101, "one-two three"), (102, "solo"), (103, None), (104, " - "), (None, "nobody's item"),
                                                           (5, writing(40, 77)), (9, writing(25, 3)), (105, "a b " * 30)]
    texts = [t for _, t in items if t]
    rows = [(i, writing(5, 500 + i) + " " + texts[i].upper() + "\n" + writing(4, 600 + i)) for i in range(len(texts))]
    rows += [(200, None), (201, ""), (202, "Solo"), (203, "one two, three!"), (204, " ".join(texts) * 2), (None, texts[3]), (7, texts[8]), (7, "unlike"), (205, "a b a b a b a b a b a b"),
             (206, " ".join(texts[12].split()[:9])), (207, " ".join(texts[12].split()[3:13])), (208, "two three one two nobody"), (209, "- -")]
    return docs(rows), rows, spark.createDataFrame([(i, t, "en", 1) for i, t in items], "item_id long, text string, lang string, row int"), items


def test_against_brute_force(docs, spark, writing):
    df, rows, items, plain = tables(docs, spark, writing)
    assert got(C.digests(df, items)) == brute(rows, plain)
    assert got(C.digests(df.repartition(6), items, window=4)) == brute(rows, plain, 4)


def test_many_small_automata_give_the_same(docs, spark, writing):
    """Items cut into pieces and dealt to several automata, a pass for each."""
    df, rows, items, plain = tables(docs, spark, writing)
    assert C.automata(items, size=150).count() > 2
    assert got(C.digests(df, items, size=150)) == brute(rows, plain)


def test_empty_tables(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert C.digests(docs([]), none).count() == 0
    assert got(C.digests(docs([(1, "a b c"), (2, None)]), none)) == brute([(1, "a b c"), (2, None)], [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=14), min_size=1, max_size=5), st.lists(st.integers(0, 3), max_size=40), st.integers(1, 6))
def test_the_automaton_against_all_windows(sequences, text, window):
    built = C.Automaton(window, vocabulary=list("abc")).finish([(s, str(i)) for i, s in enumerate(sequences)])
    hit, found = set(), set()
    stretch = [[]]
    for word in text:  # 3 is a word of no item
        stretch = [*stretch, []] if word == 3 else [*stretch[:-1], [*stretch[-1], word]]
    at = 0
    for part in stretch:
        spans, items = built.walk(part)
        hit |= {at + i for a, b in spans for i in range(a, b)}
        found |= items
        at += len(part) + 1
    said = brute([(0, " ".join("abcx"[w] for w in text))], [(str(i), " ".join("abc"[w] for w in s)) for i, s in enumerate(sequences)], window)[0]
    assert (len(hit), len(found)) == said[2:4]


def test_remove_cuts_spans_and_drops_covered_documents(docs, spark, writing):
    item, clean = writing(30, 1), writing(200, 2)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"{clean} -- {item.upper()}. {clean}"), (2, item + " tail"), (3, clean), (4, None), (5, "é " + " ".join(item.split()[:12]) + " ü " + clean)]
    df = docs(rows)
    out = C.remove(df, items)
    assert out.columns == df.columns
    found = {r.doc_id: r.text for r in out.collect()}
    assert found == {1: f"{clean} -- . {clean}", 3: clean, 4: None, 5: f"é  ü {clean}"}
    assert {r.doc_id: r.text for r in C.remove(df, items, min_span=20, max_coverage=1.0).collect()}[5] == rows[4][1]


def test_a_very_long_text(docs, spark):
    rng = random.Random(3)
    body = " ".join(rng.choice(["of", "the", "and", "x"]) for _ in range(300_000))
    item = " ".join(rng.choice(["of", "the", "and", "y"]) for _ in range(40))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    r = C.digests(docs([(1, f"{body} q {item} q {body}")]), items).first()
    assert r.n_words == 600_042 and r.n_hit >= 40 and r.contaminated
