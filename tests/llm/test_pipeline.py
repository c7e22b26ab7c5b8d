import re
import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline as P
import numpy as np
import pytest

REPO = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def corpus(spark, writing, tmp_path_factory):
    """A planted corpus: junk, copies, near copies and secrets among clean documents."""
    sf = str(tmp_path_factory.mktemp("corpus"))
    rng = np.random.default_rng(3)
    rows = [(i, writing(60 + i % 80, i)) for i in range(240)]
    junk = [(1000 + i, " ".join(w + "%%%" for w in writing(60, 5000 + i).split())) for i in range(60)]
    copies = [(2000 + i, rows[i][1].replace(" ", "\n", 3)) for i in range(20)]
    near = [(3000 + i, rows[i][1] + " end" if len(rows[i][1].split()) > 90 else rows[i][1]) for i in range(60, 90)]
    secret = [(4000 + i, writing(70, 7000 + i) + " password=" + "".join(rng.choice(list("abcdef0123456789"), 18))) for i in range(10)]
    every = rows + junk + copies + near + secret
    (spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in every], "doc_id long, text string, lang string, source string, n_chars long")
     .repartition(4).write.parquet(f"{sf}/documents.parquet"))
    labels = [(i, 1, 0) for i, _ in rows + secret] + [(i, 0, 0) for i, _ in junk]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf, dict(every), {i for i, _ in rows}, {i for i, _ in secret}


def test_stages(spark, corpus):
    sf, texts, clean, secret = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(P.STAGES):
        docs = P.cut_lineage(stage(spark, docs, sf))
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert k == len(P.STAGES) - 1 or docs.columns == columns
        if P.STAGES[k][0] == "secret scans":
            for r in docs.collect():
                assert (r.text == re.sub("password=[0-9a-f]{18}", "[SECRET]", texts[r.doc_id])) and r.n_chars == len(r.text)
    assert clean | secret <= kept[-1]  # clean documents all stay
    assert not any(1000 <= i < 2000 for i in kept[0])
    assert not any(2000 <= i < 3000 for i in kept[1])
    assert not any(3000 <= i < 4000 for i in kept[2]) and kept[2] == kept[3] == kept[4]


def test_run_gives_the_last_stage(spark, corpus):
    sf, texts, *_ = corpus
    found = P.run(spark, sf)
    assert "ids_crc32" in found.columns and found.count() > 240


def test_entry_works_without_the_subpackage(tmp_path):
    """Copies of the repository without the llm folders, or without the pipeline, still import."""
    for gone in (["pricegrid/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"], []):
        copy = tmp_path / f"copy{len(gone)}"
        hidden = shutil.ignore_patterns("__pycache__", *(Path(g).name for g in gone))
        shutil.copytree(REPO / "pricegrid", copy / "pricegrid", ignore=hidden)
        for f in {"__spark_entry__.py", "corpus_pipeline.py"} - set(gone):
            shutil.copy(REPO / f, copy)
        said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries())"], cwd=copy, capture_output=True, text=True, check=True).stdout
        assert ("op1_exact_dedup" in said) == ("pricegrid/llm" not in gone) and ("pipeline" in said.split()) == (not gone) and "weekly_rollup" in said
