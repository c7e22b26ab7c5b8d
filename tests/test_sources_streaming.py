"""Bronze stream, header contract, malformed rows, landing archives, layout."""

import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from pricegrid import constants as K
from pricegrid.operators import ops
from pricegrid.session import cut_lineage
from pricegrid.sources import bronze, landing, tables
from pricegrid.streaming import bronze_stream

HEADER = ";".join(K.SOURCE_HEADER)
ROW = "SE;SP;SAO PAULO;POSTO A;12.345.678/0001-90;RUA X;10;;CENTRO;01000-000;GASOLINA;02/01/2024;5,899;;R$ / litro;VIBRA"


def write(path, name, lines, bom=True):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(("\ufeff" if bom else "") + "\n".join(lines) + "\n")


def test_stream_ingest_once_per_file(spark, scratch):
    land = scratch("land")
    write(land, "ca-2024-01__aaaaaaaa.csv", [HEADER, ROW, ROW])
    table, ckpt = scratch("bronze"), scratch("ckpt")
    bronze_stream.ingest(spark, land, table, ckpt)
    b = spark.read.parquet(table)
    assert b.count() == 2
    r = b.first()
    assert r.region == "SE" and r.brand == "VIBRA" and r.complement is None
    assert r.source_file.endswith("ca-2024-01__aaaaaaaa.csv")
    # re-run: nothing new; a new file: only its rows
    bronze_stream.ingest(spark, land, table, ckpt)
    assert spark.read.parquet(table).count() == 2
    write(land, "ca-2024-02__bbbbbbbb.csv", [HEADER, ROW])
    bronze_stream.ingest(spark, land, table, ckpt)
    counts = {r.csv_name: r.bronze_rows for r in bronze.load_counts(
        spark.read.parquet(table), r"(ca-[0-9]{4}-[0-9]{2}__[0-9a-f]{8})").collect()}
    assert counts == {"ca-2024-01__aaaaaaaa": 2, "ca-2024-02__bbbbbbbb": 1}


def test_header_contract_folds_accents_and_reports_positions(spark, scratch):
    land = scratch("land")
    folded = [h.replace("í", "i") for h in K.SOURCE_HEADER]
    write(land, "ok.csv", [";".join(folded).upper(), ROW])
    decomposed = [h.replace("í", "i\u0301") for h in K.SOURCE_HEADER]
    write(land, "decomposed.csv", [";".join(decomposed), ROW])
    assert bronze.check_layout(bronze.new_files(spark, land)).count() == 0
    # such files go through the whole ingest
    table, ckpt = scratch("b0"), scratch("c0")
    assert bronze_stream.ingest(spark, land, table, ckpt, max_files=1) == 2
    assert [r.region for r in spark.read.parquet(table).collect()] == ["SE", "SE"]
    swapped = list(K.SOURCE_HEADER)
    swapped[0], swapped[1] = swapped[1], swapped[0]
    write(land, "bad.csv", [";".join(swapped), ROW])
    bad = bronze.check_layout(bronze.new_files(spark, land)).collect()
    assert len(bad) == 1 and bad[0].path.endswith("bad.csv") and bad[0].positions == [0, 1]
    with pytest.raises(ValueError, match="layout differs"):
        bronze_stream.ingest(spark, land, scratch("b"), scratch("c"))
    # files in the ledger are not checked again; the ledger is kept by the ingest
    known = spark.createDataFrame([("file:" + land + "/bad.csv",)], "path string")
    assert bronze.check_layout(bronze.new_files(spark, land, known)).count() == 0
    assert bronze.new_files(spark, land, spark.read.parquet(ckpt + "-files")).count() == 1
    write(land, "endless.csv", ["x" * (2 << 20)])
    assert {b.path.rsplit("/", 1)[1] for b in bronze.check_layout(bronze.new_files(spark, land)).collect()} == {"bad.csv", "endless.csv"}


def test_malformed_rows_and_blank_lines(spark, scratch):
    land = scratch("land")
    short = ";".join(ROW.split(";")[:5])
    long_ = ROW + ";EXTRA;MORE"
    write(land, "m.csv", [HEADER, ROW, short, "", long_, ";" * 15])
    prof = bronze.malformed_profile(spark, land, pattern=r"(m)\.csv").first()
    assert prof.row_count == 4            # the empty line is skipped
    assert prof.malformed_rows == 2       # short and over-long rows
    assert prof.blank_rows == 1           # the ';;' row is a blank row
    assert (prof.rows_with_extra_fields, prof.extra_fields) == (1, 2)
    table = scratch("bronze")
    bronze_stream.ingest(spark, land, table, scratch("ckpt"))
    streamed = spark.read.parquet(table)
    assert {r[0] for r in streamed.select(bronze.MALFORMED).dropna().collect()} == {short, long_}
    b = bronze.read_batch(spark, land)
    assert b.where(F.coalesce(*[F.col(c) for c in K.BRONZE_COLUMNS]).isNull()).count() == 1


def test_landing_extract_manifest_and_idempotent_skip(spark, scratch):
    arch = scratch("arch")
    os.makedirs(arch)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("dados.CSV", HEADER + "\n" + ROW + "\n")
        z.writestr("leia-me.txt", "x")
    with open(os.path.join(arch, "ca-2024-01.zip"), "wb") as f:
        f.write(buf.getvalue())
    land = scratch("land")
    man = landing.extract(spark, arch, land).collect()
    assert len(man) == 1
    m = man[0]
    assert m.semester == "2024-01" and m.csv_lines == 2
    assert m.csv_name == f"ca-2024-01__{m.zip_sha256[:8]}.csv"
    assert os.path.exists(os.path.join(land, m.csv_name))
    audit = scratch("audit")
    landing.append_audit(spark.createDataFrame(man), audit, None)
    again = landing.register(spark.createDataFrame(man), spark.read.parquet(audit))
    assert again.count() == 0
    st = landing.file_stats(spark, land).first()
    assert (st.csv_lines, st.csv_bytes) == (2, m.csv_bytes)


def test_medallion_land_is_idempotent(spark, scratch):
    from pricegrid.plans import medallion
    arch = scratch("arch")
    os.makedirs(arch)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.csv", HEADER + "\n" + ROW + "\n")
        z.writestr("b.csv", HEADER + "\n" + ROW + "\n" + ROW + "\n")
    with open(os.path.join(arch, "ca-2025-01.zip"), "wb") as f:
        f.write(buf.getvalue())
    land, audit = scratch("land"), scratch("audit")
    first = medallion.land(spark, arch, land, audit).collect()
    assert sorted(r.csv_name.rsplit("_", 1)[1] for r in first) == ["00.csv", "01.csv"]
    assert medallion.land(spark, arch, land, audit).count() == 0
    assert spark.read.parquet(audit).count() == 2


def test_landing_refuses_archive_without_csv(spark, scratch):
    arch = scratch("arch")
    os.makedirs(arch)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("page.html", "<html/>")
    with open(os.path.join(arch, "ca-2024-02.zip"), "wb") as f:
        f.write(buf.getvalue())
    with pytest.raises(Exception, match="no CSV"):
        landing.extract(spark, arch, scratch("land")).collect()


def test_truncated_target_is_written_again(spark, scratch):
    arch, land = scratch("arch"), scratch("land")
    os.makedirs(arch)
    body = ("\n".join([HEADER] + [ROW] * 50)).encode()
    with zipfile.ZipFile(os.path.join(arch, "ca-2024-01.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("ca.csv", body)
    first = landing.extract(spark, arch, land).first()
    target = os.path.join(land, first.csv_name)
    assert (first.csv_bytes, first.csv_lines) == (len(body), 51)
    with open(target, "wb") as f:
        f.write(body[:5])
    again = landing.extract(spark, arch, land).first()
    assert again == first and os.path.getsize(target) == len(body)
    assert [x for x in os.listdir(land) if x.endswith(".part")] == []


def test_tables_replace_compact_cluster(spark, scratch):
    root = scratch("tables")
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    src = tables.replace(df.repartition(8), root, "t")
    assert tables.layout_stats(spark, src).first().num_files == 8
    small = tables.compact(spark, src, root, "t")
    assert tables.layout_stats(spark, small).first().num_files == 1
    assert src != small and spark.read.parquet(src).count() == 1000
    third = tables.layout_stats(spark, src).first().size_bytes // 3 + 1
    cl = tables.cluster(spark, src, ["g"], root, "t", target_bytes=third)
    ranges = tables.file_ranges(spark, cl, "g").orderBy("lo").collect()
    assert sum(r.rows for r in ranges) == 1000
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))


def test_namespace_and_comments(spark):
    tables.setup(spark, {"pg_gold": "modelo dimensional"})
    tables.create_empty(spark, "pg_gold.runs", "run_id STRING, seconds DOUBLE")
    errs = tables.comment(spark, {"pg_gold.runs": "tempos", "pg_gold.nope": "x"},
                          [("pg_gold.runs", "seconds", "wall clock")])
    assert [e[0] for e in errs] == ["pg_gold.nope"]


def test_runs_summary_layout_gain_break_even(spark):
    rows = []
    for phase, secs in [("baseline", [9, 4, 4, 4]), ("control", [5, 3, 3, 3]),
                        ("compacted", [3, 2, 2, 2])]:
        for i, s in enumerate(secs, 1):
            rows.append(("r1", phase, "q", i, float(s), 1, 10, ""))
    runs = spark.createDataFrame(rows, ops.RUNS_SCHEMA)
    summ = ops.summarise_runs(runs)
    base = summ.where("phase = 'baseline'").first()
    assert (base.executions, base.median_seconds, base.max_seconds) == (3, 4.0, 4.0)
    g = ops.layout_gain(summ, "r1").collect()
    assert [(r.phase, r.warmup_gain_pct, r.layout_gain_pct) for r in g] == [
        ("compacted", 25.0, 25.0)]
    rb = spark.createDataFrame([(25.6,)], "seconds double")
    bs = spark.createDataFrame([(6.0,), (7.38,)], "seconds double")
    be = ops.break_even(rb, bs).first()
    assert be.break_even_dates == pytest.approx(25.6 / 6.69)


def _zip(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in members.items():
            z.writestr(f"{name}.csv", body)


def test_what_is_ingested_is_what_was_checked(spark, scratch, monkeypatch):
    """A temporary file, and a wrong file that arrives after the check, stay out of bronze."""
    land, table, ckpt = scratch("land"), scratch("bronze"), scratch("ckpt")
    write(land, "a.csv", [HEADER, ROW])
    write(land, "a.csv.77aa.part", [HEADER, ROW, ROW])
    checked = bronze.require_layout

    def and_then_a_late_file(files, header):
        checked(files, header)
        write(land, "late.csv", ["x;y", "1;2"])
    monkeypatch.setattr(bronze, "require_layout", and_then_a_late_file)
    assert bronze_stream.ingest(spark, land, table, ckpt) == 1
    monkeypatch.undo()
    rows = bronze_stream.committed_rows(spark, table, ckpt).collect()
    assert len(rows) == 1 and rows[0].source_file.endswith("/a.csv") and "batch" not in rows[0].asDict()
    assert spark.read.parquet(bronze_stream.claims_path(ckpt)).count() == 1
    with pytest.raises(ValueError, match="late.csv"):
        bronze_stream.ingest(spark, land, table, ckpt)  # now it is listed, and checked
    assert bronze_stream.committed_rows(spark, table, ckpt).count() == 1
    assert bronze.read_batch(spark, land).where("region = 'SE'").count() == 1
    assert landing.file_stats(spark, land, r"([^/]+)$").count() == 2


def test_a_crash_before_the_commit_replays_to_the_same_rows(spark, scratch, monkeypatch):
    land, table, ckpt = scratch("land"), scratch("bronze"), scratch("ckpt")
    for i in range(3):
        write(land, f"f{i}.csv", [HEADER] + [ROW] * (i + 1))
    whole = bronze_stream.load

    def half(batch, batch_id, table_path, checkpoint, *rest):
        if batch_id == 1:
            _, rows = bronze_stream._rows(batch, K.SOURCE_HEADER, K.BRONZE_COLUMNS)
            rows.write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")
            raise RuntimeError("lost before the commit")
        whole(batch, batch_id, table_path, checkpoint, *rest)
    monkeypatch.setattr(bronze_stream, "load", half)
    with pytest.raises(Exception, match="lost before the commit"):
        bronze_stream.ingest(spark, land, table, ckpt, max_files=1)
    seen = bronze_stream.committed_rows(spark, table, ckpt).count()
    assert seen < 6  # readers see committed batches only
    monkeypatch.undo()
    assert bronze_stream.ingest(spark, land, table, ckpt, max_files=1) == 3
    counts = bronze.load_counts(bronze_stream.committed_rows(spark, table, ckpt), r"(f[0-9])\.csv").collect()
    assert {r.csv_name: r.bronze_rows for r in counts} == {"f0": 1, "f1": 2, "f2": 3}


def test_a_file_changed_after_its_check_is_refused(spark, scratch):
    land, table, ckpt = scratch("land"), scratch("bronze"), scratch("ckpt")
    write(land, "a.csv", [HEADER, ROW])
    assert bronze_stream.claim(spark, land, ckpt) == 1
    write(land, "a.csv", [HEADER, ROW, ROW])
    with pytest.raises(Exception, match="changed after their header was checked"):
        bronze_stream.ingest(spark, land, table, ckpt)


def test_full_refresh_switches_readers_when_it_is_complete(spark, scratch, monkeypatch):
    land, root = scratch("land"), scratch("raw")
    write(land, "a.csv", [HEADER, ROW])
    first = bronze_stream.refresh(spark, land, root)
    write(land, "b.csv", [HEADER, ROW, ROW])
    assert bronze_stream.refresh(spark, land, root) == first and bronze_stream.read(spark, root).count() == 3

    def lost(*_):
        raise RuntimeError("lost")
    monkeypatch.setattr(bronze_stream, "load", lost)
    with pytest.raises(Exception, match="lost"):
        bronze_stream.refresh(spark, land, root, full_refresh=True)
    assert bronze_stream.current(spark, root) == first and bronze_stream.read(spark, root).count() == 3
    monkeypatch.undo()
    write(land, "a.csv", [HEADER, ROW, ROW, ROW, ROW])  # corrected in place: only a full refresh reads it again
    assert bronze_stream.refresh(spark, land, root, full_refresh=True) != first
    assert bronze_stream.read(spark, root).count() == 6
    assert spark.read.parquet(f"{first}/rows").count() == 3  # the old generation is whole


def test_a_second_landing_opens_no_archive(spark, scratch):
    from pricegrid.plans import medallion
    arch, land, audit = scratch("arch"), scratch("land"), scratch("audit")
    os.makedirs(arch)
    _zip(os.path.join(arch, "ca-2025-01.zip"), a=f"{HEADER}\n{ROW}\n", b=f"{HEADER}\n{ROW}")
    opened = spark.sparkContext.accumulator(0)
    real = landing._land

    def counted(*args):
        opened.add(1)
        return real(*args)
    landing._land = counted
    try:
        rows = medallion.land(spark, arch, land, audit).collect()
        assert sorted((r.csv_lines, r.csv_bytes) for r in rows) == sorted((2, os.path.getsize(os.path.join(land, r.csv_name))) for r in rows)
        before = opened.value
        assert before >= 1 and medallion.land(spark, arch, land, audit).count() == 0
        assert opened.value == before
        _zip(os.path.join(arch, "ca-2025-02.zip"), a=f"{HEADER}\n{ROW}\n")
        assert [r.semester for r in medallion.land(spark, arch, land, audit).collect()] == ["2025-02"]
        assert opened.value == before + 1
        # the same archive under a new time is read, and lands nothing new
        os.utime(os.path.join(arch, "ca-2025-02.zip"), (1, 1))
        assert medallion.land(spark, arch, land, audit).count() == 0 and opened.value == before + 2
    finally:
        landing._land = real
    assert os.listdir(f"{land}-incoming") == [] and len(os.listdir(land)) == 3


def test_the_archive_is_hashed_while_its_members_pass(tmp_path):
    import hashlib
    path = tmp_path / "a.zip"
    _zip(path, a="x;y\n" * 5000, b="z" * 100_000)

    class Counted(io.FileIO):
        passed = 0

        def read(self, n=None):
            data = super().read(-1 if n is None else n)
            Counted.passed += len(data)
            return data
    with Counted(path) as f:
        hashed = landing.Hashed(f)
        with zipfile.ZipFile(hashed) as z:
            for m in z.infolist():
                with z.open(m) as member:
                    while member.read(1000):
                        pass
            assert hashed.hexdigest() == hashlib.sha256(path.read_bytes()).hexdigest()
    assert Counted.passed < path.stat().st_size * 2


def test_packing_rewrites_small_files_only(spark, scratch):
    path, root = scratch("mixed"), scratch("tables")
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(2).write.parquet(path)
    spark.range(20_000, 21_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(15).write.mode("append").parquet(path)
    before = {r.path: r.length for r in tables.files(spark, path).collect()}
    large = {p for p, n in before.items() if n > 100_000}
    small = sum(n for p, n in before.items() if p not in large)
    manifest, rewritten = tables.pack_small(spark, path, root, "t", target_bytes=small // 3, small_bytes=100_000)
    after = {r.path for r in spark.read.parquet(manifest).collect()}
    assert large <= after and 0 < rewritten <= small and 3 <= len(after - set(before)) <= 5
    assert tables.read_manifest(spark, manifest).agg(F.count("id"), F.sum("id")).first() == (21_000, 20_999 * 10_500)
    again, more = tables.pack_small(spark, path, root, "t", target_bytes=1, small_bytes=100_000)  # every bin is one file
    assert more == 0 and {r.path for r in spark.read.parquet(again).collect()} == set(before)


def test_bins_are_numbered_without_gaps_over_shards(spark, monkeypatch):
    monkeypatch.setattr(tables, "LISTED", 7)
    listing = spark.createDataFrame([(f"f{i:03d}", 10 + i % 5) for i in range(60)], "path string, length long")
    rows = tables.bins(listing, 40).collect()
    assert len(rows) == 60 and {r.bin for r in rows} == set(range(max(r.bin for r in rows) + 1))
    sizes = {}
    for r in rows:
        sizes[r.bin] = sizes.get(r.bin, 0) + r.length
    assert max(sizes.values()) < 40 + 15


def test_sweep_finds_overlapping_files(spark):
    import random
    rng = random.Random(5)
    for step in (1, 3, 9):
        spans = [(f"f{i}", a, a + rng.choice([0, 1, 2, step])) for i, a in enumerate(rng.randrange(0, 60) for _ in range(25))]
        spans += [("n", None, None)]
        ranges = spark.createDataFrame(spans, "file string, lo int, hi int")
        order = sorted((lo, hi, f) for f, lo, hi in spans if lo is not None)
        want = {f for i, (lo, _, f) in enumerate(order) if any(lo < hi for _, hi, _ in order[:i])}
        found = tables.overlapping_files(ranges)
        assert {r.file for r in found.collect()} == want
        p = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in p and "Cartesian" not in p


def test_interleaved_clustering_serves_both_columns(spark, scratch):
    root = scratch("tables")
    df = spark.range(20_000).select((F.xxhash64("id") % 1000).alias("a"), F.sha2((F.col("id") % 40).cast("string"), 256).alias("b"),
                                    F.when(F.col("id") % 50 != 0, F.col("id")).alias("c"))
    src = tables.replace(df.repartition(4), root, "t")
    size = tables.layout_stats(spark, src).first().size_bytes // 16 + 1
    sorted_, z = (f(spark, src, ["a", "b"], root, "t", size) for f in (tables.cluster, tables.cluster_interleaved))
    share = {(k, c): tables.share_met(spark, p, c).first().share for k, p in (("s", sorted_), ("z", z)) for c in "ab"}
    assert share["s", "a"] < 0.2 and share["s", "b"] > 0.9  # a filter on the second column alone opens everything
    assert share["z", "a"] < 0.5 and share["z", "b"] < 0.5
    assert spark.read.parquet(z).exceptAll(df).count() == 0 and spark.read.parquet(z).count() == 20_000
    assert spark.read.parquet(tables.cluster_interleaved(spark, src, ["c", "b"], root, "t", size)).where("c is null").count() == 400


def test_rescued_fields_by_position_and_unmatched_files(spark, scratch):
    from pricegrid.operators import checks
    from pricegrid.plans import medallion
    land = scratch("land")
    write(land, "a.csv", [HEADER, ROW, ROW + ';x;"y;z"', "short;row"])
    b = cut_lineage(bronze.read_batch(spark, land))
    maps = [r[0] for r in b.select(bronze.rescued(F.col(bronze.MALFORMED))).collect() if r[0]]
    assert maps == [{17: "x", 18: '"y;z"'}]
    assert bronze.rescue_check(b).first().asDict() == {"files": 1, "malformed_rows": 2, "unmatched_files": 0, "distinct_malformed": 2,
                                                       "distinct_per_file": 2.0}
    write(land, "b.csv", [HEADER, ROW + ";1", ROW + ";2"])
    with pytest.raises(checks.CheckFailed, match="no row fits"):
        medallion.run(spark, land, scratch("out"))
