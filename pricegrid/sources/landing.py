"""Landing: survey archives -> content-addressed CSV files + audit manifest.

Archives that a ledger lists (path, length, modification time) are not opened again.
Of the others only paths cross the network; each task reads its archives from the
store once, front to back: the CSV members are inflated while the bytes that pass are
hashed (the index at the end is read first and once more), so no archive or member is
held whole. The file name carries 8 hex digits of that hash, so it is known only at the
end: members are written under temporary names in a folder beside the landing folder,
which no reader lists, and moved when the archive is through. A republished archive
lands beside the old one as a new file and the stream picks it up.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zipfile

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.session import cut_lineage

MANIFEST_SCHEMA = ("semester string, zip_sha256 string, zip_bytes bigint, csv_name string, "
                   "csv_bytes bigint, csv_lines bigint")


CHUNK = 8 << 20


def archives(spark: SparkSession, path: str, ledger: DataFrame | None = None) -> DataFrame:
    """(path, zip_bytes, modified) of the archives that ``ledger`` doesn't list as they
    are now; listing only."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
             .option("recursiveFileLookup", "true").load(path)
             .select("path", F.col("length").alias("zip_bytes"), F.col("modificationTime").alias("modified")))
    return found if ledger is None else found.join(ledger, ["path", "zip_bytes", "modified"], "left_anti")


class Hashed:
    """A seekable file that hashes every byte once, in order: what is read beyond the
    hashed part waits until the part before it has been read."""

    def __init__(self, file):
        self.file, self.sha, self.upto = file, hashlib.sha256(), 0

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        self.file.seek(offset, whence)
        return self.file.tell()

    def read(self, n: int = -1) -> bytes:
        at = self.file.tell()
        data = self.file.read(n if n >= 0 else None)
        if at <= self.upto < at + len(data):
            self.sha.update(memoryview(data)[self.upto - at:])
            self.upto = at + len(data)
        return data

    def hexdigest(self) -> str:
        """Of the whole file; reads what has not passed yet."""
        self.file.seek(self.upto)
        while self.read(CHUNK):
            pass
        return self.sha.hexdigest()


def _written(member, out) -> tuple[int, int]:
    """Copies a member in chunks; its bytes and lines."""
    size = lines = 0
    last = b"\n"
    while chunk := member.read(CHUNK):
        out.write(chunk)
        size, lines, last = size + len(chunk), lines + chunk.count(b"\n"), chunk[-1:]
    return size, lines + (last != b"\n")


def _land(path: str, zip_bytes: int, landing: str) -> list[tuple]:
    """Manifest rows of one archive, its members landed."""
    source, place = pafs.FileSystem.from_uri(path)
    fs, folder = pafs.FileSystem.from_uri(landing)
    parts = f"{folder}-incoming"
    for d in (folder, parts):
        fs.create_dir(d, recursive=True)
    stem = os.path.basename(path)
    stem = stem[:-4] if stem.lower().endswith(".zip") else stem
    semester = stem.split("-", 1)[1] if "-" in stem else stem
    with source.open_input_file(place) as f:
        hashed = Hashed(f)
        with zipfile.ZipFile(hashed) as zf:
            members = [m for m in zf.infolist() if m.filename.lower().endswith(".csv")]
            if not members:
                raise ValueError(f"{path}: archive holds no CSV member")
            moves = []
            for m in members:
                part = f"{parts}/{uuid.uuid4().hex}.part"
                with zf.open(m) as member, fs.open_output_stream(part) as out:
                    moves.append((part, *_written(member, out)))
            sha = hashed.hexdigest()
    rows = []
    for i, (part, size, lines) in enumerate(moves):
        suffix = "" if len(moves) == 1 else f"_{i:02d}"
        name = f"{stem}__{sha[:8]}{suffix}.csv"
        found = fs.get_file_info(f"{folder}/{name}")
        if found.type == pafs.FileType.NotFound or found.size != size:
            fs.move(part, f"{folder}/{name}")
        else:  # landed before under this hash: readers may hold it open
            fs.delete_file(part)
        rows.append((semester, sha, int(zip_bytes), name, size, lines))
    return rows


def extract(spark: SparkSession, archive_dir: str, landing_dir: str, ledger: DataFrame | None = None) -> DataFrame:
    """Extract every .csv member (case-insensitive) of every archive that ``ledger``
    doesn't list.

    Returns one manifest row per member. An archive without a CSV member
    fails the task (and the job) with its name. Complete targets are not
    rewritten, so a re-run is idempotent.
    """
    landing = landing_dir.rstrip("/")

    def unzip(it):
        for pdf in it:
            rows = [row for path, size in zip(pdf["path"], pdf["zip_bytes"]) for row in _land(path, size, landing)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in MANIFEST_SCHEMA.split(", ")])

    # only paths cross the network, one archive per row
    return archives(spark, archive_dir, ledger).repartition("path").mapInPandas(unzip, MANIFEST_SCHEMA)


def register(manifest: DataFrame, audit: DataFrame | None) -> DataFrame:
    """Rows not yet in the audit table (idempotent skip by csv_name), stamped."""
    new = manifest if audit is None else manifest.join(
        audit.select("csv_name"), "csv_name", "left_anti")
    return new.withColumn("downloaded_at", F.current_timestamp())


def append_audit(manifest: DataFrame, audit_path: str, audit: DataFrame | None) -> DataFrame:
    """Append the new rows and return them. They are staged first: a lazy
    plan anti-joined against the audit table would come back empty once the
    append has landed."""
    rows = cut_lineage(register(manifest, audit), "audit-new")
    rows.write.mode("append").parquet(audit_path)
    return rows


def file_stats(spark: SparkSession, landing_dir: str,
               pattern: str = r"([^/]+)$") -> DataFrame:
    """Physical line count and byte size per landed file, as a Spark job."""
    t = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(landing_dir)
    name = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return (t.select(name.alias("csv_name"), F.col("_metadata.file_size").alias("csv_bytes"))
            .groupBy("csv_name").agg(F.count(F.lit(1)).alias("csv_lines"),
                                     F.max("csv_bytes").alias("csv_bytes")))
