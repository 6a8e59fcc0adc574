"""Files listed and read by tasks: the same as Spark's scan, one level deep, each file once."""

from __future__ import annotations

import gzip
import os

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from mailgauge.operators.parse import parse_mail
from mailgauge.plans.ingest import ingest_stream
from mailgauge.sources import committed, listing
from mailgauge.sources.mailfiles import _scan, read_mail_files
from mailgauge.sources.scratch import directories
from mailgauge.sources.tables import load_parsed
from mailgauge.streaming.sinks import start_parquet
from mailgauge.streaming.sources import stream_listed_files, stream_mail

ONCE = {"availableNow": True}


def write(folder, **texts):
    os.makedirs(folder, exist_ok=True)
    for name, text in texts.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())


@pytest.fixture()
def tree(tmp_path):
    top = f"{tmp_path}/in"
    write(f"{top}/d1", a="one", b="two\r\nlines\n", empty="", _hidden="x", **{".dot": "x", "x=y": "eq", "+ % # [ü": "odd"})
    write(f"{top}/d1/k=v", c="below")
    write(f"{top}/d1/sub", d="below")
    write(f"{top}/d2", e=b"\xff\xfe not utf-8", f="\x00")
    write(f"{top}/other", g="no")
    write(top, h="beside")
    return top


def plain(df):
    path = F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    return sorted((r.p, bytes(r.v)) for r in df.select(path.alias("p"), F.col("value").cast("binary").alias("v")).collect())


def named(df):
    path = F.regexp_replace("path", "^file:/+", "/")
    return sorted((r.p, bytes(r.v)) for r in df.select(path.alias("p"), F.col("value").cast("binary").alias("v")).collect())


@pytest.mark.parametrize("patterns", [["d1"], ["d?"], ["{d1,d2}", "other"], ["*"], ["d1/a", "d2"], ["none", "no*"]])
def test_the_same_files_as_a_scan(spark, tree, patterns):
    paths = [f"{tree}/{p}" for p in patterns]
    assert named(listing.read_listed(listing.list_files(spark, *paths))) == plain(read_mail_files(spark, *paths))


def test_length_and_time_of_a_file(spark, tree):
    os.utime(f"{tree}/d1/b", (1_000_000_000, 1_000_000_000))
    row = listing.list_files(spark, f"{tree}/d1").filter("path LIKE '%/b'").selectExpr("*", "unix_seconds(modified) AS s").head()
    assert (row.length, row.s) == (11, 1_000_000_000)


def test_no_directory_below_is_listed(spark, tree):
    def opened(uri):
        system, path, before = listing.open_path(uri)

        class OneLevel:
            def get_file_info(self, asked):
                if isinstance(asked, fs.FileSelector):
                    assert asked.base_dir == path and not asked.recursive
                return system.get_file_info(asked)

        return OneLevel(), path, before

    assert listing.list_files(spark, f"{tree}/d1", opened=opened).count() == 4


def test_small_pieces(spark, tree, monkeypatch):
    write(f"{tree}/many", **{f"m{i}": f"text {i}" * 50 for i in range(60)})
    found = listing.read_listed(listing.list_files(spark, f"{tree}/many"), tasks=3)
    assert named(found) == plain(read_mail_files(spark, f"{tree}/many"))


def test_new_files_are_noted_once(spark, tree, tmp_path):
    noted = f"{tmp_path}/files"
    assert listing.note_new_files(spark, noted, f"{tree}/d*") == 6
    assert listing.note_new_files(spark, noted, f"{tree}/d*") == 0
    write(f"{tree}/d1", new="n")
    write(f"{tree}/d9", late="l")  # a directory made later
    assert listing.note_new_files(spark, noted, f"{tree}/d*", f"{tree}/d9") == 2
    files = committed.load(spark, noted)
    assert named(listing.read_listed(files)) == plain(read_mail_files(spark, f"{tree}/d*"))


def test_a_stream_over_the_noted_files(spark, tree, tmp_path):
    noted, out = f"{tmp_path}/files", f"{tmp_path}/out"

    def streamed():
        listing.note_new_files(spark, noted, f"{tree}/d*")
        files = stream_listed_files(spark, noted, tasks=2)
        start_parquet(files, out, f"{tmp_path}/check", ONCE).awaitTermination(120)
        return named(spark.read.parquet(out))

    assert streamed() == plain(read_mail_files(spark, f"{tree}/d*"))
    write(f"{tree}/d1", new="n")
    write(f"{tree}/d9", late="l")
    write(f"{tree}/d9/k=v", below="l")
    assert streamed() == plain(read_mail_files(spark, f"{tree}/d*"))
    assert streamed() == plain(read_mail_files(spark, f"{tree}/d*"))


def test_mails_ingested_from_noted_files(spark, tmp_path):
    head = "Message-ID: <{0}>\nDate: Tue, 4 Mar 2003 18:05:30 +0100 (CET)\nFrom: a@x\nTo: b@x\nX-bcc: \n\nbody {0}"
    write(f"{tmp_path}/in/a", **{f"m{i}": head.format(i) for i in range(5)}, bad="no mail")
    listing.note_new_files(spark, f"{tmp_path}/files", f"{tmp_path}/in/*")
    query = ingest_stream(
        spark, f"{tmp_path}/files", f"{tmp_path}/out", f"{tmp_path}/check", ONCE, listed=True, tasks=2
    )
    query.awaitTermination(120)
    good, bad = load_parsed(spark, f"{tmp_path}/out")
    expected = parse_mail(read_mail_files(spark, f"{tmp_path}/in/a")).filter("size(_error) = 0")
    assert sorted(r.ID for r in good.collect()) == sorted(r.ID for r in expected.collect())
    assert [os.path.basename(r.path) for r in bad.collect()] == ["bad"]


def test_many_small_files_make_few_tasks(spark, tmp_path):
    """tasks grow with the files, not with what a session counts for opening one."""
    for d in range(4):
        write(f"{tmp_path}/in/d{d}", **{f"m{i}": f"text {d} {i}\n" for i in range(300)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        found = read_mail_files(spark, f"{tmp_path}/in/*")
        assert found.select(F.spark_partition_id().alias("p")).distinct().count() <= 4
        assert sorted(r.value for r in found.collect()) == sorted(f"text {d} {i}\n" for d in range(4) for i in range(300))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_paths_and_texts_as_spark_scans_them(spark, tree):
    """Also of names that a URI escapes, of files named twice and of compressed ones."""
    names = [f"f{c}g" for c in " \t\"#%<>?[]^`{|}~!$&'()*+,;=@é\u00a0\u2003中\U0001f600"] + ["a%41", "_x=y", "_x", "c._COPYING_"]
    write(f"{tree}/d 3 %41", **{n: f"text {n}" for n in names})
    for name in ("a.gz", "b.GZ"):
        with gzip.open(f"{tree}/d2/{name}", "wt") as f:
            f.write(f"packed {name}\n")
    for patterns in (["*"], ["d2", "d2", "d2/e", "d2/a.gz"], ["d1", "d1/k=v"]):
        paths = [f"{tree}/{p}" for p in patterns]
        scanned, found = _scan(spark, directories(spark, *paths)), read_mail_files(spark, *paths)
        assert found.columns == scanned.columns
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, scanned.collect()))
    assert {"packed a.gz\n", "packed b.GZ\n"} <= {r.value for r in read_mail_files(spark, f"{tree}/d2").collect()}


def test_files_are_those_of_the_call(spark, tree):
    """What comes later is in no result of it, as with Spark's scan."""
    found = read_mail_files(spark, f"{tree}/other")
    write(f"{tree}/other", late="l")
    assert found.count() == 1 and read_mail_files(spark, f"{tree}/other").count() == 2


def test_a_stream_gets_tasks_by_its_files(spark, tmp_path, monkeypatch):
    """not a fixed number, however many files there are."""
    monkeypatch.setattr(listing, "TASK_FILES", 3)
    write(f"{tmp_path}/in", **{f"m{i}": f"text {i}" for i in range(31)})
    listing.note_new_files(spark, f"{tmp_path}/files", f"{tmp_path}/in")
    mails = stream_mail(spark, f"{tmp_path}/files", True, listed=True, tasks=None)
    noted = mails.withColumn("task", F.spark_partition_id()).select("path", "task")
    start_parquet(noted, f"{tmp_path}/out", f"{tmp_path}/check", ONCE).awaitTermination(120)
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len({r.path for r in rows}) == len(rows) == 31
    assert len({r.task for r in rows}) > 8
