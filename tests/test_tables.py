"""Schema, filters, features, averages, and reading and writing."""

from __future__ import annotations

import datetime as dt
import glob
import gzip
import json
import os

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from mailgauge.functions.tokens import word_count, words
from mailgauge.operators import averages as A
from mailgauge.operators.relational import append_mail, in_interval, order_by_date, query_view, top_n
from mailgauge.plans.ingest import ingest_directories
from mailgauge.plans.reports import report_averages, report_averages_by_sender
from mailgauge.schema import MAIL_SCHEMA, READ_SCHEMA, to_mail_schema
from mailgauge.sources import mailfiles
from mailgauge.sources.documents import read_json_document, store_json_document, store_json_lines
from mailgauge.sources.mailfiles import read_mail, read_mail_files, write_mail_files
from mailgauge.sources.scratch import land, remove, scratch_dir
from mailgauge.sources.tables import (
    load_parquet,
    load_parsed,
    output_dir,
    store_parquet,
)
from mailgauge.streaming.sources import stream_mail_files
from workload.corpus import raw_document_mails
from workload.queries import QUERIES

NOW = dt.datetime(2030, 7, 4, 21, 5, 9)


@pytest.fixture
def mails(spark):
    rows = [
        ("<1>", "2000-04-12 00:00:00", "a@x", ["p"], "s", "on the low bound"),
        ("<2>", "2000-04-12 00:00:01", "a@x", ["p", "q"], "s", "two  words "),
        ("<3>", "2001-08-18 23:59:59", "A@x", [], None, ""),
        ("<4>", "2001-08-19 00:00:00", "b@x", ["p"], "s", "on the high bound"),
        ("<5>", None, "b@x", ["p"], "s", "no date"),
        ("<6>", "2001-01-01 00:00:00", "a@x", None, "s", None),
    ]
    schema = "ID string, Date string, From string, Recipients array<string>, Subject string, Body string"
    frame = spark.createDataFrame(rows, schema)
    return frame.withColumn("Date", F.col("Date").cast("timestamp"))


def ids(df):
    return sorted(r.ID for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_interval_bounds(mails):
    assert ids(in_interval(mails, "2000-04-12", "2001-08-19")) == ["<2>", "<3>", "<6>"]
    assert ids(in_interval(mails, "2000-04-12", "2001-08-19", inclusive="low")) == ["<1>", "<2>", "<3>", "<6>"]
    assert ids(in_interval(mails, "2000-04-12", "2001-08-19", inclusive="high")) == ["<2>", "<3>", "<4>", "<6>"]
    assert len(ids(in_interval(mails, "2000-04-12", "2001-08-19", inclusive="both"))) == 5
    with pytest.raises(ValueError):
        in_interval(mails, "2000-04-12", "2001-08-19", inclusive="none")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        in_interval(mails, "soon", "2001-08-19").collect()


def test_words_and_counts(spark):
    frame = spark.createDataFrame([("a  b ",), ("",), (None,), ("a\tb\nc d",), ("   ",)], "Body string")
    rows = frame.select(words(F.col("Body")).alias("w"), word_count(F.col("Body")).alias("n")).collect()
    assert [r.w for r in rows] == [["a", "b"], [], None, ["a\tb\nc", "d"], []]
    assert [r.n for r in rows] == [2, 0, 0, 2, 0]
    rows = frame.select(word_count(F.col("Body"), lines_kept=True).alias("n")).collect()
    assert [r.n for r in rows] == [2, 0, 0, 4, 0]


def test_averages(mails):
    lengths = A.mail_lengths(in_interval(mails, "2000-04-12", "2001-08-19"))
    row = A.averages(lengths).head()
    assert (row.avgLength, row.avgNoOfRecipients) == (2 / 3, 2 / 3)
    by_sender = {r.sender: (r.avgLength, r.avgNoOfRecipients) for r in A.averages_by_sender(lengths).collect()}
    assert by_sender == {"a@x": (1.0, 1.0), "A@x": (0.0, 0.0)}
    nothing = A.averages(A.mail_lengths(mails.filter("false"))).head()
    assert (nothing.avgLength, nothing.avgNoOfRecipients) == (None, None)


def test_averages_aggregate_before_the_shuffle(mails):
    plan = plan_of(A.averages_by_sender(A.mail_lengths(mails)))
    assert plan.count("Exchange") == 1
    assert plan.index("partial_avg") > plan.index("Exchange")
    # No body crosses the network.
    exchange_input = plan[plan.index("Exchange"):].split("\n")[1]
    assert "Body" not in exchange_input


def test_window_ranking_limits_rows_before_the_shuffle(mails):
    plan = plan_of(A.top_words_by_window(A.windowed_words(mails, "Date")))
    assert plan.count("WindowGroupLimit") == 2


def test_top_n(spark):
    frame = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", 1)], "sender string, mails bigint")
    assert [r.sender for r in top_n(frame, "mails", "sender", 3).collect()] == ["c", "a", "b"]
    assert "TakeOrderedAndProject" in plan_of(top_n(frame, "mails", "sender", 3))


def test_rankings(spark, mails):
    ranked = A.top_senders(A.sender_totals(mails), n=2).collect()
    assert sorted((r.measure, r["rank"], r.sender, r.total) for r in ranked) == [
        ("mails", 1, "a@x", 3),
        ("mails", 2, "b@x", 2),
        ("words", 1, "a@x", 6),
        ("words", 2, "b@x", 6),
    ]


def test_mail_without_sender_counts_for_nobody(mails):
    some = mails.withColumn("From", F.when(F.col("ID") != "<4>", F.col("From")))
    totals = A.sender_totals(some).collect()
    assert {r.sender: r.mails for r in totals} == {"a@x": 3, "A@x": 1, "b@x": 1}


def test_word_frequency(mails):
    counts = {r.word: r["count"] for r in A.word_frequency(mails).collect()}
    assert counts["on"] == 2 and counts["two"] == 1 and "" not in counts


def test_conform(spark, mails):
    schema = "body string, recipients array<string>, FROM string, id string, extra int"
    frame = spark.createDataFrame([("x", ["p"], "a@x", "<1>", 5)], schema)
    with pytest.raises(ValueError, match="Date"):
        to_mail_schema(frame)
    table = to_mail_schema(frame.withColumn("date", F.lit("2000-01-01").cast("timestamp")))
    assert table.schema == READ_SCHEMA
    assert table.head().Subject is None
    assert [f.name for f in MAIL_SCHEMA if not f.nullable] == ["ID", "Date", "From", "Recipients"]


def test_append_keeps_repeats(mails):
    table = append_mail(mails, mails.select(*reversed(mails.columns)), mails)
    assert table.count() == 18
    assert "Exchange" not in plan_of(table)


def test_order_by_date(mails):
    assert [r.ID for r in order_by_date(mails).collect()] == ["<5>", "<1>", "<2>", "<6>", "<3>", "<4>"]


def test_copies_of_one_mail_are_split_after_an_append(spark, mails, tmp_path):
    copy = mails.filter("ID = '<1>'").crossJoin(spark.range(20_000)).drop("id")
    paths = [store_parquet(copy, f"{tmp_path}/{name}") for name in "ab"]
    both = append_mail(*[load_parquet(spark, p, positions=True) for p in paths])
    assert "Exchange" not in plan_of(both)
    ordered = order_by_date(both)
    assert ordered.columns == load_parquet(spark, *paths).columns
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = ordered.groupBy(F.spark_partition_id()).count().collect()
        stored = store_parquet(both, f"{tmp_path}/c", clustered=True, files=3)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == 40_000
    assert len(glob.glob(f"{stored}/part-*")) == 3
    table = load_parquet(spark, stored)
    assert table.count() == 40_000 and table.columns == mails.columns


def test_positions_stay_only_if_all_tables_have_them(spark, mails, tmp_path):
    path = store_parquet(mails, str(tmp_path))
    with_position = load_parquet(spark, path, positions=True)
    assert with_position.columns == [*mails.columns, "_file", "_row"]
    assert append_mail(with_position, mails).columns == mails.columns
    assert load_parquet(spark, positions=True).columns == with_position.columns


def test_parquet_round_trip(spark, mails, tmp_path):
    first = store_parquet(mails, str(tmp_path), now=NOW)
    assert first == f"{tmp_path}/2030-07-04_21-05-09_output_parquet"
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        store_parquet(mails, str(tmp_path), now=NOW)
    second = store_parquet(mails, f"{tmp_path}/more/", clustered=True, now=NOW)
    table = load_parquet(spark, first, second)
    assert table.schema == READ_SCHEMA
    assert ids(table) == sorted(ids(mails) * 2)
    plan = plan_of(A.averages(A.mail_lengths(in_interval(table, "2000-04-12", "2001-08-19"))))
    assert "PushedFilters: [IsNotNull(Date), GreaterThan(Date," in plan
    assert "ReadSchema: struct<Date:timestamp,Recipients:array<string>,Body:string>" in plan


def test_load_without_paths_or_columns(spark, mails, tmp_path):
    assert load_parquet(spark).count() == 0
    mails.drop("Subject").write.parquet(str(tmp_path / "t"))
    assert load_parquet(spark, str(tmp_path / "t")).filter("Subject IS NULL").count() == 6


def test_mail_directory(spark, tmp_path):
    folder = tmp_path / "mails"
    (folder / "sub").mkdir(parents=True)
    mail = "Message-ID: <%d>\nDate: Wed, 8 Nov 2000 06:35:20 -0700 (PDT)\nFrom: a@x\nTo: b@x\nX-bcc: \n\nbody %d"
    for i in range(3):
        (folder / f"{i}_").write_text(mail % (i, i))
    (folder / "empty").write_text("")
    (folder / "sub" / "9_").write_text(mail % (9, 9))
    assert ids(read_mail(spark, str(folder))) == ["<0>", "<1>", "<2>"]
    assert ids(read_mail(spark, str(folder), str(folder / "sub"))) == ["<0>", "<1>", "<2>", "<9>"]
    assert ids(read_mail(spark, str(folder / "sub"), str(tmp_path / "none"))) == ["<9>"]
    assert read_mail(spark, str(tmp_path / "none")).count() == 0
    assert read_mail_files(spark).columns == ["value", "path"]
    paths = [r.path for r in read_mail_files(spark, str(folder)).collect()]
    assert sorted(os.path.basename(p) for p in paths) == ["0_", "1_", "2_"]


def test_ingest_stores_mails_and_quarantine(spark, tmp_path):
    folder = tmp_path / "mails"
    folder.mkdir()
    mail = "Message-ID: <%d>\nDate: Wed, 8 Nov 2000 06:35:20 -0700 (PDT)\nFrom: a@x\nTo: b@x\nX-bcc: \n\nbody"
    for i in range(3):
        (folder / f"{i}_").write_text(mail % i)
    first = ingest_directories(spark, [str(folder)], f"{tmp_path}/first")
    (folder / "9_").write_text("no mail")
    second = ingest_directories(spark, [str(folder)], f"{tmp_path}/second")
    good, bad = load_parsed(spark, first)
    assert (ids(good), bad.count()) == (["<0>", "<1>", "<2>"], 0)
    assert good.schema == READ_SCHEMA
    good, bad = load_parsed(spark, first, second)
    assert len(ids(good)) == 6
    row = bad.head()
    assert row._error == ["no_id", "bad_date", "no_from", "no_recipients"] and row.path.endswith("/9_")
    assert "PartitionFilters: [isnotnull(valid" in plan_of(good)


def test_mail_that_is_not_utf8(spark, tmp_path):
    head = b"Message-ID: <1>\nDate: Wed, 8 Nov 2000 06:35:20 -0700 (PDT)\nFrom: a\xe9@x\nTo: b@x\nX-To: \xff\xfe\xc3"
    (tmp_path / "1_").write_bytes(head + b"\nX-cc: \nX-bcc: \n\ncaf\xe9 au\xc3 lait \xf0\x9f\nend\xe2\x82")
    row = read_mail(spark, str(tmp_path)).select("*", word_count(F.col("Body")).alias("n")).head()
    assert (row.ID, row.n, len(row.Recipients), row._error) == ("<1>", 4, 1, [])


def test_write_mail_files(spark, tmp_path):
    frame = spark.createDataFrame([("a\n\nb",), ("c",)], "value string")
    write_mail_files(frame, str(tmp_path / "out"))
    assert sorted(r.value for r in read_mail_files(spark, str(tmp_path / "out")).collect()) == ["a\n\nb\n", "c\n"]


def test_write_mail_files_into_directories(spark, tmp_path, monkeypatch):
    """Tasks write the files and the directories they lie in, each of a bounded number; there is nothing else."""
    monkeypatch.setattr(mailfiles, "FOLDER_FILES", 3)
    texts = [None, "", "a\n\nb", "caf\u00e9", "x" * 100_000, *["copy"] * 15]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    write_mail_files(frame, str(tmp_path / "out"), "text", folders=True)
    folders = sorted(os.listdir(tmp_path / "out"))
    # Spark's own writer leaves all in one directory.
    assert len(folders) >= 7 and all(1 <= len(os.listdir(tmp_path / "out" / f)) <= 3 for f in folders)
    found = read_mail_files(spark, str(tmp_path / "out" / "*"))
    assert sorted(r.value for r in found.collect()) == sorted(f"{t or ''}\n" for t in texts)
    with pytest.raises(FileExistsError):
        write_mail_files(frame, str(tmp_path / "out"), "text")
    for flag in (False, True):
        write_mail_files(frame.filter("false"), str(tmp_path / f"none{flag}"), "text", folders=flag)
        assert read_mail_files(spark, str(tmp_path / f"none{flag}" / "*")).isEmpty()


def test_write_mail_files_of_bytes_and_other_systems(spark, tmp_path):
    """Bytes that are no UTF-8 stay; what tasks cannot open is left to Spark's text sink."""
    frame = spark.sql("SELECT CAST(X'FF41C3' AS STRING) AS value")
    write_mail_files(frame, f"file://{tmp_path}/a")
    assert [(tmp_path / "a" / n).read_bytes() for n in os.listdir(tmp_path / "a")] == [b"\xffA\xc3\n"]

    def unknown(uri):
        raise pa.ArrowInvalid(f"Unrecognized filesystem type in URI: {uri}")

    write_mail_files(frame, f"{tmp_path}/b", folders=True, opened=unknown)
    assert read_mail_files(spark, f"{tmp_path}/b/*").count() == 1


def test_whole_files_lose_their_last_byte_only(spark, tmp_path):
    """of a text that ends within a character too, which reaches over the line break if characters are counted."""
    rows = spark.sql(
        "SELECT stack(5, 1L, 'a', 2L, '', 4L, 'caf\u00e9 \U0001f600', 5L, 'two\n\n', 6L, CAST(X'61F09F' AS STRING))"
        " AS (doc_id, text), 'en' AS lang, 's' AS source, 1L AS n_chars"
    )
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["scan_whole_files"](spark, str(tmp_path))
    assert found.dtypes == [("value", "string")]
    expected = raw_document_mails(spark, str(tmp_path))

    def as_bytes(frame):
        return sorted(bytes(r[0]) for r in frame.select(F.col("value").cast("binary")).collect())

    assert as_bytes(found) == as_bytes(expected) and len(as_bytes(found)) == 5


def test_endings_are_told_once(spark, tmp_path):
    """what tells compressed files is in the stored list, not worked out again by each step that reads it."""
    (tmp_path / "a").write_text("plain\n")
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"packed\n"))
    mixed = read_mail_files(spark, str(tmp_path))
    assert sorted(r.value for r in mixed.collect()) == ["packed\n", "plain\n"]
    listed = next(line for line in plan_of(mixed).splitlines() if "FileScan parquet" in line)
    assert "compressed" in listed


def test_removed_tables_are_gone(spark, mails):
    landed = land(mails)
    folder = landed.inputFiles()[0].rpartition("/")[0].removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(folder) and ids(landed) == ids(mails)
    remove(landed)
    assert not os.path.exists(folder)


def test_only_files_directly_in_the_directory(spark, tmp_path):
    for name in ("a", "k=v/b", "sub/c", "odd + %41 dir/d", "_hidden"):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(HEAD_OF_MAIL)
    folder = str(tmp_path / "in")

    def names(rows):
        return sorted(r.path.rpartition("/")[2] for r in rows.select("path").collect())

    assert names(read_mail_files(spark, folder)) == ["a"]
    assert names(read_mail_files(spark, f"{folder}/k=v", f"{folder}/nothing", f"{folder}/odd + %41 dir")) == ["b", "d"]
    assert names(read_mail_files(spark, f"{folder}/*")) == ["a", "b", "c", "d"]
    query = stream_mail_files(spark, folder).writeStream.format("memory").queryName("direct").start()
    query.processAllAvailable()
    query.stop()
    assert names(spark.table("direct")) == ["a"]


HEAD_OF_MAIL = "Message-ID: <1>\nDate: Wed, 8 Nov 2000 06:35:20 -0700 (PDT)\nFrom: a@x\nTo: b@x\n\nbody"


def document(path):
    return "".join(open(f).read() for f in sorted(glob.glob(f"{path}/part-*")))


def test_json_document(spark, tmp_path):
    rows = [(f"s{i:03}", float(i)) for i in range(100)]
    rows += [('{x "quoted" [,{', 1.5), ("null", None), ("line\nbreak", 2.0)]
    frame = spark.createDataFrame(rows, "sender string, avgLength double").repartition(5)
    expected = [{k: v for k, v in (("sender", s), ("avgLength", n)) if v is not None} for s, n in sorted(rows)]
    one = store_json_document(frame, f"{tmp_path}/one", order_by=["sender"])
    many = store_json_document(frame, f"{tmp_path}/many", order_by=["sender"], files=10)
    assert len(glob.glob(f"{one}/part-*")) == 1
    assert len(glob.glob(f"{many}/part-*")) > 5
    for path in (one, many):
        assert json.loads(document(path)) == expected
        back = read_json_document(spark, path, "sender string, avgLength double")
        assert sorted(back.collect(), key=lambda r: r.sender) == [tuple(r) for r in sorted(rows)]
    assert document(one).startswith("[{") and document(one).endswith("\n]\n")


def test_json_document_with_repeats_and_without_rows(spark, tmp_path):
    same = spark.createDataFrame([("a",)] * 7, "sender string")
    path = store_json_document(same, f"{tmp_path}/same", order_by=["sender"], files=4)
    assert json.loads(document(path)) == [{"sender": "a"}] * 7
    path = store_json_document(same.filter("false"), f"{tmp_path}/none")
    assert json.loads(document(path)) == []
    assert read_json_document(spark, path, "sender string").count() == 0


def test_json_lines(spark, tmp_path):
    frame = spark.range(100).repartition(7)
    path = store_json_lines(frame, str(tmp_path), now=NOW)
    assert path == output_dir(str(tmp_path), "json", NOW)
    assert len(glob.glob(f"{path}/part-*")) == 1
    assert sorted(json.loads(line)["id"] for line in document(path).splitlines()) == list(range(100))


def test_reports(spark, mails, tmp_path):
    tables = [store_parquet(mails, f"{tmp_path}/a"), store_parquet(mails, f"{tmp_path}/b")]
    path = report_averages(spark, tables, "2000-04-12", "2001-08-19", f"{tmp_path}/out")
    assert json.loads(document(path)) == [{"avgLength": 2 / 3, "avgNoOfRecipients": 2 / 3}]
    path = report_averages_by_sender(spark, tables, "2000-04-12", "2001-08-19", f"{tmp_path}/out2")
    assert json.loads(document(path)) == [
        {"sender": "A@x", "avgLength": 0.0, "avgNoOfRecipients": 0.0},
        {"sender": "a@x", "avgLength": 1.0, "avgNoOfRecipients": 1.0},
    ]
    path = report_averages(spark, tables, "1990-01-01", "1990-01-02", f"{tmp_path}/out3")
    assert json.loads(document(path)) == [{}]


def test_scratch(spark):
    assert scratch_dir(spark) != scratch_dir(spark)
    assert os.path.dirname(scratch_dir(spark)) == os.path.dirname(scratch_dir(spark))
    assert land(spark.range(10)).agg(F.sum("id")).head()[0] == 45


class ClusterSession:
    """What scratch_dir looks at, for a session that is not local."""

    def __init__(self, folder):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": "yarn"})


def test_scratch_on_a_cluster_is_the_shared_folder():
    assert scratch_dir(ClusterSession("hdfs:///shared/")).startswith("hdfs:///shared/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(ClusterSession(None))


def test_a_view_is_gone_after_its_query(spark, mails):
    found = query_view(mails, "SELECT ID FROM sent WHERE Subject IS NULL", "sent")
    assert not spark.catalog.tableExists("sent")
    assert [r.ID for r in found.collect()] == ["<3>"]
    mails.createTempView("taken")
    with pytest.raises(ValueError):
        query_view(mails, "SELECT * FROM taken", "taken")
    spark.catalog.dropTempView("taken")


def test_copies_of_one_mail_are_split_over_files_by_default(spark, tmp_path):
    copies = spark.range(8000).selectExpr(
        "'<1>' AS ID", "TIMESTAMP '2001-01-01' AS Date", "'a@x' AS `From`", "array('b') AS Recipients", "'s' AS Subject", "'b' AS Body"
    )
    table = store_parquet(copies, f"{tmp_path}/t", clustered=True, files=4)
    stored = load_parquet(spark, table, positions=True)
    sizes = sorted(r["count"] for r in stored.groupBy("_file").count().collect())
    assert len(sizes) == 4 and sum(sizes) == 8000 and sizes[-1] < 3000
    assert "_place" not in spark.read.parquet(table).columns


def test_landed_tables_are_deleted_one_by_one(spark):
    from mailgauge.sources import scratch

    before = set(scratch._landed)
    plain, parted = land(spark.range(5)), land(spark.range(6).selectExpr("id", "id % 2 AS k"), by="k")
    paths = scratch._landed - before
    assert len(paths) == 2 and all(os.path.isdir(p) for p in paths)
    remove(parted.filter("id > 1"))
    assert len(scratch._landed - before) == 1 and plain.count() == 5
    remove(plain)
    assert scratch._landed == before and not any(os.path.exists(p) for p in paths)
