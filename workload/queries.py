"""One query per operator: (spark, sf_dir) to DataFrame, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailgauge.functions import headers as H
from mailgauge.functions.dates import mail_date
from mailgauge.functions.recipients import map_recipients
from mailgauge.functions.tokens import recipient_count, word_count, words
from mailgauge.operators import averages as A
from mailgauge.operators.parse import (
    ERROR_COLUMN,
    has_error,
    mail_fields,
    mail_lines,
    parse_mail,
    unfold_header,
    with_recipients,
)
from mailgauge.operators.relational import append_mail, in_interval, order_by_date, query_view, top_n, with_features
from mailgauge.plans import ingest, live, reports, rollups
from mailgauge.schema import to_mail_schema
from mailgauge.sources.bysender import store_by_sender
from mailgauge.sources.documents import read_json_document, store_json_document, store_json_lines
from mailgauge.sources.listing import list_files, note_new_files, read_listed
from mailgauge.sources.mailfiles import read_mail, read_mail_files, write_mail_files
from mailgauge.sources.scratch import scratch_dir
from mailgauge.sources.tables import load_parquet, load_parsed, store_parquet, store_parsed
from mailgauge.streaming import rankings, sinks, windows
from mailgauge.streaming import sources as streams
from workload.corpus import (
    EPOCH_2000,
    HOURS,
    MAIL_OF_DOCUMENT,
    conversation_mails,
    document_mails,
    documents,
    raw_document_mails,
    raw_mails,
    readable,
    table,
)

LOW, HIGH = "2000-03-01", "2001-09-15"
# Within days, so that sums of whole days do not do.
LOW_TIME, HIGH_TIME = "2000-03-01 07:30:00", "2001-09-14 18:45:10"
SENDER_AVERAGES = "sender string, avgLength double, avgNoOfRecipients double"
ONCE = {"availableNow": True}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Directories already written by this application, by what is in them.
_staged: dict[tuple, object] = {}


def query(function: Query) -> Query:
    """Register a query; a trailing underscore only keeps it apart from an operator's name."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def staged(spark: SparkSession, sf_dir: str, what: str, write: Callable[[str], object]) -> object:
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _staged:
        _staged[key] = write(scratch_dir(spark))
    return _staged[key]


def mail_directory(spark: SparkSession, sf_dir: str) -> str:
    """All raw mails, one per file: a pattern that names the directories they lie in."""

    def write(path: str) -> str:
        write_mail_files(raw_document_mails(spark, sf_dir), path, folders=True)
        return f"{path}/*"

    return staged(spark, sf_dir, "files", write)


def mail_tables(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two stored tables: the mails with even ids (clustered by date) and the others."""

    def write(path: str) -> list[str]:
        rows = documents(spark, sf_dir)
        first = rows.filter("doc_id % 2 = 0").selectExpr(*MAIL_OF_DOCUMENT)
        second = rows.filter("doc_id % 2 = 1").selectExpr(*MAIL_OF_DOCUMENT)
        return [
            store_parquet(first, f"{path}/even", clustered=True),
            store_parquet(second, f"{path}/odd"),
        ]

    return staged(spark, sf_dir, "tables", write)


def as_text(column: str = "Date"):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# --- averages ---------------------------------------------------------------


@query
def avg_mail_stats_by_sender(spark, sf_dir):
    return A.averages_by_sender(A.mail_lengths(in_interval(document_mails(spark, sf_dir), LOW, HIGH)))


@query
def avg_mail_stats(spark, sf_dir):
    return A.averages(A.mail_lengths(in_interval(document_mails(spark, sf_dir), LOW, HIGH)))


@query
def avg_stored_mail_by_sender(spark, sf_dir):
    """The same from stored tables, where the interval is pushed into the scan."""
    return reports.interval_averages_by_sender(spark, mail_tables(spark, sf_dir), LOW, HIGH)


@query
def avg_raw_mail_by_sender(spark, sf_dir):
    """From raw mails to averages in one job."""
    mails = parse_mail(raw_document_mails(spark, sf_dir), between=(LOW, HIGH))
    return A.averages_by_sender(A.mail_lengths(mails))


def rollup(spark, sf_dir):
    """Sums by sender and day of both stored tables, added one after the other."""

    def write(path):
        for stored in mail_tables(spark, sf_dir):
            rollups.add_to_rollup(spark, path, stored, fan_in=2)
        return path

    return staged(spark, sf_dir, "rollup", write)


@query
def avg_rollup(spark, sf_dir):
    """Whole days from the sums, the rest of the interval from the mails."""
    return rollups.rollup_averages(spark, rollup(spark, sf_dir), LOW_TIME, HIGH_TIME)


@query
def avg_rollup_by_sender(spark, sf_dir):
    return rollups.rollup_averages_by_sender(spark, rollup(spark, sf_dir), LOW_TIME, HIGH_TIME)


@query
def sender_totals_rollup(spark, sf_dir):
    return rollups.rollup_sender_totals(spark, rollup(spark, sf_dir))


@query
def avg_by_sender_where_stored(spark, sf_dir):
    """From a table laid out by sender and month: no mail or sum is shuffled but those of hot senders."""

    def write(path):
        name = f"mails_{uuid.uuid4().hex}"
        store_by_sender(document_mails(spark, sf_dir), name, path, buckets=8)
        return name

    return reports.averages_by_sender_where_stored(spark, staged(spark, sf_dir, "by sender", write), LOW, HIGH)


@query
def avg_all_mail_by_sender(spark, sf_dir):
    """Documents and conversations appended; three senders hold all of the latter."""
    mails = append_mail(document_mails(spark, sf_dir), conversation_mails(spark, sf_dir))
    return A.averages_by_sender(A.mail_lengths(mails))


# --- tokens, counts, projections, filters -----------------------------------


@query
def tokenize(spark, sf_dir):
    return document_mails(spark, sf_dir).select("ID", F.array_join(words(F.col("Body")), "|").alias("words"))


@query
def tokenize_lines(spark, sf_dir):
    """Bodies that kept their line breaks, cut at any whitespace."""
    tokens = words(F.col("Body"), lines_kept=True)
    return document_mails(spark, sf_dir).select("ID", F.array_join(tokens, "|").alias("words"))


@query
def word_count_(spark, sf_dir):
    return document_mails(spark, sf_dir).select(
        "ID", word_count(F.col("Body")).cast("bigint").alias("word_count")
    )


@query
def recipient_count_(spark, sf_dir):
    return document_mails(spark, sf_dir).select(
        "ID", recipient_count(F.col("Recipients")).cast("bigint").alias("recipient_count")
    )


@query
def mail_features(spark, sf_dir):
    return with_features(document_mails(spark, sf_dir)).select(
        "ID",
        "From",
        F.array_join("Words", "|").alias("Words"),
        F.col("WordCount").cast("bigint").alias("WordCount"),
        F.col("RecipientsCount").cast("bigint").alias("RecipientsCount"),
    )


@query
def project_mail(spark, sf_dir):
    return document_mails(spark, sf_dir).select(
        "ID", as_text(), "From", F.array_join("Recipients", "|").alias("Recipients"), "Subject"
    )


@query
def interval_filter(spark, sf_dir):
    return readable(in_interval(document_mails(spark, sf_dir), LOW, HIGH))


@query
def interval_filter_stored(spark, sf_dir):
    return readable(in_interval(load_parquet(spark, *mail_tables(spark, sf_dir)), LOW, HIGH))


@query
def interval_filter_closed(spark, sf_dir):
    """Both bounds inside; each bound is the exact date of a mail where the table has it."""
    mails = document_mails(spark, sf_dir)
    return readable(in_interval(mails, "2000-01-01 00:00:05", "2001-06-01", inclusive="both"))


@query
def conform_schema(spark, sf_dir):
    return readable(to_mail_schema(conversation_mails(spark, sf_dir)))


@query
def append_mail_(spark, sf_dir):
    first, second = document_mails(spark, sf_dir), conversation_mails(spark, sf_dir)
    return readable(append_mail(first, second, first))


@query
def order_by_date_(spark, sf_dir):
    return order_by_date(document_mails(spark, sf_dir)).select(as_text(), "ID", "From", "Subject")


@query
def sql_over_view(spark, sf_dir):
    return query_view(
        A.mail_lengths(document_mails(spark, sf_dir)),
        """
        SELECT `From` AS sender, min(WordCount) AS shortest, max(WordCount) AS longest, count(*) AS mails
        FROM mail_lengths
        WHERE RecipientsCount > 1
        GROUP BY `From`
        """,
        "mail_lengths",
    ).select(
        "sender", F.col("shortest").cast("bigint").alias("shortest"),
        F.col("longest").cast("bigint").alias("longest"), "mails",
    )


# --- totals, rankings, word frequencies --------------------------------------


@query
def sender_totals(spark, sf_dir):
    return A.sender_totals(document_mails(spark, sf_dir))


@query
def top_senders_count(spark, sf_dir):
    return top_n(A.sender_totals(document_mails(spark, sf_dir)), "mails", "sender").select("sender", "mails")


@query
def top_senders_words(spark, sf_dir):
    return top_n(A.sender_totals(document_mails(spark, sf_dir)), "words", "sender").select("sender", "words")


def _ranking(ranked):
    return ranked.select("measure", F.col("rank").cast("bigint").alias("rank"), "sender", "total")


@query
def top_senders_both(spark, sf_dir):
    return _ranking(A.top_senders(A.sender_totals(document_mails(spark, sf_dir))))


@query
def word_frequency(spark, sf_dir):
    return A.word_frequency(document_mails(spark, sf_dir))


def _window_text(ranked):
    return ranked.select(
        F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        F.col("rank").cast("bigint").alias("rank"),
        "word",
        "count",
    )


@query
def top_words_window(spark, sf_dir):
    counts = A.windowed_words(document_mails(spark, sf_dir), "Date")
    return _window_text(A.top_words_by_window(counts))


@query
def top_words_sliding_window(spark, sf_dir):
    counts = A.windowed_words(document_mails(spark, sf_dir), "Date", "1 minute", "30 seconds")
    return _window_text(A.top_words_by_window(counts))


# --- parsing ------------------------------------------------------------------


@query
def mail_parse(spark, sf_dir):
    return readable(parse_mail(raw_document_mails(spark, sf_dir)))


@query
def mail_parse_lines(spark, sf_dir):
    """Line breaks of the body kept."""
    return readable(parse_mail(raw_document_mails(spark, sf_dir), body="lines"))


@query
def mail_parse_header_only(spark, sf_dir):
    """Fields taken from the header alone, never from quoted mails."""
    return readable(parse_mail(raw_document_mails(spark, sf_dir), header_only=True))


@query
def mail_body(spark, sf_dir):
    return parse_mail(raw_document_mails(spark, sf_dir)).select("ID", "Body")


@query
def mail_date_(spark, sf_dir):
    fields = mail_fields(raw_document_mails(spark, sf_dir))
    return fields.select(F.col("Message-ID").alias("ID"), mail_date("Date").alias("Date")).select(
        "ID", as_text()
    )


@query
def mail_date_by_name(spark, sf_dir):
    """Names that contradict the offset win; an unknown name is no date."""
    raw = raw_document_mails(spark, sf_dir).selectExpr(
        "doc_id",
        r"""replace(CASE WHEN doc_id % 7 = 2 THEN replace(value, '-0700 (PDT)', '-0700 (XYZ)') ELSE value END,
                    '-0800 (PST)', '+0200 (pst)') AS value""",
    )
    return parse_mail(raw, zone="name").select("ID", as_text())


@query
def header_unfold(spark, sf_dir):
    """To and X-To lines after unfolding, blanks not cleaned yet."""
    header = unfold_header(raw_document_mails(spark, sf_dir), keep=["doc_id"])
    lines = F.split("header", "\n")

    def first(name):
        return F.coalesce(F.get(F.filter(lines, lambda line: F.startswith(line, F.lit(name))), F.lit(0)), F.lit(""))

    return header.select("doc_id", first("To:").alias("to_line"), first("X-To:").alias("x_to_line"))


@query
def header_normalise(spark, sf_dir):
    """All lines of the mails whose kind the parser knows, blanks cleaned."""
    lines = mail_lines(raw_document_mails(spark, sf_dir), keep=["doc_id"])
    known = [f"{name}:" for name in ("To", "Subject", "X-To", "X-cc")]
    return lines.select("doc_id", F.explode("lines").alias("line")).filter(
        F.expr(H.line_kind("line")).isin(known)
    )


@query
def recipient_map(spark, sf_dir):
    fields = mail_fields(raw_document_mails(spark, sf_dir), keep=["doc_id"])
    return fields.select(
        "doc_id",
        F.array_join(map_recipients("To", "`X-To`"), "|").alias("to_recipients"),
        F.array_join(map_recipients("Cc", "`X-cc`"), "|").alias("cc_recipients"),
    )


@query
def recipient_concat(spark, sf_dir):
    fields = mail_fields(raw_document_mails(spark, sf_dir), keep=["doc_id"])
    return with_recipients(fields).select(
        "doc_id",
        F.array_join("Recipients", "|").alias("recipients"),
        F.size("Recipients").cast("bigint").alias("recipient_count"),
    )


@query
def mail_quarantine(spark, sf_dir):
    """Damaged mails: why a mail is put aside, '' for those that are not.  One pass."""
    parsed = parse_mail(raw_document_mails(spark, sf_dir, damaged=True), keep=["doc_id"])
    reasons = F.when(has_error(), F.array_join(ERROR_COLUMN, ",")).otherwise("")
    return parsed.select("doc_id", reasons.alias("errors"))


@query
def mail_split(spark, sf_dir):
    """Good mails and quarantine stored next to each other by one run of the parser."""
    parsed = parse_mail(raw_document_mails(spark, sf_dir, damaged=True), keep=["doc_id"])
    good, bad = load_parsed(spark, store_parsed(parsed, scratch_dir(spark)))
    counted = good.groupBy("From").agg(F.count("*").alias("good"), F.lit(0).cast("bigint").alias("bad"))
    return counted.unionAll(
        bad.groupBy("From").agg(F.lit(0).cast("bigint"), F.count("*"))
    ).groupBy(F.coalesce("From", F.lit("nobody")).alias("sender")).agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad")
    )


# --- files, tables, documents --------------------------------------------------


@query
def scan_mail_files(spark, sf_dir):
    return readable(read_mail(spark, mail_directory(spark, sf_dir)))


@query
def scan_whole_files(spark, sf_dir):
    """File contents as they are, less the line break that ends a file: one byte, so characters need not be counted."""
    files = read_mail_files(spark, mail_directory(spark, sf_dir)).selectExpr("CAST(value AS BINARY) AS value")
    return files.selectExpr("CAST(left(value, length(value) - 1) AS STRING) AS value")


@query
def scan_listed_files(spark, sf_dir):
    """The same files, listed and read by tasks."""
    files = list_files(spark, mail_directory(spark, sf_dir))
    return readable(parse_mail(read_listed(files)))


@query
def load_parquet_multi(spark, sf_dir):
    return readable(load_parquet(spark, *mail_tables(spark, sf_dir)))


@query
def parquet_roundtrip(spark, sf_dir):
    mails = append_mail(document_mails(spark, sf_dir), conversation_mails(spark, sf_dir))
    return readable(load_parquet(spark, store_parquet(mails, scratch_dir(spark))))


@query
def json_document(spark, sf_dir):
    path = reports.report_averages_by_sender(
        spark, mail_tables(spark, sf_dir), LOW, HIGH, scratch_dir(spark)
    )
    return read_json_document(spark, path, SENDER_AVERAGES)


@query
def json_document_many_files(spark, sf_dir):
    """A document of one object per mail, cut into four files."""
    lengths = A.mail_lengths(document_mails(spark, sf_dir))
    path = store_json_document(lengths, scratch_dir(spark), order_by=["ID"], files=4)
    return read_json_document(spark, path, "ID string, From string, WordCount bigint, RecipientsCount bigint")


@query
def json_lines(spark, sf_dir):
    path = store_json_lines(avg_mail_stats_by_sender(spark, sf_dir), scratch_dir(spark))
    return spark.read.schema(SENDER_AVERAGES).json(path)


# --- streams --------------------------------------------------------------------


def _finish(stream_query):
    stream_query.awaitTermination()
    return stream_query


@query
def stream_lines(spark, sf_dir):
    """Document texts as text files, streamed line by line into Parquet."""

    def write(path):
        table(spark, sf_dir, "documents").select("text").write.text(path)
        return path

    lines = streams.stream_lines(spark, staged(spark, sf_dir, "lines", write))
    out = scratch_dir(spark)
    _finish(sinks.start_parquet(lines, out, scratch_dir(spark), ONCE))
    return spark.read.schema("value string").parquet(out)


@query
def stream_lines_update(spark, sf_dir):
    """The same lines in update mode, batch by batch, as the console would show them."""

    def write(path):
        table(spark, sf_dir, "documents").select("text").write.text(path)
        return path

    lines = streams.stream_lines(spark, staged(spark, sf_dir, "lines", write))
    out = scratch_dir(spark)
    _finish(sinks.start_updates(lines, out, scratch_dir(spark), ONCE))
    return spark.read.schema("value string").parquet(out).select("value")


@query
def stream_mail(spark, sf_dir):
    """One mail per file, streamed, parsed and appended to a stored table."""
    out = scratch_dir(spark)
    _finish(ingest.ingest_stream(spark, mail_directory(spark, sf_dir), out, scratch_dir(spark), ONCE))
    mails, _ = load_parsed(spark, out)
    return readable(mails)


@query
def stream_listed_mail(spark, sf_dir):
    """The same, following a table of the files that were listed by tasks."""
    out, files = scratch_dir(spark), scratch_dir(spark)
    note_new_files(spark, files, mail_directory(spark, sf_dir))
    _finish(ingest.ingest_stream(spark, files, out, scratch_dir(spark), ONCE, listed=True, tasks=None))
    mails, _ = load_parsed(spark, out)
    return readable(mails)


def _in_slices(spark, sf_dir, start, slices=4, mixed=False):
    """Run a stream over the documents' mails that come in slices, one after the other, by date.

    ``start`` is given the stream of mails and returns the queries to run.
    What is in one slice is read in any order; windows lose a mail only if a
    slice brings one older than those before it.  With ``mixed`` every slice has mails of all dates.
    """
    folder = scratch_dir(spark)
    hour = f"(unix_seconds(Date) - {EPOCH_2000}) div 3600"
    for i in range(slices):
        dated = documents(spark, sf_dir).selectExpr("*", *MAIL_OF_DOCUMENT[1:2])
        slice_ = f"doc_id % {slices}" if mixed else f"{hour} * {slices} div {HOURS}"
        part = dated.filter(f"{slice_} = {i}").drop("Date")
        raw_mails(part).write.mode("append").parquet(folder)
        # A slice is one batch, however many files it has.
        stream = spark.readStream.schema("doc_id long, value string").options(
            **streams.NO_AGE_LIMIT, maxFilesPerTrigger=1 << 30
        )
        for running in start(parse_mail(stream.parquet(folder))):
            _finish(running)


@query
def stream_top_senders(spark, sf_dir):
    out, checkpoint = scratch_dir(spark), scratch_dir(spark)
    _in_slices(spark, sf_dir, lambda mails: [rankings.start_top_senders(mails, out, checkpoint, trigger=ONCE)], 2)
    return _ranking(sinks.latest_batch(spark, out))


@query
def stream_top_senders_merged(spark, sf_dir):
    """From results whose batches are merged two at a time."""
    out, checkpoint = scratch_dir(spark), scratch_dir(spark)

    def start(mails):
        return [rankings.start_top_senders(mails, out, checkpoint, trigger=ONCE, fan_in=2)]

    _in_slices(spark, sf_dir, start, 3)
    return _ranking(sinks.latest_batch(spark, out))


@query
def stream_top_senders_count(spark, sf_dir):
    return stream_top_senders(spark, sf_dir).filter("measure = 'mails'")


@query
def stream_top_senders_words(spark, sf_dir):
    return stream_top_senders(spark, sf_dir).filter("measure = 'words'")


@query
def stream_top_words_window(spark, sf_dir):
    """Windows still open when the stream ends are not written."""
    return _top_words_in_slices(spark, sf_dir, 4)


def _top_words_in_slices(spark, sf_dir, slices):
    out, checkpoint = scratch_dir(spark), scratch_dir(spark)

    def start(mails):
        return [rankings.start_top_words(mails, out, checkpoint, event_time="Date", trigger=ONCE)]

    _in_slices(spark, sf_dir, start, slices)
    return _window_text(spark.read.parquet(out))


@query
def stream_words_with_late(spark, sf_dir):
    """Words by window from mails in no order of date: those counted in time, and those of the late mails."""
    out, checkpoint = scratch_dir(spark), scratch_dir(spark)

    def start(mails):
        every = 1 << 30  # all words of a window, not the first few
        return [
            windows.start_top_words_keeping_late(mails, out, checkpoint, every, event_time="Date", trigger=ONCE)
        ]

    _in_slices(spark, sf_dir, start, 2, mixed=True)
    late = A.body_words(windows.late_mails(spark, out), "window").withColumn("count", F.lit(1).cast("long"))
    found = [windows.closed_windows(spark, out), windows.open_windows(spark, out), late]
    rows = reduce(DataFrame.unionAll, [f.select("window", "word", "count") for f in found])
    return rows.groupBy("window", "word").agg(F.sum("count").alias("count")).select(
        F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "word", "count"
    )


@query
def stream_parquet_append(spark, sf_dir):
    """One Parquet output per analysis, each entry with its instant or window."""
    out, checkpoint = scratch_dir(spark), scratch_dir(spark)
    _in_slices(
        spark,
        sf_dir,
        lambda mails: live.start_live_analyses(mails, out, checkpoint, trigger=ONCE, event_time="Date"),
        2,
    )
    sender_rows = sinks.latest_batch(spark, f"{out}/senders").select(
        F.concat("measure", F.when(F.col("instant").isNull(), " without instant").otherwise("")).alias("output"),
        F.col("sender").alias("entry"),
        F.col("rank").cast("bigint").alias("rank"),
        F.col("total").alias("value"),
    )
    word_rows = spark.read.parquet(f"{out}/words").select(
        F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("output"),
        F.col("word").alias("entry"),
        F.col("rank").cast("bigint").alias("rank"),
        F.col("count").alias("value"),
    )
    return sender_rows.unionAll(word_rows)
