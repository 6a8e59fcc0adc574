"""From mail directories to a stored mail table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from mailgauge.operators.parse import parse_mail
from mailgauge.sources.mailfiles import read_mail_files
from mailgauge.sources.tables import mark_valid, store_parsed
from mailgauge.streaming.sinks import start_parquet
from mailgauge.streaming.sources import stream_mail

# Files of a micro-batch, each of which the driver holds several times over while it plans the batch; options, in small
# letters, that say otherwise (with the last one, a bound would also lift a limit of age).
BATCH_FILES = 50_000
BOUNDS = {"maxfilespertrigger", "maxbytespertrigger", "latestfirst"}


def ingest_directories(spark: SparkSession, directories: Sequence[str], path: str, **parse_options) -> str:
    """Parse all mails of some directories and store them with their quarantine (see ``load_parsed``)."""
    files = read_mail_files(spark, *directories)
    return store_parsed(parse_mail(files, keep=["path"], **parse_options), path)


def ingest_stream(
    spark: SparkSession,
    directory: str,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    parse_options: dict | None = None,
    compression: str | None = "zstd",
    **options,
) -> StreamingQuery:
    """Keep appending the mails of a growing directory to a stored table, each once.

    Mails and quarantine are kept apart as in ``store_parsed``; read them with
    ``load_parsed``.  Every batch lists the directory anew on the driver: give very many files dated
    directories of their own, or let read ones be moved away (``cleanSource``).
    A batch has BATCH_FILES files at most, unless ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds it: what is
    appended is the same in any number of batches.  ``compression`` suits text that is written once and kept; None is
    the session's.
    """
    if not options.get("listed") and not BOUNDS & {o.lower() for o in options}:
        options["maxFilesPerTrigger"] = BATCH_FILES
    parsed = stream_mail(spark, directory, True, parse_options, **options)
    return start_parquet(mark_valid(parsed), path, checkpoint, trigger, ["valid"], compression)
