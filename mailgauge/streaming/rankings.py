"""Running top senders and top words per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mailgauge.operators.averages import sender_totals, updated_top_senders
from mailgauge.streaming.sinks import start_appending
from mailgauge.streaming.windows import start_counting


def start_top_senders(
    mails: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 5,
    lines_kept: bool = False,
    trigger: dict | None = None,
    fan_in: int | None = None,
) -> StreamingQuery:
    """After every micro-batch, the top senders over all mails so far.

    By mails and by words, from one aggregation whose state is a row per
    sender; only the senders of the batch and the ranking before it are
    ranked.  Writes instant, measure, rank, sender, total (and batch_id);
    ``fan_in`` as in ``start_appending``.
    """

    def ranked(changed: DataFrame, previous: DataFrame | None) -> DataFrame:
        return updated_top_senders(changed, previous, n).select(F.current_timestamp().alias("instant"), "*")

    totals = sender_totals(mails, lines_kept)
    return start_appending(totals, path, checkpoint, ranked, "update", trigger, with_previous=True, fan_in=fan_in)


def start_top_words(
    mails: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 5,
    event_time: str = "arrived",
    window: str = "1 minute",
    slide: str | None = None,
    delay: str = "1 minute",
    lines_kept: bool = False,
    trigger: dict | None = None,
    fan_in: int | None = None,
) -> StreamingQuery:
    """The most used words of each window, written once the window is closed.

    A window closes when the latest event time seen, which the micro-batch itself may bring, is ``delay`` or more
    past its end; mails later than that are dropped.  Counts are kept for open windows only, as tables below ``path`` and not
    in memory.  ``event_time`` is a column or ``processed``, the time of the micro-batch a mail came in.  Writes
    window, rank, word, count (and batch_id); ``fan_in`` as in ``start_appending``.
    """
    options = {"lines_kept": lines_kept, "trigger": trigger, "fan_in": fan_in}
    path = path.rstrip("/")
    return start_counting(mails, path, path, None, checkpoint, n, event_time, window, slide, delay, **options)
