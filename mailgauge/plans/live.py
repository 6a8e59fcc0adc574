"""The running analyses of a growing mail directory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from mailgauge.streaming.rankings import start_top_senders, start_top_words
from mailgauge.streaming.windows import start_top_words_keeping_late


def start_live_analyses(
    mails: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 5,
    trigger: dict | None = None,
    fan_in: int | None = None,
    keep_late: bool = False,
    **windows,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Top senders overall and top words per window, each to a Parquet output of its own.

    ``path/senders`` gets instant, measure, rank, sender, total after every
    micro-batch, ``path/words`` gets window, rank, word, count for every
    closed window.  ``windows`` are the options of ``start_top_words``; with ``fan_in`` both outputs stay few
    files (see ``start_appending``).  ``keep_late=True`` keeps the mails that come after their window was closed, as
    ``start_top_words_keeping_late`` does: below ``path/words`` are then ``words`` and ``late``.
    """
    shared = {"n": n, "trigger": trigger, "fan_in": fan_in}
    senders = start_top_senders(mails, f"{path}/senders", f"{checkpoint}/senders", **shared)
    start = start_top_words_keeping_late if keep_late else start_top_words
    words = start(mails, f"{path}/words", f"{checkpoint}/words", **shared, **windows)
    return senders, words
