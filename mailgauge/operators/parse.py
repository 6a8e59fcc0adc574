"""Raw mail text to mail table, as one chain of column expressions.

Works on batch and streaming frames alike: no shuffle, no Python worker, one
output row per input row.  Intermediate results that later steps use more
than once are columns of their own, so that each is computed once per mail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailgauge.functions import headers as H
from mailgauge.functions.dates import date_from_parts, date_parts
from mailgauge.functions.recipients import mark_unquoted, match_names, needs_unquoted, split_list, split_marked
from mailgauge.operators.relational import in_interval
from mailgauge.schema import MAIL_COLUMNS

ERROR_COLUMN = "_error"

# Errors that make a row no mail.  A mail without recipients is flagged as
# well but stays in the table and counts zero recipients.
FATAL = ("no_id", "bad_date", "no_from")


def _computed_once(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same frame, with a barrier for filters on the given columns.

    The optimizer moves a filter below the projections that compute its
    columns by copying their expressions into it, step by step through the
    whole chain; for a parsed date that is the parser many times over.  Rows
    that come out of a generator are final, and filters stay above it.
    """
    others = [c for c in df.columns if c not in columns]
    once = f"explode(array(struct({', '.join(_q(columns))}))) AS _row"
    return df.selectExpr(*_q(others), once).selectExpr("_row.*", *_q(others))


def _unfolded(df: DataFrame, raw: str, keep: Sequence[str]) -> DataFrame:
    return (
        df.select(*keep, F.expr(H.unix_lines(f"`{raw}`")).alias("_text"))
        .selectExpr(*_q(keep), "_text", f"{H.header_end('_text')} AS _end")
        .selectExpr(
            *_q(keep),
            f"{H.drop_noise('if(_end IS NULL, _text, left(_text, _end - 1))')} AS _head",
            "substr(_text, _end + 1) AS _rest",
        )
        .selectExpr(*_q(keep), "_head", "_rest", f"{H.last_header_at('_head')} AS _at")
        .selectExpr(
            *_q(keep),
            "if(_at = 0, _head, left(_head, _at - 1)) AS _head",
            "if(_at = 0, '', substr(_head, _at)) AS _tail",
            "_rest",
        )
        .selectExpr(*_q(keep), "_head", "_tail", f"{H.last_header('_tail')} AS _last", "_rest")
        .selectExpr(
            *_q(keep),
            rf"concat({H.unfold_headers('_head')}, replace(_last, '\n', ' '), "
            "substr(_tail, length(_last) + 1)) AS _header",
            "_rest",
        )
    )


def _lines(df: DataFrame, raw: str, keep: Sequence[str]) -> DataFrame:
    header = r"split(_header, '\n')"
    # Noise is told by how a line was written, before blanks are cleaned.
    rest = rf"filter(split(_rest, '\n'), line -> NOT {H.is_noise(H.line_kind('line'))})"
    lines = f"""concat(
        {H.clean_address_lines(header)},
        CASE WHEN _rest IS NULL THEN CAST(array() AS ARRAY<STRING>)
             WHEN {H.may_need_cleaning("_rest")} THEN {H.clean_address_lines(rest)}
             ELSE {rest} END)"""
    return _unfolded(df, raw, keep).selectExpr(*_q(keep), f"{lines} AS _lines")


def _dated(
    located: DataFrame, keep: Sequence[str], between: tuple[str, str], zone_required: bool, zone: str
) -> DataFrame:
    """The mails dated in the interval, told from the date line alone, and their date as ``_when``."""
    line = f"get(_lines, _used[{H.FIELDS.index('Date')}] - 1)"
    parts = located.withColumn("_parts", F.expr(date_parts(H.field_value(line), zone_required)))
    when = parts.selectExpr(*_q(keep), "_lines", "_kinds", "_used", f"{date_from_parts('_parts', zone)} AS _when")
    once = _computed_once(when, ["_lines", "_kinds", "_used", "_when"])
    return in_interval(once, *between, column="_when")


def _fields(
    df: DataFrame,
    raw: str,
    keep: Sequence[str],
    body: str,
    header_only: bool,
    between: tuple[str, str] | None = None,
    zone_required: bool = True,
    zone: str = "offset",
) -> DataFrame:
    if body not in ("joined", "lines"):
        raise ValueError(f"body must be 'joined' or 'lines', not {body!r}")

    # Line numbers of the fields in FIELDS order, 0 for a field without a line.
    found = [f"CAST(array_position(_kinds, '{f}:') AS INT)" for f in H.FIELDS]
    if header_only:
        end = "array_position(_lines, '')"
        found = [f"if({end} = 0 OR {at} < {end}, {at}, 0)" for at in found]
    # Line number 0 looks up index -1, which get() answers with null.
    values = [f"{H.field_value(f'get(_lines, _used[{i}] - 1)')} AS `{f}`" for i, f in enumerate(H.FIELDS)]
    in_body = "get(_kinds, i) = '' OR NOT array_contains(_used, i + 1)"
    separator = r"'\n'" if body == "lines" else "''"
    located = (
        _lines(df, raw, keep)
        .selectExpr(*_q(keep), "_lines", f"transform(_lines, line -> {H.line_kind('line')}) AS _kinds")
        .selectExpr(*_q(keep), "_lines", "_kinds", f"array({', '.join(found)}) AS _used")
    )
    if between:
        located = _dated(located, keep, between, zone_required, zone)
        values = ["_when AS `Date`" if f == "Date" else value for f, value in zip(H.FIELDS, values)]
    return located.selectExpr(
        *_q(keep), *values, f"array_join(filter(_lines, (line, i) -> {in_body}), {separator}) AS Body"
    )


def _q(names: Sequence[str]) -> list[str]:
    return [f"`{name}`" for name in names]


ADDRESS_HEADERS = {"To": "X-To", "Cc": "X-cc", "Bcc": "X-bcc"}


def with_recipients(fields: DataFrame) -> DataFrame:
    """Adds ``Recipients``: all of To, then Cc, then Bcc, repeats kept."""
    headers = [*ADDRESS_HEADERS, *ADDRESS_HEADERS.values()]
    parts = [f"{split_list(f'`{h}`')} AS `_{h}`" for h in headers]
    # Names are cut outside quotes only where nothing else has matched, and once.
    marked = [
        f"CASE WHEN {needs_unquoted(f'`{a}`', f'`{n}`', f'`_{a}`', f'`_{n}`')} THEN {mark_unquoted(f'`{n}`')} END AS `_marked {n}`"
        for a, n in ADDRESS_HEADERS.items()
    ]
    cut = [f"{split_marked(f'`_marked {n}`')} AS `_unquoted {n}`" for n in ADDRESS_HEADERS.values()]
    matched = [
        match_names(f"`{a}`", f"`{n}`", f"`_{a}`", f"`_{n}`", f"`_unquoted {n}`") for a, n in ADDRESS_HEADERS.items()
    ]
    return (
        fields.selectExpr("*", *parts)
        .selectExpr("*", *marked)
        .selectExpr("*", *cut)
        .selectExpr(*_q(fields.columns), f"concat({', '.join(matched)}) AS Recipients")
    )


def unfold_header(df: DataFrame, raw: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``header``: noise lines dropped, address headers unfolded; ``rest``: as it is.

    ``header`` ends before the empty line behind the address headers, ``rest``
    starts with that empty line and is null in a mail that has none.
    """
    unfolded = _unfolded(df, raw, keep).withColumnsRenamed({"_header": "header", "_rest": "rest"})
    return _computed_once(unfolded, ["header", "rest"])


def mail_lines(df: DataFrame, raw: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``lines``: header and rest, with the blanks of address lines cleaned."""
    return _computed_once(_lines(df, raw, keep).withColumnRenamed("_lines", "lines"), ["lines"])


def mail_fields(
    df: DataFrame,
    raw: str = "value",
    keep: Sequence[str] = (),
    body: str = "joined",
    header_only: bool = False,
) -> DataFrame:
    """One string column per header field (null when absent), and ``Body``.

    The first line that starts with a field's name gives its value, wherever
    in the mail it stands; ``header_only=True`` looks no further than the
    first empty line.  All other lines but noise are the body, concatenated as
    they are (``body="joined"``) or with their line breaks (``body="lines"``).
    """
    return _computed_once(_fields(df, raw, keep, body, header_only), [*H.FIELDS, "Body"])


def parse_mail(
    df: DataFrame,
    raw: str = "value",
    keep: Sequence[str] = (),
    body: str = "joined",
    header_only: bool = False,
    zone_required: bool = True,
    between: tuple[str, str] | None = None,
    zone: str = "offset",
) -> DataFrame:
    """Parse a column of raw mails into the mail table.

    Adds ``_error``, the list of what is wrong with the mail (empty when all
    is well); nothing a mail contains can fail the job.  ``keep`` names input
    columns to carry along.  ``between`` is an interval of dates, bounds
    outside as in ``in_interval``: body and recipients of other mails, and of those without a
    readable date, are never put together, and such mails are not returned.
    ``zone`` tells whether a date's offset or its zone name counts (see ``date_from_parts``).
    """
    fields = _fields(df, raw, keep, body, header_only, between, zone_required, zone)
    date = "Date"
    if not between:
        fields = fields.withColumn("Date", F.expr(date_parts("Date", zone_required)))
        date = date_from_parts("Date", zone)
    mail = with_recipients(fields).selectExpr(
        *_q(keep),
        "`Message-ID` AS ID",
        f"{date} AS Date",
        "From",
        "Recipients",
        "Subject",
        "Body",
    )
    errors = """array_compact(array(
        CASE WHEN ID IS NULL OR ID = '' THEN 'no_id' END,
        CASE WHEN Date IS NULL THEN 'bad_date' END,
        CASE WHEN `From` IS NULL OR `From` = '' THEN 'no_from' END,
        CASE WHEN size(Recipients) = 0 THEN 'no_recipients' END))"""
    checked = mail.selectExpr(*_q(MAIL_COLUMNS), *_q(keep), f"{errors} AS {ERROR_COLUMN}")
    return _computed_once(checked, [*MAIL_COLUMNS, ERROR_COLUMN])


def has_error(errors: Sequence[str] = FATAL) -> Column:
    """Whether a parsed mail has one of the given errors."""
    return F.arrays_overlap(F.col(ERROR_COLUMN), F.array(*[F.lit(e) for e in errors]))


def split_valid(parsed: DataFrame, fatal: Sequence[str] = FATAL) -> tuple[DataFrame, DataFrame]:
    """(mails, quarantine): rows without and with a fatal error.

    The quarantine keeps ``_error``, the mails drop it.  Each of the two frames
    runs the parser; ``store_parsed`` writes both in one run.
    """
    broken = has_error(fatal)
    return parsed.filter(~broken).drop(ERROR_COLUMN), parsed.filter(broken)
