"""The ``Date:`` header as a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted form is "Tue, 4 Mar 2003 18:05:30 +0100 (CET)",
# names in full or cut to three letters, any case, numbers with or without
# leading zeros.
_DAY = "(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)"
_MONTH = (
    "(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec|January|February|March|April|June|July"
    "|August|September|October|November|December)"
)
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MAIL_DATE = (
    rf"(?i)\A[ \t]*{_DAY}, +(-?\d+) +{_MONTH} +(-?\d+)"
    r" +(-?\d+):(-?\d+):(-?\d+) +([+-])([01]\d|2[0-3])([0-5]\d)"
)
_ZONE = r" +\(([^()\n]+)\)"

# Zone names, and minutes ahead of UTC.
ZONE_OFFSETS = {
    "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180, "JST": 540,
    "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}
ZONES = ("offset", "name")


def date_parts(value: str, zone_required: bool = True) -> str:
    """Day, month name, year, hour, minute, second, sign, offset hours and minutes, zone name.

    Null when the text has another form, or an offset beyond 23:59.  The zone
    name in brackets has to be there unless ``zone_required=False``.
    """
    pattern = _MAIL_DATE + (_ZONE if zone_required else "")
    found = f"CASE WHEN {value} RLIKE r'{pattern}' THEN {value} END"
    whole = f"{_MAIL_DATE}(?:{_ZONE})?(?s:.*)"
    return f"split(regexp_replace({found}, r'{whole}', '$1,$2,$3,$4,$5,$6,$7,$8,$9,$10'), ',', 10)"


def date_from_parts(parts: str, zone: str = "offset") -> str:
    """Instant for ``date_parts``, which should be a column as it is used ten times.

    Out-of-range numbers roll over: 31 Feb is 3 Mar, 25:00:00 is one o'clock
    on the next day.  What is beyond any timestamp is null.  The numeric
    offset counts (``zone="offset"``), or the name behind it
    (``zone="name"``): then a date with a name not in ZONE_OFFSETS is null.
    """
    if zone not in ZONES:
        raise ValueError(f"zone must be one of {ZONES}, not {zone!r}")

    def number(i: int) -> str:
        return f"try_cast({parts}[{i}] AS INT)"

    month = f"CAST((instr('{_MONTHS}', lower(left({parts}[1], 3))) + 2) / 3 AS INT)"
    if zone == "name":
        known = ", ".join(f"'{name}', {minutes}" for name, minutes in ZONE_OFFSETS.items())
        offset = f"try_element_at(map({known}), upper({parts}[9]))"
    else:
        offset = f"({number(7)} * 60 + {number(8)}) * if({parts}[6] = '-', -1, 1)"
    seconds = (
        f"(({number(0)} - 1L) * 86400 + {number(3)} * 3600L + ({number(4)} - 0L - {offset}) * 60 + {number(5)})"
    )
    first = f"unix_seconds(try_make_timestamp({number(2)}, {month}, 1, 0, 0, 0, 'UTC'))"
    # Timestamps are microseconds in 64 bits.
    return f"CASE WHEN abs({first} + {seconds}) < 9000000000000 THEN timestamp_seconds({first} + {seconds}) END"


def mail_date(value: str, zone_required: bool = True, zone: str = "offset") -> Column:
    """Instant of a mail date given as column name or SQL text, null when it has another form."""
    return F.expr(date_from_parts(f"({date_parts(value, zone_required)})", zone))
