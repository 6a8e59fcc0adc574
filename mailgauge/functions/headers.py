"""Text and line functions that turn a raw mail into clean header lines.

Regular expressions only ever see the header of a mail.  The rest, usually
most of the text, is split into lines once and looked at line by line.
"""

from __future__ import annotations

# The header fields that are read, in the order they are named.
FIELDS = ["Message-ID", "Date", "From", "Subject", "To", "Cc", "Bcc", "X-To", "X-cc", "X-bcc"]

# Lines starting like this are dropped wherever they stand.
NOISE = [
    "Mime-Version",
    "Content-Type",
    "Content-Transfer-Encoding",
    "X-Folder",
    "X-Origin",
    "X-FileName",
    "X-From",
]

# Address headers that may run over several lines, and the
# headers that end such a run (an empty line ends it too).
FOLDED = ["To", "Cc", "Bcc", "X-To", "X-cc", "X-bcc"]
FOLD_ENDS = ["Cc", "Bcc", "X-To", "X-cc", "X-bcc", "Subject"]

# The address headers end with this one.
LAST_ADDRESS_HEADER = "X-bcc"

# A line holding one of these has its blanks cleaned.
CLEANED = ["To:", "Cc:", "Bcc:", "X-cc:", "X-bcc:", "Subject"]


_LONGEST_KIND = max(len(name) + 1 for name in FIELDS + NOISE)


def _any(names: list[str]) -> str:
    return "(?:" + "|".join(names) + ")"


# (?d): only \n ends a line, as everywhere else in the parser.
_NOISE_LINES = rf"(?dm)^{_any(NOISE)}:[^\n]*(?:\n|\z)"
_FOLD_END = rf"(?:{_any(FOLD_ENDS)}:|\n|\z)"
_NO_FOLD_END = rf"(?!{_FOLD_END})"
# One line break inside a folded header per match: either the one after the
# header's first line, or, right where the last match ended, the one after a
# continuation line.  A "To:" line always starts a header of its own here.
_FOLDED_BREAK = (
    rf"(?dm)(^{_any(FOLDED)}:[^\n]*|(?!\A)\G[^\n]+)\n(?!To:){_NO_FOLD_END}"
)
_LAST_HEADER = rf"\A[^\n]*(?:\n{_NO_FOLD_END}[^\n]+)*+"


def unix_lines(raw: str) -> str:
    return rf"replace({raw}, '\r\n', '\n')"


def header_end(text: str) -> str:
    """1-based position of the line break that ends the header, null without one.

    The header is everything up to the empty line behind the last address
    header.  A mail without that header is header to its end.
    """
    mark = LAST_ADDRESS_HEADER + ":"
    at = rf"if(startswith({text}, '{mark}'), 1, nullif(instr({text}, '\n{mark}'), 0))"
    return rf"nullif(position('\n\n', {text}, {at}), 0)"


def drop_noise(text: str) -> str:
    """Without the lines that start like a noise header."""
    return rf"trim(TRAILING '\n' FROM regexp_replace({text}, r'{_NOISE_LINES}', ''))"


def is_noise(kind: str) -> str:
    names = ", ".join(f"'{name}:'" for name in NOISE)
    return f"{kind} IN ({names})"


def last_header_at(text: str) -> str:
    """1-based start of the first line with the last address header, or 0."""
    return rf"instr(concat('\n', {text}), '\n{LAST_ADDRESS_HEADER}:')"


def unfold_headers(head: str) -> str:
    """Address headers that run over several lines, each on one line.

    A continuation line is joined with one blank.  Subject, From, Date and
    Message-ID are not unfolded.
    """
    return f"regexp_replace({head}, r'{_FOLDED_BREAK}', '$1 ')"


def last_header(tail: str) -> str:
    """The last address header with its continuation lines, still folded."""
    return f"regexp_extract({tail}, r'{_LAST_HEADER}', 0)"


def may_need_cleaning(text: str) -> str:
    return rf"(contains({text}, '\t') OR contains({text}, '  '))"


def clean_address_lines(lines: str) -> str:
    """Tabs deleted and double blanks halved, in lines that name an address header."""
    named = " OR ".join(f"contains(line, '{token}')" for token in CLEANED)
    cleaned = r"replace(replace(line, '\t', ''), '  ', ' ')"
    return f"transform({lines}, line -> if({may_need_cleaning('line')} AND ({named}), {cleaned}, line))"


def line_kind(line: str) -> str:
    """A line up to its first colon, such as ``To:``, or '' without an early colon."""
    start = f"left({line}, {_LONGEST_KIND})"
    return f"left({start}, instr({start}, ':'))"


def field_value(line: str) -> str:
    """What follows the first blank of a header line; all of it if there is none."""
    return f"substr({line}, instr({line}, ' ') + 1)"
