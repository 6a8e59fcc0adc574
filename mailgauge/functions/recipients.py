"""Addresses of a To/Cc/Bcc header paired with the names of its X- header.

All of it is array expressions that walk a list once.  No lambda looks into
an array that is not its own argument, so a list of tens of thousands of
addresses costs linear time.  A header is one line, which leaves the line
break free to mark the cuts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NONE = "CAST(array() AS ARRAY<STRING>)"


def _trimmed(marked: str) -> str:
    return rf"trim(TRAILING '\n' FROM {marked})"


def split_marked(trimmed: str) -> str:
    """Parts between the line breaks of a text that does not end with one."""
    return rf"if({trimmed} = '', {_NONE}, split({trimmed}, '\n'))"


def _cut(marked: str) -> str:
    """Parts between the line breaks, empty parts at the end dropped."""
    return split_marked(_trimmed(marked))


def split_list(value: str) -> str:
    """Parts of a header list cut at comma-blank, empty parts at its end dropped."""
    return _cut(rf"replace({value}, ', ', '\n')")


def mark_unquoted(value: str) -> str:
    """A header list with a line break for every comma outside double quotes, none at the end (see ``split_marked``).

    A comma is outside when an even number of quotes follows it.
    """
    quotes = f"""(length({value}) - length(replace({value}, '"', '')))"""
    # There are quotes + 1 pieces, and quotes - i quotes follow piece i.
    marked = (
        f"""zip_with(split({value}, '"'), sequence({quotes}, 0), (piece, following) -> """
        rf"""if(following % 2 = 0, replace(piece, ',', '\n'), piece))"""
    )
    return _trimmed(f"""array_join({marked}, '"')""")


def split_unquoted(value: str) -> str:
    """Parts of a header list cut at every comma that is outside double quotes."""
    return split_marked(mark_unquoted(value))


def _labelled(addresses: str, names: str) -> str:
    return f"zip_with({addresses}, {names}, (address, name) -> concat(address, '; ', name))"


def _paired(names: str) -> str:
    """Adjacent names joined: [Last, First, Last, First] to [Last First, ...]."""
    even = f"filter({names}, (name, i) -> i % 2 = 0)"
    odd = f"filter({names}, (name, i) -> i % 2 = 1)"
    return f"zip_with({even}, {odd}, (last, first) -> concat(last, ' ', first))"


def needs_unquoted(addresses: str, names: str, a: str, n: str) -> str:
    """Whether ``match_names`` gets as far as names that are cut outside quotes."""
    return (
        f"{addresses} <> '' AND {names} <> '' AND size({a}) <> 1 AND size({a}) <> size({n}) "
        f"AND size({a}) * 2 <> size({n})"
    )


def match_names(addresses: str, names: str, a: str, n: str, unquoted: str) -> str:
    """``map_recipients`` where ``a`` and ``n`` are the two headers after ``split_list``.

    ``unquoted`` is the second one after ``split_unquoted``, which may be null unless ``needs_unquoted``.  All are
    used several times, so in a plan they should be columns.
    """
    return f"""
      CASE
        WHEN {addresses} IS NULL OR {addresses} = '' THEN {_NONE}
        WHEN {names} IS NULL OR {names} = '' THEN {a}
        WHEN size({a}) = 1 THEN array(concat({addresses}, '; ', {names}))
        WHEN size({a}) = size({n}) THEN {_labelled(a, n)}
        WHEN size({a}) * 2 = size({n}) THEN {_labelled(a, _paired(n))}
        WHEN size({a}) = size({unquoted}) THEN {_labelled(a, unquoted)}
        ELSE {a}
      END"""


def map_recipients(addresses: str, names: str) -> Column:
    """``address; name`` for every address, in order.  Takes column names or SQL text.

    * no addresses: empty, whatever the names;
    * no names: the addresses alone;
    * one address: all of the names belong to it, uncut;
    * as many names as addresses: one each;
    * twice as many: "Last, First" lists, two each;
    * as many names when commas inside quotes do not count: one each;
    * anything else: the addresses alone.
    """
    return F.expr(match_names(addresses, names, split_list(addresses), split_list(names), split_unquoted(names)))
