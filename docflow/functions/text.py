"""Reading values out of text.

Every function here is a native expression and never fails on bad input: what
cannot be read is null. Results of ``first_match`` are ``''`` where nothing
matched; callers turn that into null in a later projection, because doing it in
place would evaluate the match twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# m: ^ and $ at every line. d: only \n ends a line, so that . and $ do not stop
# at \r, U+0085 or U+2028. U: \s, \S and \d follow Unicode, so that a no-break
# space counts as white space.
FLAGS = "(?mdU)"


def lines(text: Column) -> Column:
    """``text`` as a sequence of lines that each follow a ``\\n``, for ``first_match``."""
    return F.concat(F.lit("\n"), text)


def starts_line(regex: str) -> bool:
    return regex.startswith("^")


def first_match(text: Column, regex: str, group: int) -> Column:
    """Group ``group`` of the first match, ``''`` if there is none.

    For a pattern that starts with ``^`` give ``lines(text)``. The line start is
    then matched as the ``\\n`` before it: a pattern that begins with a literal is
    searched for in leaps, one that begins with ``^`` is tried at every character.
    """
    return F.regexp_extract(text, FLAGS + _searched(regex), group)


def _searched(regex: str) -> str:
    return r"\n" + regex[1:] if starts_line(regex) else regex


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` knows only U+0020)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def filled(text: Column) -> Column:
    """Null for an empty string; ``text`` should be a plain column."""
    return F.when(text != "", text)


def whole_number(text: Column) -> Column:
    return text.try_cast("bigint")


def money(text: Column) -> Column:
    return F.translate(text, ",", "").try_cast("double")


def us_date(text: Column) -> Column:
    """MM/DD/YYYY; impossible dates and the year 0000 are null."""
    parts = F.split(text, "/")
    iso = F.concat_ws("-", parts[2], parts[0], parts[1])
    return F.when((F.size(parts) == 3) & (parts[2] != "0000"), iso.try_cast("date"))


# Of a comma-separated address of three parts or more: the last part but one,
# and the first word of the last.
CITY = r"(?sU)\A.*,\s*([^,]*?)\s*,[^,]*\z"
STATE = r"(?sU)\A.*,.*,\s*([^\s,]+)[^,]*\z"


def address_city(line: Column) -> Column:
    """City of a one-line address, ``''`` if it has none."""
    return F.regexp_extract(line, CITY, 1)


def address_state(line: Column) -> Column:
    """State of a one-line address, ``''`` if it has none."""
    return F.regexp_extract(line, STATE, 1)


def section_count(text: Column, heading: str, bullet: str) -> Column:
    """Lines matching ``bullet`` from the first ``heading`` on; no heading is 0.

    The section starts with its heading, so each later line follows a ``\\n``.
    """
    section = F.regexp_extract(text, rf"(?s)\Q{heading}\E.*", 0)
    return F.regexp_count(section, F.lit(FLAGS + _searched(bullet))).cast("bigint")


def present(*values: Column) -> Column:
    """Array of the non-null values, in order. Values must not be empty strings.

    Unlike ``array_compact`` this stays inside generated code.
    """
    return F.array_remove(F.array(*[F.coalesce(v, F.lit("")) for v in values]), "")
