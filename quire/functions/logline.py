"""Load-log line parsing (X9-X12) as column expressions.

A line reads ``HH:MM:SS up <dur>, <n> user(s), load average: a, b, c``. The
duration may itself hold a comma (``up 1 day, 2:03``), so fields are taken by
one anchored regular expression, not by comma position (quirk Z2).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the line format.
LINE_PATTERN = (r"^\s*([01]?[0-9]|2[0-3]):([0-5][0-9]):([0-5][0-9]|60)\s+up\s+(.*?),"
                r"\s+(\d+)\s+users?,"
                r"\s+load averages?:\s+([0-9.]+),\s+([0-9.]+),\s+([0-9.]+)\s*$")


_MARK = "\u0001"


def parse_fields(value: Column) -> dict[str, Column]:
    """Typed fields of one line; all null where the line does not match.

    The pattern runs once: a matching line is rewritten to its eight fields with
    a mark between them and split; any other line stays without marks (a line
    that holds the mark itself is no load line).
    """
    marked = F.regexp_replace(value, LINE_PATTERN, _MARK.join(f"${i}" for i in range(1, 9)))
    parts = F.when(~value.contains(_MARK), F.split(marked, _MARK))
    parts = F.when(F.size(parts) == 8, parts)

    def field(i: int) -> Column:
        return F.get(parts, F.lit(i))

    sec = field(0).try_cast("int") * 3600 + field(1).try_cast("int") * 60 + field(2).try_cast("int")
    return {
        "sec_of_day": sec.try_cast("bigint"),
        "uptime": field(3),
        "users": field(4).try_cast("int"),
        "load1": field(5).try_cast("double"),
        "load5": field(6).try_cast("double"),
        "load15": field(7).try_cast("double"),
    }


def line_bytes(value: Column) -> Column:
    """Bytes of the line as ``echo $line | wc -c`` counts them.

    The unquoted echo trims and squeezes blanks; the newline adds one byte.
    """
    shown = F.regexp_replace(F.trim(value), r"\s+", " ")
    return F.octet_length(shown) + 1


def shown_line(value: Column) -> Column:
    """The line as the unquoted ``echo`` prints it."""
    return F.regexp_replace(F.trim(value), r"\s+", " ")
