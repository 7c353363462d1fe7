"""Command-line and clique-argument parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import normalise_name, squeeze_blanks

# The operations the command service knows, and status texts.
KNOWN_OPS = ("author", "coauthor", "clique")
STATUS_OK = "ok"
STATUS_INVALID = "invalid input"
STATUS_UNKNOWN = "unknown command"

# ``name, name[n]``: the last part holds the count in brackets; no ']' may come
# before the '['.
_LAST_PART = r"^([^\[\]]*)\[([+-]?[0-9]+)\]"


def _java_split(c: Column, sep: str) -> Column:
    """Split like a limit-0 Java split: trailing empty parts are dropped."""
    esc = "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep
    return F.split(F.regexp_replace(c, f"{esc}+$", ""), esc)


def parse_command(line: Column) -> dict[str, Column]:
    """``op:arg`` -> op, arg (lower-cased, trimmed, blank-squeezed) and status.

    Text after a second ':' is ignored; a line with fewer than two parts is
    ``invalid input``; an unknown op is ``unknown command``. A blank after the
    colon gives an empty argument, which is also ``invalid input``.
    """
    parts = F.split(line, ":")
    op = F.lower(F.trim(squeeze_blanks(F.trim(F.get(parts, 0)))))
    arg = F.lower(F.trim(squeeze_blanks(F.trim(F.get(parts, 1)))))
    status = (F.when(F.size(parts) < 2, F.lit(STATUS_INVALID))
               .when(arg.isNull() | (arg == ""), F.lit(STATUS_INVALID))
               .when(~op.isin(*KNOWN_OPS), F.lit(STATUS_UNKNOWN))
               .otherwise(F.lit(STATUS_OK)))
    return {"op": op, "arg": arg, "status": status}


def parse_clique(arg: Column) -> dict[str, Column]:
    """``a, b, c[n]`` -> names (normalised, in order, repeats kept) and n.

    ``ok`` is false where the last part has no well-formed ``[n]``.
    """
    parts = _java_split(arg, ",")
    last = F.element_at(parts, -1)
    head = F.regexp_extract(last, _LAST_PART, 1)
    num = F.regexp_extract(last, _LAST_PART, 2)
    n = F.when(last.rlike(_LAST_PART), num.try_cast("bigint"))  # overflow -> null
    names = F.concat(F.slice(parts, 1, F.size(parts) - 1), F.array(head))
    names = F.transform(names, lambda x: normalise_name(x))
    return {"names": names, "min_count": n, "ok": F.coalesce(n.isNotNull(), F.lit(False))}
