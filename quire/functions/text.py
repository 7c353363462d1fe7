"""String column expressions (X1-X8, X13, X14). All built-in, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The record kinds the bibliography treats as one kind, and the
# name they are rewritten to.
DEFAULT_KINDS = ("inproceedings", "mastersthesis", "phdthesis")
TARGET_KIND = "article"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_last_char(c) -> Column:
    """Cut the last character, whatever it is; "" stays ""."""
    c = _col(c)
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - 1, F.lit(0)))


def split_blank(c) -> Column:
    """Split on one blank like a limit-0 Java split.

    Trailing empty tokens are dropped, inner and leading ones are kept, a
    string of blanks only gives no token, and "" gives one "". ``rtrim``
    removes trailing blanks only, so no regular expression runs before the
    split itself.
    """
    c = _col(c)
    cut = F.rtrim(c)
    return F.when((c != "") & (cut == ""), F.array().cast("array<string>")) \
        .otherwise(F.split(cut, " "))


def squeeze_blanks(c) -> Column:
    """Runs of blanks become one blank."""
    return F.regexp_replace(_col(c), " +", " ")


def normalise_name(c) -> Column:
    """X1 + X5 + X6: trim, lower-case and squeeze, as commands do to names."""
    return squeeze_blanks(F.lower(F.trim(_col(c))))


def title_tokens(c) -> Column:
    """Q6 tokeniser: lower-case, drop the last character, split on blanks."""
    return split_blank(drop_last_char(F.lower(_col(c))))


def retag(c, kinds=DEFAULT_KINDS, target: str = TARGET_KIND) -> Column:
    """Rename opening and closing tags of ``kinds`` to ``target``."""
    alt = "|".join(kinds)
    return F.regexp_replace(_col(c), f"<(/?)(?:{alt})(?=[\\s>/]|$)", f"<$1{target}")


def render_author_list(c) -> Column:
    """Join an author list with ',' (nulls skipped)."""
    return F.concat_ws(",", _col(c))


def render_article(title, authors, year) -> Column:
    """``title , [a,b] , year``."""
    return F.concat(_col(title), F.lit(" , ["), render_author_list(authors),
                    F.lit("] , "), _col(year).cast("string"))
