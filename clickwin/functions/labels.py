"""Multi-valued label column: comma-separated text such as ``a,b,c``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_labels(col, sep: str = ",") -> Column:
    """Split like ``java.lang.String.split(sep)``.

    Trailing empty strings are removed, inner and leading empties are kept,
    ``''`` gives ``['']``, a string made only of separators gives ``[]``, no
    trimming.  Plain ``split`` keeps trailing empties, so they are stripped
    first.  Null stays null (and ``explode`` then yields no row).
    """
    c = _c(col)
    empty = F.array().cast("array<string>")
    if len(sep) == 1:
        # Fast path, no regular expression per row: trailing separators are
        # trimmed as characters; a non-empty string that trims to '' was
        # made only of separators.  (``split`` with a one-character literal
        # pattern takes the JDK's non-regex fast path.)
        stripped = F.rtrim(c, F.lit(sep))
        return F.when((stripped == F.lit("")) & (c != F.lit("")), empty).otherwise(
            F.split(stripped, _re(sep)))
    only_seps = c.rlike(f"^(?:{_re(sep)})+$")
    stripped = F.regexp_replace(c, F.lit(f"(?:{_re(sep)})+$"), F.lit(""))
    return F.when(only_seps, empty).otherwise(F.split(stripped, _re(sep)))


def _re(sep: str) -> str:
    import re
    return re.escape(sep)
