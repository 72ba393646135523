"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_quote(sep: str) -> str:
    """Quote a literal separator for Spark's (Java) regex functions."""
    return "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def jvm_split(c, sep: str = " ") -> Column:
    """Tokens of ``c`` the way ``java.lang.String.split(sep)`` returns them.

    Java drops *trailing* empty tokens (leading and inner ones stay), returns
    ``[""]`` for the empty string and ``[]`` for a string made only of
    separators. Spark SQL ``split`` keeps trailing empties, so trailing
    separators are stripped first.
    """
    c = _c(c)
    if sep == " ":
        trimmed = F.rtrim(c, F.lit(" "))
    else:
        trimmed = F.regexp_replace(c, F.lit("(?:" + regex_quote(sep) + ")+$"), F.lit(""))
    return (F.when(c == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, regex_quote(sep) if sep != " " else " ")))


def jvm_split_trimmed(value, trimmed) -> Column:
    """``jvm_split(value, " ")`` given ``trimmed = rtrim(value, " ")``
    already projected (saves evaluating the trim twice)."""
    v, t = _c(value), _c(trimmed)
    return (F.when(v == "", F.array(F.lit("")))
            .when(t == "", F.array().cast("array<string>"))
            .otherwise(F.split(t, " ")))


def token_count(c, sep: str = " ") -> Column:
    """Number of tokens of ``jvm_split(c, sep)``."""
    return F.size(jvm_split(c, sep))


def lines_of(c) -> Column:
    """Lines of a multi-line text column as a file reader gives them: cut at
    \\n, \\r\\n or \\r, without the empty piece after a final line end (an
    empty text is one empty line)."""
    c = _c(c)
    c = F.when(F.contains(c, F.lit("\r")), F.regexp_replace(c, "\r\n?", "\n")).otherwise(c)
    body = F.when(F.endswith(c, F.lit("\n")), F.left(c, F.length(c) - 1)).otherwise(c)
    return F.split(body, "\n")


def split_multi(c, sep: str = "|") -> Column:
    """Values of a multi-valued field such as ``A|B|C`` (separator literal)."""
    return F.split(_c(c), regex_quote(sep))


def first_match(c, pattern: str = r"\(([0-9]+)\)", group: int = 1) -> Column:
    """First match of ``pattern`` anywhere in ``c``; ``''`` when absent."""
    return F.regexp_extract(_c(c), pattern, group)
