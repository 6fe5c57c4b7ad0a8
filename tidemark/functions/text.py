"""Line and token expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(line: Column, separator: str = " ") -> Column:
    """Split a line on `separator`, keeping leading and inner empty tokens, dropping trailing ones.

    A line without the separator is one token, so an empty line gives one empty token; a line of
    separators only gives none. A plain `split` would keep the trailing empties.
    """
    pattern = "".join("\\" + c if c in "\\^$.|?*+()[]{}" else c for c in separator)
    if len(separator) == 1:
        kept = F.rtrim(line, F.lit(separator))
    else:
        kept = F.regexp_replace(line, f"(?:{pattern})+\\z", "")
    trimmed = F.when(kept == "", F.array().cast("array<string>")).otherwise(F.split(kept, pattern, -1))
    return F.when(line.endswith(separator), trimmed).otherwise(F.split(line, pattern, -1))


def lines(text: Column) -> Column:
    """The lines of a text as a file reader yields them.

    LF or CRLF ends a line; an end at the very end of the text starts no further line; an empty
    text has no line. CRs are looked for only in texts that have one.
    """
    ended = F.when(text.endswith("\n"), F.left(text, F.length(text) - 1)).otherwise(text)
    with_cr = F.transform(F.split(ended, "\n", -1), lambda v: F.regexp_replace(v, r"\r\z", ""))
    return (
        F.when(text == "", F.array().cast("array<string>"))
        .when(text.contains("\r"), with_cr)
        .otherwise(F.split(ended, "\n", -1))
    )


def is_blank(line: Column) -> Column:
    """Empty or made of spaces only; tabs and line ends of any kind count as content."""
    return F.rtrim(line) == ""


def prefixed(value: Column, prefix: str) -> Column:
    """A value as the console sink shows it under a prefix."""
    return F.concat(F.lit(prefix + "> "), value)


def utf16_length(value: Column) -> Column:
    """The length in UTF-16 code units, as JVM strings count it: a character beyond the BMP counts as two."""
    beyond = F.octet_length(value) > F.char_length(value) + 2  # only then can a character have four bytes
    return F.when(beyond, F.shiftright(F.octet_length(F.encode(value, "UTF-16BE")), 1)).otherwise(F.char_length(value))
