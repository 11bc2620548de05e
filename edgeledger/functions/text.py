"""Text helpers that keep the splitting and trimming rules of the log format.

Splits use one plain character, which Spark does without a regular expression;
further delimiters are first mapped to it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTROL_CHARS = "".join(map(chr, range(33)))
LINE_ENDS = [chr(code) for code in (0x0A, 0x0D, 0x85, 0x2028, 0x2029)]


def clean(value: Column) -> Column:
    """Strip every character up to and including the space from both ends.

    Most texts need no strip, which their first and last byte tell; the strip itself
    looks at every character.
    """
    last = F.substring(value.cast("binary"), -1, 1)
    ends = (value < "!") | (last < F.lit(b"!"))
    return F.when(ends, F.btrim(value, F.lit(CONTROL_CHARS))).otherwise(value)


def _unify(value: Column, delimiters: str) -> Column:
    """Map all delimiters to the first one."""
    rest = delimiters[1:]
    return F.translate(value, rest, delimiters[0] * len(rest)) if rest else value


def pieces(value: Column, delimiters: str) -> Column:
    """Split at every one of ``delimiters``, without empty pieces at the end.

    A text made of delimiters only has no piece at all (NULL here); the empty text
    is one empty piece.
    """
    body = F.rtrim(_unify(value, delimiters), F.lit(delimiters[0]))
    return F.when((body != "") | (value == ""), F.split(body, re.escape(delimiters[0])))


def has_line_end(value: Column) -> Column:
    found = F.lit(False)
    for char in LINE_ENDS:
        found = found | value.contains(char)
    return found
