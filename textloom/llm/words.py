"""Words as the tables define them: white-space separated pieces without letter case and anything but letters and digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
_REMOVED = "".join(map(chr, range(128)))
_REMOVED = "".join(c for c in _REMOVED if not c.isalnum() and c not in _SPACES)


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def flat(text: Column) -> Column:
    """The words of the text with one space before, between and after them. ASCII texts take a way without patterns for single characters."""
    general = F.regexp_replace(F.regexp_replace(F.lower(F.upper(text)), r"(?U)[^\p{L}\p{N}\s\x1c-\x1f]+", ""), r"(?U)[\s\x1c-\x1f]+", " ")
    plain = F.regexp_replace(F.translate(F.lower(text), _SPACES + _REMOVED, " " * len(_SPACES)), "  +", " ")
    return F.concat(F.lit(" "), F.trim(F.when(is_ascii(text), plain).otherwise(general)), F.lit(" "))
