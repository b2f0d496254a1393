"""Character width: full-width forms brought to their plain ones, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))) + "　￥￠￡￦"
_PLAIN = "".join(map(chr, range(0x21, 0x7F))) + " ¥¢£₩"

#: Any space a writer may have used, for regular expressions of the JVM.
SPACES = "[\\s\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\u0085]"


def fold_width(text: Column) -> Column:
    """Full-width letters, digits, signs and spaces as plain ones; null stays null."""
    return F.translate(text, _WIDE, _PLAIN)
