"""Text expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import functions as F

#: Full-width ASCII (U+FF01..U+FF5E) and the ordinary characters, by rule.
WIDE = "".join(chr(0xFF01 + i) for i in range(94))
NARROW = "".join(chr(0x21 + i) for i in range(94))
#: Space separators of Unicode other than U+0020, and characters without a visible form.
SPACES = "  " + "".join(map(chr, range(0x2000, 0x200B))) + "  　"
INVISIBLE = "­͏؜᠎" + "".join(map(chr, [*range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065)])) + "﻿"


def plain(column) -> F.Column:
    """Ordinary widths and spaces, no invisible characters; one pass of ``translate``."""
    return F.translate(column, WIDE + SPACES + INVISIBLE, NARROW + " " * len(SPACES))


def squeeze(column) -> F.Column:
    """Runs of white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(column, r"(?U)\s+", " "))
