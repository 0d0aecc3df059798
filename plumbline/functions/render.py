"""Pages of readers: managed blocks inside text that people also edit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

START, END = "<!-- managed:start -->", "<!-- managed:end -->"
#: Markers of earlier releases; a page may still carry one such block.
OLD_START, OLD_END = "<!-- auto:start -->", "<!-- auto:end -->"


def _times(text: Column, marker: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(marker), F.lit("")))) / len(marker)).cast("int")


def _block(managed: Column) -> Column:
    """The block with its markers around a body without blank lines at its ends; null if markers in it are not one whole pair around all of it."""
    text = F.regexp_replace(F.coalesce(managed, F.lit("")), r"\r\n?", "\n")
    inside = F.regexp_extract(text, rf"(?s)^\s*\Q{START}\E(.*)\Q{END}\E\s*$", 1)
    marked = text.rlike(rf"(?s)^\s*\Q{START}\E.*\Q{END}\E\s*$")
    body = F.regexp_replace(F.when(marked, inside).otherwise(text), r"^\n+|\n+$", "")
    clean = ~body.rlike("|".join(rf"\Q{m}\E" for m in (START, END, OLD_START, OLD_END)))
    return F.when(clean, F.concat(F.lit(START + "\n"), F.when(body == "", "").otherwise(F.concat(body, F.lit("\n"))), F.lit(END)))


def merge_managed(current: Column, managed: Column) -> Column:
    """The page with its managed block replaced, or appended where it has none; every other byte is kept.

    A page may carry one pair of markers, of this or of earlier releases. Null where they are not one
    start before one end, or where the new block holds markers of its own. A null page counts as empty.
    """
    page, block = F.coalesce(current, F.lit("")), _block(managed)
    counts = [_times(page, m) for m in (START, END, OLD_START, OLD_END)]
    new = [(counts[0] == 1) & (counts[1] == 1) & (counts[2] == 0) & (counts[3] == 0), START, END]
    old = [(counts[2] == 1) & (counts[3] == 1) & (counts[0] == 0) & (counts[1] == 0), OLD_START, OLD_END]
    gap = F.when(page.endswith("\n\n"), "").when(page.endswith("\n"), "\n").otherwise("\n\n")
    merged = F.when(sum(counts[1:], counts[0]) == 0, F.concat(F.when(page == "", "").otherwise(F.concat(page, gap)), block, F.lit("\n")))
    for whole, start, end in (new, old):
        ordered = F.locate(start, page) < F.locate(end, page)
        merged = merged.when(whole & ordered, F.concat(F.substring_index(page, start, 1), block, F.substring_index(page, end, -1)))
    return merged
