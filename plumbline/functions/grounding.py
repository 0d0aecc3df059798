"""Whether a text supports what is said of it: quotes, values, table cells. Arrow UDFs over plain functions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F

from plumbline.functions.identity import identity_key

MOST = 500
_GAP = re.compile(r"\.{3,}|…|\[\s*(?:\.{3,}|…)\s*\]")


def _loose(text: str) -> re.Pattern | None:
    tokens = text.split()
    return re.compile(r"\s+".join(map(re.escape, tokens)), re.IGNORECASE) if tokens else None


def _letters(body: str) -> tuple[str, list[int]]:
    """The body's identity key and, for each of its characters, the place it comes from."""
    if body.isascii():
        at = [i for i, c in enumerate(body) if c.isalnum()]
        return "".join(body[i] for i in at).lower(), at
    out, at = [], []
    for i, c in enumerate(body):
        for x in unicodedata.normalize("NFKC", c).casefold():
            if x.isalnum():
                out.append(x)
                at.append(i)
    return "".join(out), at


def quote_span(quote: object, body: object, most: int = MOST) -> tuple[int, int] | None:
    """(start, end) of the part of ``body`` that a quote stands for, at most ``most`` characters, or None.

    Tried in turn: the quote as it is; with other white space and letter case; by letters and digits
    only; its parts around an ellipsis, in order. Null, empty and blank quotes stand for nothing.
    """
    if not isinstance(quote, str) or not isinstance(body, str) or not quote.strip():
        return None
    span = None
    if (at := body.find(quote)) >= 0:
        span = (at, at + len(quote))
    elif found := _loose(quote).search(body):
        span = found.span()
    elif key := identity_key(quote):
        letters, places = _letters(body)
        if (at := letters.find(key)) >= 0:
            span = (places[at], places[at + len(key) - 1] + 1)
    if span is None:
        parts = [p for p in _GAP.split(quote) if len(identity_key(p)) >= 3]
        if len(parts) >= 2:
            first, end = None, 0
            for p in parts:
                found = _loose(p).search(body, end)
                if not found:
                    return None
                first = found.start() if first is None else first
                end = found.end()
            span = (first, end)
    return span if span and span[1] - span[0] <= most else None


def quote_span_udf(most: int = MOST):
    @F.pandas_udf("struct<start:int,stop:int>")
    def span(quote: pd.Series, body: pd.Series) -> pd.DataFrame:
        found = [quote_span(q, b, most) or (None, None) for q, b in zip(quote, body)]
        return pd.DataFrame(found, columns=["start", "stop"]).astype("Int32")

    return span


def states_value(text: object, value: object, unit: object = None) -> bool:
    """Whether a text states exactly this value (and unit): bounded, not one end of a range or one of several.

    A decimal point may be written as a comma. Without unit any may follow; a blank value is not stated.
    """
    if not isinstance(text, str) or value is None or not str(value).strip():
        return False
    v = str(value).strip()
    number = re.fullmatch(r"[-+]?\d+(?:[.,]\d+)?", v)
    core = re.sub(r"\\\.|,", "[.,]", re.escape(v)) if number else r"\s+".join(map(re.escape, v.split()))
    u = str(unit).strip() if unit is not None else ""
    tail = r"\s*" + re.escape(u) + r"(?![^\W_])(?!\s*[/·^]\s*[^\W\d_])" if u else (r"(?![\d.,]*\d)" if number else r"(?![^\W_])")
    pattern = re.compile(rf"(?<![^\W_])(?<!\d[.,])(?<![-–/~]){core}{tail}", re.IGNORECASE)
    for m in pattern.finditer(text):
        before, after = text[: m.start()].rstrip(), text[m.end() :]
        several = re.match(r"\s*(?:-|–|/|\.\.+|…|to\b|or\b|bis\b|oder\b|a\b|o\b|ou\b|à\b|或|至)\s*[-+]?\d", after, re.IGNORECASE)
        one_of = re.search(r"\d\s*(?:-|–|/|\.\.+|…|\bto|\bor|\bbis|\boder|或|至)$", before, re.IGNORECASE)
        if not several and not one_of:
            return True
    return False


def cells(row: str) -> list[str] | None:
    """The cells of a table row between pipes or tabs; None for another line."""
    line = row.strip("\r\n")
    if "|" in line:
        parts = line.strip().strip("|").split("|")
    elif "\t" in line:
        parts = line.split("\t")
    else:
        return None
    return [p.strip() for p in parts] if len(parts) >= 2 else None


def table_value(body: object, model: object, label: object) -> str | None:
    """The value of ``label`` in the column whose header is exactly ``model``; None without such a column or row."""
    want_model, want_label = identity_key(model), identity_key(label)
    if not isinstance(body, str) or not want_model or not want_label:
        return None
    column = None
    for line in body.split("\n"):
        row = cells(line)
        if row is None:
            column = None
            continue
        keys = [identity_key(c) for c in row]
        hits = [i for i, k in enumerate(keys) if k == want_model]
        if hits:
            column = hits[0] if len(hits) == 1 else None
        elif column is not None and keys[0] == want_label and column < len(row) and row[column]:
            return row[column]
    return None


def states_value_udf():
    @F.pandas_udf("boolean")
    def stated(text: pd.Series, value: pd.Series, unit: pd.Series) -> pd.Series:
        return pd.Series([states_value(t, v, u) for t, v, u in zip(text, value, unit)], dtype=bool)

    return stated


def table_value_udf():
    @F.pandas_udf("string")
    def cell(body: pd.Series, model: pd.Series, label: pd.Series) -> pd.Series:
        return pd.Series([table_value(b, m, x) for b, m, x in zip(body, model, label)], dtype=object)

    return cell
