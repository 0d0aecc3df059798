"""Oversized texts cut at natural boundaries, with an overlap.

Recursive bisection: a span longer than the limit minus the overlap is cut at the strongest boundary
near its middle (paragraph, line, sentence, clause, word, token), and so are its halves. Then every
piece but the first gets the tokens before it as overlap.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import tokens
from plumbline.session import spread

LIMIT = 512
OVERLAP = 64
#: A run without white space of so many tokens stays whole, or of a 16th of what a piece may hold if that is less.
WHOLE = 8

#: Strongest first; a cut is made at the end of a match.
BOUNDARIES = [
    ("paragraph", re.compile(r"\n[^\S\n]*\n\s*")),
    ("line", re.compile(r"\n[^\S\n]*")),
    ("sentence", re.compile(r"[.!?…]+[\"'”’»)\]]*(?=\s)|[。！？]+[”’」』）]*")),
    ("clause", re.compile(r"[,;:](?=\s)|[，；：、]|\s[–—-](?=\s)")),
    ("word", re.compile(r"\S(?=\s)")),
]

PIECE = "array<struct<piece_no:int,char_start:int,char_end:int,core_start:int,n_tokens:int,overlap_tokens:int,ends_at:string,piece:string>>"


class Text:
    """A text with its cuttable positions: characters (off) and tokens (cum) before each."""

    def __init__(self, text: str, counter: tokens.Counter, whole: int = WHOLE):
        self.text, self.counter = text, counter
        chunks = tokens.CHUNK.findall(text)
        counts = counter.counts(chunks)
        lengths = list(map(len, chunks))
        if max(counts, default=0) > whole:  # long runs without white space are taken apart
            lengths, counts, chunks_in = [], [], zip(chunks, counts, strict=True)
            for chunk, n in chunks_in:
                parts = counter.atoms(chunk) if n > whole else [(len(chunk), n)]
                lengths += [p[0] for p in parts]
                counts += [p[1] for p in parts]
        self.off = [0, *accumulate(lengths)]
        self.cum = [0, *accumulate(counts)]

    def cut(self, i: int, j: int) -> tuple[int, str]:
        """Index and kind of the cut of the span between positions i and j, both excluded."""
        off, cum = self.off, self.cum
        middle = (cum[i] + cum[j]) // 2
        quarter = max(1, (cum[j] - cum[i]) // 4)
        lo = max(i + 1, bisect_left(cum, middle - quarter))
        hi = min(j - 1, bisect_right(cum, middle + quarter) - 1)
        m = min(max(bisect_left(cum, middle), i + 1), j - 1)
        for a, b in ((lo, hi), (i + 1, j - 1)):
            if a > b:
                continue
            for kind, pattern in BOUNDARIES:
                best = None
                # one character more, so that what must follow is seen; matches that start before do not count
                for found in pattern.finditer(self.text, off[a - 1], min(len(self.text), off[b] + 1)):
                    at = bisect_left(off, found.end())
                    if at < len(off) and off[at] == found.end() and a <= at <= b and (best is None or abs(cum[at] - middle) < abs(cum[best] - middle)):
                        best = at
                if best is not None:
                    return best, kind
        return m, "token"

    def spans(self, most: int) -> list[tuple[int, int, str]]:
        """(from, to, boundary it ends at) of at most ``most`` tokens each, where a single position allows it."""
        out, stack = [], [(0, len(self.off) - 1, "end")]
        while stack:
            i, j, ends = stack.pop()
            if self.cum[j] - self.cum[i] <= most or j - i < 2:
                out.append((i, j, ends))
                continue
            c, kind = self.cut(i, j)
            stack.append((c, j, ends))
            stack.append((i, c, kind))
        return out

    def before(self, i: int, wanted: int) -> tuple[int, int]:
        """Character and token position ``wanted`` tokens before position i, or as close behind as a character ends."""
        target = max(0, self.cum[i] - wanted)
        k = bisect_left(self.cum, target)
        if self.cum[k] == target or k == 0:
            return self.off[k], self.cum[k]
        at, tok = self.off[k - 1], self.cum[k - 1]
        chunk = self.text[self.off[k - 1] : self.off[k]]
        for chars, n in self.counter.atoms(chunk):
            at, tok = at + chars, tok + n
            rest = self.text[at : self.off[k]]
            # a word that begins in the middle may count differently on its own
            if tok >= target and (not rest or self.counter[rest] <= self.cum[k] - target):
                return at, tok
        return self.off[k], self.cum[k]


def split_text(text: str | None, limit: int, overlap: int, counter: tokens.Counter) -> list[tuple] | None:
    """Pieces of a text longer than ``limit`` tokens, else None. A token takes a byte at least, so short texts are not counted."""
    if text is None or len(text) * 4 <= limit:
        return None
    if len(text) <= limit and len(text.encode("utf-8", "replace")) <= limit:
        return None
    t = Text(text, counter, min(WHOLE, max(1, (limit - overlap) // 16)))
    if t.cum[-1] <= limit:
        return None
    out = []
    for n, (i, j, ends) in enumerate(t.spans(limit - overlap)):
        start, tok = t.before(i, overlap) if n else (0, 0)
        out.append((n, start, t.off[j], t.off[i], t.cum[j] - tok, t.cum[i] - tok, ends, text[start : t.off[j]]))
    return out


def split_documents(documents: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, tokenizer: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per piece of each document longer than ``limit`` tokens.

    Columns: doc_id, piece_no (from 0), char_start, char_end (end excluded), core_start (where the piece
    begins without its overlap), n_tokens, overlap_tokens, ends_at (the boundary it ends at), piece.
    Pieces without their overlaps, in order, are the text. Null, empty and short texts have no piece;
    repeated rows are cut each. The overlap is ``overlap`` tokens, less by a few only where a token does
    not end a character or where the piece would exceed the limit. No shuffle: a text is cut in its task.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be smaller than limit")

    @F.pandas_udf(PIECE)
    def pieces(text: pd.Series) -> pd.Series:
        counter = tokens.counter(tokenizer, pattern)
        return pd.Series([split_text(t, limit, overlap, counter) for t in text], dtype=object)

    return spread(documents.select("doc_id", "text"), "doc_id").where(F.col("text").isNotNull()).select("doc_id", F.explode(pieces("text")).alias("p")).select("doc_id", "p.*")
