"""Evaluation items that leak into training text.

The items form a BM25 inverted index with block maxima. Every passage of every document queries it:
words outside any stretch of ``run`` index words are no query terms, passages whose summed upper
bounds stay below the lowest threshold are skipped, the rest runs block-max WAND and retrieves every item that reaches the item's own threshold. The threshold is the
score of the weakest run of ``run`` words of that item, so no shared run can score less, whatever its
words: the retrieval loses nothing. Retrieved pairs are verified word by word.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.lookalikes import fold
from plumbline.session import spread

RUN = 13
BLOCK = 32
#: Characters of item texts in one broadcast index; its size is a small multiple of that.
BLOCK_CHARS = 8_000_000
K1, B = 1.2, 0.75
_CONTROL = re.compile(r"[\x00-\x09\x0b-\x1f\x7f]")
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Maximal runs of letters and digits of the folded text, lower case."""
    if not text.isascii() or _CONTROL.search(text):
        text = fold(text)
    return _WORD.findall(text.lower())


class Index:
    """Inverted index of the items: term -> blocks of (item, impact) with their maxima."""

    def __init__(self, items: list[tuple[int, str]], run: int = RUN):
        self.run = run
        docs = [(i, words(t)) for i, t in items]
        docs = [(i, w) for i, w in docs if len(w) >= run]
        self.ids = [i for i, _ in docs]
        self.vocab: dict[str, int] = {}
        self.seqs = [[self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws] for _, ws in docs]
        n, avg = len(docs), sum(len(s) for s in self.seqs) / max(1, len(docs))
        df = np.zeros(len(self.vocab) + 1, dtype=np.int64)
        for s in self.seqs:
            df[list(set(s))] += 1
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        postings: dict[int, list[tuple[int, float]]] = {}
        self.threshold = np.zeros(n)
        self.runs: list[set[tuple[int, ...]]] = []
        for d, s in enumerate(self.seqs):
            norm = K1 * (1 - B + B * len(s) / avg)
            impact = {t: float(idf[t]) * n_t * (K1 + 1) / (n_t + norm) for t, n_t in Counter(s).items()}
            for t, w in impact.items():
                postings.setdefault(t, []).append((d, w))
            grams = {tuple(s[k : k + run]) for k in range(len(s) - run + 1)}
            self.runs.append(grams)
            self.threshold[d] = min(sum(impact[t] for t in set(g)) for g in grams) - 1e-9
        self.lowest = float(self.threshold.min()) if n else math.inf
        self.best = np.zeros(len(self.vocab) + 1)
        self.blocks: dict[int, list[tuple[int, float, list[tuple[int, float]]]]] = {}
        for t, p in postings.items():
            p.sort()
            self.blocks[t] = [(p[k : k + BLOCK][-1][0], max(w for _, w in p[k : k + BLOCK]), p[k : k + BLOCK]) for k in range(0, len(p), BLOCK)]
            self.best[t] = max(w for _, w in p)

    def search(self, terms: set[int]) -> list[int]:
        """Items whose score for the passage reaches their threshold, by block-max WAND."""
        cursors = [[0, 0, t] for t in terms if t]  # block, place in block, term
        found = []

        def doc(c: list[int]) -> int:
            return self.blocks[c[2]][c[0]][2][c[1]][0]

        def seek(c: list[int], d: int) -> bool:
            blocks = self.blocks[c[2]]
            while c[0] < len(blocks) and blocks[c[0]][0] < d:
                c[0], c[1] = c[0] + 1, 0
            if c[0] == len(blocks):
                return False
            posting = blocks[c[0]][2]
            while posting[c[1]][0] < d:
                c[1] += 1
            return True

        while cursors:
            cursors.sort(key=doc)
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += self.best[c[2]]
                if bound >= self.lowest:
                    pivot = k
                    break
            if pivot < 0:
                break
            d = doc(cursors[pivot])
            while pivot + 1 < len(cursors) and doc(cursors[pivot + 1]) == d:
                pivot += 1
            block_bound, ends = 0.0, []
            for c in cursors[: pivot + 1]:
                blocks, k = self.blocks[c[2]], c[0]
                while k < len(blocks) and blocks[k][0] < d:
                    k += 1
                if k < len(blocks):
                    block_bound += blocks[k][1]
                    ends.append(blocks[k][0] + 1)
            if block_bound >= self.lowest:
                if doc(cursors[0]) == d:
                    if sum(self.blocks[c[2]][c[0]][2][c[1]][1] for c in cursors[: pivot + 1] if doc(c) == d) >= self.threshold[d]:
                        found.append(d)
                    to = d + 1
                else:
                    to = d
            else:
                to = min([*ends, *([doc(cursors[pivot + 1])] if pivot + 1 < len(cursors) else [])], default=d + 1)
                to = max(to, d + 1)
            head = [c for c in cursors[: pivot + 1] if seek(c, to)]
            cursors = head + cursors[pivot + 1 :]
        return found

    def leaked(self, texts: list[str | None]) -> list[list[int]]:
        """For each text the ids of the items with which it shares a run, ascending."""
        run, stride, width = self.run, self.run + 1, 2 * self.run
        get, out = self.vocab.get, []
        for text in texts:
            if not text or not self.ids:
                out.append([])
                continue
            seq = [get(w, 0) for w in words(text)]
            n = len(seq)
            if n < run:
                out.append([])
                continue
            terms = np.array(seq, dtype=np.int64)
            # a shared run holds words of the index only: other stretches are no query terms
            edges = np.flatnonzero(np.diff(np.concatenate(([False], terms > 0, [False])).astype(np.int8)))
            begin, end = edges[::2], edges[1::2]
            long = end - begin >= run
            if not long.any():
                out.append([])
                continue
            keep = np.zeros(n + 1, dtype=np.int8)
            keep[begin[long]] += 1
            keep[end[long]] -= 1
            terms = np.where(np.cumsum(keep[:-1]) > 0, terms, 0)
            seq = terms.tolist()
            ahead = np.concatenate(([0.0], np.cumsum(self.best[terms])))
            # passages of 2*run words, run+1 apart: any run of words lies within one
            starts = np.arange(0, max(1, n - run + 1), stride)
            bounds = ahead[np.minimum(starts + width, n)] - ahead[starts]
            hits: set[int] = set()
            for s in starts[bounds >= self.lowest].tolist():
                passage = seq[s : s + width]
                wanted = [d for d in self.search(set(passage)) if d not in hits]
                if wanted:
                    grams = [tuple(passage[k : k + run]) for k in range(len(passage) - run + 1)]
                    hits.update(d for d in wanted if not self.runs[d].isdisjoint(grams))
            out.append(sorted({self.ids[d] for d in hits}))
        return out


def _search_udf(shared):
    @F.pandas_udf("array<bigint>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index.__new__(Index)
        index.__dict__.update(pickle.loads(zlib.decompress(shared.value)))
        for text in batches:
            yield pd.Series(index.leaked(text.tolist()), dtype=object)

    return found


def leaked_items(documents: DataFrame, items: DataFrame, run: int = RUN, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id): the document and the item share a run of at least ``run`` consecutive words.

    Case, punctuation, spacing and line breaks do not count; characters that look the same are the
    same. Null and empty texts, and items shorter than a run, share nothing; repeated documents are
    reported once per row, repeated items once. The index of items with about ``block_chars``
    characters is broadcast at a time; a larger item table is worked through in blocks, each against all
    documents, so every block more is one more pass over them. Documents are not shuffled.
    """
    spark = documents.sparkSession
    table = items.select("item_id", "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    chars = table.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    docs = spread(documents.select("doc_id", "text"), "doc_id").where(F.col("text").isNotNull())
    result = None
    for b in range(blocks):
        part = table if blocks == 1 else table.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        index = Index([(r[0], r[1]) for r in part.orderBy("item_id").toLocalIterator()], run)
        found = _search_udf(spark.sparkContext.broadcast(zlib.compress(pickle.dumps(index.__dict__))))
        hits = docs.select("doc_id", F.explode(found("text")).alias("item_id"))
        result = hits if result is None else result.unionByName(hits)
    return result
