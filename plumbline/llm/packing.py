"""Items of varying length packed into containers of fixed capacity.

Bounded-space online best fit: a fixed number of bins is open at a time, filed by their free space in
a bitset. An item goes to the open bin with the least sufficient space; where none has room, the
fullest bin closes and a new one opens. Memory per task does not depend on the number of items.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import tokens
from plumbline.session import cut, spread

CAPACITY = 2048
OPEN_BINS = 512
#: Tokens that one task packs: many times what the open bins hold, so that few bins are left open at its end.
TASK_TOKENS = 64_000_000

PACKED = "container_id bigint, slot int, doc_id bigint, piece_no int, token_start bigint, n_tokens int, container_tokens int"


class OpenBins:
    """The open bins; ``put`` returns the bins that it closed."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.free_bits = 0  # bit s is set where a bin with s free is open
        self.by_free: dict[int, list[list]] = {}
        self.n = 0

    def _take(self, free: int) -> list:
        filed = self.by_free[free]
        found = filed.pop()
        if not filed:
            del self.by_free[free]
            self.free_bits &= ~(1 << free)
        self.n -= 1
        return found

    def put(self, item: tuple, size: int) -> list[list]:
        closed = []
        fits = self.free_bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            target = self._take(free)
        else:
            if self.n >= self.most:
                closed.append(self._take((self.free_bits & -self.free_bits).bit_length() - 1))
            free, target = self.capacity, []
        target.append(item)
        left = free - size
        if left == 0:
            closed.append(target)
        else:
            self.by_free.setdefault(left, []).append(target)
            self.free_bits |= 1 << left
            self.n += 1
        return closed

    def rest(self) -> list[list]:
        return [b for free in sorted(self.by_free) for b in self.by_free[free]]


def pack_partition(batches: Iterator[pd.DataFrame], capacity: int, open_bins: int) -> Iterator[pd.DataFrame]:
    context = TaskContext.get()
    base = (context.partitionId() if context else 0) << 36
    bins, seq = OpenBins(capacity, open_bins), 0

    def rows(closed: list[list]) -> list[tuple]:
        nonlocal seq
        out = []
        for b in closed:
            used = sum(i[3] for i in b)
            out += [(base + seq, slot, *item, used) for slot, item in enumerate(b)]
            seq += 1
        return out

    names = [c.split()[0] for c in PACKED.split(", ")]
    for pdf in batches:
        out: list[tuple] = []
        for item in zip(pdf["doc_id"].tolist(), pdf["piece_no"].tolist(), pdf["token_start"].tolist(), pdf["n_tokens"].tolist()):
            closed = bins.put(item, item[3])
            if closed:
                out += rows(closed)
        yield pd.DataFrame(out, columns=names)
    yield pd.DataFrame(rows(bins.rest()), columns=names)


def token_sizes(documents: DataFrame, tokenizer: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens of every document with a non-null text."""

    @F.pandas_udf("int")
    def size(text: pd.Series) -> pd.Series:
        count = tokens.counter(tokenizer, pattern).count
        return pd.Series([count(t) for t in text], dtype="int32")

    # not deterministic in the planner's sense only: it must not repeat the count to filter by it
    once = size.asNondeterministic()
    return spread(documents.select("doc_id", "text"), "doc_id").where(F.col("text").isNotNull()).select("doc_id", once("text").alias("n_tokens"))


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, tokenizer: str | None = None, pattern: str | None = None, parts: int | None = None) -> DataFrame:
    """One row per item in its container: container_id, slot, doc_id, piece_no, token_start, n_tokens, container_tokens.

    A document is one item; only one longer than ``capacity`` is cut, into full pieces and a remainder
    (piece_no counts from 0; ``token_start`` is the piece's place in the document's tokens). Null texts
    and texts without a token hold nothing to pack and have no row. Repeated rows are packed each.
    Only ids and sizes are shuffled; items are hashed by id and ordered by hash within a task, so a task
    that runs again packs the same containers. ``parts`` is the number of tasks that pack, by default
    one for every TASK_TOKENS tokens. At the end of a task at most ``open_bins`` containers
    are less full than they could be.
    """
    sizes = cut(token_sizes(documents, tokenizer, pattern).where("n_tokens > 0"))
    pieces = F.expr(f"transform(sequence(0, cast((n_tokens - 1) div {capacity} as int)), i -> struct(i as piece_no, cast(i as bigint) * {capacity} as token_start, cast(least({capacity}, n_tokens - i * {capacity}) as int) as n_tokens))")
    items = sizes.select("doc_id", F.explode(pieces).alias("p")).select("doc_id", "p.*")
    spread = F.xxhash64("doc_id", "piece_no", "n_tokens")
    # a number of parts that the tokens give and adaptive execution leaves alone: the containers depend on nothing else
    parts = parts or max(1, -(-(sizes.agg(F.sum("n_tokens")).first()[0] or 0) // TASK_TOKENS))
    ordered = items.withColumn("_h", spread).repartition(parts, "_h").sortWithinPartitions("_h", "doc_id", "piece_no", "n_tokens").drop("_h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return pack_partition(batches, capacity, open_bins)

    return ordered.mapInPandas(run, PACKED)
