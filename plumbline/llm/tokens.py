"""Token counts and positions of a public byte-level tokenizer, a word at a time.

The tokenizer's pattern never joins what stands on both sides of white space but for one leading
space, so a text falls into chunks (optional space and a run without white space, or white space)
that are encoded independently of each other. Chunks repeat, so their counts are kept per worker.
"""

from __future__ import annotations

import base64
import re
import sys
import types
from pathlib import Path

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
_KEPT_CHUNKS = 400_000
_KEPT_LENGTH = 40
# the white space of the pattern's regex engine
_WS = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def tokenizer_path(path: str | None = None) -> str:
    """The vocabulary file: ``path`` if given, else the default file of the installed tokenizers."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class Counter(dict):
    """chunk -> number of tokens, filled as needed; made once per worker and vocabulary file."""

    def __init__(self, path: str, pattern: str | None = None):
        import tiktoken

        if pattern is None:
            from public_tokenizers import PATTERN as pattern

        super().__init__()
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}
        self.encoding = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, chunk: str) -> int:
        n = len(self.encoding.encode_ordinary(chunk))
        if len(chunk) <= _KEPT_LENGTH:
            if len(self) >= _KEPT_CHUNKS:
                self.clear()
            self[chunk] = n
        return n

    def counts(self, chunks: list[str]) -> list[int]:
        return list(map(self.__getitem__, chunks))

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, CHUNK.findall(text)))

    def atoms(self, chunk: str) -> list[tuple[int, int]]:
        """(characters, tokens) of the smallest parts that end both a token and a character."""
        out, held, tokens = [], b"", 0
        for piece in self.encoding.decode_tokens_bytes(self.encoding.encode_ordinary(chunk)):
            held += piece
            tokens += 1
            try:
                out.append((len(held.decode()), tokens))
            except UnicodeDecodeError:
                continue
            held, tokens = b"", 0
        return out


def counter(path: str | None = None, pattern: str | None = None) -> Counter:
    """The worker's counter of a vocabulary file and its split pattern, by default that of the installed tokenizers.

    A pattern must keep apart what stands on both sides of white space, but for one leading space.
    """
    kept = sys.modules.setdefault("_plumbline_cache", types.ModuleType("_plumbline_cache")).__dict__
    path = tokenizer_path(path)
    if ("tokens", path, pattern) not in kept:
        kept["tokens", path, pattern] = Counter(path, pattern)
    return kept["tokens", path, pattern]
