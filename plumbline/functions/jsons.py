"""JSON that must be strict, and keys that must not travel on."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F


class _Strict(json.JSONDecoder):
    """Decodes what every reader understands alike: a name stands once in an object, numbers are finite."""

    def __init__(self) -> None:
        super().__init__(object_pairs_hook=self.named_once, parse_constant=self.refuse)

    @staticmethod
    def refuse(what: object) -> None:
        raise ValueError(f"not strict: {what}")

    def named_once(self, pairs: list[tuple[str, object]]) -> dict:
        out: dict = {}
        for name, value in pairs:
            if name in out:
                self.refuse(name)
            out[name] = value
        return out


def unfenced(text: str) -> str:
    """The text between the lines of one Markdown fence, if the whole text is fenced (plain or as json)."""
    lines = text.strip().split("\n")
    opens, closes = lines[0].strip(), lines[-1].strip()
    fenced = len(lines) >= 3 and opens in ("```", "```json") and closes == "```"
    return "\n".join(lines[1:-1]) if fenced else text


def strict_object(text: object) -> dict | None:
    """The object of a JSON text, one Markdown fence around it allowed; None with chatter, duplicate keys, NaN or another type."""
    if not isinstance(text, str):
        return None
    try:
        found = _Strict().decode(unfenced(text))
    except (ValueError, RecursionError):
        found = None
    return found if isinstance(found, dict) else None


def without_keys(value: object, banned: frozenset[str]) -> object:
    """The value without banned keys at any depth; keys compare as snake case."""
    if isinstance(value, dict):
        return {k: without_keys(v, banned) for k, v in value.items() if snake(k) not in banned}
    if isinstance(value, list):
        return [without_keys(v, banned) for v in value]
    return value


def snake(key: str) -> str:
    """Lower-case words joined by underscores; a word ends at other characters and before a capital behind a small letter or digit."""
    words, word, before = [], "", ""
    for c in key:
        known = c.isascii() and c.isalnum()
        if word and (not known or (c.isupper() and not before.isupper())):
            words.append(word)
            word = ""
        if known:
            word += c.lower()
        before = c
    return "_".join([*words, word] if word else words)


def canonical(value: object) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def stripped_udf(banned: list[str]):
    """Canonical JSON of a strict object without the banned keys; null for what is no strict object."""
    keys = frozenset(banned)

    @F.pandas_udf("string")
    def strip(text: pd.Series) -> pd.Series:
        objects = [strict_object(t) for t in text]
        return pd.Series([None if o is None else canonical(without_keys(o, keys)) for o in objects], dtype=object)

    return strip
