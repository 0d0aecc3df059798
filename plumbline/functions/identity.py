"""Identity of models and products in text: keys, patterns, slugs."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_RUN = re.compile(r"[^\W_]+")


def identity_key(text: object, compatibility: bool = True) -> str:
    """Letters and digits only, case folded; with ``compatibility`` forms unified first."""
    s = "" if text is None else str(text)
    s = (unicodedata.normalize("NFKC", s) if compatibility else s).casefold()
    return "".join(filter(str.isalnum, s))


def identity_key_udf(compatibility: bool = True):
    """ASCII text needs no Python (see ``identity_key_column``); this is for the rest."""

    @F.pandas_udf("string")
    def key(text: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else identity_key(t, compatibility) for t in text], dtype=object)

    return key


def identity_key_column(text: Column | str, compatibility: bool = True) -> Column:
    """Native for ASCII, Arrow UDF for other text."""
    c = F.col(text) if isinstance(text, str) else text
    other = F.when(c.rlike(r"[^\x00-\x7f]"), c)
    return F.when(c.rlike(r"^[\x00-\x7f]*$"), F.regexp_replace(F.lower(c), "[^a-z0-9]", "")).otherwise(identity_key_udf(compatibility)(other))


#: Between two words one such character alone joins them into one name.
JOINERS = frozenset("._-/")


def _spans(text: str) -> tuple[list[str], list[str]]:
    """The words of a folded text and the gaps around them: one more gap than words."""
    words, gaps, at = [], [], 0
    for m in _RUN.finditer(text):
        gaps.append(text[at : m.start()])
        words.append(m.group())
        at = m.end()
    return words, [*gaps, text[at:]]


def _fold(text: object) -> str:
    return unicodedata.normalize("NFKC", str(text)).casefold()


def names(text: object, model: object) -> bool:
    """Whether a text names exactly the model, at the positions of its words.

    The model's words must follow each other in the text, run together or apart by any punctuation and
    space; a word of the text never holds more than that, and no further word is joined to the place by
    a single dot, hyphen, underscore or slash. Compatibility forms and letter case do not count. False
    where either is missing or the model has no word.
    """
    if text is None or model is None:
        return False
    wanted, _ = _spans(_fold(model))
    if not wanted:
        return False
    ends, total = set(), 0
    for w in wanted:
        total += len(w)
        ends.add(total)
    key = "".join(wanted)
    words, gaps = _spans(_fold(text))
    for first in range(len(words)):
        if not key.startswith(words[first]) or (first and gaps[first] in JOINERS):
            continue
        at, last = 0, first
        while last < len(words) and at < total and key.startswith(words[last], at) and at + len(words[last]) in ends:
            at += len(words[last])
            last += 1
        if at == total and (last == len(words) or gaps[last] not in JOINERS):
            return True
    return False


def names_model(text: Column | str, model: Column | str) -> Column:
    """Column form of ``names``. Texts that cannot hold the model's letters and digits in a row never leave the JVM."""
    t, m = (F.col(x) if isinstance(x, str) else x for x in (text, model))
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    plain = t.rlike(r"^[\x00-\x7f]*$") & m.rlike(r"^[\x00-\x7f]*$")
    maybe = ~plain | F.contains(bare(t), bare(m))

    @F.pandas_udf("boolean")
    def exact(texts: pd.Series, models: pd.Series) -> pd.Series:
        return pd.Series([names(a, b) for a, b in zip(texts, models)], dtype=bool)

    return F.coalesce(exact(F.when(maybe, t), m), F.lit(False))


def slug(text: object, most: int = 96) -> str | None:
    """Readable path component: runs without letters and digits become one hyphen; long ones end in a hash."""
    s = unicodedata.normalize("NFKC", " ".join(str(text).split())).casefold() if text is not None else ""
    out = "-".join("".join(c if c.isalnum() else " " for c in s).split())
    if not out:
        return None
    if len(out) > most:
        digest = hashlib.sha256(s.encode()).hexdigest()[:12]
        out = out[: most - 13].rstrip("-") + "-" + digest
    return out


def stable_path(product_id: object, prefix: str = "products") -> str | None:
    """prefix/readable id-hash of the raw id; different ids never share a path."""
    if product_id is None or not (raw := " ".join(str(product_id).split())) or (readable := slug(raw, 80)) is None:
        return None
    return f"{prefix}/{readable}-{hashlib.sha256(raw.encode()).hexdigest()[:10]}"


def path_udf(prefix: str = "products"):
    @F.pandas_udf("string")
    def make(product_id: pd.Series) -> pd.Series:
        return pd.Series([stable_path(p, prefix) for p in product_id], dtype=object)

    return make


#: A fragment that looks like a model: hyphenated letters and digits, at least 5 characters.
FRAGMENT = r"[A-Za-z0-9]+(?:-[A-Za-z0-9]+)+"


def model_fragments(name: Column | str) -> Column:
    """Distinct upper-case fragments with both letters and digits, in order."""
    found = F.regexp_extract_all(name, F.lit(f"({FRAGMENT})"), F.lit(1))
    return F.array_distinct(F.transform(F.filter(found, lambda f: f.rlike("[A-Za-z]") & f.rlike("[0-9]") & (F.length(f) >= 5)), F.upper))
