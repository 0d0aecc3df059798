"""Which characters look the same: tables built by rule from the Unicode data, and a short fixed list."""

from __future__ import annotations

import re
import sys
import types
import unicodedata as ud

# Letters of other scripts that share the shape of a Latin letter, and hyphens.
LOOKALIKES = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ν": "v", "ο": "o", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J",
    "Ү": "Y", "Ԁ": "D", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "օ": "o", "հ": "h", "ո": "n", "ս": "u", "ց": "g", "ɡ": "g", "ɑ": "a",
    "‐": "-", "‑": "-",
}

_SYLLABLES = re.compile("[\uac00-\ud7a3]+")
#: Compatibility forms that are drawn like the ordinary characters.
ALIKE_TAGS = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<square>")
#: Format characters that are drawn.
_DRAWN = {0x0600, 0x0601, 0x0602, 0x0603, 0x0604, 0x0605, 0x06DD, 0x070F, 0x08E2, 0x110BD, 0x110CD}
_IGNORABLE = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x1810), 0x2065, 0x3164, *range(0xFE00, 0xFE10), 0xFFA0, *range(0xFFF0, 0xFFF9), *range(0xE0100, 0xE01F0)]


#: Code points with decompositions, marks, spaces or format characters; beyond are ideographs and private use.
CODE_POINTS = [*range(0xD800), *range(0xE000, 0x30000), *range(0xE0000, 0xE0200)]


def _cache() -> dict:
    # functions of this package travel to the workers by value; what is kept between calls lives here
    return sys.modules.setdefault("_plumbline_cache", types.ModuleType("_plumbline_cache")).__dict__


def _decompose(ch: str) -> str:
    """Full decomposition by canonical and alike forms, each part folded; Hangul syllables become their letters."""
    if 0xAC00 <= ord(ch) <= 0xD7A3:
        return ud.normalize("NFD", ch)
    d = ud.decomposition(ch)
    if d:
        tag, _, rest = d.partition(" ") if d.startswith("<") else ("", "", d)
        parts = [chr(int(x, 16)) for x in (rest if tag else d).split()]
        spacing_accent = parts[0] == " " and len(parts) > 1
        if (not tag or tag in ALIKE_TAGS) and not spacing_accent:
            return "".join(_decompose(p) for p in parts)
    return LOOKALIKES.get(ch, ch)


def char_map() -> dict[str, str]:
    """character -> its folded, decomposed form, for every character that is not its own form.

    Kinds of space become a space, line separators a line feed, characters without a visible form
    nothing. Letter case, accents, digits and punctuation are kept.
    """
    kept = _cache().get("char_map")
    if kept is not None:
        return kept
    table: dict[str, str] = {}
    ignorable = set(_IGNORABLE)
    for cp in CODE_POINTS:
        ch = chr(cp)
        cat = ud.category(ch)
        if cat == "Zs" or ch in "\t\x0b\x0c":
            to = " "
        elif cat in ("Zl", "Zp") or cp == 0x85:
            to = "\n"
        elif (cat == "Cf" and cp not in _DRAWN) or cp in ignorable or (cat == "Cc" and ch != "\n"):
            to = ""
        else:
            to = "".join(sorted_marks(_decompose(ch)))
        if to != ch:
            table[ch] = to
    _cache()["char_map"] = table
    return table


def sorted_marks(text: str) -> str:
    """Combining marks of each run in the order of their class, stable."""
    out: list[str] = []
    run: list[str] = []
    for ch in text:
        if ud.combining(ch):
            run.append(ch)
        else:
            out += sorted(run, key=ud.combining)
            run = []
            out.append(ch)
    return "".join(out + sorted(run, key=ud.combining))


def mark_classes() -> dict[str, int]:
    """combining mark -> its class."""
    return {chr(c): ud.combining(chr(c)) for c in CODE_POINTS if ud.combining(chr(c))}


def compositions() -> dict[str, str]:
    """base + mark -> composed character, without those that canonical composition excludes."""
    out = {}
    for c in CODE_POINTS:
        d = ud.decomposition(chr(c))
        if d and not d.startswith("<") and " " in d and ud.normalize("NFC", chr(c)) == chr(c):
            a, b = (chr(int(x, 16)) for x in d.split())
            if ud.combining(b):
                out[a + b] = chr(c)
    return out


def _composed(text: str) -> str:
    """Canonical composition, but for Hangul, whose letters stay apart."""
    text = ud.normalize("NFC", text)
    return _SYLLABLES.sub(lambda m: ud.normalize("NFD", m[0]), text)


def special_characters() -> str:
    """Characters that keep a text from being its own canonical form: all marks, and all whose form differs alone."""
    own = _cache().get("special")
    if own is None:
        own = "".join(c for c, to in char_map().items() if _composed(to) != c) + "".join(mark_classes())
        _cache()["special"] = own
    return own


def java_class(characters: str) -> str:
    """Characters as the inside of a Java character class, in ranges."""
    ranges: list[list[int]] = []
    for p in sorted(set(map(ord, characters))):
        if ranges and ranges[-1][1] == p - 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return "".join(rf"\x{{{a:x}}}" if a == b else rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges)


def attaching_characters() -> str:
    """Combining marks, and characters whose form begins with one: what joins the character before it."""
    return "".join(mark_classes()) + "".join(c for c, to in char_map().items() if to and ud.combining(to[0]))


def invisible_characters() -> str:
    return "".join(c for c, to in char_map().items() if not to)


def fold(text: str) -> str:
    """The canonical form of one text; the same result as ``canonical.canonical_text``."""
    if text.isascii() and text.isprintable():
        return text
    kept = _cache()
    table = kept.get("fold")
    if table is None:
        table = {ord(c): to for c, to in char_map().items()}
        kept["fold"] = table
        kept["special_set"] = frozenset(special_characters())
    if kept["special_set"].isdisjoint(text):
        return text
    return _composed(text.translate(table))
