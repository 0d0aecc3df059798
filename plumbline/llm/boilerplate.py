"""Main text of web pages: consensus of host paths.

The pages come as lines of text. A line falls into sentences; a sentence's path is the kind of its
line (list of links, table row, bullet, prose, other) and its words with numbers, designations and
capitalised words masked, as tag and class are for a node. On each page the line that names the
product opens the container of the main text, the last line that names it closes what is sure of it.
In Spark every path is voted on over all pages of its host and, with less weight, of other hosts: what
also stands before the title, or never among the lines about the product, is furniture. Then each page
is extracted again along the winning paths: a line follows the vote on its sentences, an undecided
line its decided neighbours and its own structure. No list of words takes part.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.lookalikes import _cache, fold
from plumbline.operators.skew import join_hot
from plumbline.session import cut

#: Where a line stands: among the lines about the product, behind them, before the title, on a page without title.
INSIDE, BEHIND, BEFORE, UNTITLED = 0, 1, 2, 3
#: The structure of a line that names the page's product outside lists of links.
OWN = 3
#: Bounds of shares hold with 99 %.
Z = 2.58
#: A path is furniture if more than this share of it stands before titles, ...
BEFORE_SHARE = 0.02
#: ... or at most INSIDE_SHARE of it among the lines about the product and more than RARE_SHARE of the host's pages carry it.
INSIDE_SHARE, RARE_SHARE = 0.3, 0.1
#: A path is main text if it is no furniture and more than this share of it stands among the lines about the product.
MAIN_SHARE = 0.15
#: Occurrences on other hosts weigh as much as this number of own ones at most.
OTHER_HOSTS = 50
KEPT_SHAPES, KEPT_LENGTH = 50_000, 200

_CODE = re.compile(r"(?<![^\W_])(?=[A-Za-z-]*[0-9])[A-Za-z][A-Za-z0-9]*(?:-[A-Za-z0-9]+)*(?![^\W_])")
_NUMBER = re.compile(r"\d+(?:[.,:]\d+)*")
_SEPARATORS = frozenset("|/>»·•\t")
_LINKS = re.compile(r"\s+[|/>»·•]\s+|\s{2,}")
_BULLET = re.compile(r"^(?:[-*•]|\d{1,2}\.)\s+")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+(?=\d|[^\W_a-zß-öø-ÿ])")
_CAPITAL = re.compile(r"(?<=\S)([\s\-–'’])[A-ZÀ-ÖØ-ÞΆ-ΫЀ-Я][\w'’&-]*")
#: Names of several words; a short word may stand between them.
_NAMES = re.compile(r"N(?:[ -](?:[^\W\d_]{2,3}[ -])?N)+(?!\w)")
_DATA = re.compile(r"(\d\S*(\s?[^\W\d_°%]{1,3}|\s?[%°]\S{0,2})?|[A-Z]{2,3}\d{1,2})$")
_WORDS = re.compile(r"[^\W_]+")
_TRAIL = re.compile(r"\s[>»/]\s")
_SITE = re.compile(r"^[^/]*//[^/]*")
_TAIL = re.compile(r"[?#].*$")


def designations(line: str) -> list[tuple[str, str]]:
    """(as written, key) of the product designations of a line: letters first, a digit, and a hyphen or six characters."""
    out = []
    for m in _CODE.findall(line):
        key = m.replace("-", "").upper()
        if len(key) >= 6 or ("-" in m and len(key) >= 4):
            out.append((m, key))
    return out


def page_product(site: str, slug: str, found: list[list[tuple[str, str]]]) -> str | None:
    """The designation of the page's product: one that the url's path holds if there is any, else the most frequent one. The site's name is none."""
    seen: dict[str, int] = {}
    own_site = "".join(_WORDS.findall(site)).upper()
    for codes in found:
        for _, key in codes:
            if key not in own_site:
                seen[key] = seen.get(key, 0) + 1
    if not seen:
        return None
    bare = "".join(_WORDS.findall(slug)).upper()
    return max(seen, key=lambda k: (k in bare, seen[k], k))


def named_title(slug: str, lines: list[str], links: list[bool]) -> int | None:
    """The line that names the product where no designation does: a heading by markup, else the line with most words of the url's last part."""
    for no, line in enumerate(lines):
        if line.startswith("# ") and len(line) > 2:
            return no
    wanted = set(_WORDS.findall(_TAIL.sub("", slug.lower()).rstrip("/").rpartition("/")[2]))
    if len(wanted) < 2:
        return None
    best, at = 0, None
    for no, line in enumerate(lines):
        shared = len(wanted & set(_WORDS.findall(line.lower())))
        if shared > best and 2 * shared >= len(wanted) and shared >= 2 and not links[no] and not _TRAIL.search(line):
            best, at = shared, no
    return at


def is_links(line: str) -> bool:
    """A list of links: three or more short items between separators, no sentence and no table row."""
    if (_SEPARATORS.isdisjoint(line) and "  " not in line) or line.startswith("|") or line.endswith((".", "!", "?")):
        return False
    items = [i for i in _LINKS.split(line) if i]
    return len(items) >= 3 and all(len(i.split()) <= 4 for i in items)


def skeleton(text: str, codes: list[tuple[str, str]], own: str | None) -> tuple[str, str]:
    """The masked words of a sentence, and its numbers."""
    for written, key in codes:
        text = text.replace(written, "\x02" if key == own else "\x01")
    text = _NAMES.sub("N", _CAPITAL.sub(r"\1N", text))
    numbers = _NUMBER.findall(text)
    return (_NUMBER.sub("#", text) if numbers else text).lower(), " ".join(numbers)


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _parts(kind: str, texts: list[str], codes: list[tuple[str, str]], own: str | None) -> list[tuple[int, int]]:
    """The hashed path and numbers of each sentence."""
    out = []
    for text in texts:
        path, numbers = skeleton(text, codes, own)
        out.append((_hash(kind + " " + path), _hash(numbers) if numbers else 0))
    return out


class Shape:
    """What a line says without its page."""

    __slots__ = ("links", "codes", "texts", "kind", "structure", "words", "data", "parts")

    def __init__(self, line: str):
        self.links, self.codes = is_links(line), designations(line)
        bullet = _BULLET.match(line)
        body = line[bullet.end() :] if bullet else line
        self.words = len(body.split())
        table = line.startswith("|") and line.endswith("|") and len(line) > 2
        sentence = self.words >= 4 and body.endswith((".", "!", "?", "…"))
        self.data = not table and not sentence and self.words <= 8 and _DATA.search(body) is not None
        if self.links:
            self.structure, self.kind = -2, "links"
        elif table:
            self.structure, self.kind = 2, "table"
        elif sentence:
            self.structure, self.kind = 2, "bullet" if bullet else "prose"
        else:
            self.structure, self.kind = (-2 if self.codes else 1 if self.data else 0), "bullet" if bullet else "line"
        self.texts = [line] if self.links or table else _SENTENCE.split(body)
        # without a designation the paths are the same on every page
        self.parts = None if self.codes else _parts(self.kind, self.texts, [], None)


def _shapes() -> dict[str, Shape]:
    """Shapes of lines seen before; furniture repeats on every page."""
    kept = _cache().setdefault("line_shapes", {})
    if len(kept) >= KEPT_SHAPES:
        kept.clear()
    return kept


def page_lines(url: str | None, content: str) -> list[tuple[int, int, int, int, bool, list[tuple[int, int, bool]]]]:
    """(line_no, place, structure, words, data, [(path, numbers, first on the page)]) of each visible line.

    structure: OWN for a line that names the product, 2 for sentences and table rows, 1 for data, 0 for
    other short lines, below for lists of links and lines that name other products only.
    """
    raw = fold(content).split("\n")
    if len(raw) != content.count("\n") + 1:  # other line separators do not count
        raw = [fold(line).replace("\n", " ") for line in content.split("\n")]
    lines = [line.strip() for line in raw]
    kept, shapes = _shapes(), []
    for line in lines:
        shape = kept.get(line)
        if shape is None:
            shape = Shape(line)
            if len(line) <= KEPT_LENGTH:
                kept[line] = shape
        shapes.append(shape)
    url = url or ""
    slug = _SITE.sub("", url)
    own = page_product(url[: len(url) - len(slug)], slug, [s.codes for s in shapes])
    named = [n for n, s in enumerate(shapes) if s.codes and not s.links and any(key == own for _, key in s.codes)] if own else []
    title = named[0] if named else named_title(slug, lines, [s.links for s in shapes])
    last = named[-1] if named else title
    out, seen = [], set()
    for no, (line, shape) in enumerate(zip(lines, shapes)):
        if not line:
            continue
        place = UNTITLED if title is None else BEFORE if no < title else INSIDE if no <= last else BEHIND
        mine = not shape.links and (no == title or any(key == own for _, key in shape.codes))
        parts = shape.parts
        if mine or parts is None:
            parts = _parts("own" if mine else shape.kind, shape.texts, shape.codes, own)
        rows = []
        for path, numbers in parts:
            rows.append((path, numbers, path not in seen))
            seen.add(path)
        out.append((no, place, OWN if mine else shape.structure, shape.words, shape.data, rows))
    return out


LINES = "array<struct<line_no:int,place:int,structure:int,words:int,data:boolean,parts:array<struct<path:bigint,numbers:bigint,once:boolean>>>>"


def _arrow_lines(pages: list[list[tuple]]) -> pa.Array:
    """The lines of many pages in Arrow's layout, built from flat columns."""
    lines = [line for page in pages for line in page]
    parts = [part for line in lines for part in line[5]]
    pick = lambda rows, i, kind: pa.array([r[i] for r in rows], kind)
    nested = pa.StructArray.from_arrays([pick(parts, 0, pa.int64()), pick(parts, 1, pa.int64()), pick(parts, 2, pa.bool_())], ["path", "numbers", "once"])
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(line[5]) for line in lines)]), pa.int32()), nested)
    columns = [*(pick(lines, i, pa.int32()) for i in range(4)), pick(lines, 4, pa.bool_()), lists]
    flat = pa.StructArray.from_arrays(columns, ["line_no", "place", "structure", "words", "data", "parts"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, pages)]), pa.int32()), flat)


def _lines_udf():
    @F.arrow_udf(LINES)
    def lines(url: pa.Array, content: pa.Array) -> pa.Array:
        return _arrow_lines([page_lines(u, c) for u, c in zip(url.to_pylist(), content.to_pylist())])

    return lines


def share_bound(k: Column, n: Column, side: int) -> Column:
    """Wilson bound of the share k/n, the lower one for side -1 and the upper one for side 1: few pages prove little."""
    q = k / n
    return (q + Z * Z / (2 * n) + side * Z * F.sqrt(F.greatest(q * (1 - q), F.lit(0.0)) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def path_votes(parts: DataFrame, hosts: DataFrame) -> DataFrame:
    """host, path, n (rows), vote (-1 furniture, 1 main text, 0 undecided), rare (one page of a host with many).

    ``parts`` has host, path, numbers, once, place and data of each sentence, ``hosts`` the number of
    pages of each host. Sentences of pages without a title count as rows and prove nothing. A path
    with changing numbers in a line of data is no furniture for its place behind the product's lines.
    What is furniture by share on the hosts with most of its pages is furniture on other hosts too.
    """
    titled = F.col("place") != UNTITLED
    paths = parts.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("once").alias("carried"), F.count_if(titled).alias("known"), F.count_if(F.col("place") == BEFORE).alias("before"),
        F.count_if(F.col("place") == INSIDE).alias("inside"), F.min("numbers").alias("least"), F.max("numbers").alias("most"), F.max("data").alias("data"),
    )
    # a host with very many paths is spread: the join with hosts broadcasts the largest
    paths = join_hot(paths, hosts, "host", "_weight")
    low = share_bound(F.col("carried"), F.col("pages"), -1)
    paths = paths.withColumn("rare", (F.col("carried") == 1) & (share_bound(F.col("carried"), F.col("pages"), 1) <= RARE_SHARE))
    own_tail = (F.col("known") > 0) & (2 * F.col("inside") < F.col("known"))
    common = (low > RARE_SHARE) & ((F.col("least") == F.col("most")) | ~F.col("data"))
    constant = (low >= INSIDE_SHARE) & own_tail & (F.col("least") == F.col("most"))
    paths = paths.withColumns({"_common": F.when(common & own_tail, F.col("carried")).otherwise(0), "_constant": constant})
    total = paths.groupBy("path").agg(*[F.sum(c).alias("_" + c) for c in ("known", "before", "inside", "carried")], F.sum("_common").alias("_all_common"))
    paths = paths.join(total, "path")
    others = F.col("_known") - F.col("known")
    weight = F.when(others > OTHER_HOSTS, F.lit(float(OTHER_HOSTS)) / others).otherwise(1.0)
    mixed = {c: F.col(c) + weight * (F.col("_" + c) - F.col(c)) for c in ("known", "before", "inside")}
    seen = mixed["known"] > 0
    n = F.greatest(mixed["known"], F.lit(1e-9))
    before = seen & (share_bound(mixed["before"], n, -1) > BEFORE_SHARE)
    behind = seen & (share_bound(mixed["inside"], n, 1) < INSIDE_SHARE) & (2 * F.col("_all_common") > F.col("_carried"))
    main = seen & (share_bound(mixed["inside"], n, -1) > MAIN_SHARE)
    vote = F.when(before | behind | F.col("_constant"), -1).when(main, 1).otherwise(0)
    return paths.select("host", "path", "n", vote.alias("vote"), "rare")


def line_verdicts(pages: DataFrame) -> DataFrame:
    """(fetch_id, line_no, is_main): one row per visible line of each page with content.

    Lines are counted from 0 at line feeds; a line of white space and invisible characters has no row.
    Null and empty contents have no line. A null or odd url belongs to the host ''. Pages fetched again
    vote each; rows with one fetch_id are meant to be one page. A page without a title has main text
    only if more than half of its lines are main text by vote and structure: a pure consent page has
    none. Votes are summed before they are shuffled, and lines meet them with the most frequent paths
    by broadcast: a host with a third of all pages is spread. Of a page only numbers of lines are
    brought together again, in one shuffle by fetch_id.
    """
    host = F.regexp_replace(F.lower(F.coalesce(F.regexp_extract("url", r"://([^/]*)", 1), F.lit(""))), r"^www\.", "")
    lines = (
        pages.select("fetch_id", "url", "content")
        .where(F.col("content").isNotNull())
        .select("fetch_id", host.alias("host"), F.posexplode(_lines_udf()("url", "content")).alias("pos", "l"))
        .select("fetch_id", "host", (F.col("pos") == 0).alias("first"), "l.*")
    )
    lines = cut(lines)
    parts = lines.select("fetch_id", "host", "line_no", "place", "structure", "words", "data", F.explode("parts").alias("p")).select("*", "p.*").drop("p")
    hosts = lines.groupBy("host").agg(F.count_if("first").alias("pages")).withColumn("_weight", F.col("pages"))
    key = F.concat_ws("\x01", "host", F.col("path").cast("string"))
    votes = path_votes(parts, hosts).select(key.alias("_key"), "n", "vote", "rare")
    line = ["fetch_id", "line_no", "place", "structure", "words"]
    is_own = (F.col("structure") == OWN) & (F.col("place") != BEFORE)
    own = lines.where(is_own).select(*line, F.lit(1).alias("vote"), F.lit(False).alias("rare"))
    asked = join_hot(parts.where(~is_own).withColumn("_key", key).select(*line, "_key"), votes, "_key", "n").select(*line, "vote", "rare")
    # one exchange serves the sums by line and the neighbours on the page
    met = own.unionByName(asked).repartition("fetch_id").groupBy(*line).agg(F.sum("vote").alias("_sum"), F.min("vote").alias("_least"), F.min("rare").alias("rare"))
    voted = F.when(F.col("_sum") != 0, F.signum("_sum")).when(F.col("_least") < 0, -1).otherwise(0)
    # a line that names other products only is no main text by vote; a rare sentence before the title is open
    voted = F.when((F.col("structure") == -2) & (voted > 0), 0).otherwise(voted)
    open_head = (F.col("place") == BEFORE) & F.col("rare") & (F.col("structure") == 2) & (F.col("words") >= 8)
    page = Window.partitionBy("fetch_id").orderBy("line_no")
    met = met.withColumn("_voted", F.when(open_head, 1).otherwise(voted))
    decided = F.when(F.col("_voted") != 0, F.col("_voted"))
    before = F.coalesce(F.last(decided, True).over(page.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    behind = F.coalesce(F.first(decided, True).over(page.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    # a short line leads to what follows it
    follows = (F.col("place") != BEFORE) & (F.col("structure") + 0.5 * before + behind > 0)
    met = met.withColumn("is_main", F.when(F.col("_voted") != 0, F.col("_voted") > 0).otherwise(follows))
    kept = F.avg(F.col("is_main").cast("int")).over(Window.partitionBy("fetch_id"))
    return met.select("fetch_id", "line_no", (F.col("is_main") & ((F.col("place") != UNTITLED) | (kept > 0.5))).alias("is_main"))


def main_text(pages: DataFrame) -> DataFrame:
    """(fetch_id, main_text): the main lines of each page in order, joined by line feeds; empty if it has none.

    Pages without content have no row. Only line numbers are gathered per page; the page keeps its text.
    """
    kept = line_verdicts(pages).where("is_main").groupBy("fetch_id").agg(F.array_sort(F.collect_set("line_no")).alias("_keep"))
    text = pages.select("fetch_id", "content").where(F.col("content").isNotNull()).join(kept, "fetch_id", "left")
    lines = F.split("content", "\n", -1)
    picked = F.transform(F.coalesce("_keep", F.array().cast("array<int>")), lambda i: F.get(lines, i))
    return text.select("fetch_id", F.array_join(picked, "\n").alias("main_text"))
