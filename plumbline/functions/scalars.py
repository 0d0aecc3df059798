"""Small column functions: text cleaning, times, numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_line(text: Column | str) -> Column:
    """White space runs become one space, ends trimmed; null stays null."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def clean_term(text: Column | str, most: int = 120) -> Column:
    """Control characters and quotes out, one line, at most ``most`` characters."""
    c = F.regexp_replace(F.regexp_replace(text, r"[\p{Cc}]", " "), "[\"“”]", "")
    return F.left(one_line(c), F.lit(most))


def table_cell(text: Column | str) -> Column:
    """Text that cannot leave its Markdown table cell."""
    c = one_line(text)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\\", "\\\\"), ("|", "\\|")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def markdown_text(text: Column | str) -> Column:
    """Text that forms no Markdown of its own."""
    c = one_line(text)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\\", "\\\\")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, r"([\[\]()*_`])", r"\\$1")


def internal_link(label: Column, path: Column) -> Column:
    """A link to a page of the same site; null where the path is empty, climbs or holds an empty step."""
    clean = F.regexp_replace(one_line(path), "^/+|/+$", "")
    safe = (clean != "") & ~clean.rlike(r"(^|/)(\.{0,2})(/|$)") & ~clean.rlike(r"[\x00-\x1f]")
    step = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    shown = F.array_join(F.transform(F.split(clean, "/"), step), "/")
    return F.when(safe, F.concat(F.lit("["), F.coalesce(F.nullif(markdown_text(label), F.lit("")), F.lit("查看")), F.lit("](/"), F.replace(shown, F.lit("%7E"), F.lit("~")), F.lit(")")))


def search_queries(manufacturer: Column, models: Column, category: Column, most: int = 400) -> Column:
    """Up to three queries for official documents of a product, best first; none without a model.

    ``models`` is an array, best first. Queries that differ in letter case only count once.
    """
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    first, second = F.get(models, F.lit(0)), F.get(models, F.lit(1))
    identity = F.concat_ws(" ", F.when(manufacturer != "", quoted(manufacturer)), quoted(first))
    several = second.isNotNull()
    manual, family = F.lit("official specifications technical manual"), F.lit("manufacturer product family official")
    named = F.array_contains(F.transform(F.concat(F.array(F.coalesce(manufacturer, F.lit(""))), models), F.lower), F.lower(category))
    context = F.when((category != "") & ~named, quoted(category))
    found = F.array(
        F.concat_ws(" ", identity, F.lit("official datasheet PDF")),
        F.when(several, F.concat(quoted(second), F.lit(" filetype:pdf"))).otherwise(F.concat_ws(" ", identity, manual)),
        F.concat_ws(" ", identity, context, F.when(several, manual).otherwise(family)),
    )
    cut = F.transform(found, lambda q: F.left(one_line(q), F.lit(most)))
    once = F.filter(cut, lambda q, i: ~F.exists(F.slice(cut, 1, i), lambda x: F.lower(x) == F.lower(q)))
    return F.when(F.size(models) > 0, once)


def valid_queries(queries: Column, most: int = 3, length: int = 400) -> Column:
    """Whether an array is 1 to ``most`` different queries without control characters, none blank or too long; letter case does not count."""
    clean = F.transform(queries, one_line)
    each = F.forall(queries, lambda q: q.isNotNull() & ~q.rlike(r"[\x00-\x1f\x7f]") & (one_line(q) != "") & (F.length(one_line(q)) <= length))
    return F.coalesce(F.size(queries).between(1, most) & each & (F.size(F.array_distinct(F.transform(clean, F.lower))) == F.size(queries)), F.lit(False))


def probability(text: Column | str) -> Column:
    """A number in [0, 1] written as plain decimal without further leading zeros, else null."""
    return F.when(F.trim(text).rlike(r"^(0(\.\d+)?|1(\.0+)?)$"), F.trim(text).try_cast("double"))


# Names of product categories and the broad category they belong to.
CATEGORY_ALIASES = {
    "heat pump": "热泵", "heat pumps": "热泵", "air source heat pump": "热泵", "air-to-water heat pump": "热泵",
    "ground source heat pump": "热泵", "water source heat pump": "热泵", "空气源热泵": "热泵", "空气能热泵": "热泵", "地源热泵": "热泵", "水源热泵": "热泵",
    "solar inverter": "光伏逆变器", "photovoltaic inverter": "光伏逆变器", "pv inverter": "光伏逆变器", "太阳能逆变器": "光伏逆变器",
}


def broad_category(text: Column | str) -> Column:
    clean = one_line(text)
    table = F.create_map(*[F.lit(x) for pair in CATEGORY_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(clean)), clean)


def next_month_start(ts: Column | str) -> Column:
    return F.add_months(F.trunc(ts, "MM"), 1)


def iso_date(text: Column | str) -> Column:
    """The first ten characters of a text that begins with an ISO date, else the empty string."""
    return F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})", 1)


def retry_after(text: Column | str, most: float, now: Column | None = None) -> Column:
    """Seconds of a Retry-After header between 0 and ``most``: a number, or an HTTP date as seen from ``now``; null if it is neither."""
    n = F.trim(text).try_cast("double")
    at = F.try_to_timestamp(F.regexp_replace(F.trim(text), r"^[A-Z][a-z]{2}, (.*) GMT$", "$1 +0000"), F.lit("dd MMM yyyy HH:mm:ss Z"))
    wait = F.unix_timestamp(at).cast("double") - F.unix_timestamp(now if now is not None else F.current_timestamp()).cast("double")
    bounded = lambda v: F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(most)))
    return F.when(n.isNotNull(), F.when(~F.isnan(n) & (n != F.lit(float("-inf"))), bounded(n))).otherwise(bounded(wait))


def operator_time(text: Column | str) -> Column:
    """An ISO-8601 time with its zone, as an operator types it; null without a zone."""
    c = F.trim(text)
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$"), c.try_cast("timestamp"))


def steps(values: list[int], failures: Column | str) -> Column:
    """The delay for the n-th failure: values in order, the last one from there on; null below one."""
    n = F.col(failures) if isinstance(failures, str) else failures
    return F.when(n >= 1, F.element_at(F.array(*[F.lit(v) for v in values]), F.least(n, F.lit(len(values))).cast("int")))


def finite(value: Column | str) -> Column:
    """A double that is a finite number, else null."""
    v = F.col(value).try_cast("double") if isinstance(value, str) else value.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def close(a: Column, b: Column, rel: float = 1e-12) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(rel))


def rank_score(index: Column, count: Column) -> Column:
    """1 for the first of ``count`` results, falling evenly."""
    return 1.0 - index / F.greatest(count, F.lit(1))
