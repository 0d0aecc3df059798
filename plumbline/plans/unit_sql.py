"""SQL of the stated units, for an independent engine: other regular expressions, whole-number arithmetic."""

from __future__ import annotations

from plumbline.functions import text
from plumbline.operators import units


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _plain(c: str) -> str:
    return f"translate({c}, {_quoted(text.WIDE + text.SPACES + text.INVISIBLE)}, {_quoted(text.NARROW + ' ' * len(text.SPACES))})"


_NUM = "[-+]?\\d+(?:[.,'' ]\\d+)*(?:[eE][-+]?\\d{1,3})?"
_SINGLE = f"^([^\\d]*?)({_NUM})\\s*(\\D*(?:[m,t]\\W?2)?\\D*)$"
_TOKEN = "[^\\s|,;:=\\d][^\\s|,;=\\d]*2?"
_NAME_PATTERNS = ("[\\[(]\\s*([^\\[\\]()]+?)\\s*[\\])]$", ",\\s*([^,]+?)$", "\\s(?:in|en)\\s+([^\\s,]+(?: [^\\s,]+)?)$", "\\p{Han}\\s+([^\\s,]+(?: [^\\s,]+)?)$")


def _folded(c: str) -> str:
    bare = f"regexp_replace(translate({c}, '²', '2'), '[\\s\\[\\](){{}}.·⋅∙*^\\-]', '', 'g')"
    return f"nullif(case when regexp_full_match({bare}, 'M(W|Wp|Wh|w|wh|V|v)') then 'M' || lower(substr({bare}, 2)) else lower({bare}) end, '')"


def stated_sql() -> str:
    """fact_id, quantity, value_milli of every fact that states one value with a known unit."""
    rows = ", ".join(f"({_quoted(s)}, {_quoted(q)}, {_quoted(u)}, {int(num * 10**10)}::hugeint, {int(den)}::hugeint)" for s, q, u, num, den in units.unit_rows())
    blank = lambda c: f"case when lower(trim({c})) in ('', '-', '--', 'n/a', 'na', 'none', 'null', '?') then null else {c} end"
    in_name = "coalesce(" + ", ".join(f"nullif(regexp_extract(name, '{p}', 1), '')" for p in _NAME_PATTERNS) + ")"
    comma = "coalesce(source_lang, 'en') in ('de', 'it', 'es', 'fr')"
    joins = " ".join(f"left join spellings u_{k} on u_{k}.spelling = k_{k}" for k in ("value", "unit", "name", "two", "one"))
    pick = lambda f: f"case when k_value is not null then u_value.{f} when k_unit is not null then u_unit.{f} when u_name.spelling is not null then u_name.{f} when u_two.spelling is not null then u_two.{f} else u_one.{f} end"
    return f"""with spellings(spelling, quantity, unit, num, den) as (values {rows}),
    f as (select fact_id, source_lang, trim({_plain("translate(value, '−', '-')")}) as v, trim({_plain('unit')}) as u, trim({_plain('name')}) as name, regexp_replace({_plain("translate(quote, '−', '-')")}, '\\s+', ' ', 'g') as quote from fact_item),
    p as (select *, coalesce(regexp_extract(v, '{_SINGLE}', 1), '') as pre, coalesce(regexp_extract(v, '{_SINGLE}', 2), '') as txt, trim(coalesce(regexp_extract(v, '{_SINGLE}', 3), '')) as rest, {blank('u')} as own from f),
    one as (select *, txt <> '' and not regexp_matches(pre, '[±/:]') and (not regexp_matches(pre, '\\pL$') or regexp_matches(pre, '\\p{{Han}}$')) as single, {in_name} as in_name,
      case when txt <> '' and rest = '' and own is null and quote is not null then '^(?:.*[^\\pL\\d.,\\-])?' || regexp_escape(txt) || '(?:\\s(.*)|([^\\d\\s].*)|)$' end as pattern from p),
    a as (select *, case when pattern is not null and regexp_matches(quote, pattern) then coalesce(nullif(regexp_extract(quote, pattern, 1), ''), regexp_extract(quote, pattern, 2), '') end as after from one),
    k as (select *, {_folded('rest')} as k_value, {_folded('own')} as k_unit, {_folded('in_name')} as k_name, {_folded(f"regexp_extract(after, '^(\\[?{_TOKEN} {_TOKEN})(?:$|[\\s|,;\\])\\d])', 1)")} as k_two, {_folded(f"regexp_extract(after, '^\\[?({_TOKEN})', 1)")} as k_one,
      regexp_replace(txt, '[ ''+]', '', 'g') as t from a where single),
    m as (select *, regexp_replace(t, '[eE].*$', '') as m, coalesce(regexp_extract(t, '[eE](-?\\d+)$', 1), '') as e from k),
    d as (select *, case when {comma} and (regexp_full_match(m, '-?\\d{{1,3}}(\\.\\d{{3}})+(,\\d+)?') or contains(m, ',')) and not regexp_matches(m, ',.*\\.') then replace(replace(m, '.', ''), ',', '.')
      when not {comma} and (regexp_full_match(m, '-?\\d{{1,3}}(,\\d{{3}})+(\\.\\d+)?') or not contains(m, ',')) then replace(m, ',', '')
      when regexp_full_match(m, '-?[\\d.]*,\\d+') then replace(replace(m, '.', ''), ',', '.') else replace(m, ',', '') end as digits from m),
    n as (select *, case when e = '' then try_cast(digits as decimal(29, 9)) else try_cast(round(try_cast(digits || 'e' || e as double), 9) as decimal(29, 9)) end as number from d),
    r as (select fact_id, try_cast(number as decimal(20, 9)) as number, {pick('quantity')} as quantity, {pick('unit')} as unit, {pick('num')} as num, {pick('den')} as den from n {joins}),
    s as (select *, ((number + case unit when 'K' then -273.15 when '°F' then -32 else 0 end)::decimal(20, 9) * 1000000000)::hugeint * num as x, den * 10000000000000000::hugeint as y from r where quantity is not null and number is not null)
    select fact_id, quantity, (sign(x)::hugeint * ((abs(x) * 2 + y) // (2 * y)))::bigint as value_milli from s"""


ORACLES = {"p4_found": stated_sql()}
