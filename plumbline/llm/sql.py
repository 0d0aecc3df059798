"""SQL that an independent engine can run beside the text queries."""

from __future__ import annotations



def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ranges(text: str) -> str:
    """Characters from ranges like '2000-200A 3000' of code points."""
    out = []
    for part in text.split():
        first, _, last = part.partition("-")
        out += map(chr, range(int(first, 16), int(last or first, 16) + 1))
    return "".join(out)


# Written out here and not taken from the operator's tables, so that an error in those shows: kinds of
# space, characters without a visible form, letters of other scripts that are drawn like Latin ones.
SPACES = "A0 1680 2000-200A 202F 205F 3000"
UNSEEN = "AD 34F 61C 115F-1160 17B4-17B5 180B-180F 200B-200F 202A-202E 2060-206F 3164 FE00-FE0F FEFF FFA0"
DRAWN_ALIKE = {
    "А В Е К М Н О Р С Т Х Ѕ І Ј Ү Ԛ Ԝ": "A B E K M H O P C T X S I J Y Q W", "а е о р с у х ѕ і ј һ ԁ ԛ ԝ": "a e o p c y x s i j h d q w",
    "Α Β Ε Ζ Η Ι Κ Μ Ν Ο Ρ Τ Υ Χ": "A B E Z H I K M N O P T Y X", "ο ν ɡ ɑ օ հ ո ս": "o v g a o h n u", "‐ ‑": "- -", "K Å µ Ω": "K Å μ Ω",
}
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}


def canonical_sql(column: str) -> str:
    """The canonical form of a text in DuckDB's SQL: one translation, ligatures, composition; for the characters that the test tables hold."""
    single = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)} | {c: " " for c in _ranges(SPACES)} | {"\t": " ", "\u2028": "\n", "\u2029": "\n", "\x85": "\n"}
    for odd, plain in DRAWN_ALIKE.items():
        single |= dict(zip(odd.split(), plain.split(), strict=True))
    moved = f"translate({column}, {_text(''.join(single) + _ranges(UNSEEN) + chr(13))}, {_text(''.join(single.values()))})"
    for a, b in LIGATURES.items():
        moved = f"replace({moved}, '{a}', '{b}')"
    return f"nfc_normalize({moved})"


def _lookalike_forms() -> str:
    parts = " union all ".join(
        f"select '{table}' as src_table, {key} as id, {text} as t, {canonical_sql(text)} as c from {table} where {text} is not null"
        for table, key, text in (("products", "row_id", "product_name"), ("web_fetch_exa", "fetch_id", "content"))
    )
    return f"with forms as ({parts})"


def lookalike_sql() -> str:
    """All pairs of rows of one table whose forms are equal and whose texts differ."""
    return f"{_lookalike_forms()} select distinct a.src_table, a.id as id_a, b.id as id_b from forms a join forms b on a.src_table = b.src_table and a.c = b.c and a.t <> b.t and a.id < b.id"


def class_sql() -> str:
    """Every row with the hash of its form and the number of rows that look the same but differ."""
    return f"{_lookalike_forms()} select src_table, id, md5(c) as class_id, count(*) over (partition by src_table, c) - count(*) over (partition by src_table, t) as n_links from forms"


def leak_sql(run: int = 13) -> str:
    """Documents and items with a common run of words, over all runs of both."""
    def runs(table: str, key: str) -> str:
        return f"""select distinct {key}, array_to_string(w[i:i + {run - 1}], ' ') as g from (
          select {key}, w, unnest(range(1, len(w) - {run - 2})) as i from (select {key}, regexp_extract_all(lower({canonical_sql('text')}), '[\\p{{L}}\\p{{N}}]+') as w from {table} where text is not null) where len(w) >= {run})"""

    return f"select distinct doc_id, item_id from ({runs('documents', 'doc_id')}) d join ({runs('eval_items', 'item_id')}) e using (g)"


def match_sql(wanted: str = "src_field, record_key, coalesce(brand_code, '-') as brand_code", rest: str = "") -> str:
    """Records and entries by comparing every open value with every key of the registry: no segments, no positions."""
    from plumbline.llm import registry_match as rm

    src, dst = map(_text, rm._translate_pairs())
    words = "[" + ", ".join(map(_text, rm.AFFIX_WORDS.split())) + "]"
    bare = lambda c: f"regexp_replace({c}, '[^\\pL\\pN]', '', 'g')"
    without = lambda c, cut: f"array_to_string(list_filter(string_split_regex({c}, '{cut}'), lambda w: w <> '' and not list_contains({words}, w)), '')"
    ends = "|".join(f"^{w}|{w}$" for w in rm.GLUED_WORDS)
    digits, letters = rm.DIGITS_AS_LETTERS
    return f"""with names as (select brand_code, lower(translate(unnest(list_concat([brand_code, manufacturer], coalesce(alias_list, []))), {src}, {dst})) as t from brand_registry),
    keys as (select distinct brand_code, key, case when length(key) <= 3 then 0 when length(key) <= 5 then 1 else 2 end as k
      from (select brand_code, unnest([{bare('t')}, {without('t', '[^\\pL\\pN]+')}]) as key from names) where key <> ''),
    decisions as (select product_id, d from (select product_id, decision_json as d, row_number() over (partition by product_id order by completed_at desc nulls last, decision_json desc nulls last) as rn from product_research_completions where product_id is not null) where rn = 1 and json_valid(d)),
    opened as (select product_id, case when json_type(d) = 'VARCHAR' then (case when json_valid(d->>'$') then d->>'$' end) else d end as d from decisions),
    typed as (
      select 'products.brand_code' as src_field, row_id::varchar as record_key, brand_code as value from products
      union all select 'decision_json.manufacturer', product_id, d->>'$.manufacturer' from opened),
    records as (select * from typed where value is not null and not regexp_full_match(value, '[\\s\\pZ\\pC]*') and value not in (select unnest([brand_code, manufacturer]) from brand_registry)),
    folded as (select value, lower(translate(value, {src}, {dst})) as t from (select distinct value from records)),
    parts as (
      select value, t, 1 as rank from folded
      union all select value, trim(p), 2 from (select value, unnest(string_split_regex(t, '[\\[\\](){{}}/|,;:]|\\bformerly\\b|\\s-\\s')) as p from folded) where trim(p) <> ''),
    cleaned as (
      select value, rank, t from parts
      union all select value, 3, {without("regexp_replace(t, '[.]', '', 'g')", '[^\\pL\\pN-]+')} from parts),
    compact as (select value, rank, {bare('t')} as key from cleaned),
    glued as (
      select * from compact
      union all select value, 3, regexp_replace(key, '{ends}', '', 'g') from compact where regexp_matches(key, '{ends}')),
    letters as (
      select * from glued
      union all select value, 4, translate(key, '{digits}', '{letters}') from glued where regexp_matches(key, '[a-z]') and regexp_matches(key, '[{digits}]')),
    mine as (select value, key, min(rank) as rank from letters where key <> '' group by value, key),
    exact as (select m.value, r.brand_code, m.rank, min(m.rank) over (partition by m.value) as best from mine m join keys r on m.key = r.key),
    exact_best as (select value, case when count(distinct brand_code) = 1 then min(brand_code) end as brand_code from exact where rank = best group by value),
    near as (select m.value, r.brand_code, levenshtein(m.key, r.key) * 10 + m.rank as cost from mine m join keys r on r.k > 0 and length(m.key) >= 3 and levenshtein(m.key, r.key) <= r.k where m.value not in (select value from exact_best)),
    near_best as (select value, case when count(distinct brand_code) = 1 then min(brand_code) end as brand_code from (select *, min(cost) over (partition by value) as best from near) where cost = best group by value),
    matched as (select * from exact_best union all select * from near_best)
    select {wanted} from records left join matched using (value) {rest}"""


ORACLES = {
    "p2_canonical_names": f"select row_id, {canonical_sql('product_name')} as canonical_name from products where product_name is not null",
    "p2_canonical_pages": f"select fetch_id, {canonical_sql('content')} as canonical_content from web_fetch_exa where content is not null",
    "p2_classes": class_sql(),
    "p2_found": lookalike_sql(),
    "p3_found": match_sql(),
    "p3_unmatched_values": match_sql("src_field, value, count(*) as n", "where brand_code is null group by src_field, value"),
    "p7_packed": "select doc_id, true as once, true as fits from documents where text <> ''",
    "p8_found": leak_sql(),
    "p9_rebuilt": "select doc_id, md5(text) as text_md5, true as fits from documents where text is not null",
}
