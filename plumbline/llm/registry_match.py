"""Free-entered values mapped to the closest entry of a reference list. SQL only.

Distinct values are folded and taken apart into candidate keys. Keys equal to a code, a name or an
alias match at once. The rest goes through a partition-based pigeonhole join: a reference key that
tolerates k edits is cut into k+1 segments, so any value within k edits holds one of them unchanged,
at most k places away from where it stood. Equality on (length, segment, substring) finds the
candidates, ``levenshtein`` verifies them, and an anti join reports what matches nothing.
"""

from __future__ import annotations

import unicodedata as ud

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import lookalikes as la
from plumbline.operators.skew import join_hot

# Default of a parameter: words around a name that are no part of it (legal forms, places, trade words).
AFFIX_WORDS = (
    "gmbh kg co ohg ag ltd limited inc llc corp corporation plc srl spa sas sarl sa sl bv nv oy ab kgaa "
    "group gruppe gruppo holding solar power systems system energy new technology technologies deutschland italia espana france international "
    "fa firma by oem formerly brand marke marca the von de di"
)


def _translate_pairs() -> tuple[str, str]:
    """Single characters and their folded base letter, for ``translate``: look-alikes, widths, accents, no marks."""
    source, target, drop = [], [], []
    for ch, to in la.char_map().items():
        bases = [c for c in to if not ud.combining(c)]
        if len(bases) == 1 and len(to) >= 1:
            source.append(ch)
            target.append(bases[0].lower())
        elif not bases:
            drop.append(ch)
    return "".join(source + drop), "".join(target)


#: Trade words that are also written together with a name.
GLUED_WORDS = ("solar",)
#: Digits that are typed for letters.
DIGITS_AS_LETTERS = ("0135", "oles")


def registry_keys(registry: DataFrame, affixes: str = AFFIX_WORDS) -> DataFrame:
    """key, brand_code, k (edits it tolerates): codes, names and aliases of the registry, folded.

    Names count with and without their affix words. Keys of up to 3 letters tolerate no edit, up to 5 one,
    longer ones two, in any script. A key that stands for two
    entries is kept for both and then matches neither (see ``match_values``).
    """
    src, dst = _translate_pairs()
    return registry.sparkSession.sql(
        """
        select distinct brand_code, key,
               case when length(key) <= 3 then 0 when length(key) <= 5 then 1 else 2 end as k
        from (
          select brand_code, explode(array(regexp_replace(t, '[^\\\\pL\\\\pN]', ''),
                   array_join(filter(split(t, '[^\\\\pL\\\\pN]+'), w -> w <> '' and not array_contains(split(:words, ' '), w)), ''))) as key
          from (select brand_code, lower(translate(name, :src, :dst)) as t
                from (select brand_code, explode(concat(array(brand_code, manufacturer), coalesce(alias_list, array()))) as name from {registry})))
        where key <> ''""",
        args={"src": src, "dst": dst, "words": affixes},
        registry=registry,
    )


def value_keys(values: DataFrame, affixes: str = AFFIX_WORDS, glued: tuple[str, ...] = GLUED_WORDS, digits: tuple[str, str] = DIGITS_AS_LETTERS) -> DataFrame:
    """value, key, rank: the candidate keys of each distinct value, best first.

    1 the whole value, 2 its parts between brackets and slashes, 3 the same without affix words, 4
    digits read as letters. Compact keys hold letters and digits only, so spacing, hyphens and dots
    inside a name do not count.
    """
    src, dst = _translate_pairs()
    words = ", ".join(f"'{w}'" for w in affixes.split())
    ends = "|".join(f"^{w}|{w}$" for w in glued) or "^$"
    return values.sparkSession.sql(
        f"""
        with folded as (
          select value, lower(translate(value, :src, :dst)) as t from {{values}}),
        parts as (
          select value, t, 1 as rank from folded
          union all
          select value, trim(p), 2 from folded lateral view explode(split(t, '[\\\\[\\\\]()\\\\x7b\\\\x7d/|,;:]|\\\\bformerly\\\\b|\\\\s-\\\\s')) x as p where trim(p) <> ''),
        cleaned as (
          select value, rank, t from parts
          union all
          select value, 3, array_join(filter(split(regexp_replace(t, '[.]', ''), '[^\\\\pL\\\\pN-]+'), w -> w <> '' and not array_contains(array({words}), w)), '') from parts),
        compact as (select value, rank, regexp_replace(t, '[^\\\\pL\\\\pN]', '') as key from cleaned),
        glued as (
          select value, rank, key from compact
          union all
          select value, 3, regexp_replace(key, '{ends}', '') from compact where key rlike '{ends}'),
        letters as (
          select value, rank, key from glued
          union all
          select value, 4, translate(key, '{digits[0]}', '{digits[1]}') from glued where key rlike '[a-z]' and key rlike '[{digits[0]}]')
        select value, key, min(rank) as rank from letters where key <> '' group by value, key""",
        args={"src": src, "dst": dst},
        values=values,
    )


def match_values(values: DataFrame, registry: DataFrame, n_col: str = "n", affixes: str = AFFIX_WORDS, glued: tuple[str, ...] = GLUED_WORDS, digits: tuple[str, str] = DIGITS_AS_LETTERS) -> DataFrame:
    """value, n, brand_code, distance: one row per distinct value; brand_code '-' if it belongs to no entry.

    ``values`` holds distinct non-null values with their number of rows. Exact keys outrank fuzzy ones;
    among exact ones the better rank counts. Among fuzzy ones the smaller distance counts, then the
    better rank. A value equally close to two entries belongs to neither. Very long values take part
    like any other; ``affixes``, ``glued`` and ``digits`` say what is written around and for a name; a value longer than every reference key plus its edits has no fuzzy candidate.
    """
    from plumbline.session import cut

    spark = values.sparkSession
    # both are read several times below
    keys = cut(registry_keys(registry, affixes))
    mine = cut(value_keys(values, affixes, glued, digits))
    return spark.sql(
        """
        with exact as (
          select m.value, r.brand_code, m.rank, 0 as distance from {mine} m join {keys} r on m.key = r.key),
        exact_best as (
          select value, case when count(distinct brand_code) = 1 then min(brand_code) end as brand_code
          from (select *, min(rank) over (partition by value) as best from exact) where rank = best group by value),
        open as (
          select m.value, m.key, m.rank from {mine} m left anti join exact_best e on m.value = e.value where length(m.key) >= 3),
        segments as (  -- reference side: k+1 even segments, each with its place
          select brand_code, key, k, seg, length(key) as len,
                 cast(floor(seg * length(key) / (k + 1)) as int) as at,
                 substring(key, cast(floor(seg * length(key) / (k + 1)) as int) + 1, cast(floor((seg + 1) * length(key) / (k + 1)) as int) - cast(floor(seg * length(key) / (k + 1)) as int)) as piece
          from {keys} lateral view explode(sequence(0, k)) s as seg where k > 0),
        shapes as (select distinct len, k, seg, at, length(piece) as plen from segments),
        probes as (  -- value side: the substrings that may hold a segment of a key of that length
          select distinct o.value, o.key, o.rank, s.len, s.k, s.seg, substring(o.key, s.at + d + 1, s.plen) as piece
          from (select *, l, d from open lateral view explode(sequence(greatest(length(key) - 2, 1), length(key) + 2)) x as l
                                     lateral view explode(array(-2, -1, 0, 1, 2)) y as d) o
          join shapes s on s.len = o.l and abs(o.d) <= s.k and abs(o.l - length(o.key)) <= s.k
          where s.at + d >= 0 and s.at + d + s.plen <= length(o.key)),
        near as (
          select p.value, r.brand_code, min(struct(levenshtein(p.key, r.key) as distance, p.rank as rank)) as best
          from probes p join segments r on p.len = r.len and p.k = r.k and p.seg = r.seg and p.piece = r.piece
          where levenshtein(p.key, r.key) <= r.k group by p.value, r.brand_code),
        near_best as (
          select value, case when count(distinct brand_code) = 1 then min(brand_code) end as brand_code, min(best.distance) as distance
          from (select *, min(best) over (partition by value) as top from near) where best = top group by value),
        matched as (
          select value, brand_code, 0 as distance from exact_best where brand_code is not null
          union all select value, brand_code, distance from near_best where brand_code is not null)
        select v.value, v.n, m.brand_code, m.distance from {values} v join matched m on v.value = m.value
        union all
        select v.value, v.n, '-', cast(null as int) from {values} v left anti join matched m on v.value = m.value""",
        mine=mine,
        keys=keys,
        values=values.withColumnRenamed(n_col, "n") if n_col != "n" else values,
    )


def typed_values(products: DataFrame, completions: DataFrame, registry: DataFrame) -> DataFrame:
    """src_field, record_key, value: records whose value is neither blank nor exactly a code or a name.

    Manufacturers come from readable decisions (JSON text stored as a JSON string counts as its
    content), one per product_id: the one completed last, at ties the greater text.
    """
    blank = "[\\\\s\\\\pZ\\\\pC]*"
    return products.sparkSession.sql(
        f"""
        with decisions as (
          select product_id, max(struct(completed_at, decision_json)).decision_json as j from {{completions}} where product_id is not null group by product_id),
        parsed as (select product_id, try_parse_json(j) as v from decisions),
        opened as (select product_id, case when schema_of_variant(v) = 'STRING' then try_parse_json(try_variant_get(v, '$', 'string')) else v end as v from parsed),
        typed as (
          select 'products.brand_code' as src_field, cast(row_id as string) as record_key, brand_code as value from {{products}}
          union all
          select 'decision_json.manufacturer', product_id, try_variant_get(v, '$.manufacturer', 'string') from opened),
        clean as (select explode(array(brand_code, manufacturer)) as name from {{registry}})
        select t.* from typed t left anti join clean c on t.value = c.name
        where t.value is not null and not t.value rlike '^{blank}$'""",
        products=products.select("row_id", "brand_code"),
        completions=completions.select("product_id", "completed_at", "decision_json"),
        registry=registry,
    )


def matched_records(products: DataFrame, completions: DataFrame, registry: DataFrame) -> DataFrame:
    """src_field, record_key, value, brand_code, distance: one row per typed record."""
    from plumbline.session import cut

    records = typed_values(products, completions, registry)
    values = cut(records.groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    return join_hot(records, cut(match_values(values, registry)), "value", "n")
