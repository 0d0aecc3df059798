"""Queries of search texts, links, pages and their merging."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import identity, scalars, urls
from plumbline.operators import relational as rel
from plumbline.operators.nested import flat_table
from plumbline.plans.function_queries import _ALLOWED, _ASKED, _PATH, _STANDARD
from plumbline.plans.problem_queries import _NESTED
from plumbline.plans.relational_queries import _TWO, _two_states, completions, events, facts, lineitem, orders, pages, products, registry

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


_MODELS = "list_distinct(list_transform(list_filter(regexp_extract_all(product_name, '[A-Za-z0-9]+(?:-[A-Za-z0-9]+)+'), lambda x: regexp_matches(x, '[A-Za-z]') and regexp_matches(x, '[0-9]') and length(x) >= 5), lambda x: upper(x)))"
_MANUAL = "' official specifications technical manual'"


@query(
    "str13_search_queries",
    f"""with p as (select row_id, r.manufacturer as m, list_sort({_MODELS}) as ms, p.family_code as c from products p join brand_registry r using (brand_code) where product_name is not null),
    i as (select *, '"' || m || '" "' || ms[1] || '"' as ident, case when c <> '' and lower(c) <> lower(m) and not list_contains(list_transform(ms, lambda x: lower(x)), lower(c)) then ' "' || c || '"' else '' end as ctx from p where len(ms) > 0),
    q as (select row_id, unnest([ident || ' official datasheet PDF', case when len(ms) > 1 then '"' || ms[2] || '" filetype:pdf' else ident || {_MANUAL} end,
      ident || ctx || case when len(ms) > 1 then {_MANUAL} else ' manufacturer product family official' end]) as query, unnest([1, 2, 3]) as place from i)
    select row_id, place, query from q""",
)
def _(s, d):
    """The search queries of every product with a registered brand and a model."""
    p = products(s, d).where("product_name is not null").join(registry(s, d).select("brand_code", "manufacturer"), "brand_code")
    found = scalars.search_queries(F.col("manufacturer"), F.array_sort(identity.model_fragments("product_name")), F.coalesce("family_code", F.lit("")))
    return p.select("row_id", F.posexplode(found).alias("place", "query")).select("row_id", (F.col("place") + 1).alias("place"), "query")


@query("str14_valid_queries", "select row_id, product_name is not null and not regexp_matches(product_name, '[\\x00-\\x1f\\x7f]') and regexp_matches(product_name, '[^\\s\\pZ]') and length(product_name) <= 400 as valid from products")
def _(s, d):
    return products(s, d).select("row_id", scalars.valid_queries(F.array("product_name")).alias("valid"))


@query("str19_tag_links", "select brand_code, '[' || replace(manufacturer, '_', '\\_') || '](/t/brand-' || trim(regexp_replace(lower(manufacturer), '[^a-z0-9]+', '-', 'g'), '-') || ')' as link from brand_registry")
def _(s, d):
    slug = F.regexp_replace(F.regexp_replace(F.lower("manufacturer"), "[^a-z0-9]+", "-"), "^-|-$", "")
    return registry(s, d).select("brand_code", scalars.internal_link(F.col("manufacturer"), F.concat(F.lit("t/brand-"), slug)).alias("link"))


_LINE = "trim(regexp_replace(quote, '[\\s\\x{0B}\\x{85}\\p{Z}]+', ' ', 'g'))"


@query("str08_markdown_text", f"select fact_id, regexp_replace(replace(replace(replace(replace({_LINE}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\\', '\\\\'), '([\\[\\]()*_`])', '\\\\\\1', 'g') as text from fact_item")
def _(s, d):
    return facts(s, d).select("fact_id", scalars.markdown_text("quote").alias("text"))


@query("str05_conflict_values", _NESTED + "select product_id, child_pos::int as child_pos, array_to_string(from_json(json_extract(o, '$.values'), '[\"VARCHAR\"]'), ', ') as text from urls where kind = 'conflict' and json_type(json_extract(o, '$.values')) = 'ARRAY'")
def _(s, d):
    """The values of each conflict as one line."""
    rows = flat_table(completions(s, d), "conflict").where("values is not null")
    return rows.select("product_id", "child_pos", scalars.one_line(F.array_join("values", ", ")).alias("text"))


PUBLIC = ["outcome", "manufacturer", "model", "product_category", "summary", "review_summary", "decision_notes", "schema_version"]


@query("prj02_public_decisions", "with o as (select product_id, decision_json as d from product_research_completions where json_valid(decision_json) and json_type(decision_json) = 'OBJECT') select distinct product_id, " + ", ".join(f"left(d->>'$.{f}', 20000) as {f}" for f in PUBLIC) + " from o")
def _(s, d):
    """Only reader-facing fields leave a decision, each within its budget of characters."""
    v = F.try_parse_json("decision_json")
    ok = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    fields = [F.left(F.try_variant_get(v, f"$.{f}", "string"), F.lit(20000)).alias(f) for f in PUBLIC]
    return completions(s, d).where(ok).select("product_id", *fields).distinct()


_PAGE_FIELDS = ["product_name", "brand_code", "family_code", "unit_of_measure"]
_OLD_NEW = " and ".join(f"o.payload_json->>'$.{f}' is not distinct from n.payload_json->>'$.{f}'" for f in _PAGE_FIELDS)


@query(
    "snk05_page_conflicts",
    _TWO
    + f"""select coalesce(o.product_id, n.product_id) as product_id, case when o.product_id is null then 'created' when n.product_id is null then 'orphaned' when {_OLD_NEW} then 'unchanged'
      when o.payload_json->>'$.updated_at' > n.payload_json->>'$.updated_at' then 'conflict' else 'updated' end as action
    from (select * from o where payload_json is null or json_valid(payload_json)) o full outer join (select * from n where payload_json is null or json_valid(payload_json)) n on o.product_id = n.product_id""",
)
def _(s, d):
    """What happens to each page when the newest generation is written over the one before it."""
    state = F.try_parse_json("payload_json")
    fields = {f: F.try_variant_get(state, f"$.{f}", "string") for f in [*_PAGE_FIELDS, "updated_at"]}
    old, new = (x.where(F.col("payload_json").isNull() | state.isNotNull()).withColumns(fields) for x in _two_states(s, d))
    return rel.page_actions(old, new, "product_id", _PAGE_FIELDS, "updated_at")


@query("set04_bundle_merge", "with r as (select url, fetch_id, length(content) as score, row_number() over (partition by url order by length(content) desc nulls last, fetch_id) as rn from web_fetch_exa where url is not null), q as (select url, coalesce(array_to_string(list_sort(list_distinct(list(lower(content_type)))), ','), '') as types from web_fetch_exa where url is not null group by url) select r.url, r.fetch_id, r.score, q.types from r join q using (url) where rn = 1")
def _(s, d):
    """Results with one url: the higher score wins, the first of equal ones; what found them is united whatever the letter case."""
    p = pages(s, d).where("url is not null").withColumn("score", F.length("content"))
    best = p.groupBy("url").agg(F.max(F.struct("score", (-F.col("fetch_id")).alias("f"))).alias("t"))
    kinds = p.where("content_type is not null").select("url", F.lower("content_type").alias("k")).distinct().groupBy("url").agg(F.array_join(F.array_sort(F.collect_list("k")), ",").alias("types"))
    return best.join(kinds, "url", "left").select("url", (-F.col("t.f")).alias("fetch_id"), "t.score", F.coalesce("types", F.lit("")).alias("types"))


_CANON = f"case when {_ALLOWED} then {_STANDARD} || {_PATH} || {_ASKED} end"


@query("set06_canonical_urls", f"select product_id, url, row_number() over (partition by product_id order by seen)::int as place from (select product_id, url, min(fact_id) as seen from (select product_id, fact_id, {_CANON} as url from (select product_id, fact_id, evidence_url as url from fact_item where product_id is not null)) where url is not null group by product_id, url)")
def _(s, d):
    """The different urls of each product in the order in which they first appear."""
    rows = facts(s, d).where("product_id is not null").select("product_id", "fact_id", urls.state_url("evidence_url").alias("url")).where("url is not null")
    first = rows.groupBy("product_id", "url").agg(F.min("fact_id").alias("_at"))
    return first.select("product_id", "url", F.row_number().over(Window.partitionBy("product_id").orderBy("_at")).alias("place"))


@query("top10_evidence_cap", "with rounds as (select product_id, count(*) as rounds from product_research_completions group by product_id), c as (select distinct f.product_id, f.evidence_url from fact_item f where f.evidence_url is not null and not exists (select 1 from web_fetch_exa w where w.url = f.evidence_url and w.content is not null)), r as (select c.*, greatest(1, 5 - (coalesce(rounds, 1) - 1)) as cap, row_number() over (partition by c.product_id order by evidence_url) as rn from c left join rounds using (product_id)) select product_id, evidence_url from r where rn <= cap")
def _(s, d):
    """New candidate urls of each product, fewer with every round: five in the first, one at least."""
    rounds = completions(s, d).where("product_id is not null").groupBy("product_id").agg(F.count(F.lit(1)).alias("_rounds"))
    known = pages(s, d).where("content is not null and url is not null").select(F.col("url").alias("evidence_url"))
    fresh = facts(s, d).where("evidence_url is not null").select("product_id", "evidence_url").distinct().join(known, "evidence_url", "left_anti")
    top = fresh.withColumn("_rn", F.row_number().over(Window.partitionBy("product_id").orderBy("evidence_url"))).where("_rn <= 5")
    return top.join(rounds, "product_id", "left").where(F.col("_rn") <= F.greatest(F.lit(1), 5 - (F.coalesce("_rounds", F.lit(1)) - 1))).select("product_id", "evidence_url")


@query("fil03_event_filters", "select event_id from events where event_type in ('error', 'click') and value between 0 and 599")
def _(s, d):
    kinds = rel.checked_values([" error", "click", "error"], "[a-z_]{1,32}", 32)
    return events(s, d).where(F.col("event_type").isin(*kinds) & F.col("value").between(0, 599)).select("event_id")


@query("fil12_slot", "select l_orderkey, l_partkey, o_custkey from lineitem join orders on l_orderkey = o_orderkey where l_linenumber = 1 and l_returnflag = 'A' and l_orderkey = 7")
def _(s, d):
    """The action in one slot of an attempt, with the attempt's product."""
    slot = lineitem(s, d).where("l_linenumber = 1 and l_returnflag = 'A' and l_orderkey = 7").select("l_orderkey", "l_partkey")
    attempt = orders(s, d).where("o_orderkey = 7").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return slot.join(attempt, "l_orderkey").select("l_orderkey", "l_partkey", "o_custkey")


@query("orc02_extracts", f"select url, case when failed then 'failed' else 'result' end as kind, max(case when not failed then length(content) end) as longest, count(*) as n from (select {_CANON} as url, content, content is null or fetch_status is distinct from 'success' as failed from web_fetch_exa) where url is not null group by url, failed")
def _(s, d):
    """Fetches as results and failures by url; urls that are none are dropped, the longest body of a url counts."""
    failed = F.col("content").isNull() | ~F.col("fetch_status").eqNullSafe("success")
    rows = pages(s, d).select(urls.state_url("url").alias("url"), "content", F.when(failed, "failed").otherwise("result").alias("kind")).where("url is not null")
    return rows.groupBy("url", "kind").agg(F.max(F.when(F.col("kind") == "result", F.length("content"))).alias("longest"), F.count(F.lit(1)).alias("n"))
