"""Queries over the nested decisions: citations, quotes, conflicts, sources, specifications, tags, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import canonical, render, urls
from plumbline.operators import relational as rel
from plumbline.operators.nested import flat_table, nested_rows
from plumbline.plans.problem_queries import _FROM, _NESTED
from plumbline.plans.relational_queries import completions, facts, pages, products, registry

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


CITING = ["datasheet", "source", "quote", "conclusion", "classification"]


@query("jn14_uncited_sources", _NESTED + f"select u.product_id, u.kind as child_kind, count(*) as n {_FROM} where u.kind not in ('fact', 'conflict', 'evidence') and u.url is not null and d.pos is null group by 1, 2")
def _(s, d):
    """Citations whose url is no evidence document of their completion."""
    rows = nested_rows(completions(s, d)).where(F.col("child_kind").isin(*CITING) & F.col("url").isNotNull() & (F.col("doc_pos") < 0))
    return rows.groupBy("product_id", "child_kind").agg(F.count(F.lit(1)).alias("n"))


_CITED = "from_json(json_extract(f.o, '$.evidence_urls'), '[\"VARCHAR\"]')"


@query("jn14_quotes_outside_citations", _NESTED + f"select q.product_id, q.parent_pos::int as parent_pos, q.child_pos::int as child_pos from urls q join urls f on f.kind = 'fact' and q.kind = 'quote' and f.product_id = q.product_id and f.child_pos = q.parent_pos where q.url is not null and not coalesce(list_contains({_CITED}, q.url), false)")
def _(s, d):
    """Quotes whose url their fact does not cite."""
    cited = flat_table(completions(s, d), "fact").select("product_id", F.col("child_pos").alias("parent_pos"), F.coalesce("evidence_urls", F.array().cast("array<string>")).alias("cited"))
    quotes = flat_table(completions(s, d), "quote").where("url is not null").select("product_id", "parent_pos", "child_pos", "url")
    return quotes.join(cited, ["product_id", "parent_pos"]).where(~F.array_contains("cited", F.col("url"))).select("product_id", "parent_pos", "child_pos")


@query("jn14_undeclared_reviews", _NESTED + ", reviews as (select distinct product_id, unnest(from_json(json_extract(d, '$.review_evidence_urls'), '[\"VARCHAR\"]')) as url from content where json_type(d) = 'OBJECT' and json_type(json_extract(d, '$.review_evidence_urls')) = 'ARRAY') select r.product_id, r.url from reviews r where r.url is not null and not exists (select 1 from urls u where u.kind in ('datasheet', 'source') and u.product_id = r.product_id and u.url = r.url)")
def _(s, d):
    """Review urls that are neither datasheet nor source of their decision."""
    declared = nested_rows(completions(s, d)).where(F.col("child_kind").isin("datasheet", "source")).select("product_id", "url")
    v = _decision("decision_json")
    latest = rel.latest_per_key(completions(s, d).where("product_id is not null"), ["product_id"], ["completed_at", "decision_json", "evidence_json"], ["product_id", "completed_at", "decision_json", "evidence_json"])
    reviews = latest.select("product_id", F.explode(F.try_variant_get(v, "$.review_evidence_urls", "array<string>")).alias("url")).where("url is not null").distinct()
    return reviews.join(declared, ["product_id", "url"], "left_anti")


def _decision(column: str) -> Column:
    """The decision as a variant; a JSON string that holds JSON counts as its content."""
    v = F.try_parse_json(column)
    return F.when(F.schema_of_variant(v) == "STRING", F.try_parse_json(F.try_variant_get(v, "$", "string"))).otherwise(v)


def grounded(quotes: DataFrame, body: DataFrame, keep: list[str]) -> DataFrame:
    """Quotes joined with the pages of their url, each different page once.

    Pages are made distinct by the hash of their content; only pages that a quote names move, and a url
    that very many quotes name is broadcast.
    """
    asked = quotes.select("url").distinct()
    named = body.where("content is not null").join(asked, "url", "left_semi").groupBy("url", F.md5("content").alias("_h")).agg(F.first("content").alias("content"))
    return quotes.select(*keep).join(named.drop("_h"), "url")


@query("jn15_grounded_quotes", _NESTED + "select distinct q.product_id, q.parent_pos::int as parent_pos, q.child_pos::int as child_pos from urls q join web_fetch_exa w on w.url = q.url where q.kind = 'quote' and contains(w.content, q.o->>'$.quote')")
def _(s, d):
    """Quotes of facts that stand word for word in a fetched page of their url: equi-join first, then contains."""
    quotes = flat_table(completions(s, d), "quote").where("url is not null and quote is not null")
    return grounded(quotes, pages(s, d), ["product_id", "parent_pos", "child_pos", "url", "quote"]).where(F.contains("content", "quote")).select("product_id", "parent_pos", "child_pos").distinct()


_NAMES = "('product category', 'product type', '产品类别', '产品类型')"


@query(
    "prj06_categories",
    f"""with o as (select product_id, decision_json as d from product_research_completions where json_valid(decision_json) and json_type(decision_json) = 'OBJECT' and product_id is not null),
    c as (select product_id, case when json_type(d->'$.product_category') = 'VARCHAR' and regexp_matches(d->>'$.product_category', '\\S') then d->>'$.product_category' end as c,
      list_filter(case when json_type(d->'$.facts') = 'ARRAY' then from_json(d->'$.facts', '["JSON"]') end, lambda x: lower(trim(x->>'$.name')) in {_NAMES} and json_type(x->'$.value') = 'VARCHAR' and regexp_matches(x->>'$.value', '\\S')) as named from o)
    select product_id, coalesce(min(c), min(named[1]->>'$.value')) as category from c group by product_id""",
)
def _(s, d):
    """The category of each product: its decision's, else the first non-blank value of a fact with a category's name at any position."""
    ok = F.coalesce(F.expr("schema_of_variant(v) like 'OBJECT%'"), F.lit(False))
    text = "case when schema_of_variant(variant_get({0}, '$.{1}')) = 'STRING' then try_variant_get({0}, '$.{1}', 'string') end"
    pairs = F.expr("transform(try_variant_get(v, '$.facts', 'array<variant>'), x -> struct(try_variant_get(x, '$.name', 'string') as n, " + text.format("x", "value") + " as value))")
    named = F.filter(pairs, lambda x: F.lower(F.regexp_replace(x["n"], r"^\s+|\s+$", "")).isin("product category", "product type", "产品类别", "产品类型") & x["value"].rlike(r"\S"))
    category = F.expr(text.format("v", "product_category"))
    rows = completions(s, d).withColumn("v", F.try_parse_json("decision_json")).where(ok & F.col("product_id").isNotNull())
    rows = rows.select("product_id", F.when(category.rlike(r"\S"), category).alias("c"), F.get(named, F.lit(0))["value"].alias("f"))
    return rows.groupBy("product_id").agg(F.coalesce(F.min("c"), F.min("f")).alias("category"))


def _bare_key(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^a-z0-9]', '', 'g')"


@query("set09_facts_in_conflict", _NESTED + f"select distinct f.product_id, {_bare_key("f.o->>'$.name'")} as name from urls f join urls c on f.product_id = c.product_id and f.kind = 'fact' and c.kind = 'conflict' and {_bare_key("f.o->>'$.name'")} = {_bare_key("c.o->>'$.field'")} and {_bare_key("f.o->>'$.name'")} <> ''")
def _(s, d):
    """Facts whose name is also a conflicting field of the same decision."""
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "").alias("name")
    names = flat_table(completions(s, d), "fact").select("product_id", bare("name")).where("name <> ''")
    fields = flat_table(completions(s, d), "conflict").select("product_id", bare("field"))
    return names.join(fields, ["product_id", "name"], "left_semi").distinct()


@query("prj08_decision_urls", _NESTED + "select product_id, url, row_number() over (partition by product_id order by lower(url), url)::int as place from (select distinct product_id, url from urls where kind in ('datasheet', 'source') and url is not null)")
def _(s, d):
    """The urls of each decision's datasheets and sources in the order of their lower case."""
    rows = nested_rows(completions(s, d)).where(F.col("child_kind").isin("datasheet", "source") & F.col("url").isNotNull())
    rows = rows.select("product_id", urls.public_url("url").alias("url")).where("url is not null").distinct()
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("product_id").orderBy(F.lower("url"), "url")))


_SOURCES = """, cited as (
  select product_id, url, o->>'$.title' as label, kind = 'datasheet' as is_datasheet from urls where kind in ('datasheet', 'source')
  union all select product_id, unnest(from_json(json_extract(o, '$.evidence_urls'), '["VARCHAR"]')), coalesce(o->>'$.name', '规格参数') || '（证据）', false from urls where kind = 'fact' and json_type(json_extract(o, '$.evidence_urls')) = 'ARRAY'
  union all select product_id, unnest(from_json(json_extract(o, '$.source_urls'), '["VARCHAR"]')), coalesce(o->>'$.field', '冲突项') || '（冲突证据）', false from urls where kind = 'conflict' and json_type(json_extract(o, '$.source_urls')) = 'ARRAY'),
listed as (select * from (select product_id, url, coalesce(label, '') as label, is_datasheet, row_number() over (partition by product_id, url order by not is_datasheet, lower(coalesce(label, '')), coalesce(label, '')) as rn from cited where url is not null) where rn = 1)
"""


@query("rnd04_sources", _NESTED + _SOURCES + "select product_id, url, label, is_datasheet, row_number() over (partition by product_id order by not is_datasheet, lower(url), lower(label), url)::int as place from listed")
def _(s, d):
    """Every url that a decision names, once: datasheets first, then by url and label; facts and conflicts name their evidence."""
    c = completions(s, d)
    parts = [
        flat_table(c, "datasheet").select("product_id", "url", F.col("title").alias("label"), F.lit(True).alias("is_datasheet")),
        flat_table(c, "source").select("product_id", "url", F.col("title").alias("label"), F.lit(False).alias("is_datasheet")),
        flat_table(c, "fact").select("product_id", F.explode("evidence_urls").alias("url"), F.concat(F.coalesce("name", F.lit("规格参数")), F.lit("（证据）")).alias("label"), F.lit(False).alias("is_datasheet")),
        flat_table(c, "conflict").select("product_id", F.explode("source_urls").alias("url"), F.concat(F.coalesce("field", F.lit("冲突项")), F.lit("（冲突证据）")).alias("label"), F.lit(False).alias("is_datasheet")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).where("url is not null").withColumn("label", F.coalesce("label", F.lit("")))
    first = F.min(F.struct(F.when(F.col("is_datasheet"), 0).otherwise(1).alias("p"), F.lower("label").alias("l"), F.col("label").alias("label")))
    one = rows.groupBy("product_id", "url").agg(first.alias("f")).select("product_id", "url", "f.label", (F.col("f.p") == 0).alias("is_datasheet"))
    order = Window.partitionBy("product_id").orderBy(~F.col("is_datasheet"), F.lower("url"), F.lower("label"), "url")
    return one.withColumn("place", F.row_number().over(order).cast("int"))


def _spec(owner: str) -> str:
    return f"select product_id, {owner} as owner, pos, coalesce(category, '') as category, name, value || case when unit is not null and trim(unit) <> '' then ' ' || unit else '' end as value"


@query(
    "rnd03_specifications",
    _NESTED
    + f""", specs as ({_spec('0')} from (select product_id, fact_id as pos, category, name, value, unit from fact_item where product_id is not null and name is not null and value is not null)
    union all {_spec('1')} from (select product_id, child_pos as pos, o->>'$.category' as category, o->>'$.name' as name, o->>'$.value' as value, o->>'$.unit' as unit from urls where kind = 'fact') where name is not null and value is not null)
    select product_id, category, name, value, owner = 1 as decided from (select *, row_number() over (partition by product_id, lower(category), lower(name) order by owner desc, pos desc, category desc, name desc, value desc) as rn from specs) where rn = 1""",
)
def _(s, d):
    """One row per product, category and name (letter case does not count): the decision's value over the product's, the last one given."""
    with_unit = F.concat("value", F.when(F.trim("unit") != "", F.concat(F.lit(" "), "unit")).otherwise(F.lit(""))).alias("value")
    own = facts(s, d).select("product_id", F.lit(0).alias("owner"), F.col("fact_id").alias("pos"), F.coalesce("category", F.lit("")).alias("category"), "name", with_unit)
    decided = flat_table(completions(s, d), "fact").select("product_id", F.lit(1).alias("owner"), F.col("child_pos").cast("bigint").alias("pos"), F.coalesce("category", F.lit("")).alias("category"), "name", with_unit)
    rows = own.unionByName(decided).where("product_id is not null and name is not null and value is not null")
    # partial maxima before the shuffle: a product with very many facts is no large group
    top = rows.groupBy("product_id", F.lower("category").alias("_c"), F.lower("name").alias("_n")).agg(F.max(F.struct("owner", "pos", "category", "name", "value")).alias("t"))
    return top.select("product_id", "t.category", "t.name", "t.value", (F.col("t.owner") == 1).alias("decided"))


def tag_slug(prefix: str, c: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", "")
    return F.when(slug != "", F.concat(F.lit(prefix + "-"), slug))


def _slug_sql(prefix: str, c: str) -> str:
    return f"'{prefix}-' || nullif(regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), '')"


@query(
    "set08_page_tags",
    _NESTED
    + f""", tags as (select product_id, unnest(['product', 'datasheet-found', {_slug_sql('brand', "d->>'$.manufacturer'")}, {_slug_sql('category', "d->>'$.product_category'")}]) as tag from content where json_type(d) = 'OBJECT'
    union all select product_id, 'source-' || (o->>'$.source_type') from urls where kind in ('datasheet', 'source'))
    select distinct product_id, tag from tags where tag is not null""",
)
def _(s, d):
    """The managed tags of each decided page: fixed ones, types of its sources, brand and category."""
    c = completions(s, d)
    v = _decision("decision_json")
    latest = rel.latest_per_key(c.where("product_id is not null"), ["product_id"], ["completed_at", "decision_json", "evidence_json"], ["product_id", "completed_at", "decision_json", "evidence_json"])
    objects = latest.withColumn("_v", v).where(F.coalesce(F.expr("schema_of_variant(_v) like 'OBJECT%'"), F.lit(False)))
    text = lambda f: F.try_variant_get("_v", f"$.{f}", "string")
    own = objects.select("product_id", F.explode(F.array(F.lit("product"), F.lit("datasheet-found"), tag_slug("brand", text("manufacturer")), tag_slug("category", text("product_category")))).alias("tag"))
    kinds = [flat_table(c, k).select("product_id", F.concat(F.lit("source-"), "source_type").alias("tag")) for k in ("datasheet", "source")]
    return own.unionByName(kinds[0]).unionByName(kinds[1]).where("tag is not null").distinct()


@query("rnd07_managed_pages", f"select product_id, coalesce(wiki_path || '\n\n', '') || '{render.START}\n' || product_id || ': ' || outcome || '\n{render.END}\n' as page from (select product_id, max(outcome) as outcome, nullif(max(wiki_path), '') as wiki_path from product_research_completions where product_id is not null group by product_id)")
def _(s, d):
    """Pages of completed products: the product line as managed block, what people wrote kept before it."""
    rows = completions(s, d).where("product_id is not null").groupBy("product_id").agg(F.max("outcome").alias("outcome"), F.max("wiki_path").alias("wiki_path"))
    return rows.select("product_id", render.merge_managed(F.col("wiki_path"), F.concat_ws(": ", "product_id", "outcome")).alias("page"))


@query("jn16_facts_without_page", _NESTED + "select f.fact_id from fact_item f where f.evidence_url is not null and not exists (select 1 from web_fetch_exa w where w.url = f.evidence_url) and not exists (select 1 from urls u where u.kind in ('datasheet', 'source') and u.url = f.evidence_url)")
def _(s, d):
    """Facts whose url neither a fetched page nor a declared source of any decision has."""
    declared = nested_rows(completions(s, d)).where(F.col("child_kind").isin("datasheet", "source")).select("url")
    known = pages(s, d).select("url").unionByName(declared).where("url is not null").select(F.col("url").alias("evidence_url")).distinct()
    return facts(s, d).where("evidence_url is not null").select("fact_id", "evidence_url").join(known, "evidence_url", "left_anti").select("fact_id")


@query(
    "jn12_brand_domains",
    """with names as (select lower(trim(a)) as key, brand_code from (select brand_code, unnest(list_concat([manufacturer], coalesce(alias_list, []))) as a from brand_registry)),
    alias as (select key, min(brand_code) as brand_code, count(distinct brand_code) as n from names group by key)
    select p.row_id, coalesce(c.brand_code, case when a.n = 1 then a.brand_code end) as brand_code, case when c.brand_code is not null then 'code' when a.n = 1 then 'alias' when a.n > 1 then 'conflict' end as via, r.web_domain
    from products p left join brand_registry c on p.brand_code = c.brand_code left join alias a on c.brand_code is null and lower(trim(p.brand_code)) = a.key
    left join brand_registry r on r.brand_code = coalesce(c.brand_code, case when a.n = 1 then a.brand_code end) where c.brand_code is not null or a.key is not null""",
)
def _(s, d):
    """Products whose brand is a code of the registry, else a name or alias of it; an alias of several brands is a conflict."""
    r = registry(s, d)
    names = r.select("brand_code", F.explode(F.concat(F.array("manufacturer"), F.coalesce("alias_list", F.array().cast("array<string>")))).alias("a"))
    alias = names.groupBy(F.lower(F.trim("a")).alias("_key")).agg(F.min("brand_code").alias("_alias"), F.countDistinct("brand_code").alias("_n"))
    codes = r.select(F.col("brand_code").alias("_code"), F.col("brand_code"))
    p = products(s, d).select("row_id", F.col("brand_code").alias("_typed"))
    found = p.join(codes, p["_typed"] == codes["_code"], "left").join(alias, F.lower(F.trim("_typed")) == F.col("_key"), "left").where("_code is not null or _key is not null")
    via = F.when(F.col("_code").isNotNull(), "code").when(F.col("_n") == 1, "alias").otherwise("conflict")
    brand = F.coalesce("_code", F.when(F.col("_n") == 1, F.col("_alias")))
    rows = found.select("row_id", brand.alias("brand_code"), via.alias("via"))
    return rows.join(r.select("brand_code", "web_domain"), "brand_code", "left").select("row_id", "brand_code", "via", "web_domain")


@query("hsh04_policy_fingerprints", "select brand_code, sha256('{\"brand\":' || to_json(brand_code) || ',\"domain\":' || coalesce(to_json(web_domain), 'null') || ',\"manufacturer\":' || to_json(manufacturer) || '}') as fingerprint from brand_registry")
def _(s, d):
    """A fingerprint of each brand's policy: any change of what it allows is another one."""
    fields = {"brand": F.col("brand_code"), "domain": F.col("web_domain"), "manufacturer": F.col("manufacturer")}
    return registry(s, d).select("brand_code", F.sha2(canonical.canonical_json(fields), 256).alias("fingerprint"))


@query("jsn03_object_or_empty", "select product_id, completed_at, case when json_valid(decision_json) and json_type(decision_json) = 'OBJECT' then decision_json else '{}' end as decision from product_research_completions")
def _(s, d):
    """The decision's text if it is a JSON object, else an empty one."""
    ok = F.coalesce(F.schema_of_variant(F.try_parse_json("decision_json")).startswith("OBJECT"), F.lit(False))
    return completions(s, d).select("product_id", "completed_at", F.when(ok, F.col("decision_json")).otherwise("{}").alias("decision"))


@query("snk03_published", "select product_id, coalesce(min(published_at), max(completed_at)) as published_at, min(published_at) is not null as kept from product_research_completions where product_id is not null and publishable = 1 group by product_id")
def _(s, d):
    """First write wins: a publishable row keeps the time it was published, else it takes the time of its completion."""
    rows = completions(s, d).where("product_id is not null and publishable = 1").groupBy("product_id").agg(F.min("published_at").alias("old"), F.max("completed_at").alias("new"))
    return rows.select("product_id", F.coalesce("old", "new").alias("published_at"), F.col("old").isNotNull().alias("kept"))


@query("set05_failures", "select url, fetch_status as error, count(*) as n from web_fetch_exa where content is null or fetch_status <> 'success' group by 1, 2")
def _(s, d):
    """Failed fetches, once per url and error."""
    return pages(s, d).where("content is null or fetch_status <> 'success'").groupBy("url", F.col("fetch_status").alias("error")).agg(F.count(F.lit(1)).alias("n"))


@query("prj10_source_picks", _NESTED + "select product_id, kind as child_kind, child_pos::int as child_pos, coalesce(nullif(trim(o->>'$.title'), ''), case when kind = 'datasheet' then 'Datasheet' else '相关资料' end) as label, url, kind = 'datasheet' or contains(lower(coalesce(o->>'$.source_type', '')), 'datasheet') as is_datasheet from urls where kind in ('datasheet', 'source') and url is not null")
def _(s, d):
    """Label, url and datasheet flag of every listed source; one without a title gets a fixed label."""
    picks = []
    for kind, unnamed in (("datasheet", "Datasheet"), ("source", "相关资料")):
        rows = flat_table(completions(s, d), kind).where("url is not null")
        flag = F.lit(kind == "datasheet") | F.contains(F.lower(F.coalesce("source_type", F.lit(""))), F.lit("datasheet"))
        label = F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit(unnamed))
        picks.append(rows.select("product_id", F.lit(kind).alias("child_kind"), "child_pos", label.alias("label"), "url", flag.alias("is_datasheet")))
    return picks[0].unionByName(picks[1])


@query("prj09_typed_decisions", "with o as (select product_id, completed_at, decision_json as d from product_research_completions where json_valid(decision_json) and json_type(decision_json) = 'OBJECT') select product_id, completed_at, d->>'$.schema_version' as schema_version, d->>'$.outcome' as outcome, (d->>'$.confidence')::double as confidence, case when json_type(d->'$.facts') = 'ARRAY' then json_array_length(d->'$.facts') end::int as facts from o")
def _(s, d):
    """Decisions decoded from text to typed columns; a missing or ill-typed field is null."""
    v = F.try_parse_json("decision_json")
    ok = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    text = lambda f: F.try_variant_get(v, f"$.{f}", "string").alias(f)
    size = F.size(F.try_variant_get(v, "$.facts", "array<variant>"))
    return completions(s, d).where(ok).select("product_id", "completed_at", text("schema_version"), text("outcome"), F.try_variant_get(v, "$.confidence", "double").alias("confidence"), F.when(size >= 0, size).alias("facts"))
