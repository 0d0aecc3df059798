"""Further queries: projections, rankings, merges, provenance, grounding. Stand-ins as in relational_queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import grounding, identity, jsons, render, scalars, urls
from plumbline.operators.skew import join_hot
from plumbline.plans.relational_queries import completions, documents, events, facts, lineitem, orders, pages, products, registry, snapshots

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query("prj03_without_secrets")
def _(s, d):
    """Decisions without their lease tokens and confidences, at any depth, as canonical JSON."""
    return completions(s, d).select("product_id", jsons.stripped_udf(["lease_token", "confidence"])("decision_json").alias("decision")).distinct()


@query("prj05_search_identity", "select p.row_id, p.product_name, r.manufacturer, r.web_domain, array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(p.product_name, '[A-Za-z0-9]+(?:-[A-Za-z0-9]+)+'), lambda x: regexp_matches(x, '[A-Za-z]') and regexp_matches(x, '[0-9]') and length(x) >= 5), lambda x: upper(x)))), ',') as models from products p left join brand_registry r on p.brand_code = r.brand_code where p.product_name is not null")
def _(s, d):
    """What a search for a product starts from: its name, models, and the maker and domain of its brand."""
    r = registry(s, d).select("brand_code", "manufacturer", "web_domain")
    models = F.array_join(F.array_sort(identity.model_fragments("product_name")), ",").alias("models")
    return products(s, d).where("product_name is not null").join(r, "brand_code", "left").select("row_id", "product_name", "manufacturer", "web_domain", models)


@query("prj07_trusted_policy", "select brand_code, lower(web_domain) as domain, array_to_string(list_sort(alias_list), ',') as aliases from brand_registry where web_domain is not null")
def _(s, d):
    return registry(s, d).where("web_domain is not null").select("brand_code", F.lower("web_domain").alias("domain"), F.array_join(F.array_sort("alias_list"), ",").alias("aliases"))


@query("prj08_fact_urls", "select product_id, array_to_string(list_sort(list(u)), ' ') as urls from (select distinct product_id, evidence_url as u from fact_item where evidence_url is not null and product_id is not null) group by product_id")
def _(s, d):
    pairs = facts(s, d).where("evidence_url is not null and product_id is not null").select("product_id", "evidence_url").distinct()
    return pairs.groupBy("product_id").agg(F.array_join(F.array_sort(F.collect_list("evidence_url")), " ").alias("urls"))


@query("fil01_due", "select o_orderkey from orders where o_orderstatus in ('O', 'P') and o_orderdate <= timestamp '1996-06-01'")
def _(s, d):
    o = orders(s, d)
    return o.where(F.col("o_orderstatus").isin("O", "P") & (F.col("o_orderdate") <= F.lit("1996-06-01").cast(o.schema["o_orderdate"].dataType))).select("o_orderkey")


@query("fil06_streak_window", "select event_id from events where ts >= timestamp '2024-01-20'")
def _(s, d):
    e = events(s, d)
    return e.where(F.col("ts") >= F.lit("2024-01-20").cast(e.schema["ts"].dataType)).select("event_id")


@query("fil08_optional_clauses", "select l_orderkey, l_linenumber from lineitem where l_returnflag = 'R' and l_quantity > 40 and l_discount >= 0.05")
def _(s, d):
    from functools import reduce

    asked = {"flag": "R", "above": 40, "discount": 0.05, "mode": None}
    clauses = {"flag": lambda v: F.col("l_returnflag") == v, "above": lambda v: F.col("l_quantity") > v, "discount": lambda v: F.col("l_discount") >= v, "mode": lambda v: F.col("l_linestatus") == v}
    wanted = reduce(lambda a, b: a & b, [clauses[k](v) for k, v in asked.items() if v is not None], F.lit(True))
    return lineitem(s, d).where(wanted).select("l_orderkey", "l_linenumber")


@query("fil11_lookup", "select row_id, product_name from products where product_id = 'P-0000010'")
def _(s, d):
    return products(s, d).where("product_id = 'P-0000010'").select("row_id", "product_name")


@query("fil14_narrow_domains", "select distinct lower(web_domain) as domain from brand_registry where regexp_full_match(lower(web_domain), '([a-z0-9]([a-z0-9-]*[a-z0-9])?\\.)+[a-z]{2,}')")
def _(s, d):
    return registry(s, d).select(F.lower("web_domain").alias("domain")).where(F.col("domain").rlike(r"^([a-z0-9]([a-z0-9-]*[a-z0-9])?\.)+[a-z]{2,}$")).distinct()


@query("agg02_due_count", "select count(*) as n from orders where o_orderstatus = 'O' and o_orderdate <= timestamp '1997-01-01'")
def _(s, d):
    o = orders(s, d)
    return o.where((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") <= F.lit("1997-01-01").cast(o.schema["o_orderdate"].dataType))).agg(F.count(F.lit(1)).alias("n"))


@query("agg13_usage_cost", "select l_orderkey, round(sum(l_extendedprice * l_discount), 9) as cost, sum(l_quantity) as credits from lineitem group by l_orderkey")
def _(s, d):
    return lineitem(s, d).groupBy("l_orderkey").agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 9).alias("cost"), F.sum("l_quantity").alias("credits"))


@query("agg15_sync_summary", "with k as (select product_id, min(generation) as first_g, count(distinct payload_json) as versions from product_catalogue_snapshot where product_id is not null group by product_id) select count(*) filter (where first_g > 1) as created, count(*) filter (where versions > 1) as rewritten, count(*) as total from k")
def _(s, d):
    rows = snapshots(s, d).where("product_id is not null").groupBy("product_id", F.xxhash64("payload_json").alias("_h")).agg(F.min("generation").alias("g"))
    k = rows.groupBy("product_id").agg(F.min("g").alias("first_g"), F.count(F.lit(1)).alias("versions"))
    return k.agg(F.count_if(F.col("first_g") > 1).alias("created"), F.count_if(F.col("versions") > 1).alias("rewritten"), F.count(F.lit(1)).alias("total"))


@query("agg16_audit_counts", "select url, count(*) as fetches, count(content) as bodies, count(distinct receipt) as receipts from web_fetch_exa group by url")
def _(s, d):
    rows = pages(s, d).groupBy("url", "receipt").agg(F.count(F.lit(1)).alias("n"), F.count("content").alias("b"))
    return rows.groupBy("url").agg(F.sum("n").alias("fetches"), F.sum("b").alias("bodies"), F.count("receipt").alias("receipts"))


@query("seq06_history", "select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as step from orders")
def _(s, d):
    step = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return orders(s, d).select("o_custkey", "o_orderkey", step.alias("step"))


@query("top02_fair_pick", "select o_orderkey from orders order by case o_orderstatus when (case when (select max(o_orderkey) from orders) % 5 >= 4 then 'P' else 'O' end) then 0 when 'F' then 2 else 1 end, o_orderdate, o_orderkey limit 1")
def _(s, d):
    o = orders(s, d)
    late = o.agg((F.max("o_orderkey") % 5 >= 4).alias("_late")).scalar()
    wanted = F.when(late, "P").otherwise("O")
    rank = F.when(F.col("o_orderstatus") == wanted, 0).when(F.col("o_orderstatus") == "F", 2).otherwise(1)
    return o.orderBy(rank, "o_orderdate", "o_orderkey").limit(1).select("o_orderkey")


@query("top05_best_events", "select event_id from events order by value desc nulls last, event_id limit 25")
def _(s, d):
    return events(s, d).orderBy(F.desc_nulls_last("value"), "event_id").limit(25).select("event_id")


@query("top06_first_seen", "select url, min(fetch_id) as first_seen from web_fetch_exa group by url order by 2 limit 15")
def _(s, d):
    return pages(s, d).groupBy("url").agg(F.min("fetch_id").alias("first_seen")).orderBy("first_seen").limit(15)


@query("top08_sorted_specs", "select product_id, string_agg(n, '|' order by lower(c) nulls first, c nulls first, lower(n), n) as names from (select distinct product_id, category as c, name as n from fact_item where product_id is not null and name is not null) group by product_id")
def _(s, d):
    rows = facts(s, d).where("product_id is not null and name is not null").select("product_id", "category", "name").distinct()
    key = F.struct(F.lower("category").alias("lc"), F.col("category").alias("c"), F.lower("name").alias("ln"), F.col("name").alias("n"))
    return rows.groupBy("product_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["n"]), "|").alias("names"))


@query("top09_source_list", "select product_id, evidence_url from (select product_id, evidence_url, row_number() over (partition by product_id order by (case when ends_with(lower(evidence_url), '.pdf') then 0 else 1 end), lower(evidence_url), evidence_url) as rn from (select distinct product_id, evidence_url from fact_item where evidence_url is not null)) where rn = 1")
def _(s, d):
    rows = facts(s, d).where("evidence_url is not null").select("product_id", "evidence_url").distinct()
    best = F.min(F.struct(F.when(urls.is_pdf("evidence_url"), 0).otherwise(1).alias("p"), F.lower("evidence_url").alias("l"), F.col("evidence_url").alias("u")))
    return rows.groupBy("product_id").agg(best["u"].alias("evidence_url"))


@query("set06_distinct_urls", "select product_id, count(distinct evidence_url) as n from fact_item where product_id is not null group by product_id")
def _(s, d):
    return facts(s, d).where("product_id is not null").select("product_id", "evidence_url").distinct().groupBy("product_id").agg(F.count("evidence_url").alias("n"))


@query("set09_repeated_names", "select product_id, lower(trim(name)) as name, count(*) as n from fact_item where product_id is not null and name is not null group by 1, 2 having count(*) > 1")
def _(s, d):
    rows = facts(s, d).where("product_id is not null and name is not null")
    return rows.groupBy("product_id", F.lower(F.trim("name")).alias("name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("orc01_official_first", "with h as (select distinct f.product_id, f.evidence_url, r.web_domain is not null as official from fact_item f left join brand_registry r on replace(regexp_extract(lower(f.evidence_url), '://([^/?#:]*)', 1), 'www.', '') = r.web_domain where f.evidence_url is not null and f.product_id is not null), m as (select product_id, bool_or(official) as any_official from h group by product_id) select h.product_id, h.evidence_url, case when any_official then 'official_only' else 'open_web' end as mode from h join m using (product_id) where official or not any_official")
def _(s, d):
    rows = facts(s, d).where("evidence_url is not null and product_id is not null").select("product_id", "evidence_url").distinct()
    official = rows.select("*", F.explode(urls.parent_domains(urls.host("evidence_url"))).alias("web_domain")).join(registry(s, d).select("web_domain"), "web_domain", "left_semi").select("product_id", "evidence_url").distinct()
    open_web = rows.join(official.select("product_id"), "product_id", "left_anti")
    return official.withColumn("mode", F.lit("official_only")).unionByName(open_web.withColumn("mode", F.lit("open_web")))


_SPACES = "[\\s\\x{0B}\\x{85}\\p{Z}]+"


@query("str04_clean_terms", f"select row_id, left(trim(regexp_replace(regexp_replace(regexp_replace(product_name, '\\p{{Cc}}', ' ', 'g'), '[\"“”]', '', 'g'), '{_SPACES}', ' ', 'g')), 120) as term from products")
def _(s, d):
    return products(s, d).select("row_id", scalars.clean_term("product_name").alias("term"))


@query("str20_first_of", "select row_id, coalesce(nullif(trim(product_name), ''), nullif(trim(family_code), ''), product_id) as label from products")
def _(s, d):
    return products(s, d).select("row_id", F.coalesce(F.nullif(F.trim("product_name"), F.lit("")), F.nullif(F.trim("family_code"), F.lit("")), "product_id").alias("label"))


@query("hsh03_request_fingerprints", "select l_orderkey, l_linenumber, sha256('{\"action\":\"' || l_returnflag || '\",\"request\":\"' || l_partkey || '\"}') as fingerprint from lineitem")
def _(s, d):
    from plumbline.functions.canonical import canonical_json

    rows = lineitem(s, d)
    return rows.select("l_orderkey", "l_linenumber", F.sha2(canonical_json({"action": F.col("l_returnflag"), "request": F.col("l_partkey").cast("string")}), 256).alias("fingerprint"))


@query("mth01_retry_delays", "select distinct o_orderstatus as outcome, n, case o_orderstatus when 'F' then [24, 72, 168, 720][least(n, 4)] when 'P' then [1, 6, 24][least(n, 3)] else [720, 2160, 4320][least(n, 3)] end as hours from (select o_orderstatus, (o_orderkey % 6 + 1)::int as n from orders)")
def _(s, d):
    rows = orders(s, d).select(F.col("o_orderstatus").alias("outcome"), (F.col("o_orderkey") % 6 + 1).cast("int").alias("n")).distinct()
    hours = F.when(F.col("outcome") == "F", scalars.steps([24, 72, 168, 720], "n")).when(F.col("outcome") == "P", scalars.steps([1, 6, 24], "n")).otherwise(scalars.steps([720, 2160, 4320], "n"))
    return rows.select("outcome", "n", hours.alias("hours"))


@query("mth05_close_values", "select count(*) as n from lineitem where abs(l_extendedprice * 3 / 3 - l_extendedprice) <= greatest(1e-12 * greatest(abs(l_extendedprice * 3 / 3), abs(l_extendedprice)), 1e-12)")
def _(s, d):
    return lineitem(s, d).where(scalars.close(F.col("l_extendedprice") * 3 / 3, F.col("l_extendedprice"))).agg(F.count(F.lit(1)).alias("n"))


@query("txt13_relevance", "with f as (select product_id, unnest(regexp_extract_all(upper(product_name), '[A-Z0-9]+(?:-[A-Z0-9]+)+')) as m from products where product_id is not null), g as (select distinct product_id, regexp_replace(m, '[^A-Z0-9]', '', 'g') as k from f where regexp_matches(m, '[A-Z]') and regexp_matches(m, '[0-9]') and length(m) >= 5) select d.doc_id, max(length(k)) as relevance from documents d join g on d.product_id = g.product_id where contains(regexp_replace(upper(d.text), '[^A-Z0-9]', '', 'g'), k) group by d.doc_id")
def _(s, d):
    """The longest model key of its product that a document holds. Products with many documents are broadcast, texts of others are hashed."""
    key = lambda c: F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")
    keys = products(s, d).where("product_id is not null").select("product_id", F.explode(identity.model_fragments("product_name")).alias("m")).select("product_id", key(F.col("m")).alias("k")).distinct()
    per = keys.groupBy("product_id").agg(F.collect_list("k").alias("_keys"))
    docs = documents(s, d).where("text is not null and product_id is not null").select("doc_id", "product_id", key(F.col("text")).alias("t"))
    weights = documents(s, d).where("product_id is not null").groupBy("product_id").agg(F.count(F.lit(1)).alias("_weight"))
    hits = join_hot(docs, per.join(weights, "product_id"), "product_id", "_weight").select("doc_id", F.explode(F.filter("_keys", lambda k: F.contains("t", k))).alias("k"))
    return hits.groupBy("doc_id").agg(F.max(F.length("k")).alias("relevance"))


@query("txt05_quote_spans")
def _(s, d):
    """Where quotes of facts stand in the pages of their url: span of the first page that grounds them."""
    from plumbline.operators.nested import flat_table

    from plumbline.plans.decision_queries import grounded

    quotes = flat_table(completions(s, d), "quote").where("url is not null and quote is not null")
    spans = grounded(quotes, pages(s, d), ["product_id", "parent_pos", "child_pos", "url", "quote"]).withColumn("_s", grounding.quote_span_udf()("quote", "content")).where("_s.start is not null")
    first = F.min(F.struct("_s.start", "_s.stop"))
    return spans.groupBy("product_id", "parent_pos", "child_pos").agg(first["start"].alias("start"), first["stop"].alias("stop"))


@query("txt06_stated_values")
def _(s, d):
    """Facts whose quote states their value with their unit."""
    rows = facts(s, d).where("quote is not null and value is not null")
    return rows.where(grounding.states_value_udf()("quote", "value", F.col("unit"))).select("fact_id")


@query("rnd05_home_counts", "select 'brand' as facet, brand_code as label, count(*) as n from products where trim(brand_code) <> '' group by brand_code union all select 'family', family_code, count(*) from products where trim(family_code) <> '' group by family_code union all select 'category', category, count(distinct product_id) from fact_item where trim(category) <> '' and product_id is not null group by category")
def _(s, d):
    p = products(s, d)
    facet = lambda c, n: p.where(F.trim(c) != "").groupBy(F.col(c).alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("facet"), "label", "n")
    each = facts(s, d).where(F.col("product_id").isNotNull() & (F.trim("category") != "")).select("product_id", F.col("category").alias("label")).distinct()
    categories = each.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(F.lit("category").alias("facet"), "label", "n")
    return facet("brand_code", "brand").unionByName(facet("family_code", "family")).unionByName(categories)


@query("set_constraint_violations", "select 'published_but_not_publishable' as rule, count(*) as n from product_research_completions where published_at is not null and publishable <> 1 union all select 'bad_source_hash', count(*) from product_research_completions where source_hash is null or not regexp_full_match(source_hash, '[0-9a-f]{64}') union all select 'path_without_action', count(*) from product_research_completions where wiki_path is not null and wiki_action is null")
def _(s, d):
    c = completions(s, d)
    counts = c.agg(
        F.count_if(F.col("published_at").isNotNull() & (F.col("publishable") != 1)).alias("published_but_not_publishable"),
        F.count_if(F.col("source_hash").isNull() | ~F.col("source_hash").rlike("^[0-9a-f]{64}$")).alias("bad_source_hash"),
        F.count_if(F.col("wiki_path").isNotNull() & F.col("wiki_action").isNull()).alias("path_without_action"),
    )
    return counts.unpivot([], counts.columns, "rule", "n")


