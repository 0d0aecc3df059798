"""Queries of the engine's scans, filters, joins, aggregations, streaks, rankings and set operations.

The catalogue tables stand for themselves. ``orders`` stands for the attempt log (attempt o_orderkey,
product o_custkey, outcome o_orderstatus), ``lineitem`` for the action ledger (attempt l_orderkey,
round l_linenumber, action l_returnflag, status l_linestatus, credits l_quantity), ``events`` for
provider responses.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.functions import canonical, identity, urls
from plumbline.operators import relational as rel
from plumbline.session import read_table

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def _t(name):
    return lambda spark, d: read_table(spark, d, name)


products, snapshots, completions, pages, facts, registry = map(_t, ("products", "product_catalogue_snapshot", "product_research_completions", "web_fetch_exa", "fact_item", "brand_registry"))
orders, lineitem, events, documents = map(_t, ("orders", "lineitem", "events", "documents"))
CATALOGUE_ORDER = ["product_id", "brand_code", "family_code", "product_name", "unit_of_measure", "created_at", "updated_at"]
CATALOGUE = CATALOGUE_ORDER

# ---- scans, sources, sinks


@query("src01_catalogue_scan", "select product_id, brand_code, family_code, product_name, unit_of_measure, created_at, updated_at from products where trim(product_id) <> ''")
def _(s, d):
    return products(s, d).select(*CATALOGUE).where(F.trim("product_id") != "").orderBy(F.coalesce("updated_at", "created_at"), "product_id")


@query("src02_since_inclusive", "select row_id, product_id from products where coalesce(updated_at, created_at) >= timestamptz '2025-09-01 00:00:00+00'")
def _(s, d):
    return products(s, d).where(F.coalesce("updated_at", "created_at") >= F.lit("2025-09-01 00:00:00+00:00").cast("timestamp")).select("row_id", "product_id")


@query("src06_snapshot_status", "select max(generation) as generation, count(*) filter (where generation = (select max(generation) from product_catalogue_snapshot)) as n_rows, count(distinct generation) as generations from product_catalogue_snapshot")
def _(s, d):
    per = snapshots(s, d).groupBy("generation").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max("generation").alias("generation"), F.max(F.struct("generation", "n"))["n"].alias("n_rows"), F.count(F.lit(1)).alias("generations"))


@query("src07_registry_aliases", "select brand_code, manufacturer, unnest(alias_list) as alias from brand_registry")
def _(s, d):
    return registry(s, d).select("brand_code", "manufacturer", F.explode("alias_list").alias("alias"))


@query(
    "src07_registry_violations",
    """select 'duplicate_code' as rule, brand_code as value from brand_registry group by brand_code having count(*) > 1
    union all select 'duplicate_domain', lower(web_domain) from brand_registry group by lower(web_domain) having count(*) > 1
    union all select 'too_many_aliases', brand_code from brand_registry where len(alias_list) > 20
    union all select 'blank_name', brand_code from brand_registry where trim(coalesce(manufacturer, '')) = ''""",
)
def _(s, d):
    r = registry(s, d)
    rules = [
        r.groupBy(F.col("brand_code").alias("value")).count().where("count > 1").select(F.lit("duplicate_code").alias("rule"), "value"),
        r.groupBy(F.lower("web_domain").alias("value")).count().where("count > 1").select(F.lit("duplicate_domain").alias("rule"), "value"),
        r.where(F.size("alias_list") > 20).select(F.lit("too_many_aliases").alias("rule"), F.col("brand_code").alias("value")),
        r.where(F.trim(F.coalesce("manufacturer", F.lit(""))) == "").select(F.lit("blank_name").alias("rule"), F.col("brand_code").alias("value")),
    ]
    out = rules[0]
    for x in rules[1:]:
        out = out.unionByName(x)
    return out


_ROW_TEXT = " || ".join(f"coalesce(length({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in ("row_id", "product_id", "brand_code", "family_code", "product_name", "unit_of_measure", "epoch_us(created_at)", "epoch_us(updated_at)"))


@query("src11_table_digest", f"select count(*) as n_rows, sum(('0x' || substr(sha256({_ROW_TEXT}), 1, 15))::bigint)::varchar as digest from products")
def _(s, d):
    """Count and digest of all columns, the same for the same bag of rows: two copies of a table are compared by it."""
    micros = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("created_at", "updated_at")}
    return rel.table_digest(products(s, d).withColumns(micros), ["row_id", *CATALOGUE_ORDER])


@query("snk02_insert_once", "select product_id, min(row_id) as row_id from products where product_id is not null and product_id not in (select product_id from product_research_completions where product_id is not null) group by product_id")
def _(s, d):
    incoming = products(s, d).where("product_id is not null").groupBy("product_id").agg(F.min("row_id").alias("row_id"))
    return incoming.join(completions(s, d).select("product_id"), "product_id", "left_anti")


@query("snk03_first_published", "select product_id, min(published_at) as published_at from product_research_completions where product_id is not null group by product_id")
def _(s, d):
    return completions(s, d).where("product_id is not null").groupBy("product_id").agg(F.min("published_at").alias("published_at"))


_TWO = """with l as (select generation, product_id, source_hash, payload_json from (select *, row_number() over (partition by generation, product_id order by refreshed_at desc nulls last, payload_json desc) as rn from product_catalogue_snapshot where product_id is not null) where rn = 1),
g as (select max(generation) as new_g, (select max(generation) from l where generation < (select max(generation) from l)) as old_g from l),
o as (select l.* from l, g where generation = old_g), n as (select l.* from l, g where generation = new_g)
"""


def _two_states(s, d):
    from plumbline.operators.snapshots import latest_rows
    from plumbline.session import bounded_list

    rows = latest_rows(snapshots(s, d))
    gens = bounded_list(snapshots(s, d), "generation", 100_000)
    old, new = ([None, None] + gens)[-2:]
    return [rows.where(F.col("generation").eqNullSafe(F.lit(g))) for g in (old, new)]


@query("snk04_page_actions", _TWO + "select coalesce(o.product_id, n.product_id) as product_id, case when o.product_id is null then 'created' when n.product_id is null then 'orphaned' when o.payload_json is not distinct from n.payload_json then 'unchanged' else 'updated' end as action from o full outer join n on o.product_id = n.product_id")
def _(s, d):
    old, new = _two_states(s, d)
    a, b = (x.select("product_id", F.struct("payload_json").alias(n)) for x, n in ((old, "a"), (new, "b")))
    action = F.when(F.col("a").isNull(), "created").when(F.col("b").isNull(), "orphaned").when(F.col("a").eqNullSafe(F.col("b")), "unchanged").otherwise("updated")
    return a.join(b, "product_id", "full_outer").select("product_id", action.alias("action"))


# ---- projections and filters


@query("prj02_public_projection", "select fetch_id, url, left(content, 20000) as content from web_fetch_exa where fetch_status = 'success'")
def _(s, d):
    return pages(s, d).where("fetch_status = 'success'").select("fetch_id", "url", F.left("content", F.lit(20000)).alias("content"))


@query("prj04_allow_list", "select distinct product_id, decision_json->>'$.outcome' as outcome, decision_json->>'$.model' as model from product_research_completions where json_valid(decision_json) and json_type(decision_json) = 'OBJECT'")
def _(s, d):
    v = F.from_json("decision_json", "outcome string, model string")
    ok = F.coalesce(F.expr("schema_of_variant(try_parse_json(decision_json)) like 'OBJECT%'"), F.lit(False))
    return completions(s, d).where(ok).select("product_id", v.alias("v")).select("product_id", "v.outcome", "v.model").distinct()


@query("fil02_outcome_list", "select o_orderkey from orders where o_orderstatus in ('F', 'P')")
def _(s, d):
    return orders(s, d).where(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey")


@query("fil04_half_open_window", "select event_id from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-10'")
def _(s, d):
    return events(s, d).where((F.col("ts") >= F.lit("2024-01-05").cast(events(s, d).schema["ts"].dataType)) & (F.col("ts") < F.lit("2024-01-10").cast(events(s, d).schema["ts"].dataType))).select("event_id")


@query("fil05_open_closed_window", "select event_id from events where ts > timestamp '2024-01-05' and ts <= timestamp '2024-01-10'")
def _(s, d):
    e = events(s, d)
    t = e.schema["ts"].dataType
    return e.where((F.col("ts") > F.lit("2024-01-05").cast(t)) & (F.col("ts") <= F.lit("2024-01-10").cast(t))).select("event_id")


@query("fil07_no_system_outcomes", "select product_id, outcome from product_research_completions where substr(outcome, 1, 2) <> 'no'")
def _(s, d):
    return completions(s, d).where(F.substring("outcome", 1, 2) != "no").select("product_id", "outcome")


@query("fil09_guarded_json", "select event_id from events where case when json_valid(props) then (props->>'$.k')::int end = 69")
def _(s, d):
    return events(s, d).where(F.try_variant_get(F.try_parse_json("props"), "$.k", "int") == 69).select("event_id")


@query("fil10_precheck", "select p.row_id, case when c.product_id is null then 'missing' when c.h is distinct from s.h then 'source_changed' when c.pub = 1 then 'published' else 'not_due' end as state from products p left join (select product_id, max(source_hash) as h, max(publishable) as pub from product_research_completions group by product_id) c on p.product_id = c.product_id left join (select product_id, max(source_hash) as h from product_catalogue_snapshot where generation = (select max(generation) from product_catalogue_snapshot) group by product_id) s on p.product_id = s.product_id")
def _(s, d):
    done = completions(s, d).groupBy("product_id").agg(F.max("source_hash").alias("h"), F.max("publishable").alias("pub"), F.lit(True).alias("done"))
    snap = snapshots(s, d)
    newest = snap.agg(F.max("generation").alias("generation"))
    now = snap.join(F.broadcast(newest), "generation", "left_semi").groupBy("product_id").agg(F.max("source_hash").alias("h_now"))
    state = F.when(F.col("done").isNull(), "missing").when(~F.col("h").eqNullSafe(F.col("h_now")), "source_changed").when(F.col("pub") == 1, "published").otherwise("not_due")
    return products(s, d).join(done, "product_id", "left").join(now, "product_id", "left").select("row_id", state.alias("state"))


# ---- joins


@query("jn01_next_unfinished", "select product_id from (select distinct product_id from products where product_id is not null) p where not exists (select 1 from product_research_completions c where c.product_id = p.product_id) order by product_id <= 'P-0000100', product_id limit 1")
def _(s, d):
    return rel.next_unfinished(products(s, d), completions(s, d), "product_id", "P-0000100")


@query("jn02_backfill", "select p.product_id, c.wiki_path from (select distinct product_id from products where product_id is not null) p left join (select product_id, wiki_path from (select *, row_number() over (partition by product_id order by completed_at desc nulls last, wiki_path desc nulls last) as rn from product_research_completions where wiki_action is not null) where rn = 1) c using (product_id) where not exists (select 1 from product_catalogue_snapshot s where s.product_id = p.product_id)")
def _(s, d):
    """Products that no snapshot has, with the page of their latest completed publication if there is one."""
    latest = rel.latest_per_key(completions(s, d).where("wiki_action is not null and product_id is not null"), ["product_id"], ["completed_at", "wiki_path"], ["product_id", "wiki_path"])
    known = snapshots(s, d).select("product_id")
    return products(s, d).select("product_id").where("product_id is not null").distinct().join(latest, "product_id", "left").join(known, "product_id", "left_anti")


@query("jn03_latest_success", "select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderkey desc) as rn from orders where o_orderstatus = 'F') where rn = 1")
def _(s, d):
    return rel.latest_per_key(orders(s, d).where("o_orderstatus = 'F'"), ["o_custkey"], ["o_orderkey"], ["o_custkey", "o_orderkey", "o_totalprice"])


@query("jn04_requeue", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderkey desc) as rn from orders where o_orderstatus <> 'P') where rn = 1 and o_orderstatus = 'O' and o_orderdate >= timestamp '1995-06-01' and o_orderdate < timestamp '1998-01-01' order by o_orderdate, o_orderkey limit 50")
def _(s, d):
    """Products whose latest attempt that the system did not end has the asked outcome and lies in the window, oldest first."""
    o = orders(s, d)
    t = o.schema["o_orderdate"].dataType
    last = rel.latest_per_key(o.where("o_orderstatus <> 'P'"), ["o_custkey"], ["o_orderkey"], ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate"])
    due = last.where((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= F.lit("1995-06-01").cast(t)) & (F.col("o_orderdate") < F.lit("1998-01-01").cast(t)))
    return due.orderBy("o_orderdate", "o_orderkey").limit(50).select("o_custkey", "o_orderkey")


@query("jn05_open_attempts", "select c_custkey, o_orderkey from customer join orders on c_custkey = o_custkey where o_orderstatus = 'O'")
def _(s, d):
    """Products with their attempts that have not ended (here customers and open orders)."""
    open_ones = orders(s, d).where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return read_table(s, d, "customer").select("c_custkey").join(open_ones, "c_custkey").select("c_custkey", "o_orderkey")


@query("jn06_source_consistency", "with h as (select product_id, max(struct_pack(g := generation, h := coalesce(source_hash, ''))) as t from product_catalogue_snapshot where product_id is not null group by product_id) select c.product_id, c.completed_at, case when h.t is null then 'not_listed' when c.source_hash is null then 'no_hash' when c.source_hash = h.t.h then 'current' else 'source_changed' end as state, count(*) as n from product_research_completions c left join h using (product_id) where c.product_id is not null group by all")
def _(s, d):
    """Whether each attempt was made from the source as the newest generation has it."""
    newest = snapshots(s, d).where("product_id is not null").groupBy("product_id").agg(F.max(F.struct("generation", F.coalesce("source_hash", F.lit("")).alias("h"))).alias("t"))
    state = F.when(F.col("t").isNull(), "not_listed").when(F.col("source_hash").isNull(), "no_hash").when(F.col("source_hash") == F.col("t.h"), "current").otherwise("source_changed")
    rows = completions(s, d).where("product_id is not null").join(newest, "product_id", "left")
    return rows.groupBy("product_id", "completed_at", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("jn08_expired", "select c_custkey, o_orderkey from customer join orders on c_custkey = o_custkey where o_orderstatus = 'O' and o_orderdate <= timestamp '1996-01-01'")
def _(s, d):
    """Open attempts whose time has run out."""
    o = orders(s, d)
    late = o.where((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") <= F.lit("1996-01-01").cast(o.schema["o_orderdate"].dataType))).select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return read_table(s, d, "customer").select("c_custkey").join(late, "c_custkey").select("c_custkey", "o_orderkey")


@query("jn07_action_history", "select l_orderkey, l_linenumber, l_returnflag, o_custkey from lineitem join orders on l_orderkey = o_orderkey")
def _(s, d):
    return lineitem(s, d).join(orders(s, d), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_returnflag", "o_custkey")


@query("jn09_prior_unresolved", "select a.o_orderkey, count(*) as n_other from orders a join orders b on a.o_custkey = b.o_custkey and a.o_orderkey <> b.o_orderkey and b.o_orderstatus = 'P' group by a.o_orderkey")
def _(s, d):
    # counts per product, less the attempt's own row: no pairs within a product are formed
    o = orders(s, d)
    per = o.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "P").alias("_n"))
    n = F.col("_n") - F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)
    return o.join(per, "o_custkey").select("o_orderkey", n.alias("n_other")).where("n_other > 0")


_FRAGMENTS = "regexp_extract_all(product_name, '[A-Za-z0-9]+(?:-[A-Za-z0-9]+)+')"


@query(
    "jn10_sibling_brand",
    f"""with f as (select row_id, nullif(trim(brand_code), '') as brand, upper(unnest({_FRAGMENTS})) as frag from products),
    g as (select frag, min(brand) as brand from f where regexp_matches(frag, '[A-Z]') and regexp_matches(frag, '[0-9]') and length(frag) >= 5 group by frag having count(distinct brand) = 1)
    select f.row_id, min(g.brand) as brand_code from f join g on f.frag = g.frag where f.brand is null group by f.row_id having count(distinct g.brand) = 1""",
)
def _(s, d):
    p = products(s, d).select("row_id", F.nullif(F.trim("brand_code"), F.lit("")).alias("brand"), F.explode(identity.model_fragments("product_name")).alias("frag"))
    known = p.groupBy("frag").agg(F.min("brand").alias("known"), F.max("brand").alias("_most")).where("known = _most").select("frag", "known")
    return p.where("brand is null").join(known, "frag").groupBy("row_id").agg(F.min("known").alias("brand_code"), F.max("known").alias("_most")).where("brand_code = _most").select("row_id", "brand_code")


@query("jn11_snapshot_diff", _TWO + "select count(*) filter (where o.product_id is null) as added, count(*) filter (where n.product_id is null) as removed, count(*) filter (where o.product_id is not null and n.product_id is not null and o.payload_json is distinct from n.payload_json) as changed, count(*) filter (where o.product_id is not null and n.product_id is not null and o.payload_json is not distinct from n.payload_json) as unchanged from o full outer join n on o.product_id = n.product_id")
def _(s, d):
    old, new = _two_states(s, d)
    return rel.snapshot_class_counts(old, new, "product_id", "payload_json")


@query("jn13_trusted_host", "select distinct w.fetch_id from web_fetch_exa w join brand_registry r on regexp_extract(lower(w.url), '://([^/]*)', 1) = r.web_domain or ends_with(regexp_extract(lower(w.url), '://([^/]*)', 1), '.' || r.web_domain)")
def _(s, d):
    host = pages(s, d).select("fetch_id", F.explode(urls.parent_domains(urls.host("url"))).alias("web_domain"))
    return host.join(registry(s, d).select("web_domain"), "web_domain", "left_semi").select("fetch_id").distinct()


# ---- aggregations


OUTCOMES = ["publish", "no_datasheet", "ambiguous", "insufficient_identity", "out_of_scope"]


@query("agg01_status_counts", "select v.outcome, count(c.outcome) as n from (values " + ", ".join(f"('{o}')" for o in [*OUTCOMES, "never_seen"]) + ") v(outcome) left join product_research_completions c on c.outcome = v.outcome group by v.outcome")
def _(s, d):
    return rel.zero_filled_counts(completions(s, d), "outcome", [*OUTCOMES, "never_seen"])


@query("agg03_outcome_counts", "select outcome, count(*) as n from product_research_completions group by outcome")
def _(s, d):
    return completions(s, d).groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "outcome")


@query("agg04_action_totals", "select count(*) as actions, coalesce(sum(l_quantity), 0) as credits, count(*) filter (where l_quantity is null or l_linestatus = 'O') as unknown, max(l_linenumber) as max_round from lineitem")
def _(s, d):
    return lineitem(s, d).agg(F.count(F.lit(1)).alias("actions"), F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("credits"), F.count_if(F.col("l_quantity").isNull() | (F.col("l_linestatus") == "O")).alias("unknown"), F.max("l_linenumber").alias("max_round"))


@query("agg05_action_stats", "select a.action, b.status, count(l_orderkey) as n, coalesce(sum(l_quantity), 0) as credits from (values ('A'), ('N'), ('R'), ('X')) a(action) join (values ('F'), ('O')) b(status) on true left join lineitem on l_returnflag = a.action and l_linestatus = b.status group by 1, 2")
def _(s, d):
    """Counts and credits of every known action and status, zero where no row has them."""
    kinds = s.createDataFrame([(a, b) for a in "ANRX" for b in "FO"], "action string, status string")
    sums = lineitem(s, d).groupBy(F.col("l_returnflag").alias("action"), F.col("l_linestatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("credits"))
    return kinds.join(sums, ["action", "status"], "left").select("action", "status", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("credits", F.lit(0.0)).alias("credits"))


@query("agg06_completion_counts", "select count(*) as total, coalesce(sum(case when publishable = 1 then 1 end), 0) as publishable, coalesce(sum(case when published_at is not null then 1 end), 0) as published, coalesce(sum(case when publishable = 1 and published_at is null then 1 end), 0) as pending from product_research_completions")
def _(s, d):
    ready, out = F.col("publishable") == 1, F.col("published_at").isNotNull()
    return completions(s, d).agg(F.count(F.lit(1)).alias("total"), F.count_if(ready).alias("publishable"), F.count_if(out).alias("published"), F.count_if(ready & ~out).alias("pending"))


@query("agg07_error_products", "select count(distinct user_id) as n from events where event_type = 'error' and ts > timestamp '2024-01-10'")
def _(s, d):
    e = events(s, d)
    return e.where((F.col("event_type") == "error") & (F.col("ts") > F.lit("2024-01-10").cast(e.schema["ts"].dataType))).agg(F.countDistinct("user_id").alias("n"))


@query("agg08_usage_window", "with u as (select l_returnflag as action, l_quantity as credits from lineitem where l_shipdate >= timestamp '1995-01-01' and l_shipdate < timestamp '1996-01-01' union all select 'legacy', case when o_orderstatus = 'P' then null else o_totalprice end from orders where o_orderdate >= timestamp '1995-01-01' and o_orderdate < timestamp '1996-01-01') select coalesce(action, 'total') as action, count(*) as actions, round(sum(credits), 2) as credits, count(*) - count(credits) as unknown from u group by rollup(action)")
def _(s, d):
    def window(df, c):
        t = df.schema[c].dataType
        return df.where((F.col(c) >= F.lit("1995-01-01").cast(t)) & (F.col(c) < F.lit("1996-01-01").cast(t)))

    ledger = window(lineitem(s, d), "l_shipdate").select(F.col("l_returnflag").alias("action"), F.col("l_quantity").alias("credits"))
    legacy = window(orders(s, d), "o_orderdate").select(F.lit("legacy").alias("action"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("credits"))
    u = ledger.unionByName(legacy).rollup("action").agg(F.count(F.lit(1)).alias("actions"), F.round(F.sum("credits"), 2).alias("credits"), F.count_if(F.col("credits").isNull()).alias("unknown"))
    return u.select(F.coalesce("action", F.lit("total")).alias("action"), "actions", "credits", "unknown")


@query("agg09_over_ceiling", "select l_orderkey, sum(l_quantity) as credits from lineitem group by l_orderkey having sum(l_quantity) > 200")
def _(s, d):
    return lineitem(s, d).groupBy("l_orderkey").agg(F.sum("l_quantity").alias("credits")).where("credits > 200")


@query("agg10_folded_counts", "select (min({'r': row_id, 'l': trim(product_name)})).l as label, count(*) as n from products where trim(product_name) <> '' group by lower(trim(product_name))")
def _(s, d):
    return rel.folded_counts(products(s, d), "product_name", "row_id")


@query("agg11_checksum", "with r as (select product_id as k, max(source_hash) as v from product_catalogue_snapshot where generation = 1 and product_id is not null group by product_id), b as (select substr(sha256(k), 1, 4) as b, sha256(string_agg(k || chr(0) || coalesce(v, '') || chr(10), '' order by lower(k), k)) as dig from r group by 1) select sha256(string_agg(dig, '' order by b)) as checksum from b")
def _(s, d):
    one = snapshots(s, d).where("generation = 1 and product_id is not null").groupBy("product_id").agg(F.max("source_hash").alias("source_hash"))
    return rel.catalogue_checksum(one, "product_id", "source_hash")


@query("agg12_max_attempt", "select coalesce(max(o_orderkey), 0) as attempt from orders")
def _(s, d):
    return orders(s, d).agg(F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("attempt"))


USAGE_FIELDS = ["k", "input_tokens", "output_tokens", "total_tokens", "cached_tokens", "reasoning_tokens"]


@query("agg14_token_usage", "select event_type, 'k' as field, sum((props->>'$.k')::bigint) as total from events where json_valid(props) and regexp_full_match(props->>'$.k', '[0-9]+') group by event_type")
def _(s, d):
    """Totals per type of each known field that holds a whole number; other fields and values do not count."""
    return rel.usage_totals(events(s, d), "event_type", "props", USAGE_FIELDS)


# ---- streaks


@query("seq01_failure_streak", "with t as (select o_custkey, o_orderstatus, row_number() over (partition by o_custkey order by o_orderkey desc) as rn from orders), u as (select * from t where rn <= 8) select o_custkey, coalesce(min(case when o_orderstatus <> 'F' then rn end) - 1, count(*)) as streak from u group by o_custkey")
def _(s, d):
    return rel.leading_streak(orders(s, d), "o_custkey", ["o_orderkey"], F.col("o_orderstatus") == "F", 8)


@query("seq02_retry_streak", "with t as (select o_custkey, o_orderstatus, row_number() over (partition by o_custkey order by o_orderkey desc) as rn, first_value(o_orderstatus) over (partition by o_custkey order by o_orderkey desc) as f from orders), u as (select * from t where rn <= 32) select o_custkey, coalesce(min(case when o_orderstatus <> f then rn end) - 1, count(*)) as streak from u group by o_custkey")
def _(s, d):
    o = orders(s, d).select("o_custkey", "o_orderkey", "o_orderstatus")
    newest = rel.latest_per_key(o, ["o_custkey"], ["o_orderkey"], ["o_custkey", "o_orderstatus"]).withColumnRenamed("o_orderstatus", "_f")
    return rel.leading_streak(o.join(newest, "o_custkey"), "o_custkey", ["o_orderkey"], F.col("o_orderstatus") == F.col("_f"), 32)


@query("seq03_distinct_streak", "select least(count(distinct o_custkey), 5) as streak from orders where o_orderkey > coalesce((select max(o_orderkey) from orders where o_orderstatus <> (select o_orderstatus from orders order by o_orderkey desc limit 1)), -1)")
def _(s, d):
    o = orders(s, d)
    newest = o.agg(F.max(F.struct("o_orderkey", "o_orderstatus"))["o_orderstatus"].alias("_w")).scalar()
    return rel.distinct_streak(o.withColumn("_same", F.when(F.col("o_orderstatus") == newest, "y").otherwise("n")), "o_custkey", "o_orderkey", "_same", "y", 5)


@query("seq04_latest_error", "select user_id, event_id, ts, ts + interval 6 hour as expires_at from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events where event_type = 'error') where rn = 1")
def _(s, d):
    top = rel.latest_per_key(events(s, d).where("event_type = 'error'"), ["user_id"], ["ts", "event_id"], ["user_id", "event_id", "ts"])
    return top.withColumn("expires_at", F.col("ts") + F.expr("interval 6 hours"))


@query("seq05_recovered", "select o_custkey, o_orderkey, failed from (select *, max(case when o_orderstatus = 'P' then o_orderkey end) over (partition by o_custkey, o_orderpriority order by o_orderkey rows between unbounded preceding and 1 preceding) as failed from orders) where o_orderstatus = 'F' and failed is not null")
def _(s, d):
    """Attempts with the newest earlier failed one of the same product under the same policy (here the priority)."""
    before = Window.partitionBy("o_custkey", "o_orderpriority").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, -1)
    failed = F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey"))).over(before)
    return orders(s, d).withColumn("failed", failed).where("o_orderstatus = 'F' and failed is not null").select("o_custkey", "o_orderkey", "failed")


# ---- rankings


@query("top01_due_list", "select o_orderkey from orders where o_orderstatus in ('O', 'P') order by case o_orderstatus when 'O' then 0 else 1 end, o_orderdate, o_orderkey limit 100")
def _(s, d):
    return orders(s, d).where(F.col("o_orderstatus").isin("O", "P")).orderBy(F.when(F.col("o_orderstatus") == "O", 0).otherwise(1), "o_orderdate", "o_orderkey").limit(100).select("o_orderkey")


@query("top03_oldest_pending", "select product_id from product_research_completions where publishable = 1 and published_at is null order by completed_at nulls first, product_id limit 1")
def _(s, d):
    return completions(s, d).where("publishable = 1 and published_at is null").orderBy(F.asc_nulls_first("completed_at"), "product_id").limit(1).select("product_id")


_IN_URL = "[a-z]+-[0-9]+[a-z]-[0-9][a-z0-9]+"


@query("top04_ranked_pages", f"select fetch_id, place from (select fetch_id, row_number() over (partition by regexp_extract(lower(url), '://([^/]*)', 1) order by length(regexp_extract(lower(url), '{_IN_URL}')) desc, (case when ends_with(regexp_replace(lower(url), '[?#].*', ''), '.pdf') then 0 else 1 end), length(content) desc nulls last, url, fetch_id) as place from web_fetch_exa) where place <= 5")
def _(s, d):
    """The best pages of each host: the longest model key in the url first, documents before pages, then by score and url."""
    relevance = F.length(F.regexp_extract(F.lower("url"), f"({_IN_URL})", 1))
    ranked = Window.partitionBy(urls.host("url")).orderBy(relevance.desc(), F.when(urls.is_pdf("url"), 0).otherwise(1), F.length("content").desc_nulls_last(), "url", "fetch_id")
    return pages(s, d).withColumn("place", F.row_number().over(ranked)).where("place <= 5").select("fetch_id", "place")


@query("top07_newest_first", "select product_id, max(published_at) as published_at from product_research_completions where published_at is not null group by product_id order by 2 desc, 1 limit 20")
def _(s, d):
    return completions(s, d).where("published_at is not null").groupBy("product_id").agg(F.max("published_at").alias("published_at")).orderBy(F.desc("published_at"), "product_id").limit(20)


@query("top11_round_robin", "select brand_code from brand_registry where kind = 'manufacturer' and brand_code not in ('NRDL', 'NRDX') and web_domain is not null order by brand_code <= 'MRVN', brand_code limit 1")
def _(s, d):
    """The next key behind the cursor that is neither disabled nor excluded nor without a target."""
    healthy = registry(s, d).where(F.col("kind").eqNullSafe("manufacturer") & ~F.col("brand_code").isin("NRDL", "NRDX") & F.col("web_domain").isNotNull())
    return healthy.select("brand_code").orderBy(F.col("brand_code") <= "MRVN", "brand_code").limit(1)


# ---- sets and deduplication


@query("set01_duplicate_ids", "select product_id, count(*) as n from products group by product_id having count(*) > 1")
def _(s, d):
    return rel.duplicate_keys(products(s, d), ["product_id"])


@query("set02_key_difference", "select product_id from product_catalogue_snapshot where generation = 1 except select product_id from product_catalogue_snapshot where generation = 2")
def _(s, d):
    one, two = (snapshots(s, d).where(f"generation = {g}").select("product_id") for g in (1, 2))
    return one.subtract(two)


_KEY = "lower(regexp_extract(url, '^(https?)://', 1)) || '://' || lower(regexp_extract(url, '://([^/?#:]*)', 1)) || lower(case when regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/+$', '') = '' then '/' else regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/+$', '') end) || coalesce(nullif('?' || regexp_extract(url, '[?]([^#]*)', 1), '?'), '')"


@query("set03_url_dedupe", f"with k as (select {_KEY} as dedupe_key, * from web_fetch_exa), r as (select dedupe_key, fetch_id, length(content) as score, row_number() over (partition by dedupe_key order by length(content) desc nulls last, fetch_id desc) as rn from k where dedupe_key is not null), q as (select dedupe_key, count(*) as n, coalesce(array_to_string(list_sort(list_distinct(list(content_type))), ','), '') as queries from k where dedupe_key is not null group by 1) select r.dedupe_key, r.fetch_id, r.score, q.n, q.queries from r join q using (dedupe_key) where rn = 1")
def _(s, d):
    """Results of one page become one: the best score, the number of results and all that found it (here the content types)."""
    p = pages(s, d).withColumn("score", F.length("content")).withColumn("_key", urls.dedupe_key("url")).where("_key is not null")
    best = p.groupBy("_key").agg(F.max(F.struct("score", "fetch_id")).alias("t"), F.count(F.lit(1)).alias("n"))
    found = p.where("content_type is not null").select("_key", "content_type").distinct().groupBy("_key").agg(F.array_join(F.array_sort(F.collect_list("content_type")), ",").alias("queries"))
    return best.join(found, "_key", "left").select(F.col("_key").alias("dedupe_key"), "t.fetch_id", "t.score", "n", F.coalesce("queries", F.lit("")).alias("queries"))


@query("set05_longest_body", f"with k as (select {_KEY} as dedupe_key, fetch_id, content, content_type from web_fetch_exa), r as (select *, row_number() over (partition by dedupe_key order by length(content) desc nulls last, fetch_id desc) as rn from k) select r.dedupe_key, r.fetch_id, length(r.content) as n_chars from r where rn = 1")
def _(s, d):
    p = pages(s, d).withColumn("n_chars", F.length("content"))
    return rel.merge_by_url(p, urls.dedupe_key("url"), ["fetch_id", "n_chars"], [F.col("n_chars")], "content_type").select("dedupe_key", "fetch_id", "n_chars")


@query("set07_conflicting_bodies", "select url, count(distinct sha256(content)) as bodies from web_fetch_exa where content is not null group by url having count(distinct sha256(content)) > 1")
def _(s, d):
    return pages(s, d).where("content is not null").select("url", F.sha2("content", 256).alias("_h")).distinct().groupBy("url").agg(F.count(F.lit(1)).alias("bodies")).where("bodies > 1")


@query("set08_tags", "select product_id, array_to_string(list_sort(list_distinct(list(lower(trim(category))))), ',') as tags from fact_item where trim(category) <> '' group by product_id")
def _(s, d):
    return facts(s, d).where(F.trim("category") != "").select("product_id", F.lower(F.trim("category")).alias("tag")).distinct().groupBy("product_id").agg(F.array_join(F.array_sort(F.collect_list("tag")), ",").alias("tags"))


@query("set10_ledger_union", "select l_orderkey as attempt, 'ledger' as origin from lineitem union all select o_orderkey, 'legacy' from orders")
def _(s, d):
    a = lineitem(s, d).select(F.col("l_orderkey").alias("attempt"), F.lit("ledger").alias("origin"))
    b = orders(s, d).select(F.col("o_orderkey").alias("attempt"), F.lit("legacy").alias("origin"))
    return a.unionByName(b)


