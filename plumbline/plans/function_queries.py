"""Queries of the scalar functions, over the tables of the domain."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import canonical, identity, scalars, text, urls
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


_JSON = " || ',' || ".join(
    f"""'"{f}":' || coalesce(to_json({f'strftime({f} at time zone $$UTC$$, $$%Y-%m-%dT%H:%M:%S.%fZ$$)' if f.endswith('_at') else f})::varchar, 'null')""" for f in canonical.PRODUCT_FIELDS
)
_CANONICAL = "'{' || " + _JSON + " || '}'"


@query("hsh01_canonical_json", f"select row_id, {_CANONICAL} as canonical from products")
def _(s, d):
    return read_table(s, d, "products").select("row_id", canonical.product_json().alias("canonical"))


@query("hsh02_source_hash", f"select row_id, sha256({_CANONICAL}) as source_hash from products")
def _(s, d):
    return read_table(s, d, "products").select("row_id", canonical.source_hash().alias("source_hash"))


@query("hsh05_content_hash", "select fetch_id, sha256(content) as sha256 from web_fetch_exa where content is not null")
def _(s, d):
    return read_table(s, d, "web_fetch_exa").where("content is not null").select("fetch_id", F.sha2("content", 256).alias("sha256"))


@query("hsh07_receipt_states", "select case when receipt is null then 'missing' when regexp_matches(receipt, '^v1\\.[A-Za-z0-9_-]{42}[AEIMQUYcgkosw048]$') then 'well_formed' else 'malformed' end as state, count(*) as n from web_fetch_exa group by 1")
def _(s, d):
    return read_table(s, d, "web_fetch_exa").groupBy(canonical.receipt_state("receipt").alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("hsh08_key_fingerprint", "select brand_code, left(sha256(brand_code), 12) as fingerprint from brand_registry")
def _(s, d):
    return read_table(s, d, "brand_registry").select("brand_code", F.left(F.sha2("brand_code", 256), F.lit(12)).alias("fingerprint"))


@query("jsn01_json_valid", "select completed_at, product_id, coalesce(json_valid(decision_json), false) as valid from product_research_completions")
def _(s, d):
    return read_table(s, d, "product_research_completions").select("completed_at", "product_id", F.try_parse_json("decision_json").isNotNull().alias("valid"))


@query("jsn02_json_extract", "select event_id, (props->>'$.k')::int as k from events where json_valid(props)")
def _(s, d):
    return read_table(s, d, "events").where(F.try_parse_json("props").isNotNull()).select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"))


def _narrowed(c: str) -> str:
    wide, narrow = (x.replace("'", "''") for x in (text.WIDE, text.NARROW))
    return f"translate({c}, '{wide}', '{narrow}')"


def _key(c: str) -> str:
    return f"regexp_replace(replace(replace(replace(translate(lower({c}), 'µς', 'μσ'), 'ß', 'ss'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), '[^\\pL\\pN]', '', 'g')"


@query("str01_identity_keys", "select row_id, " + _key(f"nfc_normalize({_narrowed('product_name')})") + " as key from products")
def _(s, d):
    return read_table(s, d, "products").select("row_id", identity.identity_key_column("product_name").alias("key"))


@query("str02_search_keys", "select row_id, " + _key("product_name") + " as key from products")
def _(s, d):
    return read_table(s, d, "products").select("row_id", identity.identity_key_column("product_name", compatibility=False).alias("key"))


_SPACES = "[\\s\\x{0B}\\x{85}\\p{Z}]+"


@query("str03_one_line", f"select doc_id, trim(regexp_replace(text, '{_SPACES}', ' ', 'g')) as line from documents")
def _(s, d):
    return read_table(s, d, "documents").select("doc_id", scalars.one_line("text").alias("line"))


@query("str06_slugs", "select row_id, case when slug <> '' then 'products/' || slug || '-' || left(sha256(raw), 10) end as path from (select row_id, raw, trim(regexp_replace(lower(" + _narrowed("raw") + "), '[^\\pL\\pN]+', '-', 'g'), '-') as slug from (select row_id, trim(regexp_replace(product_id, '\\s+', ' ', 'g')) as raw from products))")
def _(s, d):
    return read_table(s, d, "products").select("row_id", identity.path_udf()("product_id").alias("path"))


def _cell(c: str) -> str:
    return f"replace(replace(replace(replace(replace(trim(regexp_replace({c}, '{_SPACES}', ' ', 'g')), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\\', '\\\\'), '|', '\\|')"


@query("str08_table_cells", f"select fact_id, {_cell('name')} as cell from fact_item")
def _(s, d):
    return read_table(s, d, "fact_item").select("fact_id", scalars.table_cell("name").alias("cell"))


_BROAD = "case lower(trim(category)) " + " ".join(f"when '{a}' then '{b}'" for a, b in scalars.CATEGORY_ALIASES.items()) + " else trim(category) end"


@query("str09_categories", f"select distinct category, {_BROAD} as broad from fact_item where category is not null")
def _(s, d):
    return read_table(s, d, "fact_item").where("category is not null").select("category").distinct().select("category", scalars.broad_category("category").alias("broad"))


@query("str12_probabilities", "select fact_id, case when regexp_full_match(trim(value), '0(\\.\\d+)?|1(\\.0+)?') then trim(value)::double end as p from fact_item")
def _(s, d):
    return read_table(s, d, "fact_item").select("fact_id", scalars.probability("value").alias("p"))


_HOST = "lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1))"
_PORT = "regexp_extract(url, '^[A-Za-z]+://[^/?#:]*:(\\d*)', 1)"
_PATH = "coalesce(nullif(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), ''), '/')"
_FRAGMENT = "case when regexp_matches(url, '#.') then '#' || regexp_extract(url, '#(.*)$', 1) else '' end"
_ASKED = "case when regexp_matches(url, '^[^#]*[?][^#]') then '?' || regexp_extract(url, '[?]([^#]*)', 1) else '' end"
_STANDARD = f"lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || {_HOST} || case when {_PORT} in ('80', '443') and ({_PORT} = '80') <> (lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) = 'http') then ':' || {_PORT} else '' end"
_ALLOWED = f"regexp_full_match(lower(regexp_extract(url, '^([A-Za-z]+)://', 1)), 'https?') and {_HOST} <> '' and {_PORT} in ('', '80', '443')"


@query("url02_search_urls", f"select url, count(*) as n from (select case when {_ALLOWED} then {_STANDARD} || {_PATH} || {_ASKED} end as url from web_fetch_exa) group by url")
def _(s, d):
    return read_table(s, d, "web_fetch_exa").select(urls.search_url("url").alias("url")).groupBy("url").agg(F.count(F.lit(1)).alias("n"))


@query("url03_state_urls", f"select fact_id, case when {_ALLOWED} then {_STANDARD} || {_PATH} || {_ASKED} end as url from (select fact_id, evidence_url as url from fact_item)")
def _(s, d):
    return read_table(s, d, "fact_item").select("fact_id", urls.state_url("evidence_url").alias("url"))


@query("url07_shared_hosts", "select distinct h as host, " + " or ".join(f"h = '{x}' or ends_with(h, '.{x}')" for x in urls.SHARED_HOSTS) + " or regexp_full_match(h, '[0-9.]+') as shared from (select lower(source) as h from documents where source is not null)")
def _(s, d):
    return read_table(s, d, "documents").where("source is not null").select(F.lower("source").alias("host")).distinct().select("host", urls.is_shared_host("host").alias("shared"))


@query("url01_public_urls", f"select fetch_id, case when regexp_full_match(lower(regexp_extract(url, '^([A-Za-z]+)://', 1)), 'https?') and {_HOST} <> '' then {_STANDARD} || {_PATH} || {_ASKED} || {_FRAGMENT} end as url from web_fetch_exa")
def _(s, d):
    return read_table(s, d, "web_fetch_exa").select("fetch_id", urls.public_url("url").alias("url"))


@query("url04_standard_ports", "select fetch_id, regexp_extract(url, '://[^/?#:]*:?(\\d*)', 1) in ('', '80', '443') as standard from web_fetch_exa")
def _(s, d):
    return read_table(s, d, "web_fetch_exa").select("fetch_id", urls.standard_port("url").alias("standard"))


@query("url05_hosts", "select regexp_extract(lower(url), '://([^/?#:]*)', 1) as host, count(*) as n from web_fetch_exa group by 1")
def _(s, d):
    return read_table(s, d, "web_fetch_exa").groupBy(urls.host("url").alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query("url06_registrable", "select distinct source, case when len(string_split(source, '.')) < 2 then '' else string_split(source, '.')[-2] end as label from documents where source is not null")
def _(s, d):
    return read_table(s, d, "documents").where("source is not null").select("source").distinct().select("source", urls.registrable_label("source").alias("label"))


@query("url09_pdf_pages", "select fetch_id from web_fetch_exa where ends_with(lower(regexp_replace(url, '[?#].*$', '')), '.pdf')")
def _(s, d):
    return read_table(s, d, "web_fetch_exa").where(urls.is_pdf("url")).select("fetch_id")


@query("url10_mirror_domains", "select array_to_string(string_split(h, '.')[-2:], '.') as domain, count(*) as n from (select regexp_extract(lower(url), '://([^/?#:]*)', 1) as h from web_fetch_exa) group by 1")
def _(s, d):
    hosts = read_table(s, d, "web_fetch_exa").select(urls.host("url").alias("h"))
    return hosts.groupBy(urls.last_two_labels("h").alias("domain")).agg(F.count(F.lit(1)).alias("n"))


@query("dt01_utc_text", "select row_id, strftime(updated_at at time zone 'UTC', '%Y-%m-%dT%H:%M:%S.%fZ') as text from products")
def _(s, d):
    return read_table(s, d, "products").select("row_id", canonical.utc_text("updated_at").alias("text"))


@query("dt02_next_month", "select o_orderkey, (date_trunc('month', o_orderdate) + interval 1 month)::date as next_month from orders")
def _(s, d):
    return read_table(s, d, "orders").select("o_orderkey", scalars.next_month_start("o_orderdate").alias("next_month"))


@query("dt03_windows", "select date_trunc('month', ts) as month, date_trunc('day', ts) as day, count(*) as n from events group by all")
def _(s, d):
    e = read_table(s, d, "events")
    t = e.schema["ts"].dataType
    return e.groupBy(F.date_trunc("month", "ts").cast(t).alias("month"), F.date_trunc("day", "ts").cast(t).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("dt05_display_dates", "select distinct generation, regexp_extract(source_updated_at, '^(\\d{4}-\\d{2}-\\d{2})', 1) as day from product_catalogue_snapshot where source_updated_at is not null")
def _(s, d):
    return read_table(s, d, "product_catalogue_snapshot").where("source_updated_at is not null").select("generation", scalars.iso_date("source_updated_at").alias("day")).distinct()


@query("mth02_backoff_days", "select distinct l_linenumber as failures, [30, 90, 180][least(l_linenumber, 3)] as days from lineitem")
def _(s, d):
    return read_table(s, d, "lineitem").select(F.col("l_linenumber").alias("failures")).distinct().select("failures", scalars.steps([30, 90, 180], "failures").alias("days"))


@query("mth03_finite", "select fact_id, case when isfinite(confidence) then confidence end as confidence from fact_item")
def _(s, d):
    return read_table(s, d, "fact_item").select("fact_id", scalars.finite("confidence").alias("confidence"))


@query("mth04_rank_scores", "select l_orderkey, l_linenumber, 1.0 - (l_linenumber - 1)::double / count(*) over (partition by l_orderkey) as score from lineitem")
def _(s, d):
    from pyspark.sql import Window

    rows = read_table(s, d, "lineitem")
    n = F.count(F.lit(1)).over(Window.partitionBy("l_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", scalars.rank_score((F.col("l_linenumber") - 1).cast("double"), n).alias("score"))


_APART, _JOINER = "[^\\pL\\pN]", "[._/-]"
_EXACT = f"'(?:^|[^\\pL\\pN._/-]|(?:^|{_APART}){_JOINER})' || array_to_string(string_split_regex(lower(model), '[^a-z0-9]+'), '{_APART}*') || '(?:$|[^\\pL\\pN._/-]|{_JOINER}(?:$|{_APART}))'"


@query("txt01_named_models", "with m as (select distinct product_id, upper(x) as model from (select product_id, unnest(regexp_extract_all(product_name, '[A-Za-z0-9]+(?:-[A-Za-z0-9]+)+')) as x from products where product_id is not null) where regexp_matches(x, '[A-Za-z]') and regexp_matches(x, '[0-9]') and length(x) >= 5) select distinct doc_id, model from documents join m using (product_id) where regexp_matches(lower(" + _narrowed("text") + f"), {_EXACT})")
def _(s, d):
    """Documents that name exactly a model of the product they belong to. Products with many documents are broadcast."""
    from plumbline.operators.skew import join_hot

    p = read_table(s, d, "products").where("product_id is not null").select("product_id", F.explode(identity.model_fragments("product_name")).alias("model")).distinct()
    docs = read_table(s, d, "documents").where("text is not null and product_id is not null").select("doc_id", "product_id", "text")
    weights = docs.groupBy("product_id").agg(F.count(F.lit(1)).alias("_weight"))
    models = p.groupBy("product_id").agg(F.collect_list("model").alias("_models")).join(weights, "product_id")
    each = join_hot(docs, models, "product_id", "_weight").select("doc_id", "text", F.explode("_models").alias("model"))
    return each.where(identity.names_model("text", "model")).select("doc_id", "model").distinct()


@query("txt02_model_fragments", "select row_id, array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(product_name, '[A-Za-z0-9]+(?:-[A-Za-z0-9]+)+'), lambda x: regexp_matches(x, '[A-Za-z]') and regexp_matches(x, '[0-9]') and length(x) >= 5), lambda x: upper(x)))), ',') as models from products where product_name is not null")
def _(s, d):
    return read_table(s, d, "products").where("product_name is not null").select("row_id", F.array_join(F.array_sort(identity.model_fragments("product_name")), ",").alias("models"))


@query("txt14_extract_cap", "select fetch_id, length(left(content, 30000)) as kept, sha256(content) as sha256, length(content) > 30000 as cut from web_fetch_exa where content is not null")
def _(s, d):
    rows = read_table(s, d, "web_fetch_exa").where("content is not null")
    return rows.select("fetch_id", F.length(F.left("content", F.lit(30000))).alias("kept"), F.sha2("content", 256).alias("sha256"), (F.length("content") > 30000).alias("cut"))


@query("rnd03_spec_tables", f"select product_id, '| Name | Value |\n|---|---|\n' || string_agg('| ' || n || ' | ' || v || ' |', '\n' order by n, v) as page from (select distinct product_id, {_cell('name')} as n, {_cell('value')} as v from fact_item where product_id is not null and name is not null and value is not null) group by product_id")
def _(s, d):
    """Specification tables of products as Markdown: rows sorted, escaped, repeated facts once."""
    rows = read_table(s, d, "fact_item").where("product_id is not null and name is not null and value is not null")
    cells = rows.select("product_id", F.struct(scalars.table_cell("name").alias("n"), scalars.table_cell("value").alias("v")).alias("c")).distinct()
    line = lambda c: F.concat(F.lit("| "), c["n"], F.lit(" | "), c["v"], F.lit(" |"))
    table = F.array_join(F.transform(F.array_sort(F.collect_list("c")), line), "\n")
    return cells.groupBy("product_id").agg(F.concat(F.lit("| Name | Value |\n|---|---|\n"), table).alias("page"))
