"""Queries whose rules the test tables never touch, against SQL on tables with planted cases."""

import json
import os

import duckdb
import pytest

from plumbline.plans import core_queries
from tests.test_queries import DATA, plain

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")

DECISION = {
    "outcome": "publish", "manufacturer": "Zeta", "facts": [
        {"name": "Product type", "value": "PV inverter", "evidence_urls": ["https://z.example/a"], "evidence_quotes": [{"url": "https://z.example/b", "quote": "never cited"}, {"url": "https://z.example/a", "quote": "body of a"}]},
        {"name": "Rated-Power", "value": 5, "unit": "kW"},
    ],
    "conflicts": [{"field": "rated power", "values": [1, 2], "source_urls": ["https://z.example/c"]}],
    "sources": [{"url": "https://z.example/a", "title": "A", "source_type": "mirror"}], "review_evidence_urls": ["https://z.example/q", "https://z.example/a"],
}
PLANTED = {
    "brand_registry": "select 'ZETA', 'Zeta', 'manufacturer', ['Common Name', 'Zed'], 'z.example' union all select 'ZET2', ' ', 'manufacturer', ['common name', " + ", ".join(f"'a{i}'" for i in range(25)) + "], 'Z.example' union all select 'ZET2', 'Zwei', 'manufacturer', null, 'zz.example'",
    "products": "select -1, 'Z-1', null, 'F', 'Zeta ZZZ-99K-9ZZZ unit', 'EA', null, null union all select -2, 'Z-2', 'ZETA', 'F', 'Kit for zzz-99k-9zzz', 'EA', null, null union all select -3, 'Z-3', 'common NAME', null, null, null, null, null union all select -4, 'Z-4', 'zed', null, null, null, null, null union all select -4, 'Z-4', 'zed', null, null, null, null, null",
    "fact_item": "select -1, 'Z-1', 'n', '0.50', 'W', ' PV Inverter', null, 'en', null, null, null union all select -2, 'Z-1', 'n', '00.5', 'W', 'heat pump', null, 'en', 'https://z.example/a', 'q', null union all select -3, null, null, '1.0', null, '空气源热泵', null, null, null, null, null",
    "web_fetch_exa": "select -1, 'https://z.example/a', 'body of a', null, 'text/html', 'success', null union all select -2, 'https://z.example/a', 'other body', null, 'text/html', 'success', null union all select -3, 'HTTPS://Z.example:443/a/?utm_source=x', null, null, null, 'error', null union all select -4, 'https://z.example:8443/a', 'x', null, null, 'success', null",
    "product_research_completions": f"select 'Z-1', null, null, '{json.dumps(DECISION)}', '[{{\"url\": \"https://z.example/a\"}}]', 'publish', 1, null, null, null, null",
}
NAMES = [
    "src07_registry_violations", "src11_table_digest", "set07_conflicting_bodies", "jn10_sibling_brand", "jn12_brand_domains", "jn14_quotes_outside_citations", "jn14_uncited_sources", "jn14_undeclared_reviews",
    "jn15_grounded_quotes", "jn16_facts_without_page", "prj06_categories", "rnd03_specifications", "rnd04_sources", "set05_failures", "set08_page_tags", "set09_facts_in_conflict", "snk03_published", "str09_categories", "str12_probabilities", "url03_state_urls",
]
#: What must come out besides what SQL says: at least a row of the rule.
SEEN = {
    "src07_registry_violations": lambda rows: {r.rule for r in rows} == {"duplicate_code", "duplicate_domain", "too_many_aliases", "blank_name"},
    "set07_conflicting_bodies": lambda rows: ("https://z.example/a", 2) in [(r.url, r.bodies) for r in rows],
    "jn10_sibling_brand": lambda rows: (-1, "ZETA") in [tuple(r) for r in rows],
    "jn12_brand_domains": lambda rows: {(-3, "conflict"), (-4, "alias"), (-2, "code")} <= {(r.row_id, r.via) for r in rows},
    "jn14_quotes_outside_citations": lambda rows: [tuple(r) for r in rows] == [("Z-1", 0, 0)],
    "jn14_undeclared_reviews": lambda rows: ("Z-1", "https://z.example/q") in [tuple(r) for r in rows],
    "jn15_grounded_quotes": lambda rows: ("Z-1", 0, 1) in [tuple(r) for r in rows],
    "prj06_categories": lambda rows: ("Z-1", "PV inverter") in [tuple(r) for r in rows],
    "set09_facts_in_conflict": lambda rows: ("Z-1", "ratedpower") in [tuple(r) for r in rows],
    "str09_categories": lambda rows: {"光伏逆变器", "热泵"} <= {r.broad for r in rows},
    "str12_probabilities": lambda rows: {r.fact_id: r.p for r in rows if r.fact_id < 0} == {-1: 0.5, -2: None, -3: 1.0},
}


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    folder = tmp_path_factory.mktemp("planted")
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for name in [*PLANTED, "product_catalogue_snapshot"]:
        extra = f" union all {PLANTED[name]}" if name in PLANTED else ""
        con.sql(f"copy (select * from '{DATA}/{name}.parquet'{extra}) to '{folder}/{name}.parquet' (format parquet)")
        con.sql(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con, str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_planted_cases(spark, planted, name):
    con, folder = planted
    rows = core_queries.QUERIES[name](spark, folder).collect()
    q = con.execute(core_queries.ORACLES[name])
    names = [c[0] for c in q.description]
    assert sorted(tuple(plain(r[c]) for c in names) for r in rows) == sorted(tuple(map(plain, x)) for x in q.fetchall())
    assert rows and SEEN.get(name, bool)(rows)
