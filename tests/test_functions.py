import json

from pyspark.sql import functions as F

from plumbline.functions import canonical, identity, scalars, urls


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("r")).collect()[0].r


def each(spark, column, values):
    """The results of a column over ``u``, in the order of the values."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, u string").select("i", column.alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.i)]


def test_dedupe_key(spark):
    key = lambda u: one(spark, urls.dedupe_key("u"), u=u)
    assert key("HTTPS://WWW.A.example/P/?utm_source=x&b=2&a=1&ref=q#f") == "https://www.a.example/p?a=1&b=2"
    assert key("http://a.example") == "http://a.example/"
    assert key("ftp://a.example/") is None and key("") is None
    assert one(spark, urls.dedupe_key(F.lit(None).cast("string"))) is None


def test_three_forms_of_urls(spark):
    given = ["http://h:8080/x", "https://h:443/a%20b/?q=a+b&q=%C3%BC&z#f", "http://h:443/x", "http://u:p@h/x", "http://H./", "https://h/p?", "https://h/?UTM_x=1&b=*~&Ref=2", "h/x", "http://[2001:db8::1]:80/", None, ""]
    assert each(spark, urls.search_url("u"), given) == [None, "https://h/a%20b/?q=a+b&q=%C3%BC&z=", "http://h:443/x", None, "http://h/", "https://h/p", "https://h/?UTM_x=1&b=%2A~&Ref=2", None, "http://[2001:db8::1]/", None, None]
    assert each(spark, urls.dedupe_key("u"), given) == [None, "https://h/a%20b?q=a+b&q=%c3%bc&z=", "http://h:443/x", None, "http://h/", "https://h/p", "https://h/?b=%2a~", None, "http://[2001:db8::1]/", None, None]
    assert each(spark, urls.state_url("u"), given) == [None, "https://h/a%20b/?q=a+b&q=%C3%BC&z", "http://h:443/x", None, "http://h/", "https://h/p", "https://h/?UTM_x=1&b=*~&Ref=2", None, "http://[2001:db8::1]/", None, None]


def test_public_url(spark):
    good = {
        "HTTP://Exämple.com:80/a b?x=(1)#f": "http://xn--exmple-cua.com/a%20b?x=%281%29#f",
        "https://a.example:8443/x": "https://a.example:8443/x",
        " https://A.example ": "https://a.example/",
        "http://8.8.8.8/": "http://8.8.8.8/",
        "https://[2606:4700:4700::1111]:443/": "https://[2606:4700:4700::1111]/",
        "https://a.example./%zz?#": "https://a.example/%zz",
    }
    assert each(spark, urls.public_url("u"), list(good)) == list(good.values())
    bad = [None, "", "ftp://a.b/", "http://u:p@a.b/", "http://localhost/", "http://x.local/", "http://10.0.0.1/", "http://127.1/", "http://0x7f000001/", "http://[::1]/", "http://a_b.c/", "http://a.b:99999/", "http://a\nb/", "http://-a.b/", "http://a..b/", "http://a.b:0/", "//a.b/"]
    assert each(spark, urls.public_url("u"), bad) == [None] * len(bad)


def test_shared_hosts(spark):
    assert each(spark, urls.is_shared_host("u"), ["acme.github.io", "github.io", "github.com", "x.com", "xx.com", "10.0.0.1", "::1", "DOCS.google.com.", "", None]) == [True, True, False, True, False, True, True, True, False, False]
    assert each(spark, urls.registrable_label("u"), ["acme.github.io", "www.acme.com", "10.0.0.1"]) == ["", "acme", ""]


def test_hosts(spark):
    assert one(spark, urls.parent_domains("h"), h="a.b.c") == ["a.b.c", "b.c", "c"]
    assert one(spark, urls.registrable_label("h"), h="x.acme.co.uk") == "acme"
    assert one(spark, urls.registrable_label("h"), h="www.acme.com") == "acme"
    assert one(spark, urls.registrable_label("h"), h="localhost") == ""
    assert one(spark, urls.last_two_labels("h"), h="x.acme.co.uk") == "co.uk"


def test_exact_identity(spark):
    names = lambda t: one(spark, identity.names_model("t", "m"), t=t, m="PV-42")
    assert [names(t) for t in ("PV-42 rated power 42 W", "XPV-42", "PV-42A", "PV-42/B", "pv 42 ok", "")] == [True, False, False, False, True, False]
    assert one(spark, identity.names_model("t", "m"), t="a", m="--") is False
    cases = [("ＰＶ－42 ok", "PV-42", True), ("typ straße 5x", "STRASSE 5X", True), ("pv42", "PV-42", True), ("p v42", "PV-42", False), ("PV - 42.", "PV-42", True), ("PV-42.B", "PV-42", False), ("PV-42. B", "PV-42", True), ("a-PV-42", "PV-42", False), ("PV 42 / 7", "PV-42", True), (None, "x", False), ("x", None, False), ("PV-421 PV-42", "PV-42", True)]
    df = spark.createDataFrame([(i, t, m) for i, (t, m, _) in enumerate(cases)], "i int, t string, m string").select("i", identity.names_model("t", "m").alias("r"))
    assert {r.i: r.r for r in df.collect()} == {i: want for i, (_, _, want) in enumerate(cases)}


def test_identity_keys(spark):
    for text in ("Straße Ⅳ-x", "ABC-12", "", "ﬁ"):
        assert one(spark, identity.identity_key_column("t"), t=text) == identity.identity_key(text)
    assert identity.identity_key("Ｘ1", compatibility=False) != identity.identity_key("Ｘ1")


def test_slugs_and_paths():
    assert identity.slug("A+B  ß") == "a-b-ss"
    assert identity.slug("--") is None and identity.slug(None) is None
    assert len(identity.slug("x" * 500)) == 96
    assert identity.stable_path("A+B") != identity.stable_path("A/B")


def test_canonical_json_matches_python(spark):
    text = 'q"\\u001F/\\\x1f\x0b\t\x7f é 中\\\\u001A'
    got = one(spark, canonical.canonical_json({"b": F.col("t"), "a": F.lit(None).cast("string")}), t=text)
    assert got == json.dumps({"a": None, "b": text}, ensure_ascii=False, separators=(",", ":"))


def test_receipts(spark):
    key = b"k" * 32
    good = canonical.sign(key, "http://a/", "body")
    rows = [("http://a/", "body", good), ("http://a/", "Body", good), ("http://b/", "body", good), ("http://a/", "body", None), (None, None, good), ("http://a/", "body", good[:-2])]
    df = spark.createDataFrame(rows, "url string, content string, receipt string")
    got = df.select(canonical.verify_udf(key)("url", "content", "receipt").alias("ok"), canonical.receipt_state("receipt").alias("s")).collect()
    assert [r.ok for r in got] == [True, False, False, False, False, False]
    assert [r.s for r in got] == ["well_formed", "well_formed", "well_formed", "missing", "well_formed", "malformed"]


def test_scalars(spark):
    assert one(spark, scalars.one_line("t"), t=" a \n b ") == "a b"
    assert one(spark, scalars.clean_term("t"), t='a\x01"b"') == "a b"
    assert one(spark, scalars.table_cell("t"), t="<a>|\\") == "&lt;a&gt;\\|\\\\"
    assert [one(spark, scalars.probability("t"), t=t) for t in ("0.5", "1", "1.1", "x", "-0", "", "00.5", "01", "1.00")] == [0.5, 1.0, None, None, None, None, None, None, 1.0]
    assert one(spark, scalars.broad_category("t"), t=" PV  inverter") == "光伏逆变器"
    assert [one(spark, scalars.steps([30, 90, 180], "n"), n=n) for n in (0, 1, 2, 3, 99)] == [None, 30, 90, 180, 180]
    assert [one(spark, scalars.retry_after("t", 60.0), t=t) for t in ("5", "-1", "1e9", "NaN", "soon")] == [5.0, 0.0, 60.0, None, None]
    assert one(spark, scalars.close(F.lit(1.0), F.lit(1.0 + 1e-13))) is True
    now = F.lit("1994-11-06 08:49:00").cast("timestamp")
    assert each(spark, scalars.retry_after("u", 60.0, now), ["Sun, 06 Nov 1994 08:49:37 GMT", "Sun, 06 Nov 1994 08:00:00 GMT", "Mon, 07 Nov 1994 08:00:00 GMT", "06 Nov"]) == [37.0, 0.0, 60.0, None]
    assert [str(x) for x in each(spark, scalars.operator_time("u"), ["2026-01-02T03:04:05Z", "2026-01-02T05:04:05+02:00", "2026-01-02T03:04:05", "soon", None])] == ["2026-01-02 03:04:05", "2026-01-02 03:04:05", "None", "None", "None"]


def test_search_queries(spark):
    df = spark.createDataFrame([(1, "Acme", ["PV-42"], "Panel"), (2, "Acme", ["PV-42", "pv-43"], "acme"), (3, None, ["PV-42"], None), (4, "Acme", [], "x"), (5, "A" * 500, ["PV-42"], "x")], "i int, m string, ms array<string>, c string")
    got = {r.i: r.q for r in df.select("i", scalars.search_queries(F.col("m"), F.col("ms"), F.col("c")).alias("q")).collect()}
    assert got[1] == ['"Acme" "PV-42" official datasheet PDF', '"Acme" "PV-42" official specifications technical manual', '"Acme" "PV-42" "Panel" manufacturer product family official']
    assert got[2] == ['"Acme" "PV-42" official datasheet PDF', '"pv-43" filetype:pdf', '"Acme" "PV-42" official specifications technical manual']
    assert got[3][0] == '"PV-42" official datasheet PDF' and got[4] is None
    assert [len(q) for q in got[5]] == [400]  # cut to the same text, they are one query


def test_valid_queries(spark):
    rows = [(["a", "b"], True), (["a", "A"], False), ([], False), (["a"] * 4, False), (["a\x01"], False), ([" "], False), (["x" * 401], False), ([None], False), (None, False)]
    df = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(rows)], "i int, q array<string>")
    assert {r.i: r.ok for r in df.select("i", scalars.valid_queries(F.col("q")).alias("ok")).collect()} == {i: ok for i, (_, ok) in enumerate(rows)}


def test_links(spark):
    df = spark.createDataFrame([(1, "a[b]", "/x y/ü~*/"), (2, "", "p"), (3, "l", "a/../b"), (4, "l", ""), (5, "l", "a//b"), (6, "l", None)], "i int, l string, p string")
    got = {r.i: r.r for r in df.select("i", scalars.internal_link(F.col("l"), F.col("p")).alias("r")).collect()}
    assert got == {1: "[a\\[b\\]](/x%20y/%C3%BC~%2A)", 2: "[查看](/p)", 3: None, 4: None, 5: None, 6: None}
