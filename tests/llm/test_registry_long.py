from plumbline.llm import registry_match as rm


def test_misspelt_value_of_a_long_name(spark):
    name = "Lichtbogenwechselrichtermanufakturundphotovoltaikdachanlagenbetreiberverbund"
    assert len(name) > 66
    registry = spark.createDataFrame([("LBW", name, None)], "brand_code string, manufacturer string, alias_list array<string>")
    values = spark.createDataFrame([(name.replace("dach", "dahc"), 2), ("x" * 5000, 1)], "value string, n bigint")
    got = {r.value[:5]: (r.brand_code, r.distance) for r in rm.match_values(values, registry).collect()}
    assert got == {"Licht": ("LBW", 2), "xxxxx": ("-", None)}
