import json
from datetime import datetime

from pyspark.sql import functions as F

from plumbline.llm import registry_match as rm

REGISTRY = [("HLVR", "Heliovar", ["Brightquay Energy", "辰曦澜光"]), ("SLVN", "Solvanta", []), ("SLVT", "Solventra", None), ("NRDL", "Nordlumen", []), ("NRDX", "Nordluxen", []), ("OSTR", "Ostrafield", []), ("TRML", "Tramontel", ["Tramontel Sistemi"]), ("ENBR", "Brizasol", ["Energías Briza"])]
SCHEMA = "brand_code string, manufacturer string, alias_list array<string>"

MATCHES = {
    "heliovar": "HLVR", "HELIOVAR GmbH & Co. KG": "HLVR", "Fa. Heliovar": "HLVR", "[HLVR] Heliovar": "HLVR", "Heliovar/HLVR": "HLVR", "H E L I O V A R": "HLVR", "Ηеliоvаr": "HLVR", "Ｈｅｌｉｏｖａｒ": "HLVR",
    "brightquay energy": "HLVR", "Brightquay Energy Ltd": "HLVR", "辰曦澜光": "HLVR", "Heliovar (formerly Brightquay Energy)": "HLVR", "He1ibvar Co., Ltd.": "HLVR", "Helivoar": "HLVR", "hlvr": "HLVR", "H.L.V.R.": "HLVR", "HLVR-": "HLVR", "HL VR": "HLVR",
    "Solvata": "SLVN", "Slventra": "SLVT", "SolventraSolar": "SLVT", "Solar Solventra AG": "SLVT", "Nordl-uxen": "NRDX", "by Nordlumen": "NRDL", "OSTRAIFELD": "OSTR", "OSHTR": "OSTR", "N​RDX": "NRDX", "tramontel sistemi": "TRML", "Energias Briza": "ENBR", "Sol​vanta Deutschland GmbH": "SLVN",
}
NOTHING = ["Solar Systems GmbH", "New Energy Technology Co., Ltd.", "generic", "--", "???", "n.d.", "OEM", "Holtoby", "Fratelli Opamakiby", "x" * 3000, "Nordluen"]


def match(spark, values):
    df = spark.createDataFrame([(v, 1) for v in values], "value string, n long")
    return {r.value: r.brand_code for r in rm.match_values(df, spark.createDataFrame(REGISTRY, SCHEMA)).collect()}


def test_matches_and_reports(spark):
    got = match(spark, [*MATCHES, *NOTHING])
    assert {v: got[v] for v in MATCHES} == MATCHES
    assert {v: got[v] for v in NOTHING} == dict.fromkeys(NOTHING, "-")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_pigeonhole_misses_nothing_against_brute_force(spark):
    import random

    rng = random.Random(5)
    names = {n.lower(): (c, 2) for c, n, _ in REGISTRY} | {c.lower(): (c, 1) for c, _, _ in REGISTRY}
    values = set()
    for _ in range(400):
        word = list(rng.choice(list(names)))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                word.insert(at, rng.choice("qwertz"))
            elif word and at < len(word):
                word[at : at + 1] = [] if kind == 1 else [rng.choice("qwertz")]
        if len(word) >= 3:
            values.add("".join(word))
    got = match(spark, sorted(values))
    for v in values:
        near = sorted((distance(v, n), c) for n, (c, k) in names.items() if distance(v, n) <= k)
        best = {c for d, c in near if d == near[0][0]}
        assert got[v] == (best.pop() if len(best) == 1 else "-"), (v, near)


def test_records(spark):
    t = datetime(2026, 1, 1)
    products = spark.createDataFrame([(1, "HLVR"), (2, "Heliovar"), (3, " "), (4, None), (5, "heliovar"), (6, "tbd"), (7, "heliovar"), (8, "​ ")], "row_id bigint, brand_code string").withColumn("value", F.lit("clash")).withColumn("n", F.lit(1))
    d = lambda m: json.dumps({"manufacturer": m})
    completions = spark.createDataFrame([("A", t, d("slvn")), ("A", t, d("slvn")), ("B", t, json.dumps(d("Solvanta®"))), ("C", t, "{"), ("D", t, None), ("E", t, d(None)), ("F", t, d("Solvanta")), ("G", t, d("zzz"))], "product_id string, completed_at timestamp, decision_json string")
    got = sorted((r.src_field, r.record_key, r.brand_code) for r in rm.matched_records(products, completions, spark.createDataFrame(REGISTRY, SCHEMA)).collect())
    m = "decision_json.manufacturer"
    assert got == [(m, "A", "SLVN"), (m, "B", "SLVN"), (m, "G", "-"), ("products.brand_code", "5", "HLVR"), ("products.brand_code", "6", "-"), ("products.brand_code", "7", "HLVR")]
    assert rm.matched_records(products.limit(0), completions.limit(0), spark.createDataFrame(REGISTRY, SCHEMA)).count() == 0


def test_long_names_and_other_scripts_tolerate_edits(spark):
    long = "".join(chr(97 + (i * 7) % 26) for i in range(100))
    registry = spark.createDataFrame([("LONG", long, ["辰曦澜光新能"]), ("HAN4", "Other", ["光禅新材"]), ("KYR", "Заря Юга", None)], SCHEMA)
    typed = {long[:20] + "x" + long[20:70] + long[71:]: "LONG", "辰曦澜光新材": "LONG", "光禅新村": "HAN4", "Заря Юго": "KYR", "光村新": "-"}
    df = spark.createDataFrame([(v, 1) for v in typed], "value string, n long")
    assert {r.value: r.brand_code for r in rm.match_values(df, registry).collect()} == typed


def test_words_around_a_name_are_a_parameter(spark):
    df = spark.createDataFrame([("Heliovar Oyj", 1), ("heliovarwind", 1)], "value string, n long")
    registry = spark.createDataFrame(REGISTRY, SCHEMA)
    assert {r.brand_code for r in rm.match_values(df, registry).collect()} == {"-"}
    assert {r.brand_code for r in rm.match_values(df, registry, affixes="oyj", glued=("wind",)).collect()} == {"HLVR"}
