import random

from plumbline.llm import leaks

WORDS = [f"w{i}" for i in range(40)] + ["the", "of", "a", "and"]


def brute(docs, items, run=13):
    grams = {}
    for i, t in items:
        w = leaks.words(t or "")
        for k in range(len(w) - run + 1):
            grams.setdefault(tuple(w[k : k + run]), set()).add(i)
    out = set()
    for d, t in docs:
        w = leaks.words(t or "")
        for k in range(len(w) - run + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + run]), ())}
    return out


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id bigint, text string, item_id int")
    e = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(r.doc_id, r.item_id) for r in leaks.leaked_items(d, e, **kw).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(i, text(rng.randint(5, 60))) for i in range(60)] + [(100, "the of a and " * 10), (101, "short item")]
    docs = []
    for d in range(300):
        parts = [text(rng.randint(0, 50))]
        if d % 3:
            w = rng.choice(items)[1].split()
            k = rng.randrange(max(1, len(w) - 10))
            parts += [" ".join(w[k : k + rng.choice([12, 13, 14, 30])]), text(20)]
        docs.append((d, " ".join(parts)))
    want = brute(docs, items)
    assert want and found(spark, docs, items) == want
    assert found(spark, docs, items, block_chars=400) == want


def test_look_case_and_line_breaks_do_not_count(spark):
    item = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    odd = "x " + item.upper().replace(" ", ",\n").replace("O", "О").replace("EIGHT", "EI​GHT") + " y"
    twelve = " ".join(item.split()[:12])
    assert found(spark, [(1, odd), (2, twelve), (3, item.replace("seven", "x"))], [(9, item), (9, item)]) == {(1, 9)}


def test_nulls_empty_long(spark):
    item = " ".join(f"k{i}" for i in range(20))
    docs = [(1, None), (2, ""), (3, "z " * 200_000 + item), (None, item)]
    assert found(spark, docs, [(1, None), (2, ""), (3, item), (None, item)]) == {(3, 3), (None, 3)}
    assert found(spark, docs[:3], []) == set()
    assert found(spark, [], [(3, item)]) == set()


def test_thresholds_are_reached_by_every_run():
    rng = random.Random(4)
    index = leaks.Index([(i, " ".join(rng.choice(WORDS) for _ in range(40))) for i in range(50)])
    for d, grams in enumerate(index.runs):
        for g in list(grams)[:5]:
            assert d in index.search(set(g))
