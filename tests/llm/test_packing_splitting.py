import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import packing, splitting, tokens


def test_counts_equal_the_tokenizer():
    c = tokens.counter()
    for text in ("", " ", "a", "  two  spaces ", "line\n\n  next\t\tx\r\n", "it's 12.5 kW, ok?", "中文没有空格。" * 30, "x" * 3000, "\x1c\x85  　a", "<|endoftext|>", "👍🏽 ok", "a b"):
        assert c.count(text) == len(c.encoding.encode_ordinary(text)), text


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_counts_equal_the_tokenizer_on_any_text(text):
    c = tokens.counter()
    assert c.count(text) == len(c.encoding.encode_ordinary(text))


def test_bins_hold_their_promises():
    rng = random.Random(1)
    sizes = [rng.randint(1, 2048) for _ in range(5000)]
    bins, closed = packing.OpenBins(2048, 64), []
    for i, s in enumerate(sizes):
        closed += bins.put((i, s), s)
        assert bins.n <= 64
    closed += bins.rest()
    assert sorted(i for b in closed for i, _ in b) == list(range(5000))
    assert all(sum(s for _, s in b) <= 2048 for b in closed)
    assert sum(sizes) / 2048 / len(closed) > 0.93


def test_fullest_bin_closes_first():
    bins = packing.OpenBins(10, 2)
    assert bins.put("a", 6) == [] and bins.put("b", 8) == []
    assert bins.put("c", 7) == [["b"]]
    assert bins.put("d", 4) == [["a", "d"]]


def test_pack_documents(spark):
    rows = [(1, "word " * 100), (2, None), (3, ""), (4, "many words here " * 2000), (5, "x"), (5, "x"), (6, "中" * 3000)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id bigint, text string, n_tokens int")
    got = packing.pack_documents(df).collect()
    c = tokens.counter()
    per = {}
    for r in got:
        per.setdefault(r.doc_id, []).append((r.piece_no, r.token_start, r.n_tokens))
    assert set(per) == {1, 4, 5, 6} and len(per[5]) == 2
    for i, t in rows:
        if i in (1, 4, 6):
            pieces = sorted(per[i])
            assert sum(n for _, _, n in pieces) == c.count(t)
            assert [s for _, s, _ in pieces] == [2048 * k for k in range(len(pieces))] and (len(pieces) == 1) == (c.count(t) <= 2048)
    used = {}
    for r in got:
        used[r.container_id] = used.get(r.container_id, 0) + r.n_tokens
    assert all(r.container_tokens == used[r.container_id] <= 2048 for r in got)
    assert packing.pack_documents(df.limit(0)).count() == 0


TEXTS = [
    "A sentence of some words. Another one follows, with a clause; and more.\n\nA paragraph then.\n" * 60,
    "no boundary but words " * 400,
    "中文句子没有空格。另一句，有逗号。" * 200,
    "x" * 9000,
    "abc123" * 1500 + "\n" + "é" * 4000,
    "👍" * 900,
    "short",
    "",
]


@pytest.mark.parametrize("limit,overlap", [(512, 64), (100, 0), (64, 60)])
def test_pieces(limit, overlap):
    c = tokens.counter()
    for text in TEXTS:
        got = splitting.split_text(text, limit, overlap, c)
        if c.count(text) <= limit:
            assert got is None
            continue
        assert "".join(text[p[3] : p[2]] for p in got) == text
        for n, start, end, core, size, over, _, piece in got:
            assert piece == text[start:end] and size <= limit and over <= overlap and start <= core
            assert c.count(piece) <= limit, (text[:20], n)
            assert n == got.index((n, start, end, core, size, over, _, piece))
        assert all(p[5] > 0 for p in got[1:]) or overlap == 0


def test_natural_boundaries_are_used():
    c = tokens.counter()
    ends = {p[6] for p in splitting.split_text(TEXTS[0], 512, 64, c)}
    assert ends <= {"paragraph", "end"}
    assert {p[6] for p in splitting.split_text(TEXTS[1], 512, 64, c)} <= {"word", "end"}
    assert {p[6] for p in splitting.split_text(TEXTS[2], 512, 64, c)} <= {"sentence", "end"}


def test_split_documents(spark):
    df = spark.createDataFrame([(i, t, "p", 1) for i, t in enumerate([*TEXTS, None, TEXTS[0]])], "doc_id bigint, text string, piece string, piece_no int")
    got = {}
    for r in splitting.split_documents(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == {0, 1, 2, 3, 4, 5, 9}
    for i, rows in got.items():
        rows.sort(key=lambda r: r.piece_no)
        text = ([*TEXTS, None, TEXTS[0]])[i]
        assert "".join(text[r.core_start : r.char_end] for r in rows) == text
    with pytest.raises(ValueError):
        splitting.split_documents(df, 64, 64)


def test_containers_do_not_depend_on_adaptive_execution(spark):
    df = spark.createDataFrame([(i, "word " * (i % 400 + 1)) for i in range(300)], "doc_id bigint, text string")
    rows = lambda: sorted(tuple(r) for r in packing.pack_documents(df, parts=3).collect())
    first = rows()
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    assert rows() == first and len({r[0] >> 36 for r in first}) == 3
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_limits_below_the_size_of_a_run(spark):
    df = spark.createDataFrame([(1, "0123456789" * 12 + " a b")], "doc_id bigint, text string")
    rows = splitting.split_documents(df, limit=6, overlap=0).orderBy("piece_no").collect()
    assert all(r.n_tokens <= 6 for r in rows) and "".join(r.piece for r in rows) == "0123456789" * 12 + " a b"
