import random

import pytest

from tidemark.llm import decontaminate as dc
from tidemark.llm import rolling


def naive_tiles(item, doc, least):
    """Greedy string tiling by trying every pair of places, longest first."""
    used_i, used_d, marked = set(), set(), 0
    while True:
        best = None
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and i + n not in used_i and j + n not in used_d:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, i, j)
        if best is None:
            return marked / len(item)
        n, i, j = best
        used_i.update(range(i, i + n))
        used_d.update(range(j, j + n))
        marked += n


def tokens(text):
    return dc.normal(text).split()


def expected(docs, items, least, share):
    """{doc_id: (contaminated, n_items, best item)}"""
    out = {}
    for d, text in docs:
        w = tokens(text or "")
        own = {tuple(w[i : i + least]) for i in range(len(w) - least + 1)}
        found = []
        for i, item in items:
            t = tokens(item or "")
            if any(tuple(t[p : p + least]) in own for p in range(len(t) - least + 1)):
                c = naive_tiles(t, w, least)
                if c >= share:
                    found.append((-c, i))
        out[d] = (bool(found), len(found), min(found)[1] if found else None)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_tiling_equals_naive(seed):
    rng = random.Random(seed)
    for _ in range(30):
        item = [rng.choice("abcde").encode() for _ in range(rng.randint(1, 20))]
        doc = [rng.choice("abcdef").encode() for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.7:
            at = rng.randint(0, len(item))
            doc += item[at:] + [b"x"] + item[:at]
        hashed = [rolling.word_items([b" ".join(x)])[0] for x in (item, doc)]
        assert dc.coverage(*hashed, 3) == pytest.approx(naive_tiles(item, doc, 3))


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, k int"),
            spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, h string"))


def test_edge_cases(spark):
    a = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my"
    w = a.split()
    docs = [(1, a), (2, None), (3, ""), (4, " ".join(w[6:] + ["and"] + w[:6])), (5, a.upper().replace(" ", ", ")), (6, " ".join(w[:5])),
            (7, "x " * 3000 + a + " y" * 3000), (8, "alpha beta gamma"), (None, a), (1, a), (9, " ".join(reversed(w)))]
    items = [(0, a), (1, None), (2, ""), (3, "alpha beta gamma"), (0, a), (4, a + " one two")]
    got = dc.decontaminate(*frames(spark, docs, items)).collect()
    assert len(got) == len(docs)
    assert {r.doc_id for r in got if r.contaminated} == {1, 4, 5, 7, None}
    assert all(r.item_id == 0 and r.n_items == 2 for r in got if r.contaminated)
    kept = dc.clean_rows(*frames(spark, docs, items))
    assert kept.columns == ["doc_id", "text", "item_id", "k"]
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 6, 8, 9]


def test_empty_tables(spark):
    docs, items = frames(spark, [], [])
    assert dc.decontaminate(docs, items).collect() == []
    docs, _ = frames(spark, [(1, "a b c d e f g h")], [])
    assert [tuple(r) for r in dc.decontaminate(docs, items).collect()] == [(1, False, 0, None, 0.0)]


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_id) for r in dc.decontaminate(docs, items).collect()}
    want = expected([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], dc.LEAST, dc.COVERAGE)
    assert got == want


def test_scripts_without_blanks(spark):
    item = "今天天气很好，我们去公园散步。"
    docs = [(1, "前言" + item + "后记"), (2, "今天我们不去"), (3, "วันนี้อากาศดีมากเราไปเดินเล่น"), (4, "ก่อน วันนี้อากาศดีมากเราไปเดินเล่น หลัง"), (5, "plain words only")]
    items = [(0, item), (1, "วันนี้อากาศดีมากเราไปเดินเล่น")]
    got = {r.doc_id: r.item_id for r in dc.decontaminate(*frames(spark, docs, items)).collect() if r.contaminated}
    assert got == {1: 0, 3: 1, 4: 1}
    assert dc.normal("Día, x") == "día  x".encode()
