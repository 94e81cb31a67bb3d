import random
import re

import numpy as np
import pytest

from tidemark.llm import jaccard_join as jj
from tidemark.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows):
    """[(doc_id, n, component)] by comparing all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * len(s | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, s string, n int, key string")
    return sorted((tuple(r) for r in jj.jaccard_components(docs, **options).collect()), key=repr)


def variants(seed, bases, copies, length, rate):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(bases):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(*length))]
        for _ in range(rng.randint(*copies)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, int(rate * len(w))))):
                at = rng.randrange(len(w))
                w[at] = f"x{rng.randint(0, 99)}" if rng.random() < 0.6 else w[at].upper()
            rows.append((i, " ".join(w)))
            i += 1
    return rows


@pytest.mark.parametrize("seed, bases, copies, length, rate", [
    (1, 12, (1, 9), (3, 40), 0.04), (2, 4, (30, 60), (30, 120), 0.03), (3, 2, (60, 120), (100, 160), 0.05)])
def test_equals_brute_force(spark, monkeypatch, seed, bases, copies, length, rate):
    monkeypatch.setattr(jj.ball_links, "__defaults__", (16,))
    monkeypatch.setattr(jj.remaining_pairs, "__defaults__", (16,))
    rows = variants(seed, bases, copies, length, rate)
    assert run(spark, rows) == expected(rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (None, "one two"), (7, "z " * 4000), (8, "z " * 5),
            (9, "É é a b c d"), (10, "é é a b c d"), (11, " ".join(map(str, range(300)))), (11, " ".join(map(str, range(300)))), (3, "one two"), (None, "alone here")]
    assert run(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in jj.jaccard_components(docs).collect()), key=repr) == expected(rows)


@pytest.mark.parametrize("n2, k2", [(2, 1), (3, 1), (4, 2)])
def test_linked_sets_share_a_signature(n2, k2):
    rng = np.random.default_rng(3)
    for size in [*range(4, 40), 63, 64, 65, 100, 127, 128, 200, 500]:
        for _ in range(12):
            pool = rng.integers(0, 1 << 63, size * 2, dtype=np.uint64)
            a = np.unique(pool[:size])
            drop = rng.integers(0, size // 4 + 1)
            b = np.unique(np.concatenate([a[drop:], pool[size : size + rng.integers(0, size // 4 + 1)]]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both) and len(a) >= 4 <= len(b):
                assert len(np.intersect1d(jj.signatures(a, n2, k2), jj.signatures(b, n2, k2))), (size, len(b))


def test_components_of_a_long_chain(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 90), (90, 95), (7, 7)], "a long, b long")
    got = dict(components(spark, links).collect())
    assert got == {**{i: 0 for i in range(n + 1)}, 90: 90, 95: 90, 100: 90}
