import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences

from tidemark.llm import spelling
from tidemark.llm.queries import ORACLES, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def frame_of(spark, docs):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int")


@pytest.mark.parametrize("block", [4, 60, 16_384])
@pytest.mark.parametrize("letters, sizes", [("ab", (5, 8)), ("abcé", (5, 6)), ("stu", (4, 12))])
def test_equals_brute_force(spark, block, letters, sizes):
    rng = random.Random(block + len(letters))
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(150)]
    vocabulary += [w[:i] + w[i + 1 :] for w in vocabulary[:40] for i in (0, len(w) // 2, len(w) - 1)]
    vocabulary += ["aaaaaa" + "".join(rng.choice("bcde") for _ in range(4)) for _ in range(60)]  # one half for all
    docs = [(i, " ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(len(vocabulary))], k=120))) for i in range(30)]
    got = spelling.variants(frame_of(spark, docs), block=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(docs)


def test_letters_nulls_ties_and_chains(spark):
    docs = [(1, None), (2, ""), (None, "Größe größe GRÖßE grösse×÷ " * 9), (3, "x" * 30_000 + " " + "y" * 29_999 + "z " * 9), (4, "1234 ab-cd ab_cd")]
    docs += [(5, "aaaaa " * 3 + "aaaab " * 6 + "aaaac " * 6 + "aaaabb " * 12 + "aaaabbb " * 30)] * 2
    docs += [(6, ("w" * 40_000 + " ") * 3 + ("w" * 40_001 + " ") * 7)]
    got = spelling.variants(frame_of(spark, docs)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(docs)
    assert any(r["root"] != r["form"] and r["form"] for r in got)
    assert spelling.variants(frame_of(spark, docs).limit(0)).count() == 0
    assert spelling.variants(frame_of(spark, [(1, None), (2, "a b")])).count() == 0


def test_index_counts_every_pattern():
    rng = np.random.default_rng(1)
    some = sorted({tuple(rng.integers(1, 3, rng.integers(1, 7))) for _ in range(60)})
    index = spelling.Index(np.concatenate([np.array(w) for w in some]), np.array([len(w) for w in some]))
    text = "".join("$" + "".join("ab"[c - 1] for c in w) for w in some)
    for pattern in {"".join(rng.choice(list("ab$"), rng.integers(1, 6))) for _ in range(200)}:
        low, high = np.array([0]), np.array([index.length])
        for c in reversed(pattern):
            low, high = index.narrowed(np.array(["$ab".index(c)]), low, high)
        around = text + text[: len(pattern) - 1]
        assert max(0, high[0] - low[0]) == sum(around.startswith(pattern, i) for i in range(len(text)))


def test_hot_half_is_spread(spark):
    rows = [("hot" + "".join(chr(97 + (i // 26**k) % 26) for k in range(3)), 3) for i in range(2000)]
    vocabulary = spark.createDataFrame(rows, "word string, n long")
    entries = spelling.dealt(vocabulary, block=100).filter("indexed").groupBy("block").count().collect()
    assert max(r["count"] for r in entries) < 600 and len(entries) > 30


def test_equals_sql(spark, sf_dir):
    assert not differences(QUERIES["op13_spelling_variants"](spark, sf_dir), connect(sf_dir), ORACLES["op13_spelling_variants"])
