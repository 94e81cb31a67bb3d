import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import suffix_dedup as sd


def expected(texts, length, order=None):
    """(n_bytes, n_removed, n_spans, sha) per text; with ``order`` only later copies go."""
    raws = [(t or "").encode() for t in texts]
    seen = defaultdict(list)
    for i, r in enumerate(raws):
        for p in range(len(r) - length + 1):
            seen[r[p : p + length]].append((i, p))
    gone = [np.zeros(len(r), dtype=bool) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            first = min(places, key=lambda x: (order[x[0]], x[1])) if order else None
            for i, p in places:
                if (i, p) != first:
                    gone[i][p : p + length] = True
    out = []
    for r, g in zip(raws, gone):
        kept = bytes(np.frombuffer(r, dtype=np.uint8)[~g])
        spans = int((np.diff(np.concatenate(([0], g.astype(int)))) == 1).sum())
        out.append((len(r), int(g.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in zip(ids, texts)], "doc_id long, text string, h string, lo int, raw string")


def corpus(seed, n):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé") for _ in range(rng.randint(8, 90))) for _ in range(6)]
    texts = [None, "", "a", "ab" * 40, "a" * 70, "\0" * 30, "\0a" * 20]
    for _ in range(n):
        texts.append("".join(rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("abcdé\0") for _ in range(rng.randint(0, 40)))
                             for _ in range(rng.randint(1, 5))))
    return texts


@pytest.mark.parametrize("seed, length, gram, split", [(1, 12, 4, 2048), (2, 20, 5, 3), (3, 40, 9, 2)])
def test_all_copies_go(spark, seed, length, gram, split):
    texts = corpus(seed, 50)
    result = sd.digests(sd.suffix_dedup(frame(spark, texts), length, gram, later_only=False, split_kinds=split))
    got = {r[0]: tuple(r[1:]) for r in result.collect()}
    for i, want in enumerate(expected(texts, length)):
        assert got[i] == want, texts[i]


@pytest.mark.parametrize("split", [2048, 2])
def test_the_first_copy_stays(spark, split):
    texts = corpus(5, 50)
    docs = frame(spark, texts)
    got = {r[0]: tuple(r[1:]) for r in sd.digests(sd.suffix_dedup(docs, 16, 5, split_kinds=split)).collect()}
    for i, want in enumerate(expected(texts, 16, order=range(len(texts)))):
        assert got[i] == want, texts[i]


def test_repeated_rows_and_null_ids(spark):
    texts = ["abcdefghijklmnop", "abcdefghijklmnop", "xyz", "xyzabcdefghijklmnop"]
    rows = sd.digests(sd.suffix_dedup(frame(spark, texts, [7, 7, None, None]), 10, 4, later_only=False)).collect()
    assert sorted(tuple(r[1:]) for r in rows) == sorted(expected(texts, 10))


def test_empty_table(spark):
    assert sd.suffix_dedup(frame(spark, []), 10, 4).collect() == []


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in sd.digests(sd.suffix_dedup(docs, later_only=False)).collect()}
    for r, want in zip(rows, expected([r.text for r in rows], 200)):
        assert got[r.doc_id] == want, r.doc_id


def test_longest_previous_factors():
    rng = random.Random(4)
    for depth in (3, 8, 13, 40):
        text = bytes(rng.choice(b"ab") for _ in range(120))
        starts = np.arange(len(text))
        lpf, _, order = sd.longest_previous(np.frombuffer(text, dtype=np.uint8), starts, depth)
        for i in range(len(text)):
            best = 0
            for j in range(i):
                n = 0
                while n < depth and i + n < len(text) and text[i + n] == text[j + n]:
                    n += 1
                best = max(best, n)
            if i + depth <= len(text):
                assert lpf[i] == best, (depth, i)
        cut = [text[i : i + depth] for i in order if i + depth <= len(text)]
        assert cut == sorted(cut)


def test_previous_smaller():
    pos = np.array([4, 2, 5, 3, 0, 1])
    assert sd.previous_smaller(pos).tolist() == [-1, -1, 1, 1, -1, 4]
