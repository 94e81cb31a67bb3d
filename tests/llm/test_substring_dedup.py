import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import repeats, rolling, substring_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected(texts, window):
    """(n_words, n_removed, sha) of every text, from counts of word tuples."""
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def run(spark, texts, window, gram, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in zip(ids, texts)], "doc_id long, text string, h string, lo int, key string")
    return substring_dedup.digests(substring_dedup.substring_dedup(docs, window, gram)).collect()


def corpus(seed, n, vocabulary=6):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(3, 30))] for _ in range(5)]
    texts = [None, "", "a", "a b", "\t\n", "a " * 90, "b a " * 40, "é\x0bü\x1cñ\xa0o " * 9]
    for _ in range(n):
        w = []
        for _ in range(rng.randint(1, 5)):
            w += rng.choice(passages) if rng.random() < 0.6 else [rng.choice("abcdefgh"[:vocabulary]) + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 25))]
        texts.append(rng.choice([" ", "\n", "  "]).join(w))
    return texts


@pytest.mark.parametrize("seed, window, gram", [(1, 5, 2), (2, 7, 3), (3, 12, 4)])
def test_equals_brute_force(spark, seed, window, gram):
    texts = corpus(seed, 60)
    got = {r[0]: tuple(r[1:4]) for r in run(spark, texts, window, gram)}
    for i, want in enumerate(expected(texts, window)):
        assert got[i] == want, texts[i]


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(9))
    texts = [text, text, "x y z", "x y z " + text]
    rows = run(spark, texts, 5, 2, [7, 7, None, None])
    want = expected(texts, 5)
    assert sorted(tuple(r[1:4]) for r in rows) == sorted(want) and len(rows) == 4


def test_whole_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:4]) for r in substring_dedup.digests(substring_dedup.substring_dedup(docs)).collect()}
    for r, want in zip(rows, expected([r.text for r in rows], 35)):
        assert got[r.doc_id] == want, r.doc_id


def test_empty_table(spark):
    assert run(spark, [], 5, 2) == []


def test_long_texts_are_cut_into_overlapping_parts(monkeypatch):
    raw = [b"a b c d e f g h i j k l m n o p q r s t u v w x y z " * 40, b"", b"a b c"]
    whole = [np.concatenate(x) for x in zip(*rolling.all_runs(raw, rolling.word_items, 9, 3))]
    parts = [list(rolling.sliced(raw, rolling.word_items, 9, size=50))]
    windows = sorted((t[i] if (t := p[0]) else 0, o + s) for p in parts[0] for i, o in enumerate(p[1])
                     for s in range(max(0, p[3][i + 1] - p[3][i] - 8)))
    assert windows == [(0, s) for s in range(26 * 40 - 8)]
    assert sum(whole[2] - whole[1] + 1) == 26 * 40 - 8


def test_words_are_hashed_alike_in_any_part():
    raw = ("word één twö \x1c " * 500).encode()
    a, _ = rolling.word_items([raw])
    b, starts = rolling.word_items([raw[:30], raw, b""], part=64)
    assert (b[starts[1] : starts[2]] == a).all() and len(a) == len(raw.split())


def test_spans_are_maximal(spark):
    assert [x.tolist() for x in rolling.intervals(rolling.covered(np.array([1, 2, 7]), np.array([1, 3, 7]), 3, 10))] == [[1, 7], [6, 10]]
    assert repeats.KEY == ["doc_id", "k"]


def test_rows_that_repeat_id_and_text_keep_one_list_of_spans(spark):
    rows = spark.createDataFrame([(None, 5, "text")] * 300, "doc_id long, k long, raw string").select(F.struct("doc_id", "k").alias("key"), "raw")
    spans = spark.createDataFrame([(None, 5, 0, 3), (None, 5, 4, 9)] * 300, "doc_id long, k long, lo int, hi int")
    got = repeats.with_spans(rows, spans).collect()
    assert len(got) == 300 and {len(r.spans) for r in got} == {2}
