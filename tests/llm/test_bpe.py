import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe


@pytest.fixture(scope="module")
def encoding():
    lines = open(bpe.RANKS, "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None, "", " ", "a", "don't we'll\n\n  x  \t", "é" * 300, "ab1!? " * 200, "\x1c \x1d\x1e a\x1f", " " * 500 + "x", "   word　", "12345" * 90,
    "<|endoftext|> is text", "\U0001f600" * 99, "á" * 80, "x" * 900, "'s" * 200, "!'s 're" * 50, "\n" * 300 + "a",
]


@pytest.mark.parametrize("size", [1, 7, 50])
def test_cut_texts_have_the_ids_of_whole_ones(encoding, size):
    rng = random.Random(size)
    alphabet = ["a", "B", "é", "1", "٣", "'", "s", "ll", " ", "  ", "\n", "\t", "!", " ", "\x1c", "日", "́", "\U0001f600"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    for text in texts:
        assert "".join(bpe.pieces(text, size)) == text
        assert bpe.encode_text(encoding, text, size) == encoding.encode_ordinary(text), repr(text)


def check(encoding, rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = encoding.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_edge_texts(spark, encoding):
    texts = [*TEXTS, "long word " * 30000]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, ids string")
    check(encoding, bpe.encode_digests(docs).collect(), texts)
    whole = {r.doc_id: r for r in bpe.encode(docs).collect()}
    for i, t in enumerate(texts):
        assert list(whole[i].ids) == encoding.encode_ordinary(t or "") and bytes(whole[i].decoded) == (t or "").encode()


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b")], "doc_id long, text string")
    assert [r.n_tokens for r in bpe.encode_digests(docs).collect()] == [2, 2, 2]
    assert bpe.encode_digests(docs.limit(0)).collect() == []


def test_whole_table(spark, encoding, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(encoding, bpe.encode_digests(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
