import hashlib

import numpy as np
import pytest

from tidemark.llm import materialise as m


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 17, 1000, 4097])
def test_permutation_and_inverse(n):
    out = m.permute(np.arange(n), n, "key")
    assert sorted(out) == list(range(n))
    assert (m.permute(out, n, "key", backwards=True) == np.arange(n)).all()
    if n > 100:
        assert (out != np.arange(n)).mean() > 0.9 and (m.permute(np.arange(n), n, "other") != out).any()


def test_large_range_stays_in_range():
    n = (1 << 40) + 12345
    x = np.arange(n - 1000, n)
    out = m.permute(x, n, "k")
    assert len(set(out)) == 1000 and out.max() < n and (m.permute(out, n, "k", backwards=True) == x).all()


def encoding():
    with open(m.bpe.RANKS, "rb") as f:
        return m.bpe.load_encoding(f.read(), m.public_tokenizers.PATTERN)


def check(docs, folder, length, per_shard):
    rows = sorted(m.materialise(docs, folder, "k", length, per_shard).collect())
    n, bpe = len(rows), encoding()
    kind, end, fill = m.token_type(bpe.n_vocab)
    assert [r.slot for r in rows] == list(range(n))
    assert sorted(r.sequence for r in rows) == list(range(n))
    assert all(r.slot == m.permute([r.sequence], n, "k")[0] for r in rows[:50])
    blocks = m.read_from(folder, 0, n + 5, length, per_shard, kind) if n else []
    assert [hashlib.sha256(b.tobytes()).hexdigest() for b in blocks] == [r.tokens_sha256 for r in rows]
    assert all(r.offset == r.slot % per_shard * length * kind.itemsize for r in rows)
    stream = np.concatenate([blocks[r.slot] for r in sorted(rows, key=lambda r: r.sequence)]).tolist()
    used = sum(r.n_tokens for r in rows)
    assert set(stream[used:]) <= {fill} and fill not in stream[:used]
    texts, at = [], 0
    while at < used:
        close = stream.index(end, at)
        texts.append(stream[at:close])
        at = close + 1
    hashes = docs.selectExpr("coalesce(text, '') AS t", "xxhash64(doc_id, coalesce(text, '')) AS k").collect()
    assert texts == [bpe.encode_ordinary(r.t) for r in sorted(hashes, key=lambda r: r.k)]
    if n > 3:
        assert [b.tolist() for b in m.read_from(folder, n - 3, 2, length, per_shard, kind)] == [b.tolist() for b in blocks[n - 3 : n - 1]]
    return rows


def test_token_type():
    assert m.token_type(65534)[0].itemsize == 2 and m.token_type(65535)[0].itemsize == 4


def test_edge_cases(spark, tmp_path):
    texts = [None, "", "a", "é" * 7, "x" * 15, "y" * 16, "long words " * 700, "a", "a"]
    docs = spark.createDataFrame([(None if i % 3 else i, t, 1, "s") for i, t in enumerate(texts)], "doc_id long, text string, slot int, at string")
    check(docs.union(docs.filter("doc_id = 6")), str(tmp_path / "a"), 16, 5)
    assert m.materialise(docs.limit(0), str(tmp_path / "none"), "k", 16, 5).collect() == []


def test_whole_table_whatever_the_partitions(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = check(docs, str(tmp_path / "b"), 1024, 64)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = m.materialise(docs.repartition(5, "text"), str(tmp_path / "c"), "k", 1024, 64).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(again) == rows
    for shard in {r.shard for r in rows}:
        assert (tmp_path / "b" / f"shard-{shard:08d}.bin").read_bytes() == (tmp_path / "c" / f"shard-{shard:08d}.bin").read_bytes()


def test_texts_are_encoded_once(spark, sf_dir, tmp_path):
    rows = m.materialise(spark.read.parquet(f"{sf_dir}/documents.parquet"), str(tmp_path / "d"))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan, plan
