import hashlib
from collections import defaultdict

import pytest
from compare import connect, differences

from tidemark.llm import exact_dedup as ed
from tidemark.llm.queries import ORACLES, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        left = 1
        for i in ids:
            kept = i == keep and left == 1
            left -= kept
            out.append((i, keep, len(ids), kept, sha))
    return sorted(out, key=repr)


ROWS = [(1, None), (2, ""), (3, "A b"), (4, "a B"), (5, "É"), (6, "é"), (7, "x" * 50000), (8, "X" * 50000), (None, "a b"), (None, "alone"), (None, "alone"),
        (4, "a B"), (4, "a B"), (9, "i̇"), (10, "İ"), (11, "a b ")]


@pytest.mark.parametrize("runs, fan_in", [(64, 4), (5, 2), (1, 2)])
def test_equals_brute_force(spark, monkeypatch, runs, fan_in):
    monkeypatch.setattr(ed.merge_runs, "__defaults__", (runs, fan_in, "min"))
    rows = ROWS + [(100 + i, f"copy {i % 3}") for i in range(200)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, sha string, run int")
    got = ed.exact_dedup(docs, runs=runs)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)
    kept = ed.kept_rows(docs, got)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in expected(rows) if r[3]), key=repr)


def test_smallest_id_can_stay(spark):
    docs = spark.createDataFrame([(2, "a"), (1, "A"), (3, "b")], "doc_id long, text string")
    assert {r.keep_id for r in ed.exact_dedup(docs, keep="min").collect()} == {1, 3}


def test_empty_table(spark):
    assert ed.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_equals_its_sql(spark, sf_dir):
    name = "op8_exact_dedup"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_no_python(spark, sf_dir):
    plan = QUERIES["op8_exact_dedup"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_every_round_sorts_and_merges(spark):
    rows = spark.createDataFrame([(i, f"copy {i % 3}") for i in range(50)], "doc_id long, text string")
    merged = ed.merge_runs(ed.digests(rows), runs=64, fan_in=4)
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    planned = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 3 and planned.count("Sort [sha") == 3
    assert sorted(r.group_size for r in merged.collect()) == [16, 17, 17]


def test_texts_are_hashed_once(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "A")], "doc_id long, text string")
    assert "sha2(" not in ed.exact_dedup(rows)._jdf.queryExecution().optimizedPlan().toString()
