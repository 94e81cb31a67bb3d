import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import language_id, ngrams, quality
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op7_language_id"](spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    out = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4) == 2
    rows = got.join(docs.select("doc_id", "lang", out.alias("out")), "doc_id").collect()
    assert len(rows) == docs.count() and all(r.held_out == r.out and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = QUERIES["op10_quality"](spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = got.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


ROWS = [(1, None, "en"), (2, "", "de"), (3, "123 !?", "en"), (4, "the cat and the dog of the house", "en"), (4, "the cat and the dog of the house", "en"),
        (None, "der hund und die katze im haus", "de"), (5, "le chat et le chien de la maison", "fr"), (6, "x" * 300000, None), (7, "El perro y el gato", "es"),
        (8, "la casa de los perros y las flores", "es"), (9, "der hund ist im garten und die katze", "de"), (10, "this is the house of the dog", "en")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 1, 0.5, "s") for r in rows], "doc_id long, text string, lang string, id int, score double, out string")


def test_languages_of_odd_rows(spark):
    got = language_id.predict(frame(spark)).collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3))
    assert all(r.lang_pred in {"en", "de", "fr", "es"} for r in got if r.doc_id not in (1, 2, 3))
    assert by[None].held_out is False
    kept = language_id.recognised(frame(spark), language_id.fit(frame(spark), language_id.held_out()))
    assert kept.columns == frame(spark).columns and kept.count() == len(ROWS) - 3


def test_languages_without_labels(spark):
    none = frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language_id.predict(none).collect()} == {("und", 0.0)}
    assert language_id.predict(frame(spark, [])).collect() == []


def test_stage_without_labels_keeps_every_text_with_a_letter(spark):
    none = frame(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language_stage(spark, none, None)
    assert kept.columns == none.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 4, 5, 6, 7, 8, 9, 10]


def test_one_language_only(spark):
    one = frame(spark).withColumn("lang", F.lit("en"))
    assert {r.lang_pred for r in language_id.predict(one).collect()} == {"en", "und"}


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 0), (2, 0), (4, 1), (5, 1), (6, None), (None, 1), (7, 1), (7, 0), (99, 1)], "doc_id long, quality int")
    got = quality.predict(frame(spark), labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    empty = quality.predict(frame(spark), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in empty} == {(0.5, 1)}
    assert quality.predict(frame(spark, []), labels).collect() == []


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    quality_dim = 6
    p = {"W": rng.normal(size=(quality_dim, 5)), "b": rng.normal(size=5), "V": rng.normal(size=(5, 4)), "U": rng.normal(size=(5, 4)),
         "w": rng.normal(size=4), "c": rng.normal(size=5), "d": rng.normal(size=1)}
    x, bag = rng.normal(size=(7, quality_dim)), np.array([0, 0, 0, 1, 2, 2, 2])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss(p):
        *_, z = quality.pool(quality.encode(x, p), bag, 3, p)
        s = quality._sigmoid(z @ p["c"] + p["d"])
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum() / weight.sum()

    grad = quality.gradients(x, bag, y, weight, p)
    for name in p:
        at = tuple(0 for _ in p[name].shape)
        up, down = ({**p, name: p[name].copy()} for _ in range(2))
        up[name][at] += 1e-3
        down[name][at] -= 1e-3
        assert np.ravel(grad[name])[0] == pytest.approx((loss(up) - loss(down)) / 2e-3, rel=0.02, abs=2e-4), name


def test_counts_do_not_depend_on_slices():
    raws = [b"abc" * 500, b"", b"hello world" * 90, b"z"]
    whole, owner = ngrams.counts(raws, 64, (1, 2))
    assert owner.tolist() == [0, 1, 2, 3] and whole[1].sum() == 0
    for i, r in enumerate(raws):
        alone, _ = ngrams.counts([r], 64, (1, 2))
        assert (alone[0] == whole[i]).all()
    parts = list(ngrams.slices(raws, 700))
    assert b"".join(p for g in parts for i, p in g if i == 0) == raws[0]
    cut, owner = ngrams.counts(raws, 64, (1,), segment=512)
    assert owner.tolist() == [0, 0, 0, 1, 2, 2, 3] and cut.sum() == sum(map(len, raws))


def test_sample_takes_each_language_alike(spark):
    rows = [(i, f"the house number {i} of the town", "en") for i in range(3000)] + [(9000 + i, f"la casa {i} del pueblo", "es") for i in range(12)]
    rows += [(None, "le chat et le chien", "fr")] * 500
    got, x = language_id.training_sample(frame(spark, rows), F.lit(False), "doc_id", "text", "lang", 30, 200)
    assert {lang: got.count(lang) for lang in set(got)} == {"en": 10, "es": 10, "fr": 1} and len(x) == 21
    again, y = language_id.training_sample(frame(spark, rows).repartition(7), F.lit(False), "doc_id", "text", "lang", 30, 200)
    assert got == again and (x == y).all()
    assert set(language_id.training_sample(frame(spark, rows), F.lit(False), "doc_id", "text", "lang", 30, 2)[0]) == {"en", "fr"}


def test_passages_of_a_long_text_are_bounded_for_the_fit_only():
    texts = ["ab" * 400_000, None, "short", "e" * 512]
    bags = quality.bags_of(texts, 8)
    rows = [len(b) // 2 // quality.DIM for b in bags]
    assert rows == [8, 1, 1, 1]
    assert np.frombuffer(bags[3], dtype=np.uint16).max() >= 500
    assert quality.bags_of(["x" * 2000], 64) == quality.bags_of(["x" * 2000], 4)


def test_quality_of_text_ids(spark):
    labels = spark.createDataFrame([("4", 1), ("9", 0), ("7", 1)], "doc_id string, quality int")
    docs = frame(spark).withColumn("doc_id", F.col("doc_id").cast("string"))
    assert quality.predict(docs, labels).count() == len(ROWS)
