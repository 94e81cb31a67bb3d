"""Language identification in two steps: the family first, then its closely related languages.

Both steps vote over one-versus-one linear support vector machines on hashed byte n-grams of the
whole lower-cased text. The machines are fitted on a bounded sample (``sample_rows``, spread evenly
over the languages by a hash of the id); everything else covers all rows.
"""

import itertools

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod
from tidemark.llm.ngrams import counts, scaled, slices

DIM = 2048
ORDERS = (1, 2, 3)
SAMPLE_ROWS = 1600
MAX_LANGUAGES = 200
RANKS = 2**63 - 1
# A language that is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic",
}
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def features(texts, dim=DIM):
    """One scaled row of n-gram counts per text."""
    raws = [t.lower().encode() for t in texts]
    out = np.zeros((len(raws), dim), dtype=np.float32)
    for group in slices(raws):
        x, _ = counts([p for _, p in group], dim, ORDERS)
        np.add.at(out, [i for i, _ in group], x)
    return scaled(out)


def fit_svm(x, y, reg=1e-4, steps=200):
    """Linear SVM by averaged full-batch subgradient steps on the hinge loss; ``y`` is -1 or 1."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w, b = np.zeros(x.shape[1], dtype=np.float32), np.float32(0)
    mean_w, mean_b, n = np.zeros_like(w), 0.0, 0
    for step in range(1, steps + 1):
        hit = (y * (x @ w + b) < 1) * weight * y
        rate = np.float32(20 / np.sqrt(step))
        w += rate * (hit @ x - reg * w)
        b += rate * hit.sum()
        if step > steps // 2:
            mean_w, mean_b, n = mean_w + w, mean_b + b, n + 1
    return mean_w / n, mean_b / n


def fit_pairs(x, labels):
    """One machine per pair of labels, as (labels, columns of weights, offsets)."""
    names = sorted(set(labels))
    labels = np.array(labels)
    weights, offsets = [], []
    for a, b in itertools.combinations(names, 2):
        own = (labels == a) | (labels == b)
        w, c = fit_svm(x[own], np.where(labels[own] == a, 1, -1).astype(np.float32))
        weights.append(w)
        offsets.append(c)
    width = x.shape[1]
    return names, np.array(weights, dtype=np.float32).reshape(-1, width).T, np.array(offsets, dtype=np.float32)


def vote(x, fitted):
    """(position of the winner, its confidence from 0 to 1) per row; margins break ties."""
    names, weights, offsets = fitted
    points = np.zeros((len(x), len(names)), dtype=np.float64)
    margin = np.full((len(x), len(names)), np.inf)
    scores = x @ weights + offsets if weights.shape[1] else np.zeros((len(x), 0))
    for m, (a, b) in enumerate(itertools.combinations(range(len(names)), 2)):
        s = scores[:, m].astype(np.float64)
        points[:, a] += (s > 0) + 0.1 * np.tanh(s)
        points[:, b] += (s <= 0) - 0.1 * np.tanh(s)
        margin[:, a] = np.minimum(margin[:, a], s)
        margin[:, b] = np.minimum(margin[:, b], -s)
    best = points.argmax(axis=1)
    least = np.clip(margin[np.arange(len(x)), best], -20, 20)
    return best, 1 / (1 + np.exp(-3 * least))


def training_sample(docs, held_out, id_col, text_col, lang_col, sample_rows, max_languages):
    """Rows (lang, features) of at most ``sample_rows`` documents: the same number of each language, first by a hash of id and text.

    At most ``max_languages`` languages, the most frequent ones, are learned, as the machines grow with the square
    of a family's languages. Rows that repeat an id and a text count once.
    """
    usable = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"), held_out.alias("out")
    ).filter("lang is not null and text is not null and not out").withColumn("rank", F.xxhash64("id", "text").bitwiseAND(RANKS))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("rank").alias("different"))
    sizes = sizes.orderBy(F.desc("rows"), "lang").limit(max_languages).collect()
    if not sizes:
        return [], np.zeros((0, DIM), dtype=np.float32)
    each = max(1, sample_rows // len(sizes))
    spark = docs.sparkSession
    # The first ``each`` of n different hashes lie below 8 * each / n of their range, or n is small and all are looked at.
    bounds = spark.createDataFrame([(r.lang, min(1.0, 8 * each / max(r.different, 1)) * RANKS) for r in sizes], "lang string, bound double")
    ranked = usable.join(F.broadcast(bounds), "lang").filter("rank <= bound")
    order = Window.partitionBy("lang").orderBy("rank")
    few = ranked.select("lang", "rank").distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= each)
    # at most sample_rows pairs are broadcast
    rows = ranked.join(F.broadcast(few.select("lang", "rank")), ["lang", "rank"]).groupBy("lang", "rank").agg(F.min("text").alias("text"))

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"lang": b["lang"], "rank": b["rank"], "x": [r.astype(np.float16).tobytes() for r in features(b["text"])]})

    got = rows.select("lang", "rank", "text").mapInPandas(run, "lang string, rank long, x binary")
    got = got.toPandas().sort_values(["lang", "rank"])
    x = np.frombuffer(b"".join(got["x"]), dtype=np.float16).reshape(-1, DIM).astype(np.float32)
    return list(got["lang"]), x


def fit(docs, held_out, id_col="doc_id", text_col="text", lang_col="lang", families=FAMILIES,
        sample_rows=SAMPLE_ROWS, max_languages=MAX_LANGUAGES):
    """(family machines, {family: machines of its languages}); None without labelled rows."""
    langs, x = training_sample(docs, held_out, id_col, text_col, lang_col, sample_rows, max_languages)
    if not langs:
        return None
    family = np.array([families.get(lang, f"only {lang}") for lang in langs])
    inner = {f: fit_pairs(x[family == f], [a for a, b in zip(langs, family) if b == f]) for f in sorted(set(family))}
    return fit_pairs(x, list(family)), inner


def predict_texts(texts, model):
    """[(language, score)] of a list of strings; ``und`` and 0 without a letter or a model."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    usable = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
    if model is None or not usable:
        return out
    outer, inner = model
    x = features([texts[i] for i in usable])
    best, sure = vote(x, outer)
    for f, name in enumerate(outer[0]):
        own = np.flatnonzero(best == f)
        if len(own):
            pick, inner_sure = vote(x[own], inner[name])
            for row, p, s in zip(own, pick, inner_sure):
                out[usable[row]] = (str(inner[name][0][p]), float(min(max(sure[row] * s, 0.0), 1.0)))
    return out


def identify(docs, model, id_col="doc_id", text_col="text", also=()):
    """doc_id, lang_pred, score and the columns ``also`` of every row, without a shuffle.

    A text that is null or has no letter is ``und`` with score 0. Rows with equal ids are judged one
    by one; of other columns only those in ``also`` are carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights per language pair
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *also)
    kept = [c for c in rows.columns if c != "text"]
    schema = rows.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = predict_texts(b.column(b.schema.get_field_index("text")).to_pylist(), shared.value)
            plain = b.select(kept)
            yield pa.RecordBatch.from_arrays(
                [*plain.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                [*kept, "lang_pred", "score"],
            )

    return rows.mapInArrow(run, schema)


def predict(docs, modulus=4, remainder=2):
    """Fit on documents outside the held-out fold and predict the language of all of them."""
    out = held_out(modulus, remainder)
    model = fit(docs, out)
    return identify(docs, model, also=[out.alias("held_out")]).select("doc_id", "held_out", "lang_pred", "score")


def recognised(docs, model, text_col="text"):
    """The input rows, all columns, whose text has a language: neither null nor without a letter.

    Without a model (no labelled row to fit one on) no language is named, so every text with a letter stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            if shared.value is None:
                kept = [bool(t and LETTER.search(t)) for t in texts]
            else:
                kept = [lang != UNKNOWN for lang, _ in predict_texts(texts, shared.value)]
            yield b.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(modulus=4, remainder=2, id_col="doc_id"):
    return F.coalesce(crc_mod(id_col, modulus) == remainder, F.lit(False))
