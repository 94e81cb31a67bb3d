"""Substring deduplication by word windows: Rabin-Karp hashes, counted in Spark."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import repeats, rolling
from tidemark.llm.repeats import KEY, column

WINDOW = 35
GRAM = 8


def window_counts(rows, kinds, window):
    """(doc_id, k, lo, wa, wb, n): both Rabin-Karp hashes of every window of one run of each kind."""
    reps = kinds.select(F.struct("rep.doc_id", "rep.k").alias("key"), F.struct("rep.lo", "rep.hi", "n").alias("run"))
    wanted = reps.groupBy("key").agg(F.collect_list("run").alias("runs"))
    joined = rows.join(wanted, "key").select("key.doc_id", "key.k", "raw", "runs")
    id_type = joined.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            offsets, (lo, hi, n) = repeats.lists(column(b, "runs"))
            for i, raw in enumerate(column(b, "raw").to_pylist()):
                own = slice(offsets[i], offsets[i + 1])
                size = (hi[own] - lo[own] + 1).astype(np.int64)
                at = np.repeat(lo[own], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                items, _ = rolling.word_items([raw])
                a = rolling.Rolling(items).spans(at, at + window).view(np.int64)
                z = rolling.Rolling(rolling.mix(items), rolling._M2).spans(at, at + window).view(np.int64)
                row = pa.array(np.full(len(at), i))
                yield pa.RecordBatch.from_arrays(
                    [column(b, "doc_id").take(row), column(b, "k").take(row), pa.array(at.astype(np.int32)), pa.array(a), pa.array(z),
                     pa.array(np.repeat(n[own], size))],
                    ["doc_id", "k", "lo", "wa", "wb", "n"],
                )

    return joined.mapInArrow(run, f"doc_id {id_type}, k long, lo int, wa long, wb long, n long")


def repeated_windows(windows):
    """Single windows that also start elsewhere: (doc_id, k, lo, hi)."""
    again = windows.groupBy("wa", "wb").agg(F.sum("n").alias("all")).filter("all > 1").select("wa", "wb")
    again = repeats.stored(windows.sparkSession, again, "repeated-windows")
    return windows.filter("n = 1").join(again, ["wa", "wb"]).select(*KEY, "lo", F.col("lo").alias("hi"))


def _kept(raw, mask_of):
    words = raw.split()  # white space of bytes is exactly blank and 9 to 13
    mask = mask_of(len(words))
    if mask is not None:
        return len(words), mask, b" ".join([w for w, m in zip(words, mask) if not m]).decode()
    return len(words), None, b" ".join(words).decode()


def substring_dedup(docs, window=WINDOW, gram=GRAM, id_col="doc_id", text_col="text"):
    """Remove every word covered by a window of ``window`` words that also starts anywhere else.

    One row per input row: doc_id, n_words, n_removed, removed (maximal intervals of word positions) and
    kept (remaining words joined by one blank). Windows are judged on the input. A null text has no
    words; a text shorter than the window keeps all. Rows that repeat an id and a text are two texts, so
    their windows are repeated. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = repeats.binary_rows(docs, id_col, text_col)
    found = repeats.candidates(spark, rows, rolling.word_items, window, gram, "windows")
    kinds = repeats.classes(found)
    windows = repeats.stored(spark, window_counts(rows, kinds, window), "window-hashes")
    spans = repeats.whole_runs(found, kinds).unionByName(repeated_windows(windows))
    return repeats.removed(repeats.with_spans(rows, spans), _kept, window, "string", "n_words")


def digests(result):
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("removed").cast("long").alias("n_spans"))
