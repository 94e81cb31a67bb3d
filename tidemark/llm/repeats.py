"""Repeated windows of a corpus: what substring deduplication by words and by bytes share.

``runs`` (see rolling.py) are counted by anchor. An anchor that occurs once has no repeated window. If all
runs of an anchor are alike, all their windows are repeated. Only anchors with unlike runs need their
windows compared, and of runs that are alike only one each.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.common import keyed, stored

KEY = ["doc_id", "k"]


def binary_rows(docs, id_col, text_col):
    """(key, raw): the key names a row by id and content (null-safe), null texts are empty."""
    rows = keyed(docs, id_col, text_col)
    return rows.select(F.struct("doc_id", "k").alias("key"), F.col("text").cast("binary").alias("raw"))


def column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def groups(batches, keys):
    """Tables of the rows of one key each, from batches sorted by integer ``keys``; holds one group and one batch."""
    held = None
    for b in batches:
        new = pa.Table.from_batches([b])
        held = new if held is None else pa.concat_tables([held, new])
        change = np.zeros(max(held.num_rows - 1, 0), dtype=bool)
        for key in keys:
            change |= np.diff(held[key].to_numpy()) != 0
        at = 0
        for cut in np.flatnonzero(change) + 1:
            yield held.slice(at, cut - at)
            at = cut
        held = held.slice(at)
    if held is not None and held.num_rows:
        yield held


def lists(col):
    """(offsets, fields as numpy arrays) of a list<struct> column without nulls."""
    flat = col.flatten()
    offsets = col.offsets.to_numpy()
    return offsets - offsets[0], [flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)]


def run_table(rows, items_of, length, gram):
    """(h, r, doc_id, k, lo, hi): anchor and content hash of every run of every text."""
    flat = rows.select("key.doc_id", "key.k", "raw")
    id_type = flat.schema["doc_id"].dataType.simpleString()
    schema = f"h long, r long, doc_id {id_type}, k long, lo int, hi int"

    def run(batches):
        for b in batches:
            ids, ks = column(b, "doc_id"), column(b, "k")
            for text, lo, hi, h, r in rolling.all_runs(column(b, "raw").to_pylist(), items_of, length, gram):
                if len(text):
                    at = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h), pa.array(r), ids.take(at), ks.take(at), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                        ["h", "r", "doc_id", "k", "lo", "hi"],
                    )

    return flat.mapInArrow(run, schema)


def candidates(spark, rows, items_of, length, gram, label):
    """Runs whose anchor occurs again, stored: (h, r, doc_id, k, lo, hi, alike, first).

    ``alike``: all runs of the anchor have the same content; ``first`` is then the first of them.
    """
    table = stored(spark, run_table(rows, items_of, length, gram), f"{label}-runs")
    heads = table.groupBy("h").agg(
        F.count("*").alias("n"), F.min("r").alias("a"), F.max("r").alias("b"), F.min(F.struct(*KEY, "lo")).alias("first")
    ).filter("n > 1").select("h", (F.col("a") == F.col("b")).alias("alike"), "first")
    # Stored, so that the join shuffles both sides anew and Spark can split a hot anchor.
    heads = stored(spark, heads, f"{label}-anchors")
    return stored(spark, table.join(heads, "h"), f"{label}-candidates")


def classes(found):
    """One row per distinct run of the anchors with unlike runs, stored: (h, r, n, rep)."""
    kinds = found.filter("not alike").groupBy("h", "r").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "lo", "hi")).alias("rep"))
    return stored(found.sparkSession, kinds, "kinds")


def whole_runs(found, kinds, later_only=False):
    """(doc_id, k, lo, hi) of runs that occur more than once as a whole, with or without the first one."""
    alike = found.filter("alike")
    many = kinds.filter("n > 1").select("h", "r", F.struct("rep.doc_id", "rep.k", "rep.lo").alias("first"))
    mixed = found.filter("not alike").drop("first").join(many, ["h", "r"])
    both = alike.select(*KEY, "lo", "hi", "first").unionByName(mixed.select(*KEY, "lo", "hi", "first"))
    if later_only:
        both = both.filter(~F.struct(*KEY, "lo").eqNullSafe(F.col("first")))
    return both.select(*KEY, "lo", "hi")


def with_spans(rows, spans):
    """Rows joined with their spans: (key, raw, spans), an empty list where there are none.

    Rows that repeat an id and a text bring the same spans, which are kept once.
    """
    lists_ = spans.groupBy(F.struct(*KEY).alias("key")).agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    joined = rows.join(lists_, "key", "left")
    empty = F.expr("cast(array() as array<struct<lo:int,hi:int>>)")
    return joined.select("key.doc_id", "raw", F.coalesce("spans", empty).alias("spans"))


def removed(joined, kept_of, length, kept_type, count_name):
    """(id, count, n_removed, removed, kept) of every row; ``kept_of(raw, mask_of)`` gives the last two's source."""
    id_type = joined.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {count_name} long, n_removed long, removed array<struct<start:int,end:int>>, kept {kept_type}"
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    text_type = pa.string() if kept_type == "string" else pa.binary()

    def run(batches):
        for b in batches:
            offsets, (lo, hi) = lists(column(b, "spans"))
            n, gone, cuts, kept = [], [], [], []
            for i, raw in enumerate(column(b, "raw").to_pylist()):
                a, z = offsets[i], offsets[i + 1]
                size, mask, rest = kept_of(raw, lambda m, a=a, z=z: rolling.covered(lo[a:z], hi[a:z], length, m) if z > a else None)
                n.append(size)
                gone.append(0 if mask is None else int(mask.sum()))
                cuts.append([] if mask is None else [{"start": int(s), "end": int(e)} for s, e in zip(*rolling.intervals(mask))])
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(cuts, pa.list_(span)), pa.array(kept, text_type)],
                ["doc_id", count_name, "n_removed", "removed", "kept"],
            )

    return joined.mapInArrow(run, schema)
