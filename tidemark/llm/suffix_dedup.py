"""Suffix-array deduplication: longest-previous-factor arrays over the segments that may hold repeats.

The segments come from runs of windows with a repeated anchor (see repeats.py), one per distinct
content with its count. All segments of an anchor meet in one task, or in several parts if there are many;
a task sorts the suffixes of its segments, and previous and next smaller positions in suffix order
give the longest earlier match of every suffix.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import repeats, rolling
from tidemark.llm.repeats import KEY, column

LENGTH = 200
GRAM = 40
TASK_BYTES = 1 << 20
# So many segments of up to 2 * length bytes, and some 60 bytes of work for each byte, meet in one task; parts of an
# anchor with more exchange one row per window, so they should be large.
SPLIT_KINDS = 8192


def dense(key):
    return np.unique(key, return_inverse=True)[1].astype(np.int32)


def suffix_ranks(text, depth):
    """Ranks by the first 8, 16, ... bytes below ``depth``, and by the first ``depth`` bytes.

    Prefix doubling; bytes past the end count as zero. The last entry orders suffixes by ``depth`` bytes.
    """
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    packed = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        packed = (packed << np.uint64(8)) | padded[j : j + n]
    levels = [(8, dense(packed))] if depth >= 8 else [(1, text.astype(np.int32))]
    while levels[-1][0] < depth:
        size, rank = levels[-1]
        step = min(size, depth - size)
        after = np.zeros(n, dtype=np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        levels.append((size + step, dense(rank.astype(np.int64) * (n + 257) + after)))
    return levels


def previous_smaller(pos):
    """For every place in suffix order the nearest place before it with a smaller text position, or -1."""
    at = np.arange(len(pos)) - 1
    todo = np.flatnonzero((at >= 0) & (pos[at] > pos))
    while len(todo):
        at[todo] = at[at[todo]]  # what lies between is larger still
        todo = todo[(at[todo] >= 0) & (pos[at[todo]] > pos[todo])]
    return at


def common(text, levels, a, b):
    """Length of the common prefix of suffixes a and b, up to the depth of the ranks."""
    depth, rank = levels[-1]
    same = rank[a] == rank[b]
    length = np.zeros(len(a), dtype=np.int64)
    for size, rank in reversed(levels[:-1]):
        x, y = a + length, b + length
        inside = (x < len(text)) & (y < len(text)) & (length + size <= depth)
        hit = inside & (rank[np.minimum(x, len(text) - 1)] == rank[np.minimum(y, len(text) - 1)])
        length += size * hit
    for _ in range(8):
        x, y = a + length, b + length
        inside = (x < len(text)) & (y < len(text)) & (length < depth)
        hit = inside & (text[np.minimum(x, len(text) - 1)] == text[np.minimum(y, len(text) - 1)])
        length += hit
    return np.where(same, depth, np.minimum(length, depth))


def longest_previous(text, starts, depth):
    """(lpf, block, order) of the suffixes at ``starts`` (ascending), compared up to ``depth`` bytes.

    ``lpf``: longest match with a suffix that starts earlier; ``block``: number of the group of suffixes
    with equal first ``depth`` bytes; ``order``: places of ``starts`` in suffix order.
    """
    levels = suffix_ranks(text, depth)
    block = levels[-1][1][starts]
    order = np.argsort(block, kind="stable")
    pos = starts[order]
    before = previous_smaller(pos)
    n = len(pos)
    after = n - 1 - previous_smaller(pos[::-1])[::-1]
    lpf = np.zeros(n, dtype=np.int64)
    for other, there in ((before, before >= 0), (after, after < n)):
        i = np.flatnonzero(there)
        lpf[order[i]] = np.maximum(lpf[order[i]], common(text, levels, pos[i], pos[other[i]]))
    return lpf, block, order


def judge(segments, counts, split, length, later_only):
    """Spans and exchanged windows of one task's segments (in text order within an anchor).

    Returns (segment, lo, hi) of runs of repeated windows, and (segment, lo, hashes) of one window of every
    distinct content in segments whose anchor is split over several parts.
    """
    text = np.concatenate([np.frombuffer(s + b"\0", dtype=np.uint8) for s in segments])
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    per = sizes - length + 1
    owner = np.repeat(np.arange(len(segments)), per)
    inside = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    first = np.cumsum(sizes + 1) - sizes - 1
    starts = first[owner] + inside
    lpf, block, _ = longest_previous(text, starts, length)
    later = lpf >= length
    if later_only:
        hit = later
    else:
        # a block with a later copy is repeated, the first copy as well
        hit = np.isin(block, block[later]) & (counts[owner] == 1)
    at = np.flatnonzero(hit)
    new = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(owner[at]) != 0))) if len(at) else np.zeros(0, bool)
    begin = at[new]
    end = at[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(at) - 1]))] if len(at) else at
    spans = owner[begin], inside[begin], inside[end]
    alone = np.flatnonzero(~later & split[owner])
    where = starts[alone]
    items = rolling.BYTE[text]
    wa = rolling.Rolling(items).spans(where, where + length).view(np.int64)
    wb = rolling.Rolling(rolling.mix(items), rolling._M2).spans(where, where + length).view(np.int64)
    return spans, (owner[alone], inside[alone], wa, wb, counts[owner[alone]])


def segment_rows(rows, kinds, length, split_kinds):
    """(h, part, split, n, doc_id, k, lo, segment) of one run of each kind, with its bytes."""
    sizes = kinds.groupBy("h").agg(F.count("*").alias("kinds"))
    parts = F.ceil(F.col("kinds") / split_kinds)
    placed = kinds.join(sizes, "h").select(
        "h", F.pmod("r", parts).alias("part"), (parts > 1).alias("split"), "n",
        F.struct("rep.doc_id", "rep.k").alias("key"), F.col("rep.lo").alias("lo"), F.col("rep.hi").alias("hi"),
    )
    wanted = placed.groupBy("key").agg(F.collect_list(F.struct("h", "part", "split", "n", "lo", "hi")).alias("runs"))
    # one row per run after the join, cut out of the text where it lies
    cut = rows.join(wanted, "key").select("key", "raw", F.explode("runs").alias("run"))
    return cut.select(
        "run.h", "run.part", "run.split", "run.n", "key.doc_id", "key.k", "run.lo",
        F.expr(f"substring(raw, run.lo + 1, run.hi - run.lo + {length})").alias("segment"),
    )


def judged(segments, length, later_only, task_bytes=TASK_BYTES):
    """(doc_id, k, lo, hi, wa, wb, n): spans of repeated windows, and windows (with hashes) of split anchors."""
    id_type = segments.schema["doc_id"].dataType.simpleString()
    placed = segments.repartition("h", "part").sortWithinPartitions("h", "part", *KEY, "lo")
    names = ["doc_id", "k", "lo", "hi", "wa", "wb", "n"]

    def process(table):
        # Parts of one anchor are judged one by one: only within a part the rows are in text order.
        h, part = table["h"].to_numpy(), table["part"].to_numpy()
        cuts = np.flatnonzero((np.diff(h) == 0) & (np.diff(part) != 0)) + 1
        for a, z in zip([0, *cuts], [*cuts, len(h)]):
            yield from judge_table(table.slice(a, z - a))

    def judge_table(table):
        lo = table["lo"].to_numpy()
        spans, windows = judge(
            table["segment"].to_pylist(), table["n"].to_numpy(), table["split"].to_numpy(zero_copy_only=False), length, later_only)
        for owner, a, z, hashes in ((*spans, None), (windows[0], windows[1], windows[1], windows[2:])):
            if len(owner):
                at = pa.array(owner)
                empty = pa.nulls(len(owner), pa.int64())
                last = [pa.array(x) for x in hashes] if hashes else [empty, empty, empty]
                columns = [table["doc_id"].take(at).combine_chunks(), table["k"].take(at).combine_chunks(),
                           pa.array((lo[owner] + a).astype(np.int32)), pa.array((lo[owner] + z).astype(np.int32)), *last]
                yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches):
        held, size = None, 0
        for b in batches:
            new = pa.Table.from_batches([b])
            held = new if held is None else pa.concat_tables([held, new])
            size += column(b, "segment").nbytes
            if size > task_bytes:
                h, part = held["h"].to_numpy(), held["part"].to_numpy()
                change = np.flatnonzero((np.diff(h) != 0) | (np.diff(part) != 0))
                if len(change):  # an anchor's part is at most split_kinds short segments
                    yield from process(held.slice(0, change[-1] + 1))
                    held = held.slice(change[-1] + 1).combine_chunks()
                    size = held["segment"].nbytes
        if held is not None and held.num_rows:
            yield from process(held)

    return placed.mapInArrow(run, f"doc_id {id_type}, k long, lo int, hi int, wa long, wb long, n long")


def across_parts(windows, later_only):
    """Windows that repeat in another part of a split anchor: (doc_id, k, lo, hi)."""
    own = windows.filter("wa is not null")
    again = own.groupBy("wa", "wb").agg(F.count("*").alias("parts"), F.min(F.struct(*KEY, "lo")).alias("first")).filter("parts > 1")
    both = own.join(again, ["wa", "wb"])
    if later_only:
        both = both.filter(~F.struct(*KEY, "lo").eqNullSafe(F.col("first")))
    return both.select(*KEY, "lo", "hi")


def _kept(raw, mask_of):
    mask = mask_of(len(raw))
    return len(raw), mask, raw if mask is None else np.frombuffer(raw, dtype=np.uint8)[~mask].tobytes()


def suffix_dedup(docs, length=LENGTH, gram=GRAM, later_only=True, split_kinds=SPLIT_KINDS, id_col="doc_id", text_col="text"):
    """Remove bytes covered by a string of ``length`` bytes that starts earlier, or anywhere else.

    ``later_only``: the first copy, by (id, hash of the text, position), stays. Otherwise all copies go. One row per
    input row: doc_id, n_bytes, n_removed, removed (maximal spans of byte positions) and kept (bytes).
    Matches never cross texts and are judged on the input. A null text is empty; a text shorter than
    ``length`` stays whole. Rows that repeat an id and a text get the same result: with ``later_only``
    both stay, else both go. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = repeats.binary_rows(docs, id_col, text_col)
    found = repeats.candidates(spark, rows, rolling.byte_items, length, gram, "bytes")
    kinds = repeats.classes(found)
    windows = repeats.stored(spark, judged(segment_rows(rows, kinds, length, split_kinds), length, later_only), "suffix-matches")
    spans = repeats.whole_runs(found, kinds, later_only)
    spans = spans.unionByName(windows.filter("wa is null").select(*KEY, "lo", "hi")).unionByName(across_parts(windows, later_only))
    return repeats.removed(repeats.with_spans(rows, spans), _kept, length, "binary", "n_bytes")


def digests(result):
    return result.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
