"""Benchmark decontamination by greedy string tiling.

Documents and test items that share seeds of ``least`` tokens are joined in Spark. For every such pair the
longest common stretches are marked one after another, never overlapping, found by running Karp-Rabin
hashes; the share of an item's tokens that is marked counts, so passages in another order are caught.
"""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from tidemark.llm import repeats, rolling
from tidemark.llm.common import keyed, on_row, unused, stored
from tidemark.llm.repeats import column

LEAST = 6
COVERAGE = 0.5
FILTER_BITS = 22
_SIGNS = bytes(ord(" ") if c < 128 and not chr(c).isalnum() else c for c in range(256))
# Scripts written without blanks between words: each of their characters is a token. Their signs separate tokens.
_UNSPACED = regex.compile(r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]\p{M}*)")
_OWN_SIGNS = regex.compile(r"[\u3000-\u3004\u3008-\u3020\uFF01-\uFF0F\uFF1A-\uFF20\uFF3B-\uFF40\uFF5B-\uFF65]")


def normal(text):
    """Lower-cased UTF-8 with a blank for every ASCII sign, and around each character of an unspaced script."""
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \1 ", _OWN_SIGNS.sub(" ", text))
    return text.lower().encode().translate(_SIGNS)


def grams(raws, least):
    """(text, position, hash) of every stretch of ``least`` tokens, slice by slice."""
    for texts, offsets, items, starts in rolling.sliced(raws, rolling.word_items, least):
        if len(items) < least:
            continue
        h = rolling.Rolling(items).grams(least)
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        own = np.flatnonzero(text[: len(h)] == text[least - 1 :])
        t = text[own]
        yield np.array(texts)[t], own - starts[t] + np.array(offsets)[t], h[own].view(np.int64)


def item_seeds(items, least):
    """(item_id, ik, pos, h) of every seed of every test item."""
    flat = items.select("item_id", "ik", "item")
    id_type = flat.schema["item_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for text, pos, h in grams([normal(t) for t in column(b, "item").to_pylist()], least):
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [column(b, "item_id").take(at), column(b, "ik").take(at), pa.array(pos.astype(np.int32)), pa.array(h)],
                    ["item_id", "ik", "pos", "h"])

    return flat.mapInArrow(run, f"item_id {id_type}, ik long, pos int, h long")


def seeded_documents(docs, seeds, least):
    """(doc_id, k, text, seeds): documents with a hash that some item may have.

    Items' seeds are folded into a bit map of fixed size, broadcast whatever their number; it only spares
    rows, the join on whole hashes decides.
    """
    slot = F.shiftrightunsigned("h", 64 - FILTER_BITS).cast("int")
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[seeds.select(slot.alias("s")).distinct().toPandas()["s"].to_numpy(dtype=np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        known = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            texts = column(b, "text").to_pylist()
            hits = {}
            for text, _, h in grams([normal(t) for t in texts], least):
                hit = known[(h.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                for i in np.unique(text[hit]):
                    hits.setdefault(int(i), []).append(h[hit & (text == i)])
            if hits:
                at = pa.array(sorted(hits))
                found = [np.unique(np.concatenate(hits[i])) for i in sorted(hits)]
                yield pa.RecordBatch.from_arrays(
                    [column(b, "doc_id").take(at), column(b, "k").take(at), column(b, "text").take(at), pa.array(found, pa.list_(pa.int64()))],
                    ["doc_id", "k", "text", "seeds"])

    return docs.mapInArrow(run, f"doc_id {id_type}, k long, text string, seeds array<long>")


def near_seeds(doc, item, least):
    """The tokens of ``doc`` that lie in a seed of ``item``; gaps become tokens that match nothing."""
    if len(doc) < least or len(item) < least:
        return []
    own, theirs = rolling.Rolling(doc).grams(least), rolling.Rolling(item).grams(least)
    mask = rolling.covered(np.flatnonzero(np.isin(own, theirs)), np.flatnonzero(np.isin(own, theirs)), least, len(doc))
    out = []
    for a, z in zip(*rolling.intervals(mask)):
        out += [int(t) for t in doc[a:z]]
        out.append(-1 - len(out))
    return out


def _windows(tokens, used, size):
    """(position, running hash) of every stretch of ``size`` unmarked tokens."""
    base, modulus = 1_000_003, (1 << 61) - 1
    out_weight = pow(base, size - 1, modulus)
    h, have = 0, 0
    for i, t in enumerate(tokens):
        if used[i]:
            h, have = 0, 0
            continue
        if have == size:
            h = (h - (tokens[i - size] % modulus) * out_weight) % modulus
            have -= 1
        h = (h * base + t % modulus) % modulus
        have += 1
        if have == size:
            yield i - size + 1, h


def tiles(item, doc, least):
    """Greedy tiling: [(item position, document position, length)], longest first, none overlapping."""
    used_item, used_doc = [False] * len(item), [False] * len(doc)
    found = []
    size = max(least, min(len(item), len(doc)))
    while size >= least:
        table = {}
        for i, h in _windows(item, used_item, size):
            table.setdefault(h, []).append(i)
        best, longest = [], 0
        for j, h in _windows(doc, used_doc, size):
            for i in table.get(h, ()):
                if item[i : i + size] != doc[j : j + size]:
                    continue
                n = size
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not used_item[i + n] and not used_doc[j + n]:
                    n += 1
                best.append((-n, i, j))
                longest = max(longest, n)
        marked = False
        for n, i, j in sorted(best):
            n = -n
            if n == longest and not any(used_item[i : i + n]) and not any(used_doc[j : j + n]):
                used_item[i : i + n] = [True] * n
                used_doc[j : j + n] = [True] * n
                found.append((i, j, n))
                marked = True
        # nothing longer than the longest is left; without a match the length is halved, down to the least
        if not marked:
            if size == least:
                break
            size = max(least, size // 2)
    return found


def coverage(item, doc, least):
    """Share of the item's tokens in tiles of the document (arrays of token hashes)."""
    near = near_seeds(doc, item, least)
    n = sum(t[2] for t in tiles([int(t) for t in item], near, least)) if near else 0
    return n / len(item) if len(item) else 0.0


def contaminated_pairs(docs, benchmark, least=LEAST, share=COVERAGE, id_col="doc_id", text_col="text", item_id_col="item_id", item_text_col="text"):
    """(doc_id, k, item_id, coverage) of every document and item with at least ``share`` of the item in tiles."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    items = keyed(benchmark, item_id_col, item_text_col, "item_id").withColumnsRenamed({"k": "ik", "text": "item"}).dropDuplicates(["item_id", "ik"])
    seeds = stored(spark, item_seeds(items, least), "item-seeds")
    found = stored(spark, seeded_documents(rows, seeds, least), "seeded-documents")
    # Tiles of an item cannot hold more tokens than its seeds do: too few shared seeds, no need to tile.
    size = seeds.groupBy("item_id", "ik").agg((F.max("pos") + least).alias("tokens"))
    shared = found.select("doc_id", "k", F.explode("seeds").alias("h")).distinct().join(seeds, "h")
    counts = shared.groupBy("doc_id", "k", "item_id", "ik").agg(F.countDistinct("pos").alias("n"))
    i = size.withColumnsRenamed({"item_id": "_item_id", "ik": "_ik"})
    pairs = counts.join(i, (counts["ik"] == i["_ik"]) & counts["item_id"].eqNullSafe(i["_item_id"]))
    pairs = pairs.filter(F.col("n") * least >= F.col("tokens") * share).select("doc_id", "k", "item_id", "ik")
    texts = found.select("doc_id", "k", "text").dropDuplicates(["doc_id", "k"])
    full = on_row(pairs, texts, "inner")
    it = items.withColumnsRenamed({"item_id": "_item_id", "ik": "_ik"})
    full = full.join(it, (full["ik"] == it["_ik"]) & full["item_id"].eqNullSafe(it["_item_id"])).select("doc_id", "k", "item_id", "text", "item")
    types = [full.schema[c].dataType.simpleString() for c in ("doc_id", "item_id")]

    def run(batches):
        for b in batches:
            got = []
            for text, item in zip(column(b, "text").to_pylist(), column(b, "item").to_pylist()):
                got.append(coverage(rolling.word_items([normal(item)])[0], rolling.word_items([normal(text)])[0], least))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "k"), column(b, "item_id"), pa.array(got, pa.float64())],
                                             ["doc_id", "k", "item_id", "coverage"])

    tiled = full.mapInArrow(run, f"doc_id {types[0]}, k long, item_id {types[1]}, coverage double")
    return tiled.filter(F.col("coverage") >= share)


def decontaminate(docs, benchmark, least=LEAST, share=COVERAGE, id_col="doc_id", text_col="text", **names):
    """One row per input row: doc_id, contaminated, n_items, item_id and coverage (of the best covered item).

    Tokens are runs of letters, digits and other non-ASCII characters, lower-cased; of scripts without blanks
    (Chinese, Japanese, Thai and others) every character is one. A null text has none; items
    of fewer than ``least`` tokens match nothing. Of equally covered items the smallest id counts. Rows that
    repeat an id and a text get the same result; repeated items count once; other columns are ignored.
    """
    pairs = contaminated_pairs(docs, benchmark, least, share, id_col, text_col, **names)
    best = pairs.groupBy("doc_id", "k").agg(
        F.count("*").alias("n_items"), F.min_by(F.struct("item_id", "coverage"), F.struct(-F.col("coverage"), F.col("item_id"))).alias("best"))
    rows = keyed(docs, id_col, text_col).select("doc_id", "k")
    return on_row(rows, best, "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.col("best.item_id").alias("item_id"), F.coalesce("best.coverage", F.lit(0.0)).alias("coverage"))


def clean_rows(docs, benchmark, least=LEAST, share=COVERAGE, id_col="doc_id", text_col="text", **names):
    """The input rows, all columns, that hold no test item."""
    bad = contaminated_pairs(docs, benchmark, least, share, id_col, text_col, **names).select("doc_id", "k").distinct()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own, doc, k = (unused(n, *docs.columns) for n in ("_own", "_doc_id", "_k"))
    marked = docs.withColumn(own, F.xxhash64(text))
    b = bad.withColumnsRenamed({"doc_id": doc, "k": k})
    return marked.join(b, (F.col(own) == F.col(k)) & F.col(f"`{id_col}`").eqNullSafe(F.col(doc)), "left_anti").drop(own)
