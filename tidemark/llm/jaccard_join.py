"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

The sets of word shingles are put into bands of size. In a band the domain of shingles is cut into first-level
groups and each group into ``N2`` partitions; similar sets differ in so few shingles that in some
group at most ``K2`` partitions differ, so they share the signature of some ``N2 - K2`` partitions.

Signatures bring candidates; every link is decided on the whole sets. Members of a signature are first compared with
its smallest member, the hub. By the triangle inequality of the Jaccard distance all links of a member near the
hub lie within a wider ball around it, so balls are compared inside, in blocks; members far from the hub get
another one. Members that are in one component already need no comparison.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import repeats, rolling
from tidemark.llm.common import discard, named_rows, stored
from tidemark.llm.components import components
from tidemark.llm.repeats import column

SHINGLE = 5
N2, K2 = 2, 1
LEVELS = 12
BALL = 256
ROUNDS = 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(raws, n=SHINGLE):
    """Sorted distinct shingle hashes of every text; a short text is one shingle, an empty one none."""
    items, starts = rolling.word_items([r.translate(_LOWER) for r in raws])
    rolled = rolling.Rolling(items)
    grams = rolled.grams(n) if len(items) >= n else None
    out = []
    for a, z in zip(starts[:-1], starts[1:]):
        if z - a >= n:
            out.append(np.unique(grams[a : z - n + 1]))
        elif z > a:
            out.append(rolled.spans(np.array([a]), np.array([z])))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_hash(s):
    """One number per set; equal sets are one node of the join."""
    return int(rolling.mix(np.array([s.size], dtype=np.uint64) + rolling.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))[0])


def differences(size):
    """Most shingles that differ between a set and a linked set that is not smaller: u - i <= u / 5 and u <= 1.25 a."""
    return size // 4


def band_of(size):
    return max(1, int(size - 1).bit_length())


def _band_signatures(s, band, level, n2, k2):
    """(signatures of partition subsets that hold a shingle, whether a linked set surely shares one of them)."""
    per_group = k2 + 1
    need = differences(len(s)) // per_group + 1
    groups = differences(1 << band) // per_group + 1
    groups += groups // 5
    x = rolling.mix(s + np.uint64((band * 64 + level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    cell = ((x >> np.uint64(33)) % np.uint64(groups)).astype(np.int64) * n2 + ((x & np.uint64(0xFFFF)) % np.uint64(n2)).astype(np.int64)
    count = np.bincount(cell, minlength=groups * n2)
    total = np.zeros(groups * n2, dtype=np.uint64)
    np.add.at(total, cell, rolling.mix(x))
    count, total = count.reshape(groups, n2), rolling.mix(total).reshape(groups, n2)
    subsets = list(itertools.combinations(range(n2), n2 - k2))
    held = np.stack([count[:, list(c)].sum(axis=1) > 0 for c in subsets], axis=1)
    # A group counts if none of its subsets is empty: then what agrees in it is a shingle's signature.
    clean = np.cumsum(held.all(axis=1))
    used = int(np.searchsorted(clean, need)) + 1
    sure = used <= groups
    out = []
    g = np.arange(groups, dtype=np.uint64)
    for j, c in enumerate(subsets):
        sig = np.full(groups, (band * 64 + level) * len(subsets) + j, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + g
        for col in c:
            sig = rolling.mix(sig) + total[:, col]
        out.append(rolling.mix(sig)[:used][held[:used, j]])
    return np.concatenate(out), sure


def signatures(s, n2=N2, k2=K2):
    """PartEnum signatures of a set. Sets of fewer than four shingles can only link with equal ones.

    Only as many groups are used as the set's own size asks for. A set for which too many partitions are empty
    signs once more with another cut of the domain: two such sets meet there, and any other partner meets
    one of its signatures before.
    """
    if len(s) < 4:
        return np.zeros(0, dtype=np.uint64)
    bands = [band_of(len(s))]
    if len(s) * 5 // 4 > 1 << bands[0]:
        bands.append(bands[0] + 1)  # the larger set of a pair names the band
    out = []
    for band in bands:
        for level in range(LEVELS):
            sig, sure = _band_signatures(s, band, level, n2, k2)
            out.append(sig)
            if sure:
                break
        else:
            out.append(np.array([band], dtype=np.uint64))
    return np.unique(np.concatenate(out))


def signed_rows(rows):
    """(doc_id, k, n, s, sigs): size and number of every row's set and its signatures, empty where a batch holds them already."""
    flat = rows.select("key.doc_id", "key.k", "raw")
    id_type = flat.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            sets, done = shingles(column(b, "raw").to_pylist()), set()
            nodes = [set_hash(s) for s in sets]
            sigs = []
            for s, node in zip(sets, nodes):
                sigs.append(np.zeros(0, dtype=np.uint64) if node in done else signatures(s))
                done.add(node)
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in sigs])))
            flat_sigs = np.concatenate(sigs) if sigs else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id"), column(b, "k"), pa.array([len(s) for s in sets], pa.int64()), pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat_sigs.view(np.int64)))], ["doc_id", "k", "n", "s", "sigs"])

    return flat.mapInArrow(run, f"doc_id {id_type}, k long, n long, s long, sigs array<long>")


def members(sigs):
    """(sig, hub, s) of every set that shares a signature with a smaller-numbered one, the hub.

    One pass over rows sorted by signature, holding one batch: a set has many signatures, each hashed
    anywhere, so a group of copies spreads over all partitions.
    """

    def run(batches):
        sig0 = s0 = hub0 = None
        for b in batches:
            sig, s = column(b, "sig").to_numpy(), column(b, "s").to_numpy()
            if not len(sig):
                continue
            first = np.concatenate(([sig[0] != sig0], np.diff(sig) != 0))
            copy = np.concatenate(([sig[0] == sig0 and s[0] == s0], (np.diff(sig) == 0) & (np.diff(s) == 0)))
            at = np.maximum.accumulate(np.where(first, np.arange(len(sig)), -1))
            hub = np.where(at >= 0, s[np.maximum(at, 0)], hub0 if hub0 is not None else 0)
            keep = ~first & ~copy
            sig0, s0, hub0 = sig[-1], s[-1], hub[-1]
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (sig, hub, s)], ["sig", "hub", "s"])

    placed = sigs.repartition("sig").sortWithinPartitions("sig", "s")
    return placed.mapInArrow(run, "sig long, hub long, s long")


def parities(s):
    """Parity of the number of shingles in each of 4 to 8 cells per shingle, as packed bits (a power of two).

    Two sets differ in at least as many shingles as their cells differ in parity.
    """
    bits = 1 << max(8, (4 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def least_difference(x, y):
    """At least so many shingles differ between the sets of two packed parities; the longer one is folded."""
    x, y = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def sketches(texts):
    """(s, n, sketch) of every set."""

    def run(batches):
        for b in batches:
            sets = shingles(column(b, "raw").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [column(b, "s"), pa.array([len(x) for x in sets], pa.int64()), pa.array([parities(x) for x in sets], pa.binary())], ["s", "n", "sketch"])

    return texts.select("s", "raw").mapInArrow(run, "s long, n long, sketch binary")


def possible(pairs, marks, share):
    """The pairs (a, b) whose sizes and parities don't rule out a similarity of ``share``."""
    left = marks.select(F.col("s").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("xa"))
    right = marks.select(F.col("s").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("xb"))
    sized = pairs.join(left, "a").join(right, "b").filter(F.least("na", "nb") >= share * F.greatest("na", "nb"))

    def run(batches):
        for b in batches:
            n = column(b, "na").to_numpy() + column(b, "nb").to_numpy()
            d = np.array([least_difference(x, y) for x, y in zip(column(b, "xa").to_pylist(), column(b, "xb").to_pylist())], dtype=np.int64)
            yield b.select(["a", "b"]).filter(pa.array(n - d >= share * (n + d), pa.bool_()))

    return sized.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(run, "a long, b long")


def verified(pairs, texts):
    """(a, b, both, any): sizes of intersection and union of the sets of every pair."""
    left = texts.select(F.col("s").alias("a"), F.col("raw").alias("ra"))
    right = texts.select(F.col("s").alias("b"), F.col("raw").alias("rb"))

    def run(batches):
        for b in batches:
            nodes = {}
            for name, raw in (("a", "ra"), ("b", "rb")):
                nodes.update(zip(column(b, name).to_pylist(), column(b, raw).to_pylist()))
            sets = dict(zip(nodes, shingles(list(nodes.values()))))
            both, either = [], []
            for a, z in zip(column(b, "a").to_pylist(), column(b, "b").to_pylist()):
                i = len(np.intersect1d(sets[a], sets[z], assume_unique=True))
                both.append(i)
                either.append(len(sets[a]) + len(sets[z]) - i)
            yield pa.RecordBatch.from_arrays([column(b, "a"), column(b, "b"), pa.array(both, pa.int64()), pa.array(either, pa.int64())], ["a", "b", "both", "any"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ra", "rb").mapInArrow(run, "a long, b long, both long, any long")


def block_links(sets, labels):
    """Pairs of positions that link and join two components, of sets compared all with all."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    use = shared[inverse]
    owner, col = owner[use], place[inverse[use]]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    for start in range(0, int(shared.sum()), 8192):
        a, z = np.searchsorted(col, [start, start + 8192])
        m = np.zeros((len(sets), 8192), dtype=np.float32)
        m[owner[a:z], col[a:z] - start] = 1
        both += m @ m.T
    either = sizes[:, None] + sizes[None, :] - both
    i, j = np.nonzero(np.triu(100 * both >= 80 * either, 1))
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(i, j):
        x, y = find(labels[a]), find(labels[b])
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def ball_links(balls, texts, size=BALL):
    """Links (a, b) between components inside every ball (hub, s, label), blocks of ``size`` sets against each other."""
    open_ = balls.groupBy("hub").agg(F.count("*").alias("n"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("hub", "n")
    blocks = F.ceil(F.col("n") / size).cast("int")
    placed = balls.join(open_, "hub").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("s"), "blocks").cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = pairs.join(texts.select("s", "raw"), "s").select(
        "hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "s", "label", "raw")

    def run(batches):
        for rows in repeats.groups(batches, ("hub", "i", "j")):
            found = block_links(shingles(rows["raw"].to_pylist()), rows["label"].to_pylist())
            if found:
                s = rows["s"].to_numpy()
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(s[a]), pa.array(s[b])], ["a", "b"])

    placed = rows.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
    return placed.mapInArrow(run, "a long, b long")


def remaining_pairs(left, labels, marks, size=BALL):
    """Pairs (a, b) of different components in one signature's rest that sizes and parities don't rule out."""
    groups = left.groupBy("sig").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    placed = left.join(groups, "sig").join(labels.withColumnRenamed("node", "s"), "s", "left").withColumn("label", F.coalesce("label", "s"))
    placed = placed.join(marks, "s").withColumn("own", F.pmod(F.xxhash64("s"), "blocks").cast("int"))
    rows = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "s", "label", "n", "sketch")

    def near(rows):
        n, label, s = (rows[c].to_numpy() for c in ("n", "label", "s"))
        marks_ = rows["sketch"].to_pylist()
        short = min(map(len, marks_))
        x = np.stack([np.bitwise_xor.reduce(np.frombuffer(k, dtype=np.uint8).reshape(-1, short), axis=0) for k in marks_])
        for r in range(len(s) - 1):
            small, large = np.minimum(n[r], n[r + 1 :]), np.maximum(n[r], n[r + 1 :])
            at = np.flatnonzero((label[r + 1 :] != label[r]) & (10 * small >= 8 * large)) + r + 1
            if len(at):
                at = at[np.bitwise_count(x[at] ^ x[r]).sum(axis=1, dtype=np.int64) <= np.minimum(n[at], n[r]) // 4]
                yield from ((min(s[r], s[k]), max(s[r], s[k])) for k in at)

    def run(batches):
        found = set()
        for rows in repeats.groups(batches, ("sig", "i", "j")):
            found.update(near(rows))
            if len(found) > 10_000:  # signatures of one pair mostly repeat; what is left over, Spark merges
                yield pairs_batch(found)
                found = set()
        if found:
            yield pairs_batch(found)

    def pairs_batch(found):
        a, b = np.array(sorted(found), dtype=np.int64).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    placed = rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return placed.mapInArrow(run, "a long, b long").distinct()


def labelled_rows(docs, id_col="doc_id", text_col="text", rounds=ROUNDS):
    """(doc_id, k, n, s, label) of every row; rows of one component have one label."""
    spark = docs.sparkSession
    rows = repeats.binary_rows(docs, id_col, text_col)
    signed = stored(spark, signed_rows(rows), "signed-sets")
    nodes = stored(spark, signed.drop("sigs"), "sets")
    found = stored(spark, members(signed.select(F.explode("sigs").alias("sig"), "s")), "members")
    discard(signed)
    # One text per set that shares a signature, for the comparisons.
    needed = found.select("s").unionByName(found.select(F.col("hub").alias("s"))).distinct()
    reps = nodes.filter("n >= 4").groupBy("s").agg(F.min(F.struct("doc_id", "k")).alias("key")).join(needed, "s")
    texts = stored(spark, rows.join(reps, "key").dropDuplicates(["key"]).select("s", "raw"), "set-texts")
    marks = stored(spark, sketches(texts), "set-parities")
    left, links, labels, whole = found, None, None, None
    known, spent = None, []
    for turn in range(rounds):
        star = left.select(F.col("hub").alias("a"), F.col("s").alias("b")).distinct()
        hubs = star.select(F.col("a").alias("hub")).distinct()
        if known is not None:
            star = star.join(known.select("a", "b"), ["a", "b"], "left_anti")
        # What parities rule out is far from the hub, and needs no text.
        star = stored(spark, possible(star, marks, 0.4), "possible-pairs")
        near = stored(spark, verified(star, texts), "hub-pairs")
        discard(star)
        spent.append(near)
        known = near if known is None else known.unionByName(near)
        linked = known.filter("100 * both >= 80 * any").select("a", "b")
        # Within 0.6 of the hub in distance lies every link of a member within 0.4. Members that link with
        # the hub are in its component.
        ball = known.filter("10 * both >= 4 * any").select(F.col("a").alias("hub"), F.col("b").alias("s"), (100 * F.col("both") >= 80 * F.col("any")).alias("linked"))
        ball = ball.join(hubs, "hub", "left_semi")
        ball = ball.unionByName(ball.select("hub", F.col("hub").alias("s"), F.lit(True).alias("linked")).distinct())
        if labels is None:
            ball = ball.withColumn("label", F.when(F.col("linked"), F.col("hub")).otherwise(F.col("s")))
        else:
            ball = ball.join(labels.select(F.col("node").alias("s"), F.col("label").alias("own")), "s", "left")
            ball = ball.join(labels.select(F.col("node").alias("hub"), F.col("label").alias("its")), "hub", "left")
            ball = ball.withColumn("label", F.when(F.col("linked"), F.coalesce("its", "hub")).otherwise(F.coalesce("own", "s")))
        inside = ball_links(ball.select("hub", "s", "label"), texts)
        links = linked.unionByName(inside) if links is None else links.unionByName(linked).unionByName(inside)
        links = stored(spark, links.distinct(), "links")
        spent.append(links)
        if labels is None:
            labels = components(spark, links)
        by_s = labels.withColumnRenamed("node", "s")
        close = known.filter("10 * both >= 6 * any").select(F.col("a").alias("hub"), F.col("b").alias("s"))
        rest = left.join(close, ["hub", "s"], "left_anti").select("sig", "s")
        labelled = rest.join(by_s, "s", "left").withColumn("label", F.coalesce("label", "s"))
        open_ = labelled.groupBy("sig").agg(F.min("s").alias("hub"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
        before, whole = whole, stored(spark, rest.join(open_.select("sig", "hub"), "sig"), "rest")
        if before is not None:
            discard(before)
        left = whole.filter("s <> hub").select("sig", "hub", "s")
        if left.isEmpty():
            if turn:
                labels = components(spark, links)
            break
    else:
        pairs = remaining_pairs(whole.select("sig", "s"), labels, marks)
        pairs = pairs.join(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        last = verified(pairs, texts).filter("100 * both >= 80 * any").select("a", "b")
        links = stored(spark, links.unionByName(last), "links")
        spent.append(links)
        labels = components(spark, links)
    # The result reads the sets and the labels only.
    discard(found, texts, marks, whole, *spent)
    return nodes.join(labels.withColumnRenamed("node", "s"), "s", "left").withColumn("label", F.coalesce("label", "s"))


def jaccard_components(docs, id_col="doc_id", text_col="text", rounds=ROUNDS):
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links, own id included).

    Two rows link when their sets of five-word shingles (A-Z lower-cased; fewer words are one shingle) have a
    Jaccard similarity of at least 0.8. Rows without words, null texts too, link with nothing and are
    components of their own. Null ids take part; a component of null ids has a null number. Repeated rows link.
    Other columns are ignored.
    """
    placed = labelled_rows(docs, id_col, text_col, rounds)
    least = placed.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = placed.join(least, "label", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs, id_col="doc_id", text_col="text", rounds=ROUNDS):
    """The input rows, all columns: of every component the row with the smallest id, and all rows without words."""
    placed = labelled_rows(docs, id_col, text_col, rounds)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("k"))
    first = placed.filter("n > 0").groupBy("label").agg(F.min_by(F.struct("doc_id", "k"), order).alias("w")).select("w.*")
    return named_rows(docs, first.unionByName(placed.filter("n = 0").select("doc_id", "k")), id_col, text_col)
