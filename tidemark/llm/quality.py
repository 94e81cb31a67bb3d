"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from hashed byte n-grams by a small
learned layer, a gated attention weighs the passages, and the weighted sum is scored. Only
documents carry labels. The network is fitted on a bounded sample of labelled rows (``sample_rows``),
of each at most ``BAG_PASSAGES`` passages spread over the whole text; scoring covers every passage of every text.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod
from tidemark.llm.ngrams import counts, scaled, slices

DIM = 1024
ORDERS = (1, 2, 3)
PASSAGE = 512
HIDDEN, GATE = 24, 12
SAMPLE_ROWS = 2000
BAG_PASSAGES = 64


def passages(texts):
    """(rows of scaled counts, owner): one row per passage of 512 bytes, in slices."""
    raws = [(t or "").encode() for t in texts]
    for group in slices(raws):
        x, owner = counts([p for _, p in group], DIM, ORDERS, PASSAGE)
        yield x, np.array([i for i, _ in group])[owner]


def bags_of(texts, most=BAG_PASSAGES):
    """Counts of at most ``most`` passages of every text as bytes of 16-bit numbers, spread evenly by multiples of the golden ratio."""
    bags, seen = {i: [] for i in range(len(texts))}, [0] * len(texts)
    for x, owner in passages(texts):
        for i in np.unique(owner):
            own = x[owner == i]
            ranks = (np.arange(seen[i], seen[i] + len(own), dtype=np.uint64) * np.uint64(2654435769)) % np.uint64(1 << 32)
            seen[i] += len(own)
            few = np.argsort(ranks)[:most]
            bags[i] = sorted(bags[i] + [(int(ranks[j]), own[j].astype(np.uint16).tobytes()) for j in few])[:most]
    return [b"".join(row for _, row in bags[i]) for i in range(len(texts))]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def start(rng):
    def layer(a, b):
        return (rng.standard_normal((a, b)) * np.sqrt(2 / a)).astype(np.float32)

    p = {"W": layer(DIM, HIDDEN) * 4, "b": np.zeros(HIDDEN, np.float32), "V": layer(HIDDEN, GATE), "U": layer(HIDDEN, GATE)}
    return {**p, "w": layer(GATE, 1)[:, 0], "c": layer(HIDDEN, 1)[:, 0], "d": np.zeros(1, np.float32)}


def encode(x, p):
    return np.maximum(x @ p["W"] + p["b"], 0)


def pool(h, bag, n, p):
    """Gated attention over the passages of each of ``n`` bags; ``bag`` ascends."""
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    top = np.full(n, -np.inf)
    np.maximum.at(top, bag, e)
    a = np.exp(e - top[bag])
    a = (a / np.bincount(bag, a, n)[bag]).astype(np.float32)
    z = np.zeros((n, h.shape[1]), dtype=np.float32)
    np.add.at(z, bag, a[:, None] * h)
    return t, g, a, z


def gradients(x, bag, y, weight, p):
    """Gradients of the weighted log loss."""
    n = len(y)
    h = encode(x, p)
    t, g, a, z = pool(h, bag, n, p)
    dlogit = ((_sigmoid(z @ p["c"] + p["d"]) - y) * weight / weight.sum()).astype(np.float32)
    dz = dlogit[:, None] * p["c"]
    through = np.einsum("ij,ij->i", dz[bag], h)
    mean = np.bincount(bag, a * through, n)
    de = a * (through - mean[bag]).astype(np.float32)
    gate = de[:, None] * p["w"]
    dt, dg = gate * g * (1 - t * t), gate * t * g * (1 - g)
    dh = (a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (h > 0)
    return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ dlogit, "d": np.array([dlogit.sum()])}


def train(bags, y, weight, epochs=16, batch=48, rate=0.01, decay=1e-4, seed=7):
    """Adam over mini-batches of bags (arrays of passage rows)."""
    rng = np.random.default_rng(seed)
    p = start(rng)
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            x = scaled(np.concatenate([bags[i] for i in pick]).astype(np.float32))
            bag = np.repeat(np.arange(len(pick)), [len(bags[i]) for i in pick])
            grad = gradients(x, bag, y[pick], weight[pick], p)
            step += 1
            for k in p:
                gk = grad[k] + decay * p[k]
                m1[k] = 0.9 * m1[k] + 0.1 * gk
                m2[k] = 0.999 * m2[k] + 0.001 * gk * gk
                now = rate * (1 - epoch / epochs)
                p[k] = (p[k] - now * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def score_texts(texts, p):
    """Scores of a list of strings or None; an empty text is a bag of one empty passage."""
    if p is None:
        return np.full(len(texts), 0.5)
    hs, owners = [], []
    for x, owner in passages(texts):
        hs.append(encode(scaled(x), p))
        owners.append(owner)
    *_, z = pool(np.concatenate(hs), np.concatenate(owners), len(texts), p)
    return _sigmoid((z @ p["c"] + p["d"]).astype(np.float64))


def training_sample(docs, labels, held_out, sample_rows, id_col, text_col, label_col):
    """(bags, labels, weights) of at most ``sample_rows`` labelled documents, half per class where possible."""
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"), held_out.alias("out"))
    usable = usable.filter("y in (0, 1) and id is not null and not out").withColumn("rank", F.xxhash64("id"))
    sizes = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    if not sizes:
        return [], np.zeros(0), np.zeros(0)
    each = sample_rows // len(sizes)
    share = F.when(F.col("y") == 1, min(1.0, each / max(sizes.get(1, 0), 1))).otherwise(min(1.0, each / max(sizes.get(0, 0), 1)))
    few = usable.filter(F.pmod("rank", F.lit(1_000_000)) < share * 1_000_000).orderBy("rank", "y").limit(sample_rows)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "x": bags_of(list(b["text"]))})

    # at most sample_rows pairs of numbers are broadcast
    got = rows.join(F.broadcast(few.select("id", "y")), "id").select("id", "y", "text").mapInPandas(run, f"id {id_type}, y int, x binary")
    got = got.toPandas().sort_values(["id", "y", "x"])
    y = got["y"].to_numpy(dtype=np.float32)
    bags = [np.frombuffer(x, dtype=np.uint16).reshape(-1, DIM) for x in got["x"]]
    weight = np.array([sizes[int(v)] / max((y == v).sum(), 1) for v in y], dtype=np.float32)
    return bags, y, weight


def fit(docs, labels, held_out, sample_rows=SAMPLE_ROWS, id_col="doc_id", text_col="text", label_col="quality"):
    """The fitted weights, or None without labelled documents."""
    bags, y, weight = training_sample(docs, labels, held_out, sample_rows, id_col, text_col, label_col)
    return train(bags, y, weight) if len(bags) else None


def score(docs, p, threshold=0.3, id_col="doc_id", text_col="text", also=()):
    """doc_id, score, predicted and the columns ``also`` of every row, without a shuffle.

    Null texts count as empty; without a model every score is 0.5. Rows with equal ids are scored one
    by one and other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(p)  # a fixed number of weights
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *also)
    kept = [c for c in rows.columns if c != "text"]
    schema = rows.select(*kept).schema.add("score", "double").add("predicted", "integer")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            s = score_texts(b.column(b.schema.get_field_index("text")).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [*b.select(kept).columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())],
                [*kept, "score", "predicted"],
            )

    return rows.mapInArrow(run, schema)


def predict(docs, labels, modulus=5, remainder=0):
    """Fit on labelled documents outside the held-out fold and score all documents."""
    out = F.coalesce(crc_mod("doc_id", modulus) == remainder, F.lit(False))
    p = fit(docs, labels, out)
    return score(docs, p, also=[out.alias("held_out")]).select("doc_id", "held_out", "score", "predicted")
