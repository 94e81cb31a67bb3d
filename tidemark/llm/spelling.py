"""Spelling variants: words one edit apart, by search schemes over FM-indexes of the delimited vocabulary.

An edit lies in one half of a word, so the other half matches exactly. Two searches cover all cases: match the left
half outward from the delimiter before the word and extend across the right one allowing one error, or the same from
the right. The pattern grows to the right on an index of the reversed words and to the left on one of the words
themselves; both keep it as an interval of suffix ranks, and a character narrows the interval by two rank queries.

Spark deals the vocabulary by exact half: a word goes where its own halves lead, and as an index entry also where those
of words one character shorter or longer do. Many halves share a block, and each block has an index of its own, of
some ``BLOCK`` words. A half with more words than that is spread over several blocks, which its queries all visit.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm.common import CRC32_SQL, lower_ascii, stored
from tidemark.llm.repeats import column, groups
from tidemark.session import broadcast_if_small

RUN = "[A-Za-zÀ-ÿ]+"
CUT, SHORTEST, LEAST, SHARE = 97, 5, 3, 2
BLOCK = 16_384
QUERIES = 4096


def words(docs, id_col="doc_id", text_col="text"):
    """(word, n) of every distinct word of at least SHORTEST code points and LEAST occurrences.

    A run of letters loses a code point where ``CUT`` divides the crc32 h of ``<id>:<run>``: the one at h modulo its length.
    """
    run = F.col("run")
    ident = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    runs = docs.select(ident.alias("id"), F.explode(F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.when(run.rlike("[A-Z]"), lower_ascii(run)).otherwise(run))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = h % F.length("run")
    cut = F.concat(F.substr("run", F.lit(1), at.cast("int")), F.substr("run", (at + 2).cast("int")))
    found = runs.select(F.when(h % CUT == 0, cut).otherwise(run).alias("word")).filter(F.length("word") >= SHORTEST)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST)


def halves(vocabulary):
    """(side, half, word, n, own): where a word is indexed; ``own`` where it is searched for as well."""
    size = F.length("word")
    lengths = [F.greatest(size + d, F.lit(SHORTEST)) for d in (-1, 0, 1)]
    left = F.array_distinct(F.array(*[F.floor(q / 2) for q in lengths]))
    right = F.array_distinct(F.array(*[F.ceil(q / 2) for q in lengths]))
    sides = [
        F.transform(left, lambda k: F.struct(F.lit(0).alias("side"), F.substr("word", F.lit(1), k.cast("int")).alias("half"), (k == F.floor(size / 2)).alias("own"))),
        F.transform(right, lambda k: F.struct(F.lit(1).alias("side"), F.substr("word", (size - k + 1).cast("int")).alias("half"), (k == F.ceil(size / 2)).alias("own"))),
    ]
    return vocabulary.select("word", "n", F.explode(F.concat(*sides)).alias("_h")).select("_h.side", "_h.half", "word", "n", "_h.own")


def dealt(vocabulary, block=BLOCK):
    """(block, side, word, n, indexed, asked): the entries and queries of every block; ``block`` entries on average."""
    spark = vocabulary.sparkSession
    rows = halves(vocabulary)
    sizes = stored(spark, rows.groupBy("side", "half").agg(F.count(F.lit(1)).alias("size")), "halves")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // block))
    # A half is spread only if it fills a block: there are at most total / block such halves.
    wide = sizes.filter(F.col("size") > block).select("side", "half", F.ceil(F.col("size") / block).cast("int").alias("parts"))
    rows = rows.join(broadcast_if_small(wide), ["side", "half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("word"), "parts").cast("int")
    visits = F.when(F.col("own"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(mine))
    rows = rows.withColumn("part", F.explode(visits))
    place = F.pmod(F.xxhash64("side", "half", "part"), F.lit(blocks)) * 2 + F.col("side")
    return rows.select(place.alias("block"), "side", "word", "n", (F.col("part") == mine).alias("indexed"), F.col("own").alias("asked"))


class Index:
    """FM-index of cyclic text ``$w1$w2...``; an interval [low, high) of its sorted rotations stands for a pattern."""

    def __init__(self, symbols, sizes):
        """``symbols``: the words' symbols, from 1, joined; ``sizes``: symbols per word. Words are distinct."""
        ends = np.cumsum(sizes)
        text = np.insert(symbols, np.concatenate(([0], ends[:-1])), 0)
        self.length, self.kinds = len(text), int(text.max(initial=0)) + 1
        key, step = text.astype(np.int64), 0
        while True:  # prefix doubling: rotations in the order of their first 1, 2, 4, ... symbols
            order = np.argsort(key, kind="stable")
            rank = np.empty_like(key)
            rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
            if rank[order[-1]] == self.length - 1:
                break
            step = step * 2 or 1
            key = rank * self.length + np.roll(rank, -step)
        self.rotations = order
        self.last = text[order - 1]
        self.by_symbol = self.last.astype(np.int64) * (self.length + 1) + np.arange(self.length)
        self.by_symbol.sort()
        self.word_of = np.cumsum(text == 0) - 1

    def narrowed(self, symbol, low, high):
        """The intervals of ``symbol`` put before the patterns of [low, high)."""
        base = symbol * (self.length + 1)
        return np.searchsorted(self.by_symbol, base + low), np.searchsorted(self.by_symbol, base + high)

    def before(self, low, high):
        """(i, symbol): symbols other than the delimiter that occur before the pattern of interval i, each once or with gaps of none."""
        size = high - low
        few = size <= self.kinds
        i = np.flatnonzero(few)
        owner = np.repeat(i, size[i])
        rows = np.arange(len(owner)) - np.repeat(np.cumsum(size[i]) - size[i], size[i]) + low[owner]
        seen = np.unique(owner * self.kinds + self.last[rows])
        i = np.flatnonzero(~few)  # wide intervals: try every symbol
        every = (i[:, None] * self.kinds + np.arange(self.kinds)).ravel()
        seen = np.concatenate((seen, every))
        owner, symbol = seen // self.kinds, seen % self.kinds
        keep = symbol > 0
        return owner[keep], symbol[keep]


def near_pairs(index, patterns, exact):
    """(query, word) numbers at distance one: rows of ``patterns`` (symbols outward, 0 after the end), ``exact`` of which match as they are."""
    many, width = patterns.shape
    size = (patterns > 0).sum(axis=1)
    q = np.arange(many)
    low, high = index.narrowed(np.zeros(many, np.int64), np.zeros(many, np.int64), np.full(many, index.length))
    out = []

    def finish(q, at, low, high):
        """Match what is left as it is, and the delimiter after it."""
        while len(q):
            live = low < high
            q, at, low, high = q[live], at[live], low[live], high[live]
            done = at > size[q]
            if done.any():
                out.append(np.stack((q[done], index.word_of[index.rotations[low[done]]])))
                q, at, low, high = q[~done], at[~done], low[~done], high[~done]
            low, high = index.narrowed(patterns[q, at], low, high)
            at = at + 1

    for at in range(width):
        free = (at >= exact[q]) & (at <= size[q])
        w, lo, hi = q[free], low[free], high[free]
        if len(w):
            now, after = patterns[w, at], patterns[w, np.minimum(at + 1, width - 1)]
            # Leave out: of equal neighbours the last.
            gone = (now > 0) & (after != now)
            finish(w[gone], np.full(gone.sum(), at + 1), lo[gone], hi[gone])
            owner, symbol = index.before(lo, hi)
            differs = symbol != now[owner]
            owner, symbol = owner[differs], symbol[differs]
            a, b = index.narrowed(symbol, lo[owner], hi[owner])
            other = now[owner] > 0
            finish(w[owner[other]], np.full(other.sum(), at + 1), a[other], b[other])  # replaced
            finish(w[owner], np.full(len(owner), at), a, b)  # put in
        q_, low, high = q, *index.narrowed(patterns[q, at], low, high)
        live = (low < high) & (at < size[q_])
        q, low, high = q_[live], low[live], high[live]
        if not len(q):
            break
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)


def block_pairs(side, spelled, indexed, asked):
    """(query, word) row numbers of a block's rows that are near."""
    raw = [np.frombuffer(w.encode("utf-32-le"), dtype=np.uint32) for w in spelled]
    letters = np.unique(np.concatenate(raw))
    coded = [np.searchsorted(letters, w if side == 0 else w[::-1]) + 1 for w in raw]  # outward from the exact half
    entries = np.flatnonzero(indexed)
    index = Index(np.concatenate([coded[i][::-1] for i in entries]), np.array([len(coded[i]) for i in entries]))
    wanted = np.flatnonzero(asked)
    for at in range(0, len(wanted), QUERIES):
        some = wanted[at : at + QUERIES]
        sizes = np.array([len(coded[i]) for i in some])
        patterns = np.zeros((len(some), sizes.max() + 1), dtype=np.int64)
        patterns[np.arange(patterns.shape[1]) < sizes[:, None]] = np.concatenate([coded[i] for i in some])
        exact = sizes // 2 if side == 0 else sizes - sizes // 2
        found = near_pairs(index, patterns, exact)
        found = np.unique(found[0] * len(entries) + found[1])
        yield some[found // len(entries)], entries[found % len(entries)]


def near_words(vocabulary, block=BLOCK):
    """(word, near, n_of): every ordered pair of near words, some twice."""

    def run(batches):
        for table in groups(batches, ("block",)):
            # Two halves of a word may share a block.
            coded = table["word"].combine_chunks().dictionary_encode()
            at, spelled = coded.indices.to_numpy(), coded.dictionary
            n = np.zeros(len(spelled), dtype=np.int64)
            n[at] = table["n"].to_numpy()
            indexed, asked = (np.bincount(at, table[c].to_numpy(), len(spelled)) > 0 for c in ("indexed", "asked"))
            if indexed.any():
                for a, b in block_pairs(table["side"][0].as_py(), spelled.to_pylist(), indexed, asked):
                    yield pa.RecordBatch.from_arrays([spelled.take(pa.array(a)), spelled.take(pa.array(b)), pa.array(n[b])], ["word", "near", "n_of"])

    placed = dealt(vocabulary, block).repartition("block").sortWithinPartitions("block")
    return placed.mapInArrow(run, "word string, near string, n_of long")


def roots(spark, links):
    """(word, root) of every word with a form: forms followed to the last, each round twice as far.

    A form occurs at least twice as often as its word, so no chain has 64 links.
    """
    up = stored(spark, links, "forms")
    for _ in range(7):
        on = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        up = stored(spark, up.drop("moved").join(on, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "forms")
        if up.filter("moved").isEmpty():
            break
    return up.select("word", "root")


def variants(docs, id_col="doc_id", text_col="text", block=BLOCK):
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word (one code point inserted, deleted or replaced) with the largest n, of equal ones the
    first by code points, if it occurs at least twice as often; else null, and ``root`` is the word itself.
    Null and empty texts have no words; a null id counts as an empty one. Repeated rows count every time. Other columns
    are ignored; without words there are no rows.
    """
    spark = docs.sparkSession
    vocabulary = stored(spark, words(docs, id_col, text_col), "words")
    # A word has at most some 2 * length + 1 neighbours per letter.
    near = near_words(vocabulary, block).groupBy("word").agg(F.collect_set(F.struct((-F.col("n_of")).alias("m"), "near")).alias("all"))
    near = near.select("word", F.size("all").cast("long").alias("n_near"), F.array_min("all").alias("best"))
    found = vocabulary.join(near, "word", "left")
    takes = -F.col("best.m") >= SHARE * F.col("n")
    found = found.select(
        "word", F.when(takes, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, -F.col("best.m")).alias("form_n"))
    found = stored(spark, found, "near-words")
    ends = roots(spark, found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '{RUN}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
each AS (SELECT id || ':' || w AS t, w, count(*) AS n FROM runs GROUP BY ALL),
crcs AS ({CRC32_SQL.format(table="each")}),
typed AS (SELECT CASE WHEN crc % {CUT} = 0 THEN substr(w, 1, crc % length(w)) || substr(w, crc % length(w) + 2) ELSE w END AS word, n FROM each JOIN crcs USING (t)),
words AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {LEAST}),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS m FROM cuts a JOIN cuts b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.d = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY m DESC, near) AS near, max(m) AS m FROM pairs GROUP BY word),
forms AS (SELECT w.word, CASE WHEN m >= {SHARE} * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {SHARE} * n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)),
chains AS (SELECT word, word AS root, form FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chains c JOIN forms f ON f.word = c.form)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chains c ON c.word = f.word AND c.form IS NULL
"""
