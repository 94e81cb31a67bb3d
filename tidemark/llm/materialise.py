"""Training-order materialisation: token ids of all texts as fixed-stride binary shards in a keyed order.

The token ids of the texts, ordered by a hash of id and text, form one stream, each text closed by an end mark; the
stream is cut into sequences of equal length. A Feistel permutation of the sequence numbers, walked along its cycle
until it stays in range, gives every sequence a slot; range partitions of the slots write the shards. The shards
depend on rows, key and parameters alone, not on how Spark partitions anything.
"""

import hashlib
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.repeats import column

SEQUENCE = 1024
SHARD_SEQUENCES = 4096
ROUNDS = 6
CHANGED = "the input changed between two scans; write it to a table first"


def pack(raw):
    """Bytes of ids on their way through a shuffle."""
    return pa.Codec("zstd", compression_level=6).compress(raw, asbytes=True)


def unpack(packed, size):
    return pa.Codec("zstd").decompress(packed, size, asbytes=True)


def _mix(x, key):
    x = (x ^ key) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def round_keys(key, rounds=ROUNDS):
    return [int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "big") for r in range(rounds)]


def _steps(x, keys, half, backwards):
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for k in reversed(keys) if backwards else keys:
        k = np.uint64(k)
        if backwards:
            left, right = right ^ (_mix(left, k) & mask), left
        else:
            left, right = right, left ^ (_mix(right, k) & mask)
    return (left << np.uint64(half)) | right


def permute(x, n, key, backwards=False, rounds=ROUNDS):
    """A keyed permutation of 0..n-1, or its inverse: balanced Feistel rounds on the next even number of bits,
    repeated for values out of range until they fall below ``n`` (fewer than four walks on average)."""
    out = np.asarray(x, dtype=np.uint64).copy()
    half = max(1, (max(int(n) - 1, 1).bit_length() + 1) // 2)
    keys = round_keys(key, rounds)
    todo = np.arange(len(out))
    while len(todo):
        out[todo] = _steps(out[todo], keys, half, backwards)
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def file_system(uri):
    """(file system, path) of a folder: local, HDFS or an object store, by its scheme."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri.removeprefix("file:"))


def qualified(spark, folder):
    """The folder with the scheme that Spark gives a path without one, so tasks and Spark mean the same store."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def token_type(vocabulary):
    """(numpy type, end mark, fill mark): the two ids after the vocabulary are the marks."""
    return np.dtype("<u2" if vocabulary + 2 <= 1 << 16 else "<u4"), vocabulary, vocabulary + 1


def token_rows(docs, ranks, kind, end, bits, id_col, text_col):
    """(k, n, ids, bucket): the packed ids of every text with the end mark. ``k`` orders the texts, its first ``bits`` are the bucket."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.xxhash64(F.col(f"`{id_col}`"), text).alias("k"), text.alias("text"))

    def run(batches):
        encoding = bpe.load_encoding(*ranks.value)
        for b in batches:
            ids = [np.array(bpe.encode_text(encoding, t) + [end], dtype=kind) for t in column(b, "text").to_pylist()]
            packed = [pack(i.tobytes()) for i in ids]
            yield pa.RecordBatch.from_arrays([column(b, "k"), pa.array([len(i) for i in ids], pa.int64()), pa.array(packed, pa.binary())], ["k", "n", "ids"])

    bucket = (F.shiftright("k", 64 - bits) + (1 << (bits - 1))).cast("int")
    return rows.mapInArrow(run, "k long, n long, ids binary").withColumn("bucket", bucket).filter("bucket is not null")


def bucket_bases(dealt):
    """(bucket, base, size, total): where every bucket's tokens lie in the stream; one row per bucket, whatever the corpus.

    All columns of ``dealt`` are used, and its bucket is known to be set, so that Spark finds the same exchange here and
    where the tokens are cut, and encodes once.
    """
    sums = dealt.groupBy("bucket").agg(F.sum("n").alias("size"), F.max("k").alias("k"), F.max(F.octet_length("ids")).alias("longest"))
    sums = sums.filter("k is not null and longest > 0")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("size").over(before), F.lit(0))
    return sums.select("bucket", base.alias("base"), "size", F.sum("size").over(Window.partitionBy()).alias("total"))


def pieces(ordered, length, kind, key):
    """(slot, sequence, sequences, at, n, ids) of the stretch of each sequence that a bucket gives, from texts in order within it."""
    schema = "slot long, sequence long, sequences long, at int, n int, ids binary"
    width = kind.itemsize

    def run(batches):
        at = own = close = sequences = None
        held, done = bytearray(), []

        def cut():
            """The ids held since the last cut end at ``at``."""
            if held:
                n = len(held) // width
                done.append((*divmod(at - n, length), n, pack(bytes(held))))
                held.clear()

        def settle():
            cut()
            if at != close:
                raise ValueError(CHANGED)

        def result():
            seq, offset, n, packed = zip(*done)
            done.clear()
            seq = np.array(seq, dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(permute(seq, sequences, key)), pa.array(seq), pa.array(np.full(len(seq), sequences)),
                 pa.array(offset, pa.int32()), pa.array(n, pa.int32()), pa.array(packed, pa.binary())],
                ["slot", "sequence", "sequences", "at", "n", "ids"])

        for b in batches:
            if b.num_rows:
                sequences = -(-column(b, "total")[0].as_py() // length)
            names = ["bucket", "n", "ids", "base", "size"]
            for bucket, n, packed, base, size in zip(*(column(b, c).to_pylist() for c in names)):
                if bucket != own:
                    settle()
                    own, at, close = bucket, base, base + size
                raw = unpack(packed, n * width)
                i = 0
                while i < n:
                    take = min(length - at % length, n - i)
                    held += raw[i * width : (i + take) * width]
                    i += take
                    at += take
                    if at % length == 0:
                        cut()
            if done:
                yield result()
        settle()
        if done:
            yield result()

    return ordered.select("bucket", "n", "ids", "base", "size", "total").mapInArrow(run, schema)


def write_shards(spread, folder, length, per_shard, kind, fill):
    """Write the shards of every range partition; rows (slot, sequence, shard, offset, n_tokens, tokens_sha256).

    A shard is written under a name of its own and then renamed, so a repeated or lost task leaves whole files
    only, with the same content.
    """

    def run(batches):
        shard = out = temporary = None
        fs, root = file_system(folder)
        slot, seq, row = None, None, bytearray()
        done = []

        def close():
            nonlocal out
            if out is not None:
                out.close()
                fs.move(temporary, f"{root}/shard-{shard:08d}.bin")
                out = None

        def finish():
            nonlocal shard, out, temporary
            if slot is None:
                return
            s = slot // per_shard
            if s != shard:
                close()
                shard = s
                temporary = f"{root}/.{s:08d}-{uuid.uuid4().hex}"
                out = fs.open_output_stream(temporary)
            used = len(row) // kind.itemsize
            full = bytes(row) + np.full(length - used, fill, dtype=kind).tobytes()
            out.write(full)
            done.append((slot, seq, s, (slot - s * per_shard) * len(full), used, hashlib.sha256(full).hexdigest()))

        def result():
            cols = list(zip(*done)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              ["slot", "sequence", "shard", "offset", "n_tokens", "tokens_sha256"])

        for b in batches:
            for x, q, used, cut in zip(*(column(b, c).to_pylist() for c in ("slot", "sequence", "n", "ids"))):
                if x != slot:
                    finish()
                    slot, seq, row = x, q, bytearray()
                row += unpack(cut, used * kind.itemsize)
            if done:
                yield result()
        finish()
        close()
        if done:
            yield result()

    return spread.mapInArrow(run, "slot long, sequence long, shard long, offset long, n_tokens int, tokens_sha256 string")


def materialise(docs, folder, key="order", length=SEQUENCE, per_shard=SHARD_SEQUENCES, rank_path=bpe.RANKS,
                pattern=public_tokenizers.PATTERN, id_col="doc_id", text_col="text"):
    """Write all sequences in training order and return one row per sequence.

    slot (place in the order), sequence (place in the stream), shard and byte offset in it, n_tokens (fill marks
    excluded; only the last sequence may be short) and the digest of its bytes. Tokens are the ids of byte-level BPE
    (see bpe.py), little-endian, two bytes each if the vocabulary and two marks fit, else four. Every text, also a null
    or empty one, ends with the first id after the vocabulary; the second one fills the last sequence. ``docs`` must
    give the same rows when a lost task scans them again (a table does; counts are compared). Texts follow
    each other by a hash of id and text, ties by their ids; rows that repeat both are interchangeable and each
    give a text. Other columns are ignored, an empty table writes nothing.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    fs, root = file_system(folder)
    fs.create_dir(root, recursive=True)
    ranks = bpe._frames(rank_path, pattern, spark)
    kind, end, fill = token_type(bpe.load_encoding(*ranks.value).n_vocab)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(20, max(1, (partitions - 1).bit_length()))
    dealt = token_rows(docs, ranks, kind, end, bits, id_col, text_col).repartitionById(1 << bits, "bucket")
    placed = dealt.join(F.broadcast(bucket_bases(dealt)), "bucket")  # at most 2 ** 20 rows
    cut = pieces(placed.sortWithinPartitions("bucket", "k", "ids"), length, kind, key)
    shards = F.ceil(F.col("sequences") / per_shard)
    part = F.floor(F.floor(F.col("slot") / per_shard) * partitions / shards).cast("int")
    spread = cut.withColumn("part", part).repartitionById(partitions, "part").sortWithinPartitions("slot", "at")
    return write_shards(spread.select("slot", "sequence", "n", "ids"), folder, length, per_shard, kind, fill)


def read_from(folder, slot, count, length=SEQUENCE, per_shard=SHARD_SEQUENCES, kind=np.dtype("<u2")):
    """Resume: the ids of ``count`` sequences from ``slot`` on, by seeking at multiples of the stride."""
    fs, root = file_system(folder)
    stride = length * kind.itemsize
    out = []
    while count > 0:
        shard, row = divmod(slot, per_shard)
        take = min(count, per_shard - row)
        with fs.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
            f.seek(row * stride)
            block = f.read(take * stride)
        out += [np.frombuffer(block[i : i + stride], dtype=kind) for i in range(0, len(block), stride)]
        if len(block) < take * stride:
            break
        slot, count = slot + take, count - take
    return out
