"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

A text is cut at safe boundaries before encoding, so one call never sees more than about
``piece_chars`` characters: between two characters that no match of the split pattern spans,
with a left side whose last match ends there whatever follows. Ids are those of the whole text.
"""

import base64
import hashlib

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import functions as F

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_CHARS = 1 << 16
# No match holds a letter, digit or mark followed by white space: cut between them. The characters
# U+001C-U+001F are left alone, since engines disagree on whether they are white space.
CUT = regex.compile(r"(?<=[\p{L}\p{N}\p{P}\p{S}])(?=[ \n])")
# Without such a place: after a letter or number and before one of the other kind.
CUT_CLASS = regex.compile(r"(?<=\p{L})(?=[\p{N}\p{P}])|(?<=\p{N})(?=[\p{L}\p{P}])")

ENCODED = "doc_id long, n_tokens long, ids array<int>, decoded binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"

_encodings = {}


def load_encoding(rank_bytes, pattern):
    """The tiktoken encoding for the bytes of a rank file; kept per worker."""
    import tiktoken

    key = (hashlib.sha256(rank_bytes).digest(), pattern)
    if key not in _encodings:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_bytes.splitlines() if line)}
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def pieces(text, size=PIECE_CHARS):
    """Cut ``text`` at safe boundaries into pieces of ``size`` characters or a little more."""
    at = 0
    while len(text) - at > size:
        cut = CUT.search(text, at + size, min(len(text), at + 2 * size))
        cut = cut or CUT_CLASS.search(text, at + size) or CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(encoding, text, size=PIECE_CHARS):
    if len(text) <= size:
        return encoding.encode_ordinary(text)
    ids = []
    for piece in pieces(text, size):
        ids += encoding.encode_ordinary(piece)
    return ids


def _frames(rank_path, pattern, spark):
    """A broadcast of the rank file: its size is that of one vocabulary, whatever the corpus."""
    with open(rank_path, "rb") as f:
        return spark.sparkContext.broadcast((f.read(), pattern))


def _input(docs, id_col, text_col):
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))


def encode(docs, rank_path=RANKS, pattern=public_tokenizers.PATTERN, id_col="doc_id", text_col="text"):
    """One row per document: ids and the bytes they decode to. A null or empty text has no ids.

    No shuffle; rows with equal or null ids are encoded one by one; other columns are ignored.
    """
    ranks = _frames(rank_path, pattern, docs.sparkSession)

    def run(batches):
        encoding = load_encoding(*ranks.value)
        for b in batches:
            ids = [encode_text(encoding, t) for t in b["text"]]
            yield pd.DataFrame({
                "doc_id": b["doc_id"].astype("Int64"), "n_tokens": [len(i) for i in ids], "ids": ids,
                "decoded": [encoding.decode_bytes(i) for i in ids],
            })

    return _input(docs, id_col, text_col).mapInPandas(run, ENCODED)


def encode_digests(docs, rank_path=RANKS, pattern=public_tokenizers.PATTERN, id_col="doc_id", text_col="text"):
    """As ``encode``, with SHA-256 of the comma-joined ids and of the decoded bytes in their place.

    ``n_bytes`` is the length of the decoded bytes. Ids never leave the worker.
    """
    ranks = _frames(rank_path, pattern, docs.sparkSession)

    def run(batches):
        encoding = load_encoding(*ranks.value)
        names = [str(i) for i in range(encoding.n_vocab + 1)]
        for b in batches:
            rows = []
            for text in b["text"]:
                ids = encode_text(encoding, text)
                raw = encoding.decode_bytes(ids)
                joined = ",".join([names[i] for i in ids]).encode()
                rows.append((len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(raw).hexdigest(), len(raw)))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"])
            out.insert(0, "doc_id", b["doc_id"].astype("Int64"))
            yield out

    return _input(docs, id_col, text_col).mapInPandas(run, DIGESTS)
