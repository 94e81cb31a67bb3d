"""The training-data pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Every stage works on all rows its predecessor kept. All but the last return the columns of ``documents``.
"""

from tidemark.llm import bpe, decontaminate, exact_dedup, jaccard_join, language_id
from tidemark.llm.common import prepare, stored


def language_stage(spark, docs, sf_dir):
    """Language identification: rows without a recognisable language go."""
    prepare(spark)
    return language_id.recognised(docs, language_id.fit(docs, language_id.held_out()))


def exact_stage(spark, docs, sf_dir):
    """Exact dedup: of equal texts (A-Z lower-cased) the row with the largest id stays."""
    return exact_dedup.kept_rows(docs, exact_dedup.exact_dedup(docs))


def near_stage(spark, docs, sf_dir):
    """N-gram Jaccard join: of every group of near copies the row with the smallest id stays."""
    prepare(spark)
    return jaccard_join.one_of_each(docs)


def benchmark_stage(spark, docs, sf_dir):
    """Benchmark decontamination: rows that hold at least half of a test item go."""
    prepare(spark)
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark, docs, sf_dir):
    """Byte-level BPE of every text: number and digest of its ids, digest of the decoded bytes."""
    prepare(spark)
    return bpe.encode_digests(docs)


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE encoding and decoding", encode_stage),
]

# Languages, tilings and BPE can't be expressed in SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
