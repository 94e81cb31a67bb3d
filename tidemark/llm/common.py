"""Helpers shared by the corpus operators."""

from pyspark.sql import functions as F

from tidemark.session import scratch_dir

BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# DuckDB SQL, (t, crc) of the texts t of a table. The crc32 register takes a byte at a time, each in eight steps.
CRC32_SQL = """
SELECT t, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * strlen(t), 2), lambda k: ('0x' || substr(hex(t), k, 2))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, _: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) AS crc FROM {table}
"""


def prepare(spark):
    """Bound what one Arrow batch holds, so that very long texts do not pile up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def documents(spark, sf_dir):
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def crc_mod(col, n):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def lower_ascii(col):
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def keyed(docs, id_col, text_col, id_name="doc_id"):
    """(doc_id, k, text): null texts are empty, ``k`` hashes the text.

    (doc_id, k) names a row by content, so repeated ids need no numbering: rows that agree in
    both are the same text and get the same result.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias(id_name), text.alias("text")).withColumn("k", F.xxhash64("text"))


def on_row(left, right, how):
    """Join on (doc_id, k); a null id equals a null id."""
    r = right.withColumnsRenamed({"doc_id": "_doc_id", "k": "_k"})
    joined = left.join(r, (left["k"] == r["_k"]) & left["doc_id"].eqNullSafe(r["_doc_id"]), how)
    return joined.drop("_doc_id", "_k")


def stored(spark, frame, label):
    """Write ``frame`` to the shared folder and read it back; cuts the lineage."""
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    table._scratch = path
    return table


def discard(*tables):
    """Remove tables that ``stored`` wrote and that nothing still to be computed reads."""
    for table in tables:
        if getattr(table, "_scratch", None):
            hadoop = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table._scratch)
            hadoop.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def unused(name, *columns):
    """A column name that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def named_rows(docs, winners, id_col, text_col):
    """The rows of ``docs``, all columns, that ``winners`` (doc_id, k) names; of repeated rows one."""

    def name(i, k):
        return F.concat(F.coalesce(i.cast("string"), F.lit("null")), F.lit(":"), k.cast("string"))

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    row = unused("_row", *docs.columns)
    rows = docs.withColumn(row, name(F.col(f"`{id_col}`"), F.xxhash64(text)))
    return rows.join(winners.select(name(F.col("doc_id"), F.col("k")).alias(row)), row, "left_semi").dropDuplicates([row]).drop(row)


def shared_folder(spark, label):
    return scratch_dir(spark, label)
