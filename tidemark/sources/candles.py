"""Candle files in, partitioned tables, files and reports out."""

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.symbols import safe_name
from tidemark.functions.timeframes import TIMEFRAME_SECONDS
from tidemark.operators.stats import collection_report
from tidemark.schemas import CANDLE_FILE, REQUIRED_FILE_COLUMNS

QUARANTINE = "line string, file string, reason string"


def _text_schema(columns):
    # Text first: whether a line parses must not depend on the columns a query happens to read.
    return T.StructType([T.StructField(c, T.StringType(), True) for c in (*columns, "_corrupt")])


def _open(uri):
    """A byte stream of a file by its URI, in an executor; local, HDFS and object stores."""
    from pyarrow import fs

    if "://" not in uri:
        return fs.LocalFileSystem().open_input_stream(uri.removeprefix("file:"))
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path)


def _header_line(uri, most=1 << 20):
    with _open(uri) as f:
        head = b""
        while b"\n" not in head and len(head) < most and (more := f.read(4096)):
            head += more
    return head.split(b"\n")[0].decode("utf-8-sig", "replace").rstrip("\r")


def file_headers(spark: SparkSession, path) -> DataFrame:
    """(file, header): the first line of every CSV file, read in executors; nothing else of it is read.

    Where the executors' Python cannot open the store, Spark's text reader finds the first lines instead.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")

    def read(batches):
        for b in batches:
            lines = []
            for uri in b["path"]:
                try:
                    lines.append(_header_line(uri))
                except (ValueError, OSError):
                    lines.append(None)
            yield b.assign(header=lines).rename(columns={"path": "file"})

    found = listed.repartition("path").mapInPandas(read, "file string, header string")
    if found.where("header IS NULL").isEmpty():
        return found
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path)
    place = F.struct(F.input_file_block_start(), F.monotonically_increasing_id())
    first = lines.select(F.col("_metadata.file_path").alias("file"), "value", place.alias("at"))
    return first.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def header_columns(line: str) -> tuple:
    """Column names of a header line: CSV quoting, no byte order mark, no blanks around names."""
    names = next(csv.reader([line.lstrip("\ufeff")], skipinitialspace=True), [])
    return tuple(n.strip() for n in names)


def file_layouts(spark: SparkSession, path, required) -> tuple:
    """({columns: files}, [(header, file, reason)]): usable files by header, and the others.

    The driver gets one row per file, as many as Spark's own file index holds.
    """
    usable, unusable = {}, []
    for file, line in file_headers(spark, path).toLocalIterator():
        columns = header_columns(line or "")
        lacking = [c for c in required if c not in columns]
        if not any(columns):
            unusable.append((line, file, "no header"))
        elif lacking:
            unusable.append((line, file, "missing columns " + ", ".join(lacking)))
        elif len(set(columns)) < len(columns) or "" in columns:
            unusable.append((line, file, "repeated or empty column names"))
        else:
            usable.setdefault(columns, []).append(file)
    return usable, unusable


def read_candle_csv(
    spark: SparkSession, path, columns=None, timeframe: str = "1h", need_symbol: bool = True
):
    """(rows, quarantined lines) of all candle CSV files under ``path``.

    With ``columns`` every file must have exactly this header: one pass, checked
    by the reader. Without it the first line of every file is looked up first. Quarantined
    are bad lines and, by their header, the files that lack a required column, each with a
    reason. The symbol is the row's own, else the
    file name without its ending; the timeframe is the row's own, else one
    written in the file name between underscores, else ``timeframe``.
    """
    required = [c for c in REQUIRED_FILE_COLUMNS if need_symbol or c != "symbol"]
    skipped = []
    if columns is not None:
        layouts = {tuple(columns): [path] if isinstance(path, str) else list(path)}
        lacking = [c for c in required if c not in columns]
        if lacking:
            raise ValueError(f"missing columns {lacking}")
    else:
        layouts, skipped = file_layouts(spark, path, required)
    frames = [
        _read_layout(spark, header, files, timeframe, columns is not None)
        for header, files in sorted(layouts.items())
    ]
    if not frames:
        # No file qualifies: the same columns without rows.
        frames = [_read_layout(spark, REQUIRED_FILE_COLUMNS, [], timeframe, True)]
    rows, bad = frames[0]
    for more, more_bad in frames[1:]:
        rows, bad = rows.unionByName(more), bad.unionByName(more_bad)
    if skipped:
        bad = bad.unionByName(spark.createDataFrame(skipped, QUARANTINE))
    return rows, bad


def _read_layout(spark, header, files, timeframe, check_header):
    raw = (
        spark.read.schema(_text_schema(header))
        .option("header", True)
        # A header that was looked up is parsed already; the reader only skips its line.
        .option("enforceSchema", not check_header)
        .option("ignoreLeadingWhiteSpace", not check_header)
        .option("ignoreTrailingWhiteSpace", not check_header)
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .csv(files)
    )
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1)
    names = "|".join(TIMEFRAME_SECONDS)
    from_name = F.nullif(F.regexp_extract(stem, rf"_({names})(_|$)", 1), F.lit(""))
    typed = {
        f.name: f.dataType
        for f in CANDLE_FILE.fields
        if f.name in header and not isinstance(f.dataType, T.StringType)
    }
    bad_field = F.col("_corrupt").isNotNull()
    for name, kind in typed.items():
        parsed = F.col(name).try_cast(kind)
        required = name in REQUIRED_FILE_COLUMNS
        bad_field |= parsed.isNull() if required else parsed.isNull() & F.col(name).isNotNull()
    marked = raw.select(
        "*",
        stem.alias("_stem"),
        from_name.alias("_frame"),
        F.col("_metadata.file_path").alias("_file"),
        bad_field.alias("_bad"),
    )

    def value(name):
        if name in typed:
            return F.col(name).try_cast(typed[name]).alias(name)
        return F.lit(None).cast(CANDLE_FILE[name].dataType).alias(name)

    own_symbol = F.col("symbol") if "symbol" in header else F.lit(None).cast("string")
    own_frame = F.col("timeframe") if "timeframe" in header else F.lit(None).cast("string")
    rows = marked.where(~F.col("_bad")).select(
        value("timestamp").alias("time"),
        F.coalesce(own_symbol, F.col("_stem")).alias("symbol"),
        *[value(c) for c in ("open", "high", "low", "close", "volume")],
        value("quote_volume"),
        value("trades_count"),
        F.coalesce(own_frame, F.col("_frame"), F.lit(timeframe)).alias("timeframe"),
    )
    line = F.coalesce(F.col("_corrupt"), F.to_csv(F.struct(*[F.col(c) for c in header])))
    bad = marked.where("_bad").select(
        line.alias("line"), F.col("_file").alias("file"), F.lit("bad line").alias("reason")
    )
    return rows, bad


def write_candle_csv(candles: DataFrame, path: str) -> None:
    """CSV files in one folder per symbol and timeframe (``/`` in a name becomes ``_``)."""
    named = candles.withColumn("symbol_safe", safe_name(F.col("symbol"))).withColumn(
        "frame", F.col("timeframe")
    )
    # Rebalancing gives each folder few files, and splits the files of a hot symbol.
    named = named.hint("rebalance", F.col("symbol_safe"), F.col("frame"))
    named.write.partitionBy("symbol_safe", "frame").option("header", True).csv(path)


def write_report(candles: DataFrame, path: str) -> None:
    collection_report(candles).coalesce(1).write.json(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """One CSV file with a header; for aggregated results of a few rows."""
    summary.coalesce(1).write.option("header", True).csv(path)


def with_chunk(df: DataFrame, time: str = "time", days: int = 1) -> DataFrame:
    """Add ``day``, the first day of the row's ``days``-long table chunk."""
    epoch = F.lit("1970-01-01").cast("date")
    day = F.col(time).cast("date")
    start = F.date_sub(day, F.pmod(F.datediff(day, epoch), F.lit(days)).cast("int"))
    return df.withColumn("day", start)


def write_by_day(df: DataFrame, path: str, time: str = "time", days: int = 1, mode="overwrite"):
    """A table in day chunks; with ``overwrite`` only the chunks that occur in ``df`` are replaced.

    ``df`` must not read from ``path``.
    """
    (
        with_chunk(df, time, days)
        .hint("rebalance", F.col("day"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
