"""Session defaults, the shared scratch folder and size-checked broadcasts."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A dimension up to this many rows (tens of bytes each) may be shipped to every executor.
BROADCAST_ROWS = 200_000


# The JVM does not compile methods above 8000 bytes: wide stages then split up instead of being interpreted.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark) -> None:
    """Apply the settings the operators rely on to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


def build_session(master=None, app="tidemark", shuffle_partitions=None):
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark, label):
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors do not share one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after counting that it is small.

    The count stops at ``max_rows + 1`` rows. A larger side is returned without
    a hint, so Spark joins it by shuffle and splits hot keys (AQE skew join).
    """
    seen = df.limit(max_rows + 1).count()
    return F.broadcast(df) if seen <= max_rows else df
