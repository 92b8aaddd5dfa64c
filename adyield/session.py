"""Session helpers shared by the operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPLICATION_SALTS = 16
NUMBERS = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"}


def build_session(app: str = "adyield", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every node sees, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder before running on a cluster")
            folder = tempfile.mkdtemp(prefix="adyield-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from there with a short lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to as many tasks as the session shuffles to.

    For rows that much work awaits: a small file, or one of few row groups, is read by few tasks, and these would do all of it.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def worked_out(value: Column) -> Column:
    """A value for ``select`` that is worked out once per row.

    Filters on a plain column are pushed to the scan, and each repeats the column's expression there; they stay above an unfolded list.
    """
    return F.explode(F.array(value))


def fits_broadcast(*tables: DataFrame) -> bool:
    """True when each table, counted, stays under the session's broadcast threshold.

    Counting stops at the first row too many. A row is taken as 8 bytes per number and 48 per text or nested value.
    """
    for table in tables:
        limit = table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower().removesuffix("b")
        unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(limit[-1:], 1)
        limit_bytes = int(limit.rstrip("kmg")) * unit
        width = sum(8 if field.dataType.simpleString() in NUMBERS else 48 for field in table.schema.fields)
        rows = limit_bytes // max(8, width)
        if rows <= 0 or table.limit(rows + 1).count() > rows:
            return False
    return True
