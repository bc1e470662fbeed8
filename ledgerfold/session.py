"""Session helpers: one place for the settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A hinted broadcast is only ever used at or below this many rows.
BROADCAST_ROWS = 200_000


def build_session(app: str = "ledgerfold", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library expects; explicit ``conf`` wins.

    Shuffle parallelism is left to the cluster default and AQE unless the caller
    states one, because the right number depends on the data, not on the code.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings: dict[str, object] = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that all executors share.

    It comes from ``spark.checkpoint.dir``. A local session that names
    none (tests) gets a temporary one; a cluster session must name a shared one,
    since a machine-local folder would not survive a lost executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema, made without Python workers."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when a bounded count proves the side is small.

    Above the bound the frame is returned unhinted and the join shuffles.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
