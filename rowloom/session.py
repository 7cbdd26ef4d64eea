"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"
# folders made for local sessions that name none
_local_roots: dict[str, str] = {}


def session(app: str = "rowloom", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC timestamps."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot key even where that costs one more exchange further up
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a folder of its own.
    """
    root = spark.conf.get(SCRATCH_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {SCRATCH_CONF} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="run-")
    return _local_roots[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call uses."""
    return f"{scratch_root(spark)}/rowloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    Later steps see one fixed set of rows even when executors are lost, and can prune
    columns and use file sizes for join planning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_fits(df: DataFrame) -> bool:
    """Whether Spark's own size estimate is within its own limit for broadcasts.

    The estimate of written rows is the size of their files, so ask it of a ``materialize`` result.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit
