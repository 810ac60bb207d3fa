"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "larderline", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # copies behind a cut go when nothing reads them
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the session names it.

    A local session that names none gets a fresh folder; a cluster has to name one, as its executors see no local folder of the driver.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    fresh = tempfile.mkdtemp(prefix="larderline-")
    spark.conf.set("spark.checkpoint.dir", fresh)
    return fresh


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; every call has its own, so that no table that is still read gets replaced."""
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and go on from the written copy.

    Used where several branches read the same expensive result, and in loops.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many tasks as there are cores, ahead of a step that costs CPU per row.

    Only for a plain scan: a few small files would else keep one core busy.
    A large table has more splits than cores and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def wide(df: DataFrame, *by: str) -> DataFrame:
    """``df`` over the session's number of shuffle partitions (dealt by the columns ``by``), ahead of a step that multiplies its rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
