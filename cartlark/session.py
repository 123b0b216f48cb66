"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "cartlark", **conf: str) -> SparkSession:
    """A UTC session; cluster sizing is left to the caller's own settings."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates and hours are UTC by contract, whatever the cluster default is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session without
    that setting (tests, the bench) gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="cartlark-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives lost executors and is computed once."""
    context = df.sparkSession.sparkContext
    directory = shared_dir(df.sparkSession)
    if not context.getCheckpointDir():
        context.setCheckpointDir(directory)
    return df.checkpoint(eager=True)
