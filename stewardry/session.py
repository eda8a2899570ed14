"""Session defaults and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Stand-in folder per local application.
_LOCAL = {}


def build_session(app="stewardry", master=None, **conf):
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark, label):
    """A fresh folder all executors can reach.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only where it
    is unset and the master is local does a machine-local folder stand in.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _LOCAL.setdefault(context.applicationId, None) or tempfile.mkdtemp(prefix="stewardry-")
        _LOCAL[context.applicationId] = shared
    return os.path.join(shared, f"{label}-{uuid.uuid4().hex}")


def materialize(df, label, partition_by=None):
    """Write a reused result to a table in the shared folder and read it back."""
    path = scratch_dir(df.sparkSession, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
