"""Cutting lineage on shared storage, and scratch folders that every executor can reach."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where that is unset, a folder of this application below ``hadoop.tmp.dir`` on the default file
    system, removed when the application ends. A default file system that is a local disk only serves
    a single machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    hadoop = context._jsc.hadoopConfiguration()
    system = context._jvm.org.apache.hadoop.fs.FileSystem.get(hadoop)
    if system.getUri().getScheme() == "file" and not context._jsc.isLocal():
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    name = f"{hadoop.get('hadoop.tmp.dir')}/lakeaudit-{context.applicationId}-{uuid.uuid4().hex[:8]}"
    folder = system.makeQualified(context._jvm.org.apache.hadoop.fs.Path(name))
    system.deleteOnExit(folder)
    spark.conf.set("spark.checkpoint.dir", folder.toString())
    return folder.toString()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame) -> DataFrame:
    """Materialise once on shared storage, so lost executors cannot change what was seen."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def workers_ready(spark: SparkSession) -> None:
    """Lets Python workers on this machine find the package; a cluster gets it with ``--py-files``."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, ROOT) if x)
