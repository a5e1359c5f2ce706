"""Write, audit, publish: versions of a layer, and one marker that makes a version current.

A job writes its tables below ``_versions/<version>``, audits them there and then publishes. Publishing
creates a single empty file, ``_published/<version>``, which a file system does as a whole or not at all;
the current version is the largest one published. Readers see all tables of one version, and a job that
fails half way, or whose audit fails, leaves the version before it as it was.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

VERSIONS, PUBLISHED = "_versions", "_published"


def _path(spark: SparkSession, text: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def published(spark: SparkSession, root: str) -> list[str]:
    """The published versions, oldest first: a name per run of the job."""
    where, system = _path(spark, f"{root.rstrip('/')}/{PUBLISHED}")
    if not system.exists(where):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(where) if not s.getPath().getName().startswith("."))


def new_version(spark: SparkSession, root: str) -> str:
    """A version name that sorts behind all published ones."""
    known = published(spark, root)
    moment = max(time.time_ns(), int(known[-1].split("-")[0]) + 1 if known else 0)
    return f"{moment:020d}-{uuid.uuid4().hex[:8]}"


def version_folder(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{VERSIONS}/{version}"


def publish(spark: SparkSession, root: str, version: str) -> None:
    where, system = _path(spark, f"{root.rstrip('/')}/{PUBLISHED}/{version}")
    if not system.createNewFile(where):
        raise FileExistsError(f"version {version} is already published")


def current_folder(spark: SparkSession, root: str) -> str:
    """The folder of the current version; ``root`` itself where nothing was published."""
    known = published(spark, root)
    return version_folder(root, known[-1]) if known else root.rstrip("/")


def withdraw(spark: SparkSession, root: str, version: str) -> None:
    """Takes a published version back, so that the one before it is current; its tables stay."""
    where, system = _path(spark, f"{root.rstrip('/')}/{PUBLISHED}/{version}")
    system.delete(where, False)
