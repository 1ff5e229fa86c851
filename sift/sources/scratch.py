"""Where a run keeps tables that outlive a lost executor."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in storage every executor can reach.

    The folder the cluster names in `spark.checkpoint.dir` comes first, then
    the context's checkpoint folder, then the session's warehouse. Of these
    two, one on the local file system is refused unless the master is local:
    every machine would write to a disk of its own, and what is read back
    would lack the others' files, without an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
        if on_cluster(spark.sparkContext.master) and scheme_of(spark, base) == "file":
            raise RuntimeError(
                f"{base} is a folder of one machine's own; set spark.checkpoint.dir to one "
                "that all machines share"
            )
    return f"{base.rstrip('/')}/sift/{label}-{uuid.uuid4().hex}"


def on_cluster(master: str) -> bool:
    """Whether executors may be on other machines than the driver."""
    return not re.fullmatch(r"local(\[.*\])?", master)


def scheme_of(spark: SparkSession, path: str) -> str:
    """The file system a path is on; without a scheme, the default one."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if found:
        return found[1].lower()
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return default.split(":", 1)[0].lower()


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path made by `scratch_path`, through the file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
