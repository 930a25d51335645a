"""Where intermediate tables live: the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
PREFIX, _SESSION = "covey-", uuid.uuid4().hex[:12]


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or a folder of this machine where none is set (tests, local mode)."""
    found = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="covey-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage, survives lost executors.

    Inside of scratch() the table goes when that ends, unless it is to be kept."""
    path = f"{shared_dir(df.sparkSession)}/{PREFIX}{_SESSION}-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = len(_SCRATCH) - 1 - keep
    if at >= 0:
        _SCRATCH[at].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Deletes, at its end, the tables that stored() wrote inside and wasn't to keep: what is made from them must be stored by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        _delete(spark, _SCRATCH.pop())


def _delete(spark: SparkSession, paths: list[str]) -> None:
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in map(make, paths):
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: A join of a table with the few of its rows that another one names: Spark then drops most of the others
#: at the scan by a Bloom filter of bounded size, however small the table is.
RUNTIME_FILTERS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "512MB",
}


@contextmanager
def runtime_filters(spark: SparkSession):
    """Runtime filters for the plans that are run inside."""
    before = {k: spark.conf.get(k, None) for k in RUNTIME_FILTERS}
    for k, v in RUNTIME_FILTERS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def clear(spark: SparkSession) -> int:
    """Deletes the tables that stored() wrote in this session's shared folder; how many there were.

    For when the results made from them are written: until then they are read again."""
    jvm, folder = spark.sparkContext._jvm, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [x.getPath() for x in files.globStatus(jvm.org.apache.hadoop.fs.Path(folder, f"{PREFIX}{_SESSION}-*")) or []]
    for path in found:
        files.delete(path, True)
    return len(found)
