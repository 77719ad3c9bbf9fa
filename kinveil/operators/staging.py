"""Written tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Paths of tables that are still there, in the order they were written.
_held: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where it is unset (tests, local runs)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    found = found or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="kinveil-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def _delete(spark: SparkSession, path: str) -> None:
    try:
        name = path.rsplit("/", 1)[-1]
        if "-" not in name:
            spark.sql(f"drop table if exists `{name}`")
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session has gone already
        pass


def stage(df: DataFrame, tag: str, codec: str | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back, so that what follows neither
    recomputes it nor depends on the executors that made it. The files go by discard(), at the end of a
    scratch() they were written in, or when the driver exits."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/kinveil-{tag}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", codec) if codec else df.write
    writer.parquet(path)
    _held.append(path)
    atexit.register(lambda: path in _held and _delete(spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_staged_at"] = path
    return out


def stage_buckets(df: DataFrame, tag: str, key: str, buckets: int) -> DataFrame:
    """stage() as a table bucketed by key: later joins and groups by key read it where it is, without a
    shuffle. Writing needs none either; every task writes the buckets it has."""
    spark = df.sparkSession
    name = f"kinveil_{tag}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/{name}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).option(
        "compression", "zstd"
    ).saveAsTable(name)
    _held.append(path)
    atexit.register(lambda: path in _held and _delete(spark, path))
    out = spark.table(name)
    out.__dict__["_staged_at"] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in tables:
        path = df.__dict__.get("_staged_at")
        if path in _held:
            _held.remove(path)
            _delete(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables staged inside go at its end, but for those put into the list it gives."""
    before, keep = set(_held), []
    yield keep
    kept = {df.__dict__.get("_staged_at") for df in keep}
    for path in [p for p in _held if p not in before and p not in kept]:
        _held.remove(path)
        _delete(spark, path)
