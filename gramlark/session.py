"""Session set-up and staging of intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "gramlark", cpus: int | str = 8, **conf) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GRAMLARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stage_root(spark: SparkSession) -> str:
    """Shared folder for staged tables, as named by ``spark.checkpoint.dir``.

    A folder of our own is made only for a local master; on a cluster an unset
    folder is an error, because a machine-local path dies with its machine.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="gramlark-stage-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


_STAGED: list[str] = []


TIDY_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str = "table", lean: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors and keeps
    column pruning for the passes that follow.  Worth its write wherever more
    than one pass over joined or derived rows follows.  A ``lean`` one takes less
    disk: it is packed tighter, and the shuffle files of its write go at once.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    if lean:
        before = spark.conf.get(TIDY_CONF, None)
        spark.conf.set(TIDY_CONF, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            spark.conf.unset(TIDY_CONF) if before is None else spark.conf.set(TIDY_CONF, before)
    else:
        df.write.parquet(path)
    _STAGED.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._gramlark_staged = path
    return out


def is_staged(df: DataFrame) -> bool:
    """True for a table returned by ``stage`` (not for frames derived from it)."""
    return bool(getattr(df, "_gramlark_staged", False))


def as_staged(df: DataFrame, base: DataFrame) -> DataFrame:
    """``df``, columns of ``base`` or derived from them row by row, counts as staged if ``base`` is."""
    if is_staged(base):
        df._gramlark_staged = base._gramlark_staged
    return df


def release(df: DataFrame) -> None:
    """Delete one table returned by ``stage`` that nothing built on it needs any more."""
    spark, path = df.sparkSession, df._gramlark_staged
    if path in _STAGED:
        _STAGED.remove(path)
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release_staged(spark: SparkSession) -> int:
    """Delete the tables staged so far; frames built on them can no longer run."""
    jvm, count = spark._jvm, 0
    conf = spark._jsc.hadoopConfiguration()
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        count += bool(path.getFileSystem(conf).delete(path, True))
    return count
