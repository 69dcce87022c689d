"""Tables kept in versions: a write counts only once its marker is there.

A version is a folder of its own; its marker, an empty file beside it, is
created after the rows are written.  Readers look at markers alone, so a write
that broke off is never seen and needs no repair, and rows that are being read
are never replaced.  Versions are named by time, ties by a random part.
"""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

MARKER = ".committed"


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_version(df: DataFrame, root: str, at: datetime | None = None) -> str:
    """Write ``df`` as the version of time ``at`` (now) below ``root``; returns its name."""
    at = (at or datetime.now(timezone.utc)).astimezone(timezone.utc)
    version = f"{at:%Y%m%dT%H%M%S%f}-{uuid4().hex[:12]}"
    df.write.parquet(f"{root}/{version}")
    files, marker = _files(df.sparkSession, f"{root}/{version}{MARKER}")
    files.create(marker, False).close()
    return version


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the committed versions, oldest first; one name per write, never per row."""
    files, where = _files(spark, root)
    if not files.exists(where):
        return []
    names = (s.getPath().getName() for s in files.listStatus(where))
    return sorted(n.removesuffix(MARKER) for n in names if n.endswith(MARKER))


def read_version(spark: SparkSession, root: str, version: str | None = None, until: datetime | None = None) -> DataFrame:
    """A named version, or the newest (of time ``until`` or before)."""
    found = versions(spark, root)
    if version is None and until is not None:
        last = f"{until.astimezone(timezone.utc):%Y%m%dT%H%M%S%f}"
        found = [v for v in found if v.split("-")[0] <= last]
    if version not in found and (version is not None or not found):
        raise FileNotFoundError(f"no committed version {version or ''} in {root}")
    return spark.read.parquet(f"{root}/{version or found[-1]}")


def drop_versions(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete all but the newest ``keep`` committed versions and what was never committed before them.

    A marker goes before its rows, so that no reader finds half a version.
    """
    files, where = _files(spark, root)
    kept = versions(spark, root)[-keep:] if keep else []
    names = sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []
    old = [n for n in names if n.removesuffix(MARKER) not in kept and (not kept or n < kept[0])]
    for n in sorted(old, key=lambda n: not n.endswith(MARKER)):
        files.delete(_files(spark, f"{root}/{n}")[1], True)
    return len({n.removesuffix(MARKER) for n in old})
