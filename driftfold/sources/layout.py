"""What lies in a dataset's folders, and what may: names and kinds only, listed by the driver, one row an entry."""

from __future__ import annotations

import os
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The entries a dataset may have (folder, name, kind).
ALLOWED = (
    ("data", ".gitkeep", "file"),
    ("data", "blogs.csv", "file"),
    ("data", "changes", "directory"),
    ("data", "link-health.jsonl", "file"),
    ("data", "manifest.json", "file"),
    ("data", "runs", "directory"),
    ("data", "users", "directory"),
    ("state", "crawler.json", "file"),
)
ENTRY = "folder string, name string, kind string, bytes long"
#: Folders of years, where an empty .gitkeep may lie beside the year files.
YEAR_FOLDERS = ("data/changes", "data/runs")


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def _is_link(status) -> bool:
    # Hadoop follows the links of a local file system without saying so; other stores tell.
    place = urlsplit(status.getPath().toString())
    return status.isSymlink() or (place.scheme == "file" and os.path.islink(status.getPath().toUri().getPath()))


def entries(spark: SparkSession, root: str, folder: str = ".") -> DataFrame:
    """(folder, name, kind, bytes) of a folder's entries; none if it does not exist. kind: file, directory or link."""
    files, target = _files(spark, root if folder == "." else f"{root}/{folder}")
    found = files.listStatus(target) if files.exists(target) else []
    rows = [(folder, s.getPath().getName(), "link" if _is_link(s) else "directory" if s.isDirectory() else "file", s.getLen()) for s in found]
    return spark.createDataFrame(rows, ENTRY)


def faults(found: DataFrame) -> DataFrame:
    """(folder, name, fault) of entries that could hide data that nothing validates.

    Entries of `data` and `state` must be on the list, of the kind it says; a .gitkeep must be an empty file, also
    beside year files. A link is never of the right kind.
    """
    allowed = F.broadcast(found.sparkSession.createDataFrame(list(ALLOWED), "folder string, name string, wanted string"))
    keep = F.col("name") == ".gitkeep"
    listed = found.where(F.col("folder").isin("data", "state", *YEAR_FOLDERS)).join(allowed, ["folder", "name"], "left")
    wanted = F.when(F.col("folder").isin(*YEAR_FOLDERS), "file").otherwise(F.col("wanted"))
    fault = F.when(wanted.isNull(), "unexpected entry").when(F.col("kind") != wanted, F.concat(F.lit("must be a "), wanted)).when(keep & (F.col("bytes") > 0), "must be empty")
    return listed.select("folder", "name", fault.alias("fault")).where("fault is not null")


def dataset_faults(spark: SparkSession, root: str) -> DataFrame:
    """faults of the dataset at root."""
    found = entries(spark, root, "data").unionByName(entries(spark, root, "state"))
    for folder in YEAR_FOLDERS:
        found = found.unionByName(entries(spark, root, folder))
    return faults(found)
