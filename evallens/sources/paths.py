"""Paths on whatever file system Hadoop is configured for."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

PATTERN_CHARS = r"[{}\[\]*?\\]"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of `path`, and Hadoop's class of paths."""
    return _fs(spark, path)[0], spark._jvm.org.apache.hadoop.fs.Path


def literal_path(path: str) -> str:
    """`path` for Spark's readers, which take names as patterns."""
    return re.sub(f"({PATTERN_CHARS})", r"\\\1", path)


def hidden_name(name: str, folder: bool) -> bool:
    """Whether Spark's readers pass over a file or a folder of this name."""
    hidden = name.startswith(".") or (name.startswith("_") and "=" not in name)
    if hidden and not folder:
        return True
    return (hidden or name.endswith("._COPYING_")) and not name.startswith(("_common_metadata", "_metadata"))


def roots(spark: SparkSession, uri: str) -> list[tuple[str, int, int, bool]]:
    """(path, length, modified, whether it is a folder) of what `uri`, which may be a pattern, names; as Spark writes paths."""
    fs, p = _fs(spark, uri)
    p = fs.makeQualified(p)
    if re.search(PATTERN_CHARS, uri):
        found = list(fs.globStatus(p) or ())
    else:
        found = [fs.getFileStatus(p)] if fs.exists(p) else []
    if not found:
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {p.toString()}.")
    return [(f.getPath().toString(), f.getLen(), f.getModificationTime(), f.isDirectory()) for f in found]


def open_fs(uri: str):
    """(file system, path in it) of a qualified path, for tasks that open files themselves (`pyarrow.fs`)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:(//)?", "", uri)
    if "://" not in uri:
        raise ValueError(f"{uri}: a path needs its file system")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def path_exists(spark: SparkSession, path: str) -> bool:
    """False only if there is nothing there; any other fault is raised."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete `path` and all below it, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with the scheme and host of its file system, the session's default if it names none."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def folder_numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers N of the folders `name=N` in `path`, ascending; none if there is no such path."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))
