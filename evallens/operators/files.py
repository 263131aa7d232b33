"""Files attached to tasks: key split (P1), supported filter (P2), task join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evallens.functions.text import splitext_base, splitext_ext
from evallens.schemas import SUPPORTED_EXTENSIONS


def split_keys(keys: DataFrame, key: str = "file_name") -> DataFrame:
    """P1 + P2: `os.path.splitext(key)`, extension lower-cased, supported flag."""
    return keys.select(
        F.col(key).alias("file_name"),
        splitext_base(F.col(key)).alias("file_base_name"),
        splitext_ext(F.col(key)).alias("file_ext"),
    ).withColumn("supported", F.col("file_ext").isin(list(SUPPORTED_EXTENSIONS)))


def files_by_task(tasks: DataFrame, files: DataFrame) -> DataFrame:
    """Every task with each of its files (base name = task id).

    Kept flat, one row per (task, file); a task without files has one row with
    NULL file columns.  Nothing is collected per task.  Written as an inner
    join (AQE may split a task that owns a large share of the files; in a
    left outer join the file side could not be split) plus the tasks without
    files (anti join against the distinct base names, combined map-side).
    """
    f = split_keys(files) if "file_base_name" not in files.columns else files
    f = f.select(F.col("file_base_name").alias("task_id"), "file_name", "file_ext", "supported")
    ids = tasks.select("task_id")
    matched = f.join(ids, "task_id").select("task_id", "file_name", "file_ext", "supported")
    bare = ids.join(f.select("task_id").distinct(), "task_id", "left_anti").select(
        "task_id", F.lit(None).cast("string").alias("file_name"), F.lit(None).cast("string").alias("file_ext"),
        F.lit(None).cast("boolean").alias("supported"))
    return matched.unionByName(bare)


def file_counts(tasks: DataFrame, files: DataFrame) -> DataFrame:
    """A9 as a count: files per task, 0 when none (partial counts before the join)."""
    f = split_keys(files) if "file_base_name" not in files.columns else files
    n = f.groupBy(F.col("file_base_name").alias("task_id")).agg(F.count(F.lit(1)).alias("n_files"))
    return (tasks.select("task_id").join(n, "task_id", "left")
                 .select("task_id", F.coalesce("n_files", F.lit(0)).alias("n_files")))


def orphan_files(tasks: DataFrame, files: DataFrame) -> DataFrame:
    """Files whose base name matches no task (dropped silently by the reference)."""
    f = split_keys(files) if "file_base_name" not in files.columns else files
    return f.join(tasks.select(F.col("task_id").alias("file_base_name")), "file_base_name", "left_anti")


def wanted_files(tasks: DataFrame, files: DataFrame, key: str = "key") -> DataFrame:
    """Files of known tasks with a supported extension: joined on key names
    before any content is extracted (semi join; the task side is only ids)."""
    f = files.withColumn("_base", splitext_base(F.col(key)))
    f = f.where(splitext_ext(F.col(key)).isin(list(SUPPORTED_EXTENSIONS)))
    return f.join(tasks.select(F.col("task_id").alias("_base")), "_base", "left_semi").drop("_base")
