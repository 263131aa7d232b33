"""Task operators: latest row per key (P6) and steps edits.

Parquet tables cannot be updated in place, so an edit is a row in an
append-only change log; the current steps are resolved at read time, and a
compacted table is written to a new version directory, never over the path
being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evallens.functions.text import py_strip
from evallens.session import scratch_path
from evallens.sources.buckets import read_bucketed, write_bucketed
from evallens.sources.paths import folder_numbers, path_exists
from evallens.sources.tasks import TASK_COLUMNS


def latest_per_key(df: DataFrame, key: str = "task_id", order: tuple[str, ...] = ("loaded_at",)) -> DataFrame:
    """One row per key, the last by `order` ("last row wins" made explicit).

    Rows that tie in `order` are told apart by their other columns, in column
    order, so the result never depends on how rows are dealt.  The last order
    value per key comes from a hash aggregate over (key, order) alone; only the
    rows that hold it are compared in full.
    """
    others = [c for c in df.columns if c != key and c not in order]
    # structs of the order columns: one column that compares and joins like all of them
    top = df.groupBy(F.col(key).alias("_k")).agg(F.max(F.struct(*order)).alias("_o"))
    last = df.join(top, df[key].eqNullSafe(F.col("_k")) & F.struct(*[df[c] for c in order]).eqNullSafe(F.col("_o"))).drop("_k", "_o")
    best = F.max(F.struct(*order, *others)).alias("_row")
    return last.groupBy(key).agg(best).select(*[F.col(key) if c == key else F.col(f"_row.`{c}`") for c in df.columns])


def pick_tasks(tasks: DataFrame, ids) -> DataFrame:
    """The tasks with the chosen ids; an empty choice selects nothing.

    A short list of ids becomes an `IN` filter that reaches the parquet scan;
    a DataFrame of ids (any size) is a semi join.
    """
    if isinstance(ids, DataFrame):
        return tasks.join(ids.select(F.col(ids.columns[0]).alias("task_id")).distinct(), "task_id", "left_semi")
    chosen = [i for i in ([ids] if isinstance(ids, str) else list(ids or [])) if i]
    return tasks.where(F.col("task_id").isin(chosen)) if chosen else tasks.limit(0)


def valid_step_changes(changes: DataFrame) -> DataFrame:
    """P10: an edit whose steps are blank after `strip()` is refused.

    Accepted steps are stored as typed (not stripped).
    """
    return changes.where(F.coalesce(py_strip(F.col("steps")) != "", F.lit(False)))


def rejected_step_changes(changes: DataFrame) -> DataFrame:
    return changes.where(~F.coalesce(py_strip(F.col("steps")) != "", F.lit(False)))


def latest_step_change(changes: DataFrame) -> DataFrame:
    """Latest accepted edit per task, by (changed_at, seq), ties by the steps' text."""
    return latest_per_key(valid_step_changes(changes).select("task_id", "steps", "changed_at", "seq"),
                          "task_id", ("changed_at", "seq"))


def apply_step_updates(tasks: DataFrame, changes: DataFrame) -> DataFrame:
    """S7 + J3: `UPDATE Tasks SET Steps = ? WHERE task_id = ?`, resolved as a join.

    Every task row with a matching id takes the latest accepted edit; tasks
    without edits keep their steps.  Adds `steps_changed_at` (NULL if unchanged).
    """
    latest = latest_step_change(changes).select(
        "task_id", F.col("steps").alias("_new_steps"), F.col("changed_at").alias("steps_changed_at"))
    cols = [F.coalesce("_new_steps", "steps").alias("steps") if c == "steps" else F.col(c)
            for c in tasks.columns]
    return tasks.join(latest, "task_id", "left").select(*cols, "steps_changed_at")


def unmatched_step_updates(tasks: DataFrame, changes: DataFrame) -> DataFrame:
    """Accepted edits whose task id matches no task (the reference reports success)."""
    return valid_step_changes(changes).join(tasks.select("task_id"), "task_id", "left_anti")


# --- versions --------------------------------------------------------------------------
#
# A store of tasks is a folder:
#     base=V/       the tasks with their steps as of version V, bucketed by task id
#     edits=N/      the accepted edits of one append, as they are in the log
#     manifest=V/   (buckets, edits): how many buckets base=V has, and the first append it does not hold
# `manifest=V` is written last; a version counts once it is there.

EDITS = "task_id string, steps string, changed_at timestamp_ntz, seq long"
BASE = ", ".join(f"{c} {'int' if c == 'level' else 'string'}" for c in TASK_COLUMNS) + ", steps_changed_at timestamp_ntz, steps_seq long"
BUCKETS = 64


def _latest_version(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(version, its buckets, the first append after it)."""
    done = [v for v in folder_numbers(spark, path, "manifest") if path_exists(spark, f"{path}/manifest={v}/_SUCCESS")]
    m = spark.read.schema("buckets int, edits int").parquet(f"{path}/manifest={max(done)}").first()
    return max(done), m.buckets, m.edits


def _write_version(tasks: DataFrame, path: str, version: int, buckets: int, edits: int, dealt: bool = False) -> None:
    spark = tasks.sparkSession
    write_bucketed(tasks, f"{path}/base={version}", "task_id", buckets, dealt)
    spark.createDataFrame([(buckets, edits)], "buckets int, edits int").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest={version}")


def create_task_store(tasks: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Version 0 of a store of tasks, without edits."""
    never = (F.lit(None).cast("timestamp_ntz").alias("steps_changed_at"), F.lit(None).cast("long").alias("steps_seq"))
    _write_version(tasks.select(*TASK_COLUMNS, *never), path, 0, buckets, 0)


def append_step_edits(changes: DataFrame, path: str) -> int:
    """Appends the accepted edits among `changes` (P10) to a store; returns the append's number."""
    n = max(folder_numbers(changes.sparkSession, path, "edits"), default=-1) + 1
    valid_step_changes(changes).select("task_id", "steps", "changed_at", F.col("seq").cast("long").alias("seq")).write.mode(
        "overwrite").parquet(f"{path}/edits={n}")
    return n


def _current(spark: SparkSession, path: str) -> DataFrame:
    version, buckets, first = _latest_version(spark, path)
    base = read_bucketed(spark, f"{path}/base={version}", BASE, "task_id", buckets)
    later = [f"{path}/edits={n}" for n in folder_numbers(spark, path, "edits") if n >= first]
    if not later:
        return base
    edits = latest_per_key(spark.read.schema(EDITS).parquet(*later), "task_id", ("changed_at", "seq"))
    folder = scratch_path(spark, "task-edits")
    write_bucketed(edits.select("task_id", F.struct("changed_at", "seq", "steps").alias("edit")), folder, "task_id", buckets)
    edits = read_bucketed(spark, folder, "task_id string, edit struct<changed_at:timestamp_ntz,seq:long,steps:string>", "task_id", buckets)
    both = base.join(edits.hint("shuffle_hash"), "task_id", "left")
    held = F.struct(F.col("steps_changed_at").alias("changed_at"), F.col("steps_seq").alias("seq"), "steps")
    newer = F.col("edit").isNotNull() & (F.col("steps_changed_at").isNull() | (F.col("edit") >= held))
    now = {"steps": "edit.steps", "steps_changed_at": "edit.changed_at", "steps_seq": "edit.seq"}
    return both.select(*[F.when(newer, F.col(now[c])).otherwise(F.col(c)).alias(c) if c in now else F.col(c) for c in base.columns])


def read_current_tasks(spark: SparkSession, path: str) -> DataFrame:
    """S4 + S7: every task with its current steps and `steps_changed_at`.

    The newest version with the latest edit per task of the appends since.  Those
    edits are resolved among themselves and stored in as many buckets as the base,
    whose rows are then neither exchanged nor sorted.  An edit that is older than
    the one its task already holds (it came late) does not undo it.
    """
    return _current(spark, path).drop("steps_seq")


def compact_task_store(spark: SparkSession, path: str) -> int:
    """Writes the current tasks as the next version, of which edits so far are part; returns its number."""
    version, buckets, _ = _latest_version(spark, path)
    until = max(folder_numbers(spark, path, "edits"), default=-1) + 1
    _write_version(_current(spark, path), path, version + 1, buckets, until, dealt=True)
    return version + 1


def compact_steps(tasks: DataFrame, changes: DataFrame, path: str) -> DataFrame:
    """Write the tasks with their current steps to `path` (a new version) and read it back.

    Afterwards a reader needs only this version and the edits made since; the
    compacted edits need not be aggregated again.  `path` must not exist.
    """
    apply_step_updates(tasks, changes).write.mode("errorifexists").parquet(path)
    return tasks.sparkSession.read.parquet(path)
