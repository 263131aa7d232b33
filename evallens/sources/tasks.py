"""Task metadata: JSON scan (S1), nested flatten with defaults (S2), store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evallens.schemas import TASK_JSON, TASKS

TASK_COLUMNS = [f.name for f in TASKS.fields]

# The eight columns the answer app reads back.
READ_COLUMNS = ["task_id", "question", "final_answer", "steps", "number_of_steps",
                "how_long", "tools", "number_of_tools"]


CORRUPT = "_corrupt_record"


def read_task_json(spark: SparkSession, path: str, multiline: bool = True, strict: bool = True) -> DataFrame:
    """Metadata JSON with the fixed schema.

    `multiline=True` reads files whose root is an array (one record per
    element); such a file is one task, so at scale prefer many files or JSON
    lines (`multiline=False`), which split.  A record that is not valid JSON fails
    the read; with `strict=False` it is kept as text in `_corrupt_record`
    (`good_records`, `rejected_records`).
    """
    r = spark.read.option("multiLine", multiline)
    if strict:
        return r.schema(TASK_JSON).option("mode", "FAILFAST").json(path)
    lenient = T.StructType([*TASK_JSON.fields, T.StructField(CORRUPT, T.StringType())])
    return r.schema(lenient).option("mode", "PERMISSIVE").json(path)


def good_records(read: DataFrame) -> DataFrame:
    """The records of a lenient read that are valid."""
    return read.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_records(read: DataFrame) -> DataFrame:
    """The text of the records of a lenient read that are not."""
    # Spark reads the text of bad records only beside another column.
    nothing = F.left(F.coalesce("task_id", F.lit("")), F.lit(0))
    return read.where(F.col(CORRUPT).isNotNull()).select(F.concat(F.col(CORRUPT), nothing).alias("record"))


def parse_task_json(text_col) -> F.Column:
    """S1 on a string column holding one JSON record per row."""
    return F.from_json(text_col, TASK_JSON)


def flatten_tasks(nested: DataFrame) -> DataFrame:
    """Five top-level and five `Annotator Metadata` fields, with defaults.

    A missing key and an explicit null both become the default ('' or 0); a
    missing `Annotator Metadata` gives '' for its five fields.
    """
    meta = F.col("`Annotator Metadata`")

    def s(c):
        return F.coalesce(c.cast("string"), F.lit(""))

    return nested.select(
        s(F.col("task_id")).alias("task_id"),
        s(F.col("Question")).alias("question"),
        # a number, a number as text or with a decimal point
        F.coalesce(F.expr("try_cast(Level AS double)").cast("int"), F.lit(0)).alias("level"),
        s(F.col("file_name")).alias("file_name"),
        s(F.col("`Final answer`")).alias("final_answer"),
        s(meta.getField("Steps")).alias("steps"),
        s(meta.getField("Number of steps")).alias("number_of_steps"),
        s(meta.getField("How long did this take?")).alias("how_long"),
        s(meta.getField("Tools")).alias("tools"),
        s(meta.getField("Number of tools")).alias("number_of_tools"),
    )


def write_tasks(tasks: DataFrame, path: str | None, mode: str = "append", fmt: str = "parquet",
                options: dict | None = None) -> None:
    """S3: one job commit for the whole load (the reference commits once at the end).

    For a database pass `fmt="jdbc"`, `path=None` and the JDBC options
    (`url`, `dbtable`, ...).
    """
    w = tasks.select(*TASK_COLUMNS).write.mode(mode).format(fmt).options(**(options or {}))
    w.save(path) if path is not None else w.save()


def read_tasks(spark: SparkSession, path: str | None, fmt: str = "parquet", columns=None,
               options: dict | None = None) -> DataFrame:
    """Scan stored tasks; only the needed columns reach the reader.

    With `fmt="jdbc"`, give `partitionColumn`, `lowerBound`, `upperBound` and
    `numPartitions` in `options` so the table is read by many tasks.
    """
    r = spark.read.format(fmt).options(**(options or {}))
    if fmt != "jdbc":
        r = r.schema(TASKS)
    df = r.load(path) if path is not None else r.load()
    return df.select(*(columns or READ_COLUMNS))
