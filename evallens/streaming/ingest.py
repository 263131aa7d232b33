"""Streaming jobs: evaluation ingest (T1) and a live summary.

The reference records verdicts one at a time and recomputes its report from a
full scan; here verdict files arriving in a folder are appended to the
evaluations table by a Structured Streaming query, and the summary is kept
current by a second one.  Checkpoints make both restartable after failures.

Beside the table lies a ledger: for each batch, the counts of the rows it
stored.  A batch that is replayed after a failure writes its folder and its entry
anew, and of a batch's entries the last attempt counts, so the summary never
counts a row twice and never reads the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from evallens.operators import report
from evallens.operators.verdicts import valid_verdicts
from evallens.schemas import EVALUATIONS
from evallens.session import settings
from evallens.sources.evaluations import EVAL_COLUMNS, normalize_evaluations, stamp, with_evaluation_id
from evallens.sources.paths import path_exists


STORED = T.StructType([*EVALUATIONS.fields, T.StructField("batch", T.LongType())])
LEDGER = T.StructType([T.StructField(n, T.LongType()) for n in ("total_evaluations", "correct_answers", "batch", "attempt")])

# The ids seen are kept in files of the checkpoint, with an index in executors' memory and on their disks.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def ledger_path(sink: str) -> str:
    return sink.rstrip("/") + "-ledger"


def _enter(spark: SparkSession, sink: str, batch_id: int, stored: DataFrame) -> None:
    """A ledger entry for a batch: the counts of its rows, as a further attempt if it has entries already."""
    folder, attempt = f"{ledger_path(sink)}/batch={batch_id}", 0
    while path_exists(spark, f"{folder}/attempt={attempt}/_SUCCESS"):
        attempt += 1
    report.counts(stored).coalesce(1).write.mode("overwrite").parquet(f"{folder}/attempt={attempt}")


def rebuild_ledger(spark: SparkSession, sink: str) -> None:
    """Ledger entries, in one pass, for a table whose ledger is lost or that was written without one."""
    rows = report.counts(spark.read.schema(STORED).parquet(sink), "batch").withColumn("attempt", F.lit(0).cast("long"))
    rows.write.mode("overwrite").partitionBy("batch", "attempt").parquet(ledger_path(sink))


def _trigger(w, available_now: bool, interval: str):
    return w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)


def read_ingested(spark: SparkSession, sink: str) -> DataFrame:
    """The evaluations stored by `ingest_evaluations`."""
    return spark.read.schema(EVALUATIONS).parquet(sink).select(*EVAL_COLUMNS)


def ingest_evaluations(spark: SparkSession, source: str, sink: str, checkpoint: str,
                       validate: bool = False, fmt: str = "parquet",
                       max_files_per_trigger: int | None = None, available_now: bool = True,
                       interval: str = "1 minute") -> StreamingQuery:
    """verdict/evaluation files in `source` -> rows stored in `sink`, one folder per micro-batch.

    Nothing is dropped for being late.  A supplied `evaluation_id` is stored
    once, however much later it is repeated: the ids are the query's state, so a
    batch looks up its own ids only and reads nothing of the table.  The
    checkpoint belongs to the table; without it earlier ids are not known.
    Rows without an id are all kept and get a new one (they take no state), and a
    missing time becomes the batch's time.  A batch that is replayed after a
    failure sees the state before it, overwrites its own folder and adds an attempt
    to its ledger entry.
    """
    r = spark.readStream.schema(EVALUATIONS).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = r.load(source)
    if validate:
        rows = valid_verdicts(rows)
    named = rows.where(F.col("evaluation_id").isNotNull()).dropDuplicates(["evaluation_id"])
    unnamed = rows.where(F.col("evaluation_id").isNull())

    def store(batch: DataFrame, batch_id: int) -> None:
        folder = f"{sink}/batch={batch_id}"
        normalize_evaluations(stamp(with_evaluation_id(batch))).write.mode("overwrite").parquet(folder)
        _enter(spark, sink, batch_id, spark.read.schema(EVALUATIONS).parquet(folder))

    w = named.select(*EVAL_COLUMNS).unionByName(unnamed.select(*EVAL_COLUMNS)).writeStream.foreachBatch(store)
    with settings(spark, STATE_STORE):
        return _trigger(w.option("checkpointLocation", checkpoint), available_now, interval).start()


def live_summary(spark: SparkSession, evaluations: str, out: str, checkpoint: str,
                 available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """A1-A4 over the evaluations table as a streaming aggregate of its ledger.

    State is one row per ingest batch, its last attempt's counts.  Complete mode;
    each micro-batch writes a version of its own, which readers see once it is
    committed (`read_summary`), so a reader or a crash never finds the summary gone.
    """
    entries = spark.readStream.schema(LEDGER).parquet(ledger_path(evaluations))
    share = F.max_by(F.struct("total_evaluations", "correct_answers"), "attempt").alias("share")
    shares = entries.groupBy("batch").agg(share).select("share.*")

    def publish(batch: DataFrame, batch_id: int) -> None:
        report.summary_of(report.merged_counts(batch)).write.mode("overwrite").parquet(f"{out}/version={batch_id}")

    w = (shares.writeStream.outputMode("complete").foreachBatch(publish)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, available_now, interval).start()


def read_summary(spark: SparkSession, out: str) -> DataFrame:
    """The latest complete version of the summary."""
    return spark.read.parquet(out).orderBy(F.desc("version")).limit(1).drop("version")
