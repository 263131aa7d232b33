"""Prompt assembly (A10, P14) and batch completion (M1, M2)."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evallens.functions.text import splitext_base
from evallens.schemas import (CHUNK_END, CHUNK_HEAD, CHUNK_MID, MAX_RESPONSE_TOKENS, PROMPT_QUESTION, PROMPT_STEPS, PROMPT_TEXT,
                              SUPPORTED_EXTENSIONS, SYSTEM_MESSAGE, TEMPERATURE)
from evallens.session import scratch_path
from evallens.sources.paths import folder_numbers, path_exists

# Stored answers, one row per prompt sent.
SCORED = T.StructType([
    T.StructField("prompt_id", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
])

COMPLETED = T.StructType([
    T.StructField("prompt_id", T.StringType()),
    T.StructField("task_id", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
])


def task_texts(extracted: DataFrame) -> DataFrame:
    """A10: per task, `Extracted Text from {key}:\\n{text}\\n` for each supported file, in key order.

    Key order is the object store's listing order (binary UTF-8).  Only key
    names and texts are grouped; file bytes never reach this shuffle.
    """
    chunks = (extracted.where(F.col("ext").isin(list(SUPPORTED_EXTENSIONS)))
                       .select(splitext_base(F.col("key")).alias("task_id"), "key",
                               F.concat(F.lit(CHUNK_HEAD), F.col("key"), F.lit(CHUNK_MID),
                                        F.coalesce(F.col("text"), F.lit("")), F.lit(CHUNK_END)).alias("chunk")))
    return chunks.groupBy("task_id").agg(
        F.expr("listagg(chunk, '') WITHIN GROUP (ORDER BY key)").alias("extracted_text"))


def prompt_text(steps, question, extracted_text) -> F.Column:
    """`Steps:\\n{steps}\\n\\nQuestion:\\n{question}\\n` + optional extracted-text block.

    A NULL steps/question is written as '' (the reference would write `None`).
    """
    txt = F.coalesce(extracted_text, F.lit(""))
    return F.concat(
        F.lit(PROMPT_STEPS), F.coalesce(steps, F.lit("")),
        F.lit(PROMPT_QUESTION), F.coalesce(question, F.lit("")), F.lit("\n"),
        F.when(txt != "", F.concat(F.lit(PROMPT_TEXT), txt)).otherwise(F.lit("")),
    )


def build_prompts(tasks: DataFrame, extracted: DataFrame | None = None) -> DataFrame:
    """(task_id, prompt) for every task; tasks without files get no text block."""
    t = tasks.select("task_id", "question", "steps")
    if extracted is not None:
        t = t.join(task_texts(extracted), "task_id", "left")
    else:
        t = t.withColumn("extracted_text", F.lit(None).cast("string"))
    return t.select("task_id", prompt_text(F.col("steps"), F.col("question"), F.col("extracted_text")).alias("prompt"))


def prompt_id(prompt) -> F.Column:
    return F.sha2(prompt, 256)


def chat_request(prompt: str) -> dict:
    """The request the reference sends, for callers whose `fn` talks to a chat service."""
    return {
        "messages": [{"role": "system", "content": SYSTEM_MESSAGE}, {"role": "user", "content": prompt}],
        "max_tokens": MAX_RESPONSE_TOKENS,
        "temperature": TEMPERATURE,
    }


def _answers(distinct: DataFrame, fn: Callable[[str], str], max_attempts: int, backoff_seconds: float) -> DataFrame:
    """(prompt_id, response, error, attempts) of rows (prompt_id, prompt), one call per row."""

    def run(batches):
        for pdf in batches:
            out = []
            for p in pdf["prompt"]:
                resp, err, n = None, None, 0
                while n < max_attempts:
                    n += 1
                    try:
                        resp, err = fn(p), None
                        break
                    except Exception as e:  # noqa: BLE001 - recorded per row
                        err = f"{type(e).__name__}: {e}"
                        if n < max_attempts:
                            time.sleep(backoff_seconds * 2 ** (n - 1))
                out.append((resp, err, n))
            yield pd.DataFrame({
                "prompt_id": pdf["prompt_id"],
                "response": [o[0] for o in out], "error": [o[1] for o in out],
                "attempts": pd.array([o[2] for o in out], dtype="int32"),
            })

    return distinct.mapInPandas(run, SCORED)


def _identified(prompts: DataFrame) -> DataFrame:
    return prompts.select(prompt_id(F.col("prompt")).alias("prompt_id"), "task_id", "prompt")


def _distinct(identified: DataFrame, parallelism: int | None) -> DataFrame:
    d = identified.groupBy("prompt_id").agg(F.first("prompt").alias("prompt"))
    return d.repartition(parallelism, "prompt_id") if parallelism else d


def complete(prompts: DataFrame, fn: Callable[[str], str], parallelism: int | None = None,
             max_attempts: int = 3, backoff_seconds: float = 0.5) -> DataFrame:
    """M1: one row per (task, prompt) with the response of `fn` (prompt -> response).

    Equal prompts are sent once.  `parallelism` bounds concurrent calls (one
    call at a time per partition).  Errors are kept apart from responses.  The
    result is recomputed on every action, which would call the service again:
    use `complete_to_table` to write answers once and read them back.
    """
    src = _identified(prompts)
    got = _answers(_distinct(src, parallelism), fn, max_attempts, backoff_seconds)
    return src.select("prompt_id", "task_id").join(got, "prompt_id").select(*COMPLETED.names)


def changed_prompts(prompts: DataFrame, scored: DataFrame) -> DataFrame:
    """M2: prompts whose text has no answer yet (by prompt id; a failed call is no answer)."""
    p = prompts.withColumn("prompt_id", prompt_id(F.col("prompt")))
    done = scored.where(F.col("error").isNull()) if "error" in scored.columns else scored
    return p.join(done.select("prompt_id").distinct(), "prompt_id", "left_anti").drop("prompt_id")


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """The stored answer of each prompt: a response if there is one, else the last error."""
    rows = spark.read.schema(SCORED).parquet(path)
    best = F.max(F.struct(F.col("error").isNull().alias("ok"), "attempts", "response", "error"))
    return rows.groupBy("prompt_id").agg(best.alias("b")).select("prompt_id", "b.response", "b.error", "b.attempts")


# --- queue -----------------------------------------------------------------------------
#
# A queue is a folder beside its answers:
#     <answers>-queue/prompts/run=N   (prompt_id, prompt) that no earlier run holds
#     <answers>-queue/members/run=N   (prompt_id, task_id) of run N
# Answers are appended, one row for each time a prompt was sent, so a prompt's state is
# pending (no row), failed (only errors) or done.

PROMPTS = "prompt_id string, prompt string"
MEMBERS = "prompt_id string, task_id string"


def queue_path(answers: str) -> str:
    return answers.rstrip("/") + "-queue"


def enqueue(prompts: DataFrame, answers: str) -> int:
    """Stores the tasks' prompts, those not queued yet once each; returns the run's number.

    Prompts are built (files read, texts extracted) here and never again.
    """
    spark, queue = prompts.sparkSession, queue_path(answers)
    done = [n for n in folder_numbers(spark, f"{queue}/members", "run") if path_exists(spark, f"{queue}/prompts/run={n}/_SUCCESS")]
    run = max(done, default=-1) + 1
    raw = scratch_path(spark, "queue-prompts")
    _identified(prompts).write.parquet(raw)
    src = spark.read.schema(MEMBERS + ", prompt string").parquet(raw)
    src.select("prompt_id", "task_id").write.mode("overwrite").parquet(f"{queue}/members/run={run}")
    new = src.select("prompt_id", "prompt")
    if done:
        new = new.join(spark.read.schema(PROMPTS).parquet(f"{queue}/prompts/run=*").select("prompt_id"), "prompt_id", "left_anti")
    new.groupBy("prompt_id").agg(F.first("prompt").alias("prompt")).write.mode("overwrite").parquet(f"{queue}/prompts/run={run}")
    return run


def queue_states(spark: SparkSession, answers: str) -> DataFrame:
    """(prompt_id, state, times_sent) of every queued prompt: pending, failed or done."""
    queued = spark.read.schema(PROMPTS).parquet(f"{queue_path(answers)}/prompts/run=*").select("prompt_id")
    if not path_exists(spark, answers):
        return queued.select("prompt_id", F.lit("pending").alias("state"), F.lit(0).cast("long").alias("times_sent"))
    sent = spark.read.schema(SCORED).parquet(answers).groupBy("prompt_id").agg(
        F.count(F.lit(1)).alias("times_sent"), F.bool_or(F.col("error").isNull()).alias("ok"))
    state = F.when(F.col("ok").isNull(), "pending").when(F.col("ok"), "done").otherwise("failed")
    return queued.join(sent, "prompt_id", "left").select("prompt_id", state.alias("state"), F.coalesce("times_sent", F.lit(0)).alias("times_sent"))


def drain(spark: SparkSession, fn: Callable[[str], str], answers: str, slices: int = 1,
          parallelism: int | None = None, max_attempts: int = 3, backoff_seconds: float = 0.5) -> None:
    """Sends every queued prompt that is not done, once each, in `slices` parts.

    A part claims its prompts by state when it begins and is committed when it
    ends, so a failure loses at most one part's answers, and whoever drains
    the queue next goes on from there.  Only stored prompts are read.
    """
    queued = spark.read.schema(PROMPTS).parquet(f"{queue_path(answers)}/prompts/run=*")
    part = F.pmod(F.xxhash64("prompt_id"), F.lit(slices))
    for i in range(slices):
        todo = queued.where(part == i)
        if path_exists(spark, answers):
            done = spark.read.schema(SCORED).parquet(answers).where(F.col("error").isNull() & (part == i))
            todo = todo.join(done.select("prompt_id"), "prompt_id", "left_anti")
        todo = todo.repartition(parallelism, "prompt_id") if parallelism else todo
        _answers(todo, fn, max_attempts, backoff_seconds).write.mode("append").parquet(answers)


def complete_to_table(prompts: DataFrame, fn: Callable[[str], str], path: str, slices: int = 1,
                      parallelism: int | None = None, max_attempts: int = 3, backoff_seconds: float = 0.5) -> DataFrame:
    """M1 and M2 with bookkeeping: a row per (task, prompt), answers stored in `path`, prompts in its queue.

    Prompts with a stored response are not sent; those that failed before, and
    new ones, are sent once each.  The prompts are built once, whatever `slices` is.
    Only a missing path counts as "no table yet"; any other fault is raised.
    """
    spark = prompts.sparkSession
    run = enqueue(prompts, path)
    drain(spark, fn, path, slices, parallelism, max_attempts, backoff_seconds)
    members = spark.read.schema(MEMBERS).parquet(f"{queue_path(path)}/members/run={run}")
    return members.join(read_answers(spark, path), "prompt_id").select(*COMPLETED.names)
