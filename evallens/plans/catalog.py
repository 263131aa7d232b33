"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables (through the adapters in `fixtures`) in
full; the matching DuckDB SQL is in `evallens.plans.oracle`.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evallens.operators import daily, gaps, report
from evallens.plans import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def summary_metrics(spark, d):
    return report.summary(fx.evaluations(spark, d))


def outcome_distribution(spark, d):
    return report.distribution(fx.evaluations(spark, d))


def top_feedback_words(spark, d):
    return report.top_words(fx.evaluations(spark, d))


def top_document_words(spark, d):
    docs = fx.table(spark, d, "documents", "doc_id", "text")
    return report.top_words(docs, text_col="text", id_col="doc_id")


def document_word_counts(spark, d):
    docs = fx.table(spark, d, "documents", "doc_id", "text")
    return report.word_counts(docs, text_col="text", id_col="doc_id").select("word", "frequency")


def evaluation_detail(spark, d):
    return report.detail(fx.evaluations(spark, d))


def first_evaluation(spark, d):
    return report.first_row(fx.evaluations(spark, d), "evaluation_id")


def _events(spark, d):
    return fx.table(spark, d, "events", "event_id", "ts")


def time_gaps(spark, d):
    return gaps.time_gaps(_events(spark, d), ts="ts", key="event_id")


def time_gaps_daily(spark, d):
    """Gaps of the events of each calendar day, restarted at midnight."""
    gap = gaps.time_gaps(_events(spark, d), ts="ts", key="event_id")
    prev = gaps.micros(F.col("ts")) - F.round(F.col("gap_minutes") * gaps.MICROS_PER_MINUTE).cast("long")
    midnight = gaps.micros(F.to_date("ts").cast("timestamp_ntz"))
    return gap.withColumn("gap_minutes", F.when(prev >= midnight, F.col("gap_minutes")))


def time_gaps_tied(spark, d):
    """Events with repeated rows and rows without an id at the same times."""
    ev = _events(spark, d)
    again = ev.where(F.col("event_id") % 10 == 0)
    unnamed = ev.where(F.col("event_id") % 15 == 0).select(F.lit(None).cast("long").alias("event_id"), "ts")
    return gaps.time_gaps(ev.unionByName(again).unionByName(unnamed), ts="ts", key="event_id")


def time_gaps_burst(spark, d):
    """Half of all events at one time."""
    at = F.when(F.col("event_id") % 2 == 0, F.expr("timestamp_ntz'2024-01-15 12:00:00'")).otherwise(F.col("ts"))
    return gaps.time_gaps(_events(spark, d).withColumn("ts", at), ts="ts", key="event_id")


def evaluation_gaps(spark, d):
    return gaps.time_gaps(fx.evaluations(spark, d))


def mean_gap(spark, d):
    return gaps.mean_gap(_events(spark, d), ts="ts")


def evaluation_mean_gap(spark, d):
    return gaps.mean_gap(fx.evaluations(spark, d))


def gap_histogram(spark, d):
    return gaps.gap_histogram(_events(spark, d), ts="ts")


def evaluation_gap_histogram(spark, d):
    return gaps.gap_histogram(fx.evaluations(spark, d))


QUERIES: dict[str, Query] = {
    "summary_metrics": summary_metrics,
    "outcome_distribution": outcome_distribution,
    "top_feedback_words": top_feedback_words,
    "top_document_words": top_document_words,
    "document_word_counts": document_word_counts,
    "evaluation_detail": evaluation_detail,
    "first_evaluation": first_evaluation,
    "time_gaps": time_gaps,
    "time_gaps_daily": time_gaps_daily,
    "time_gaps_tied": time_gaps_tied,
    "time_gaps_burst": time_gaps_burst,
    "evaluation_gaps": evaluation_gaps,
    "mean_gap": mean_gap,
    "evaluation_mean_gap": evaluation_mean_gap,
    "gap_histogram": gap_histogram,
    "evaluation_gap_histogram": evaluation_gap_histogram,
}


# --- tasks -------------------------------------------------------------------

from evallens.operators import files as files_op  # noqa: E402
from evallens.operators import links as links_op  # noqa: E402
from evallens.operators import tasks as tasks_op  # noqa: E402
from evallens.operators import verdicts as verdicts_op  # noqa: E402
from evallens.schemas import TASK_JSON  # noqa: E402
from evallens.session import scratch_path  # noqa: E402
from evallens.sources import tasks as tasks_src  # noqa: E402


def _tasks(spark, d):
    return fx.tasks(spark, d).drop("conv_id")


def tasks_flat(spark, d):
    """S1 + S2 on JSON text: nested records -> JSON -> parse with the fixed schema -> flatten."""
    nested = fx.nested_task_records(spark, d)
    parsed = nested.select(tasks_src.parse_task_json(F.to_json(F.struct(*nested.columns))).alias("r")).select("r.*")
    return tasks_src.flatten_tasks(parsed)


def tasks_loaded(spark, d):
    """S1-S4 through storage: JSON files -> scan -> flatten -> parquet table -> scan."""
    json_dir = scratch_path(spark, "task-json")
    fx.nested_task_records(spark, d).write.json(json_dir)
    flat = tasks_src.flatten_tasks(tasks_src.read_task_json(spark, json_dir, multiline=False))
    table_dir = scratch_path(spark, "tasks")
    tasks_src.write_tasks(flat, table_dir)
    return tasks_src.read_tasks(spark, table_dir, columns=tasks_src.TASK_COLUMNS)


def tasks_latest(spark, d):
    return tasks_op.latest_per_key(fx.task_loads(spark, d), "task_id", ("loaded_at",))


def tasks_current_steps(spark, d):
    return tasks_op.apply_step_updates(_tasks(spark, d), fx.step_changes(spark, d))


def unmatched_step_updates(spark, d):
    return tasks_op.unmatched_step_updates(_tasks(spark, d), fx.step_changes(spark, d))


def rejected_step_changes(spark, d):
    return tasks_op.rejected_step_changes(fx.step_changes(spark, d))


def evaluations_valid(spark, d):
    return verdicts_op.valid_verdicts(fx.verdicts(spark, d))


def evaluations_rejected(spark, d):
    return verdicts_op.rejected_verdicts(fx.verdicts(spark, d))


# --- files and links -----------------------------------------------------------

def _keys(spark, d):
    return fx.object_keys(spark, d).select("file_name")


def object_keys_split(spark, d):
    urls = fx.table(spark, d, "pages", "url").select(F.col("url").alias("file_name"))
    return files_op.split_keys(_keys(spark, d).unionByName(urls))


def task_files(spark, d):
    return files_op.files_by_task(_tasks(spark, d), _keys(spark, d))


def task_file_counts(spark, d):
    return files_op.file_counts(_tasks(spark, d), _keys(spark, d))


def orphan_files(spark, d):
    return files_op.orphan_files(_tasks(spark, d), _keys(spark, d))


def _pages(spark, d):
    return fx.table(spark, d, "pages", "page_id", "url", "html")


def links_all(spark, d):
    return links_op.harvest_links(_pages(spark, d))


def links_filtered(spark, d):
    return links_op.file_urls(links_op.harvest_links(_pages(spark, d)))


# The harvest suffixes match no link of the test pages; these two keep 410.
TEST_SUFFIXES = (".", "e")


def links_filtered_e(spark, d):
    return links_op.file_urls(links_op.harvest_links(_pages(spark, d)), suffixes=TEST_SUFFIXES)


QUERIES.update({
    "tasks_flat": tasks_flat,
    "tasks_loaded": tasks_loaded,
    "tasks_latest": tasks_latest,
    "tasks_current_steps": tasks_current_steps,
    "unmatched_step_updates": unmatched_step_updates,
    "rejected_step_changes": rejected_step_changes,
    "evaluations_valid": evaluations_valid,
    "evaluations_rejected": evaluations_rejected,
    "object_keys_split": object_keys_split,
    "task_files": task_files,
    "task_file_counts": task_file_counts,
    "orphan_files": orphan_files,
    "links_all": links_all,
    "links_filtered": links_filtered,
    "links_filtered_e": links_filtered_e,
})


# --- extraction, prompts, completions ----------------------------------------------

import hashlib  # noqa: E402

from evallens.operators import extract as extract_op  # noqa: E402
from evallens.operators import prompts as prompts_op  # noqa: E402


def extract_plain(spark, d):
    return extract_op.extract_text(fx.file_bytes(spark, d), python_formats=()).select("key", "ext", "text", "status")


def extract_csv(spark, d):
    return extract_op.extract_text(fx.csv_files(spark, d)).select("key", "ext", "text", "status")


def extract_zip(spark, d):
    return extract_op.extract_text(fx.zip_files(spark, d)).select("key", "ext", "text", "status")


def _prompts(spark, d, tasks=None):
    tasks = tasks if tasks is not None else _tasks(spark, d)
    files = files_op.wanted_files(tasks, fx.object_bytes(spark, d))
    return prompts_op.build_prompts(tasks, extract_op.extract_text(files))


def prompts(spark, d):
    return _prompts(spark, d)


def answer_fingerprint(prompt: str) -> str:
    """Deterministic stand-in for the chat service: reads the whole prompt."""
    return f"{len(prompt)}:{hashlib.sha256(prompt.encode('utf-8')).hexdigest()}"


def completions(spark, d):
    return prompts_op.complete(_prompts(spark, d), answer_fingerprint)


def _extracted(spark, d):
    """The text of the tasks' files, extracted once and stored."""
    files = files_op.wanted_files(_tasks(spark, d), fx.object_bytes(spark, d))
    path = scratch_path(spark, "extracted")
    extract_op.extract_text(files).write.parquet(path)
    return spark.read.schema(extract_op.EXTRACTED).parquet(path)


def rerun_completions(spark, d):
    """M2: after steps edits, only prompts without a stored answer are scored again."""
    tasks, texts = _tasks(spark, d), _extracted(spark, d)
    answers = scratch_path(spark, "answers")
    prompts_op.complete_to_table(prompts_op.build_prompts(tasks, texts), answer_fingerprint, answers)
    edited = tasks_op.apply_step_updates(tasks, fx.step_changes(spark, d))
    after = prompts_op.build_prompts(edited, texts)
    return prompts_op.complete(prompts_op.changed_prompts(after, prompts_op.read_answers(spark, answers)), answer_fingerprint)


def _failing_fingerprint(prompt: str) -> str:
    """A service that is down for the prompts whose fingerprint starts with a letter."""
    out = answer_fingerprint(prompt)
    if out.split(":")[1][0] in "abcdef":
        raise RuntimeError("down")
    return out


def completions_resumed(spark, d):
    """M1 + M2: some prompts fail in the first run; the second run sends only those."""
    p, answers = _prompts(spark, d), scratch_path(spark, "answers")
    prompts_op.complete_to_table(p, _failing_fingerprint, answers, max_attempts=1)
    rows = prompts_op.complete_to_table(p, answer_fingerprint, answers, slices=2)
    return rows.join(prompts_op.queue_states(spark, answers), "prompt_id")


def completions_shared(spark, d):
    """M1: tasks that share a prompt get a row each and the prompt is sent once."""
    p = prompts_op.build_prompts(_tasks(spark, d))
    again = p.withColumn("task_id", F.concat(F.lit("copy-"), "task_id"))
    answers = scratch_path(spark, "answers")
    rows = prompts_op.complete_to_table(p.unionByName(again), answer_fingerprint, answers)
    sent = spark.read.schema(prompts_op.SCORED).parquet(answers).groupBy("prompt_id").agg(F.count(F.lit(1)).alias("times_sent"))
    return rows.join(sent, "prompt_id").select("task_id", "response", "times_sent")


def extract_csv_rewritten(spark, d):
    """E4 where pandas changes the text: quoted fields, trailing zeros and a missing value."""
    return extract_op.extract_text(fx.quoted_csv_files(spark, d)).select("key", "ext", "text", "status")


def extract_encodings(spark, d):
    """Carriage returns, bytes that are not UTF-8, and files without content."""
    return extract_op.extract_text(fx.odd_file_bytes(spark, d), python_formats=()).select("key", "ext", "text", "status")


def extract_decoded(spark, d):
    """A caller's decoder for `.docx` files."""
    files = fx.file_bytes(spark, d).select(F.regexp_replace("key", r"\.json$", ".docx").alias("key"), "content")
    decode = lambda data: f"{len(data)} bytes"
    return extract_op.extract_text(files, decoders={".docx": decode}, python_formats=()).where("ext = '.docx'").select("key", "text", "status")


QUERIES.update({
    "completions_resumed": completions_resumed,
    "completions_shared": completions_shared,
    "extract_csv_rewritten": extract_csv_rewritten,
    "extract_encodings": extract_encodings,
    "extract_decoded": extract_decoded,
})

QUERIES.update({
    "extract_plain": extract_plain,
    "extract_csv": extract_csv,
    "extract_zip": extract_zip,
    "prompts": prompts,
    "completions": completions,
    "rerun_completions": rerun_completions,
})


# --- object store and streaming ---------------------------------------------------

from evallens.session import shared_dir  # noqa: E402,F401
from evallens.sources import objects as objects_src  # noqa: E402
from evallens.sources.paths import delete_path, open_fs, qualified  # noqa: E402
from evallens.streaming import ingest as ingest_st  # noqa: E402

# Stored files: <folder>/key=<name>
KEY_PATTERN = r"/key=([^/]+)$"
NO_KEY = "__HIVE_DEFAULT_PARTITION__"  # the name of the object that holds the rows without a key
FILES_PER_FOLDER = 2_000
MOST_REPEATED = 10_000  # keys that come more than once and are set apart, before all rows are dealt by key


def _stored_documents(spark, d):
    """Documents written as files, one per key, with a newline at the end."""
    store = scratch_path(spark, "store")
    docs = fx.file_bytes(spark, d).select("key", F.col("content").cast("string").alias("value"))
    return _written(docs, store)


def _written(docs, store):
    """(key, value) rows as files, one per key, whose values are its lines.

    Files lie in folders by a hash of their key.  A task streams each to a hidden name
    and moves it to its place when it is whole, so a repeated task changes nothing.
    Rows are dealt by key where keys repeat; the others are written where they are read.
    """
    spark = docs.sparkSession
    store = qualified(spark, store)
    fs, top = open_fs(store)
    fs.create_dir(top, recursive=True)
    folders = max(4 * spark.sparkContext.defaultParallelism, -(-docs.count() // FILES_PER_FOLDER))
    rows = docs.select(F.coalesce(F.nullif("key", F.lit("")), F.lit(NO_KEY)).alias("key"), F.coalesce("value", F.lit("")).cast("binary").alias("value"))
    rows = rows.withColumn("folder", F.pmod(F.xxhash64("key"), F.lit(folders)))
    repeated = [(r.key,) for r in rows.groupBy("key").count().where("count > 1").select("key").limit(MOST_REPEATED + 1).collect()]
    if len(repeated) > MOST_REPEATED:
        parts = [(rows, True)]
    elif repeated:
        keys = F.broadcast(spark.createDataFrame(repeated, "key string"))
        parts = [(rows.join(keys, "key", "left_anti"), False), (rows.join(keys, "key", "left_semi"), True)]
    else:
        parts = [(rows, False)]

    def write(batches):
        fs, top = open_fs(store)
        at, sink, hidden, done, made = None, None, "", 0, set()

        def close():
            sink.close()
            fs.move(hidden, f"{top}/{at[0]}/key={quote(at[1], safe='')}")

        for b in batches:
            for folder, key, value in zip(b.column("folder").to_pylist(), b.column("key").to_pylist(), b.column("value")):
                if (folder, key) != at:
                    if sink is not None:
                        close()
                    if folder not in made:
                        fs.create_dir(f"{top}/{folder}", recursive=True)
                        made.add(folder)
                    at, hidden, done = (folder, key), f"{top}/{folder}/.{uuid.uuid4().hex}", done + 1
                    sink = fs.open_output_stream(hidden, compression=None)
                sink.write(value.as_buffer())
                sink.write(b"\n")
        if sink is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([done])], names=["files"])

    for part, deal in parts:
        if deal:
            part = part.repartition(folders, "folder").sortWithinPartitions("folder", "key", "value")
        part.select("folder", "key", "value").mapInArrow(write, "files long").agg(F.sum("files")).collect()
    return store


def object_listing(spark, d):
    """S8 over a store derived from `documents`."""
    store = _stored_documents(spark, d)
    return objects_src.list_objects(spark, store, key_pattern=KEY_PATTERN).select("key", "length")


def objects_landed(spark, d):
    """S8 + S9 + S11 + extraction: store -> landed table (by ext) -> text."""
    store = _stored_documents(spark, d)
    out = scratch_path(spark, "landed")
    objects_src.land_objects(spark, store, out, key_pattern=KEY_PATTERN)
    landed = objects_src.read_landed(spark, out)
    return extract_op.extract_text(landed, python_formats=()).select("key", "ext", "text", "status")


def _evaluation_files(spark, d):
    """The evaluations written as files twice over: all rows, then the incorrect ones again."""
    src = scratch_path(spark, "eval-in")
    ev = fx.evaluations(spark, d)
    ev.write.parquet(f"{src}/part1")
    ev.where(~F.col("is_correct")).write.parquet(f"{src}/part2")
    return src


def ingest_stream_result(spark, d):
    """Duplicates removed by the streaming ingest."""
    src = _evaluation_files(spark, d)
    sink = scratch_path(spark, "eval-sink")
    q = ingest_st.ingest_evaluations(spark, f"{src}/*", sink, scratch_path(spark, "ckpt"))
    q.awaitTermination()
    return ingest_st.read_ingested(spark, sink)


def live_summary_result(spark, d):
    """The streaming summary over the ingested table."""
    src = _evaluation_files(spark, d)
    sink = scratch_path(spark, "eval-sink")
    ingest_st.ingest_evaluations(spark, f"{src}/*", sink, scratch_path(spark, "ckpt")).awaitTermination()
    out = scratch_path(spark, "summary")
    ingest_st.live_summary(spark, sink, out, scratch_path(spark, "ckpt")).awaitTermination()
    return ingest_st.read_summary(spark, out)


def live_summary_replayed(spark, d):
    """T2 after T1 has replayed a batch whose commit was lost."""
    src, sink, ckpt = _evaluation_files(spark, d), scratch_path(spark, "eval-sink"), scratch_path(spark, "ckpt")
    out, seen = scratch_path(spark, "summary"), scratch_path(spark, "ckpt")
    files = len(spark.read.parquet(f"{src}/*").inputFiles())

    def both():
        ingest_st.ingest_evaluations(spark, f"{src}/*", sink, ckpt, max_files_per_trigger=-(-files // 3)).awaitTermination()
        ingest_st.live_summary(spark, sink, out, seen).awaitTermination()

    both()
    last = spark.read.schema(ingest_st.STORED).parquet(sink).agg(F.max("batch")).first()[0]
    delete_path(spark, f"{ckpt}/commits/{last}")
    both()
    return ingest_st.read_summary(spark, out)


QUERIES.update({
    "live_summary_replayed": live_summary_replayed,
    "object_listing": object_listing,
    "objects_landed": objects_landed,
    "ingest_stream_result": ingest_stream_result,
    "live_summary_result": live_summary_result,
})


def links_parsed(spark, d):
    """S10 on pages with nested and unclosed items, comments and custom tags."""
    return links_op.harvest_links(fx.odd_pages(spark, d))


QUERIES["links_parsed"] = links_parsed


def summary_display(spark, d):
    return report.summary_display(fx.evaluations(spark, d))


def evaluated_tasks(spark, d):
    """P7 at scale: the tasks named by the evaluations (a set of ids, semi join)."""
    return tasks_op.pick_tasks(_tasks(spark, d), fx.evaluations(spark, d).select("task_id"))


def _flat(blocks):
    """Blocks of the report as (block, item, value) rows."""
    summary = {"total": "total_evaluations", "correct": "correct_answers", "incorrect": "incorrect_answers", "correct_pct": "correct_pct",
               "incorrect_pct": "incorrect_pct"}
    numbers = f"stack({len(summary)}, " + ", ".join(f"'{k}', double({c})" for k, c in summary.items()) + ")"
    rows = {
        "summary": blocks["summary"].select(F.expr(f"{numbers} AS (item, value)")),
        "distribution": blocks["distribution"].select(F.col("outcome").alias("item"), F.col("n").cast("double").alias("value")),
        "top_words": blocks["top_words"].select(F.concat_ws(" ", "rank", "word").alias("item"), F.col("frequency").cast("double").alias("value")),
        "mean_gap": blocks["mean_gap"].select(F.col("n_times").cast("string").alias("item"), F.col("mean_gap_minutes").alias("value")),
        "histogram": blocks["histogram"].select(F.col("bin").cast("string").alias("item"), F.col("n").cast("double").alias("value")),
    }
    out = [df.select(F.lit(name).alias("block"), "item", "value") for name, df in rows.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), out)


def report_incremental(spark, d):
    """The report from daily states: old days first, then a new day, and an old one again after late rows."""
    path, ev = scratch_path(spark, "report-states"), fx.evaluations(spark, d)
    day = F.to_date("evaluation_timestamp")
    last = ev.agg(F.max(day).cast("string")).first()[0]
    late = ev.agg(F.min(day).cast("string")).first()[0]
    daily.update_states(ev.where((day < last) & ((day != late) | (F.col("evaluation_id") % 3 == 0))), path)
    daily.update_states(ev, path, [last])
    daily.update_states(ev, path, [late])
    return _flat(daily.report_from_states(spark, path))


def report_empty(spark, d):
    """Rows per block of the report over a table without evaluations."""
    none = fx.evaluations(spark, d).where(F.col("evaluation_id").isNull())
    out = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("block"), "n") for name, df in report.evaluation_report(none).items()]
    return functools.reduce(lambda a, b: a.unionByName(b), out)


def top_words_unnamed(spark, d):
    """O2 with rows that have no id: a third of the feedback, and a word that only they hold."""
    ev = fx.evaluations(spark, d)
    none = F.col("evaluation_id") % 3 == 0
    text = F.when(none, F.concat("user_feedback", F.lit(" zebra zebra zebra zebra zebra zebra zebra zebra"))).otherwise(F.col("user_feedback"))
    ev = ev.withColumns({"user_feedback": text, "evaluation_id": F.when(~none, F.col("evaluation_id"))})
    return report.top_words(ev)


QUERIES.update({"report_incremental": report_incremental, "report_empty": report_empty, "top_words_unnamed": top_words_unnamed})
QUERIES.update({"summary_display": summary_display, "evaluated_tasks": evaluated_tasks})


# --- backfills, strictness, versions -----------------------------------------------

from evallens.operators import verdicts as verdicts_ops  # noqa: E402
from evallens.sources import evaluations as evals_src  # noqa: E402


def ingest_stream_backfill(spark, d):
    """T1 over several triggers with old files among them, and equal verdicts without ids."""
    src, sink = scratch_path(spark, "backfill-in"), scratch_path(spark, "backfill-sink")
    ev = fx.evaluations(spark, d)
    for i in range(3):  # each part's times lie months before the one before
        part = ev.where(F.col("evaluation_id") % 3 == i)
        part = part.withColumn("evaluation_timestamp", F.col("evaluation_timestamp") - F.make_dt_interval(F.lit(60 * i)))
        part.write.parquet(f"{src}/part{i}")
    unnamed = ev.where(F.col("evaluation_id") % 5 == 0).withColumn("evaluation_id", F.lit(None).cast("long"))
    unnamed.unionByName(unnamed).write.parquet(f"{src}/part3")
    files = len(spark.read.parquet(f"{src}/*").inputFiles())
    ingest_st.ingest_evaluations(spark, f"{src}/*", sink, scratch_path(spark, "ckpt"), max_files_per_trigger=-(-files // 4)).awaitTermination()
    got = ingest_st.read_ingested(spark, sink)
    return got.select(F.col("evaluation_id").isNotNull().alias("has_id"), "task_id", "is_correct", "user_feedback", "evaluation_timestamp")


def evaluations_stored(spark, d):
    """S5 + S6 + F10: verdicts without id and time, appended twice and read back."""
    path = scratch_path(spark, "evaluations")
    v = verdicts_ops.valid_verdicts(fx.verdicts(spark, d)).drop("evaluation_id", "evaluation_timestamp")
    for _ in range(2):
        evals_src.append_evaluations(v, path)
    got = evals_src.read_evaluations(spark, path)
    return got.groupBy("task_id", "is_correct", "user_feedback").agg(
        F.count_distinct("evaluation_id").alias("ids"), F.count("evaluation_timestamp").alias("times"))


def objects_fetched(spark, d):
    """The content of the wanted keys."""
    store = _stored_documents(spark, d)
    wanted = fx.file_bytes(spark, d).where(F.col("key").rlike(r"[05]\.(txt|py)$")).select("key")
    got = objects_src.fetch_objects(spark, store, wanted, key_pattern=KEY_PATTERN)
    return got.select("key", F.col("content").cast("string").alias("text"))


def objects_fetched_landed(spark, d):
    """S9 on a landed store: only the slots of the wanted keys are read."""
    out = scratch_path(spark, "landed")
    objects_src.land_objects(spark, _stored_documents(spark, d), out, key_pattern=KEY_PATTERN, slot_bytes=1 << 14)
    wanted = fx.file_bytes(spark, d).where(F.col("key").rlike(r"^[0-9]*77\.")).select("key")
    return objects_src.fetch_landed(spark, out, wanted).select("key", F.col("content").cast("string").alias("text"))


def objects_landed_delta(spark, d):
    """S8 + S11 from inventories: of the second one only new and changed objects are read, deleted ones go."""
    docs = fx.file_bytes(spark, d).select("key", F.col("content").cast("string").alias("value"))
    m = F.regexp_extract("key", r"^(\d+)", 1).cast("long") % 7
    first = _written(docs.where(m != 3), scratch_path(spark, "store"))
    later = docs.where(m.isin(1, 3)).withColumn("value", F.concat("value", F.lit(" (again)")))
    later = _written(later, scratch_path(spark, "store"))
    old, new = (objects_src.list_objects(spark, s, key_pattern=KEY_PATTERN) for s in (first, later))
    inventories = [old, old.where(~m.isin(1, 2)).unionByName(new)]
    out = scratch_path(spark, "landed")
    for i, inventory in enumerate(inventories):
        path = scratch_path(spark, "inventory")
        inventory.select(F.col("path").alias("object"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified")).write.parquet(path)
        listing = objects_src.inventory_listing(spark.read.parquet(path), "object", "size", "last_modified", key_pattern=KEY_PATTERN)
        objects_src.land_changes(spark, out, listing, landing=i)
    landed = objects_src.read_landed(spark, out)
    return landed.select("key", "ext", "length", F.col("content").cast("string").alias("text"))


def _task_lines(spark, d):
    """Task records as JSON lines; each eleventh is cut off, some levels are text or decimals."""
    r = fx.nested_task_records(spark, d)
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in r.columns]))
    i = F.col("task_id").cast("long")
    line = F.when(i % 3 == 1, F.regexp_replace(line, r'"Level":(\d)', '"Level":"$1"')).when(
        i % 3 == 2, F.regexp_replace(line, r'"Level":(\d)', '"Level":$1.0')).otherwise(line)
    path = scratch_path(spark, "task-lines")
    r.select(F.when(i % 11 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(path)
    return tasks_src.read_task_json(spark, path, multiline=False, strict=False)


def tasks_lenient(spark, d):
    """S1 + S2: the valid records of a lenient read, levels given as text or decimals."""
    return tasks_src.flatten_tasks(tasks_src.good_records(_task_lines(spark, d)))


def tasks_rejected(spark, d):
    """The text of the records that are not valid JSON."""
    return tasks_src.rejected_records(_task_lines(spark, d))


def tasks_array(spark, d):
    """S1 + S2: files whose root is an array, one per hundred tasks."""
    r = fx.nested_task_records(spark, d)
    arrays = r.groupBy(F.floor(F.col("task_id").cast("long") / 100).alias("part")).agg(
        F.expr("concat('[', listagg(to_json(struct(*)), ',\n'), ']')").alias("value"))
    path = scratch_path(spark, "task-arrays")
    arrays.repartition("part").write.partitionBy("part").text(path)
    return tasks_src.flatten_tasks(tasks_src.read_task_json(spark, path).drop("part"))


def tasks_tied(spark, d):
    """Loads with one time; the row that sorts last by its columns stays."""
    loads = fx.task_loads(spark, d).withColumn("loaded_at", F.expr("timestamp_ntz'2024-03-01 00:00:00'"))
    return tasks_op.latest_per_key(loads, "task_id", ("loaded_at",))


def tasks_compacted(spark, d):
    """A compacted version of the tasks reads like the log."""
    return tasks_op.compact_steps(_tasks(spark, d), fx.step_changes(spark, d), scratch_path(spark, "tasks-v2"))


def tasks_versioned(spark, d):
    """A store with edits before, at and after a compaction, some of them late, reads like the log."""
    path, log = scratch_path(spark, "task-store"), fx.step_changes(spark, d)
    tasks_op.create_task_store(_tasks(spark, d), path, buckets=8)
    late = F.regexp_extract("task_id", r"(\d+)$", 1).cast("long") % 8 == 0
    for i, part in enumerate((log.where((F.col("seq") > 1) & late), log.where((F.col("seq") == 1) & ~late), log.where((F.col("seq") == 1) & late),
                              log.where((F.col("seq") > 1) & ~late))):
        tasks_op.append_step_edits(part, path)
        if i % 2 == 0:
            tasks_op.compact_task_store(spark, path)
    return tasks_op.read_current_tasks(spark, path)


def links_odd_files(spark, d):
    """P3-P5 on odd pages: one row per file URL, `/blob/` rewritten."""
    links = links_op.harvest_links(fx.odd_pages(spark, d))
    return links_op.file_urls(links, distinct=True)


QUERIES.update({
    "ingest_stream_backfill": ingest_stream_backfill,
    "evaluations_stored": evaluations_stored,
    "objects_fetched": objects_fetched,
    "objects_fetched_landed": objects_fetched_landed,
    "objects_landed_delta": objects_landed_delta,
    "tasks_lenient": tasks_lenient,
    "tasks_rejected": tasks_rejected,
    "tasks_array": tasks_array,
    "tasks_tied": tasks_tied,
    "tasks_compacted": tasks_compacted,
    "tasks_versioned": tasks_versioned,
    "links_odd_files": links_odd_files,
})
