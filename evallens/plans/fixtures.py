"""Adapter views over the driver tables (FIXTURES.md section 3).

Each adapter exists twice, as a DataFrame and as DuckDB SQL, with the same
definition, so every registered query can be checked against an oracle.  All
adapters read whole tables; their work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


# --- evaluations -------------------------------------------------------------

def evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "labels", "doc_id", "quality")
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    e = table(spark, sf_dir, "events", "event_id", "ts")
    j = l.join(d, "doc_id").join(e, F.col("doc_id") == F.col("event_id"))
    return j.select(
        F.col("doc_id").alias("evaluation_id"),
        F.col("doc_id").cast("string").alias("task_id"),
        (F.col("quality") == 1).alias("is_correct"),
        F.when(F.col("quality") == 0, F.col("text")).alias("user_feedback"),
        F.col("ts").alias("evaluation_timestamp"),
    )


EVALUATIONS_SQL = """
evaluations AS (
  SELECT l.doc_id AS evaluation_id, CAST(l.doc_id AS VARCHAR) AS task_id,
         (l.quality = 1) AS is_correct,
         CASE WHEN l.quality = 0 THEN d.text END AS user_feedback,
         e.ts AS evaluation_timestamp
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id
       JOIN events e ON e.event_id = l.doc_id
)"""


# --- verdicts: evaluations with blank and padded feedback ---------------------

def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = evaluations(spark, sf_dir)
    i = F.col("evaluation_id")
    fb = (F.when(i % 7 == 0, F.lit(" \t　 "))
           .when(i % 5 == 0, F.concat(F.lit("  "), F.coalesce(F.col("user_feedback"), F.lit("ok")), F.lit(" \n")))
           .otherwise(F.col("user_feedback")))
    return ev.withColumn("user_feedback", fb)


VERDICTS_SQL = EVALUATIONS_SQL + """,
verdicts AS (
  SELECT evaluation_id, task_id, is_correct,
         CASE WHEN evaluation_id % 7 = 0 THEN ' ' || chr(9) || chr(12288) || ' '
              WHEN evaluation_id % 5 = 0 THEN '  ' || coalesce(user_feedback, 'ok') || chr(160) || chr(10)
              ELSE user_feedback END AS user_feedback,
         evaluation_timestamp
  FROM evaluations
)"""


# --- tasks: one per conversation ----------------------------------------------

def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return c.groupBy("conv_id").agg(
        F.expr("min_by(text, turn) FILTER (WHERE role = 'user')").alias("question"),
        F.expr("min_by(text, turn) FILTER (WHERE role = 'assistant')").alias("final_answer"),
        F.expr("min_by(text, turn) FILTER (WHERE role = 'system')").alias("steps"),
        F.count(F.lit(1)).alias("n_turns"),
    ).select(
        F.col("conv_id").cast("string").alias("task_id"),
        F.col("question"),
        (F.col("conv_id") % 3 + 1).cast("int").alias("level"),
        F.lit("").alias("file_name"),
        F.col("final_answer"),
        F.col("steps"),
        F.col("n_turns").cast("string").alias("number_of_steps"),
        F.lit("").alias("how_long"),
        F.lit("").alias("tools"),
        F.lit("0").alias("number_of_tools"),
        F.col("conv_id"),
    )


TASKS_SQL = """
tasks AS (
  SELECT CAST(conv_id AS VARCHAR) AS task_id,
         arg_min(text, turn) FILTER (WHERE role = 'user') AS question,
         CAST(conv_id % 3 + 1 AS INTEGER) AS level,
         '' AS file_name,
         arg_min(text, turn) FILTER (WHERE role = 'assistant') AS final_answer,
         arg_min(text, turn) FILTER (WHERE role = 'system') AS steps,
         CAST(count(*) AS VARCHAR) AS number_of_steps,
         '' AS how_long, '' AS tools, '0' AS number_of_tools,
         conv_id
  FROM conversations GROUP BY conv_id
)"""


def nested_task_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The question-set shape (TASK_JSON) built from conversations.

    Conversations without a system turn have no `Annotator Metadata`; odd ids
    miss `How long did this take?`; ids divisible by 4 have an explicit null
    `Level`.
    """
    t = tasks(spark, sf_dir)
    meta = F.struct(
        F.col("steps").alias("Steps"),
        F.col("number_of_steps").alias("Number of steps"),
        F.when(F.col("conv_id") % 2 == 0, F.concat(F.col("number_of_steps"), F.lit(" minutes"))).alias("How long did this take?"),
        F.lit("none").alias("Tools"),
        F.col("number_of_tools").alias("Number of tools"),
    )
    return t.select(
        F.col("task_id"),
        F.col("question").alias("Question"),
        F.when(F.col("conv_id") % 4 != 0, F.col("level")).alias("Level"),
        F.concat(F.col("task_id"), F.lit(".txt")).alias("file_name"),
        F.col("final_answer").alias("Final answer"),
        F.when(F.col("steps").isNotNull(), meta).alias("Annotator Metadata"),
    )


# --- tasks loaded twice: P6 ------------------------------------------------------

def task_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tasks(spark, sf_dir).drop("conv_id").withColumn("conv_id", F.col("task_id").cast("long"))
    first = t.withColumn("loaded_at", F.expr("timestamp_ntz'2024-03-01 00:00:00'"))
    again = (t.where(F.col("conv_id") % 5 == 0)
              .withColumn("question", F.concat(F.col("question"), F.lit(" (revised)")))
              .withColumn("loaded_at", F.expr("timestamp_ntz'2024-03-01 01:00:00'")))
    return first.unionByName(again).drop("conv_id")


TASK_LOADS_SQL = TASKS_SQL + """,
task_loads AS (
  SELECT * EXCLUDE (conv_id), TIMESTAMP '2024-03-01 00:00:00' AS loaded_at FROM tasks
  UNION ALL BY NAME
  SELECT * EXCLUDE (conv_id) REPLACE (question || ' (revised)' AS question),
         TIMESTAMP '2024-03-01 01:00:00' AS loaded_at
  FROM tasks WHERE conv_id % 5 = 0
)"""


# --- step change log: S7 -------------------------------------------------------

def step_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits in one pass over the tasks: two accepted edits for ids = 0 (mod 4), a
    blank one for 1 (mod 4), one for an unknown id for 2 (mod 4)."""
    t = tasks(spark, sf_dir).select("task_id", "conv_id")
    m = F.col("conv_id") % 4
    tid = F.col("task_id")
    base = F.expr("timestamp_ntz'2024-02-01 00:00:00' + make_dt_interval(0, 0, CAST(conv_id AS INT), 0)")

    def change(seq: int, task_id, steps, when_):
        at = base + F.expr(f"make_dt_interval({seq}, 0, 0, 0)")
        return F.when(when_, F.struct(task_id.alias("task_id"), steps.alias("steps"), at.alias("changed_at"),
                                      F.lit(seq).cast("long").alias("seq")))

    edits = F.array_compact(F.array(
        change(1, tid, F.concat(F.lit("Step 1: revise the answer for task "), tid), m == 0),
        change(2, tid, F.concat(F.lit("Step 2: check the answer for task "), tid, F.lit("\n")), m == 0),
        change(3, tid, F.lit(" \n\t "), m == 1),
        change(4, F.concat(F.lit("unknown-"), tid), F.lit("orphan change"), m == 2),
    ))
    return t.select(F.explode(edits).alias("c")).select("c.*")


STEP_CHANGES_CTE = """
step_changes AS (
  SELECT task_id, 'Step 1: revise the answer for task ' || task_id AS steps,
         TIMESTAMP '2024-02-01 00:00:00' + to_minutes(CAST(conv_id AS BIGINT)) + INTERVAL 1 DAY AS changed_at, CAST(1 AS BIGINT) AS seq
  FROM tasks WHERE conv_id % 4 = 0
  UNION ALL
  SELECT task_id, 'Step 2: check the answer for task ' || task_id || chr(10),
         TIMESTAMP '2024-02-01 00:00:00' + to_minutes(CAST(conv_id AS BIGINT)) + INTERVAL 2 DAY, 2
  FROM tasks WHERE conv_id % 4 = 0
  UNION ALL
  SELECT task_id, ' ' || chr(10) || chr(9) || ' ',
         TIMESTAMP '2024-02-01 00:00:00' + to_minutes(CAST(conv_id AS BIGINT)) + INTERVAL 3 DAY, 3
  FROM tasks WHERE conv_id % 4 = 1
  UNION ALL
  SELECT 'unknown-' || task_id, 'orphan change',
         TIMESTAMP '2024-02-01 00:00:00' + to_minutes(CAST(conv_id AS BIGINT)) + INTERVAL 4 DAY, 4
  FROM tasks WHERE conv_id % 4 = 2
)"""
STEP_CHANGES_SQL = TASKS_SQL + "," + STEP_CHANGES_CTE



# --- object keys: files attached to tasks ----------------------------------------

def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tasks(spark, sf_dir).select("task_id", "conv_id")
    m = F.col("conv_id") % 3
    keys = F.array_compact(F.array(
        F.when(m >= 1, F.concat(F.col("task_id"), F.lit(".txt"))),
        F.when(m == 2, F.concat(F.col("task_id"), F.lit(".PDF"))),
        F.when(F.col("conv_id") % 10 == 0, F.concat(F.lit("x"), F.col("task_id"), F.lit(".csv"))),
    ))
    return t.select(F.explode(keys).alias("file_name"), F.col("conv_id"))


OBJECT_KEYS_SQL = TASKS_SQL + """,
object_keys AS (
  SELECT task_id || '.txt' AS file_name, conv_id FROM tasks WHERE conv_id % 3 >= 1
  UNION ALL SELECT task_id || '.PDF', conv_id FROM tasks WHERE conv_id % 3 = 2
  UNION ALL SELECT 'x' || task_id || '.csv', conv_id FROM tasks WHERE conv_id % 10 = 0
)"""


def object_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys with content: the document whose id is the conversation id."""
    k = object_keys(spark, sf_dir)
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    return (k.join(d, k.conv_id == d.doc_id, "left")
             .select(F.col("file_name").alias("key"),
                     F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8").alias("content")))


# --- file bytes: documents as stored files ------------------------------------------

FILE_BYTES_EXTS = (".txt", ".py", ".pdb", ".json")


def file_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    ext = F.element_at(F.array(*[F.lit(e) for e in FILE_BYTES_EXTS]), (F.col("doc_id") % 4 + 1).cast("int"))
    return d.select(
        F.concat(F.col("doc_id").cast("string"), ext).alias("key"),
        F.encode(F.col("text"), "UTF-8").alias("content"),
    )


def odd_file_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files with carriage returns (id % 3 = 1), a byte that is not
    UTF-8 at the end (id % 3 = 2; in `.py` files it reads as Latin-1), or, for ids
    divisible by 9, no content."""
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    ext = F.element_at(F.array(F.lit(".txt"), F.lit(".py"), F.lit(".pdb")), (F.floor(F.col("doc_id") / 3) % 3 + 1).cast("int"))
    text = F.encode(F.col("text"), "UTF-8")
    ascii_ = F.encode(F.regexp_replace("text", r"[^\x00-\x7F]", "?"), "UTF-8")
    bad = F.concat(F.when(ext == ".py", ascii_).otherwise(text), F.unhex(F.lit("E9")))
    m = F.col("doc_id") % 3
    content = F.when(F.col("doc_id") % 9 == 0, F.lit(None).cast("binary")).when(
        m == 1, F.encode(F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")), "UTF-8")).when(m == 2, bad).otherwise(text)
    return d.select(F.concat(F.col("doc_id").cast("string"), ext).alias("key"), content.alias("content"))


def quoted_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`{custkey}.csv` of the customer's orders: keys in quotes, priorities with a
    zero too many, an empty field for orders that are not finished."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    line = F.concat(F.lit('"'), F.col("o_orderkey").cast("string"), F.lit('",'), (F.col("o_orderkey") % 7).cast("string"), F.lit(".50,"),
                    F.when(F.col("o_orderstatus") == "F", F.lit("F")).otherwise(F.lit("")))
    per = o.withColumn("_line", line).groupBy("o_custkey").agg(
        F.expr("listagg(_line, '\n') WITHIN GROUP (ORDER BY o_orderkey)").alias("_body"))
    return per.select(F.concat(F.col("o_custkey").cast("string"), F.lit(".csv")).alias("key"),
                      F.encode(F.concat(F.lit("key,prio,status\n"), F.col("_body"), F.lit("\n\n")), "UTF-8").alias("content"))


# --- odd pages: nested and unclosed items around the real page ---------------------------

def odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages", "page_id", "url", "html")
    i = F.col("page_id").cast("string")
    head = F.concat(
        F.lit('<!-- <li><a href="/hidden.pdf">x</a></li> --><ul><li><a href="/u/blob/'), i,
        F.lit('.pdf">a<li class="x>y"><a name=n href=\'/v/'), i, F.lit('.txt\'>b</ul><li-icon><a href="/icon.pdf"></a></li-icon>'
              '<script>var x = "<li><a href=/s.pdf>";</script><ol><li>outer<ul><li><a href="/in&#x26;'), i,
        F.lit('&amp;&#233;.csv">c</a></li></ul></li><LI><br/><a href="https://o.example/z/blob/same.pdf">d</a></LI></ol><a href="/free.pdf">e</a>'))
    return p.select("page_id", "url", F.concat(head, F.col("html")).alias("html"))


# --- CSV files: one per order, its line items ----------------------------------------

CSV_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`{orderkey}.csv` with a header and the order's lines in line-number order (ties by text)."""
    li = table(spark, sf_dir, "lineitem", *CSV_COLUMNS)
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CSV_COLUMNS])
    body = F.expr("listagg(_line, '\n') WITHIN GROUP (ORDER BY l_linenumber, _line)")
    per_order = li.withColumn("_line", line).groupBy("l_orderkey").agg(body.alias("_body"))
    return per_order.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".csv")).alias("key"),
        F.encode(F.concat(F.lit(",".join(CSV_COLUMNS) + "\n"), F.col("_body"), F.lit("\n")), "UTF-8").alias("content"),
    )


CSV_FILES_SQL = """
csv_lines AS (
  SELECT l_orderkey, l_linenumber,
         concat_ws(',', """ + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in CSV_COLUMNS) + """) AS line
  FROM lineitem)"""


# --- ZIP archives: one per conversation ------------------------------------------------

def _zip_batch(batches):
    import io
    import zipfile

    import pandas as pd

    for pdf in batches:
        keys, blobs = [], []
        for conv_id, turns in zip(pdf["conv_id"], pdf["turns"]):
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
                for t in turns:
                    zf.writestr(f"conv{conv_id}/turn{t['turn']}.txt", (t["text"] or "").encode("utf-8"))
                zf.writestr(f"conv{conv_id}/meta.json", b"{}")
                zf.writestr(f"conv{conv_id}/raw.bin", b"\x00\x01")
                if conv_id % 2 == 0 and len(turns):
                    inner = io.BytesIO()
                    with zipfile.ZipFile(inner, "w") as iz:
                        iz.writestr("first.txt", (turns[0]["text"] or "").encode("utf-8"))
                    zf.writestr(f"conv{conv_id}/inner.zip", inner.getvalue())
            keys.append(f"conv{conv_id}.zip")
            blobs.append(buf.getvalue())
        yield pd.DataFrame({"key": keys, "content": blobs})


def zip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`conv{id}.zip`: every turn as `turn{n}.txt`, a `.json`, a `.bin`, and for even
    ids a nested `inner.zip` holding the first turn."""
    c = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    per_conv = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("turns"))
    return per_conv.mapInPandas(_zip_batch, "key string, content binary")
