"""DuckDB SQL equal to each registered query (same column names and types)."""

from __future__ import annotations

from evallens.plans import fixtures as fx
from evallens.schemas import STOPWORDS

_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


def _summary(src: str) -> str:
    return f"""
  SELECT count(*) AS total_evaluations,
         count(*) FILTER (WHERE coalesce(is_correct, false)) AS correct_answers,
         count(*) - count(*) FILTER (WHERE coalesce(is_correct, false)) AS incorrect_answers,
         CAST(count(*) FILTER (WHERE coalesce(is_correct, false)) AS DOUBLE) / count(*) * 100.0 AS correct_pct,
         CAST(count(*) - count(*) FILTER (WHERE coalesce(is_correct, false)) AS DOUBLE) / count(*) * 100.0 AS incorrect_pct
  FROM {src} HAVING count(*) > 0"""


def _word_counts(src: str, text: str, key: str) -> str:
    return f"""
  src AS (SELECT {key} AS id, [w FOR w IN regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}_]+') IF w <> ''] AS t
          FROM {src} WHERE {text} IS NOT NULL),
  toks AS (SELECT id, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM src),
  kept AS (SELECT * FROM toks WHERE word NOT IN ({_STOP})),
  ranked AS (SELECT word, id, pos, count(*) OVER (PARTITION BY word) AS frequency,
                    row_number() OVER (PARTITION BY word ORDER BY id, pos) AS rn FROM kept),
  counts AS (SELECT word, frequency, id AS first_id, pos AS first_pos FROM ranked WHERE rn = 1)"""


def _top_words(src: str, text: str, key: str, k: int = 5) -> str:
    return f""",{_word_counts(src, text, key)}
SELECT CAST(row_number() OVER (ORDER BY frequency DESC, first_id, first_pos) AS INTEGER) AS rank,
       word, frequency
FROM counts ORDER BY frequency DESC, first_id, first_pos LIMIT {k}"""


def _gaps(src: str, ts: str, key: str) -> str:
    return f"""
  SELECT {key}, {ts},
         CASE WHEN {ts} IS NOT NULL THEN
           CAST(date_diff('microsecond', lag({ts}) OVER (ORDER BY {ts} NULLS LAST, {key}), {ts}) AS DOUBLE)
           / 60000000.0::DOUBLE END AS gap_minutes
  FROM {src}"""


def _mean_gap(src: str, ts: str) -> str:
    return f"""
  SELECT count({ts}) AS n_times,
         CASE WHEN count({ts}) > 1 THEN
           CAST(epoch_us(max({ts})) - epoch_us(min({ts})) AS DOUBLE) / (count({ts}) - 1) / 60000000.0::DOUBLE
         END AS mean_gap_minutes
  FROM {src}"""


def _histogram(gaps_sql: str, max_bins: int = 30) -> str:
    return f"""
  g AS ({gaps_sql}),
  v AS (SELECT gap_minutes AS v FROM g WHERE gap_minutes IS NOT NULL),
  r AS (SELECT min(v) AS lo, max(v) AS hi FROM v HAVING count(*) > 0),
  w AS (SELECT lo, hi, CASE WHEN hi > lo THEN (
          SELECT min(c.w) FROM (
            SELECT m * pow(10.0::DOUBLE, e) AS w FROM (VALUES (1::DOUBLE), (2::DOUBLE), (5::DOUBLE)) m(m), range(-12, 15) e(e)) c
          WHERE floor(hi / c.w) - floor(lo / c.w) + 1 <= {max_bins} AND c.w >= (hi - lo) / {max_bins}) ELSE 1.0::DOUBLE END AS w FROM r),
  b AS (SELECT unnest(range(CAST(floor(lo / w) AS BIGINT), CAST(floor(hi / w) AS BIGINT) + 1)) AS bin, w FROM w),
  c AS (SELECT CAST(floor(v / w) AS BIGINT) AS bin, count(*) AS n FROM v, w GROUP BY ALL)
SELECT b.bin, b.bin * w AS bin_start, (b.bin + 1) * w AS bin_end, coalesce(n, 0) AS n FROM b LEFT JOIN c USING (bin)"""


EV = "WITH" + fx.EVALUATIONS_SQL
EVENTS = "(SELECT event_id, ts FROM events)"

ORACLE: dict[str, str] = {
    "summary_metrics": EV + _summary("evaluations"),
    "outcome_distribution": EV + ", s AS (" + _summary("evaluations") + """)
SELECT 'Correct' AS outcome, correct_answers AS n FROM s
UNION ALL SELECT 'Incorrect', incorrect_answers FROM s""",
    "top_feedback_words": EV + _top_words("evaluations", "user_feedback", "evaluation_id"),
    "top_document_words": "WITH d AS (SELECT doc_id, text FROM documents)" + _top_words("d", "text", "doc_id"),
    "document_word_counts": "WITH d AS (SELECT doc_id, text FROM documents)," + _word_counts("d", "text", "doc_id")
                            + "\nSELECT word, frequency FROM counts",
    "evaluation_detail": EV + """
SELECT evaluation_id, task_id, is_correct, user_feedback, evaluation_timestamp FROM evaluations
ORDER BY evaluation_timestamp NULLS LAST, evaluation_id""",
    "first_evaluation": EV + "\nSELECT * FROM evaluations ORDER BY evaluation_id LIMIT 1",
    "time_gaps": _gaps(EVENTS, "ts", "event_id"),
    "time_gaps_daily": """
  SELECT event_id, ts,
         CAST(date_diff('microsecond', lag(ts) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id), ts) AS DOUBLE)
         / 60000000.0::DOUBLE AS gap_minutes
  FROM events WHERE ts IS NOT NULL
  UNION ALL SELECT event_id, ts, NULL FROM events WHERE ts IS NULL""",
    "time_gaps_tied": _gaps("""(
    SELECT event_id, ts FROM events
    UNION ALL SELECT event_id, ts FROM events WHERE event_id % 10 = 0
    UNION ALL SELECT CAST(NULL AS BIGINT), ts FROM events WHERE event_id % 15 = 0)""", "ts", "event_id"),
    "time_gaps_burst": _gaps("""(
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-01-15 12:00:00' ELSE ts END AS ts FROM events)""", "ts", "event_id"),
    "evaluation_gaps": EV + _gaps("evaluations", "evaluation_timestamp", "evaluation_id"),
    "mean_gap": _mean_gap(EVENTS, "ts"),
    "evaluation_mean_gap": EV + _mean_gap("evaluations", "evaluation_timestamp"),
    "gap_histogram": "WITH" + _histogram(_gaps(EVENTS, "ts", "event_id")),
    "evaluation_gap_histogram": EV + "," + _histogram(_gaps("evaluations", "evaluation_timestamp", "evaluation_id")),
}


# --- tasks, verdicts, files, links -------------------------------------------------

from evallens.schemas import HARVEST_SUFFIXES, SUPPORTED_EXTENSIONS  # noqa: E402


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


# Python's white space, by code point.
_SPACES = " || ".join(f"chr({c})" for c in (
    *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))


def strip_sql(x: str) -> str:
    return f"trim({x}, {_SPACES})"


_TASKS_FLAT = """
SELECT task_id, coalesce(question, '') AS question,
       CAST(CASE WHEN conv_id % 4 <> 0 THEN level ELSE 0 END AS INTEGER) AS level,
       task_id || '.txt' AS file_name,
       coalesce(final_answer, '') AS final_answer,
       coalesce(steps, '') AS steps,
       CASE WHEN steps IS NOT NULL THEN number_of_steps ELSE '' END AS number_of_steps,
       CASE WHEN steps IS NOT NULL AND conv_id % 2 = 0 THEN number_of_steps || ' minutes' ELSE '' END AS how_long,
       CASE WHEN steps IS NOT NULL THEN 'none' ELSE '' END AS tools,
       CASE WHEN steps IS NOT NULL THEN number_of_tools ELSE '' END AS number_of_tools
FROM tasks"""

_VALID_CHANGES = f"""
  valid AS (SELECT * FROM step_changes WHERE {strip_sql('steps')} <> '')"""

# The extension starts at the last dot of the last path segment, leading dots aside.
_SPLIT = """
  SELECT file_name, left(file_name, length(file_name) - length(e)) AS file_base_name, lower(e) AS file_ext FROM (
    SELECT file_name, CASE WHEN contains(ltrim(string_split(file_name, '/')[-1], '.'), '.')
                           THEN '.' || string_split(file_name, '.')[-1] ELSE '' END AS e
    FROM {src})"""


def _split(src: str) -> str:
    exts = ", ".join(q(e) for e in SUPPORTED_EXTENSIONS)
    return f"SELECT *, file_ext IN ({exts}) AS supported FROM ({_SPLIT.format(src=src)})"


# The pages' items hold one level of list and hrefs in double quotes.
_LINKS = """
  li1 AS (SELECT page_id, url, unnest(string_split(html, '<li')[2:]) AS li,
                 generate_subscripts(string_split(html, '<li')[2:], 1) AS li_pos FROM pages),
  a AS (SELECT page_id, url, li_pos, regexp_extract(string_split(li, '</li>')[1], '<a [^>]*href="([^"]*)"', 1) AS raw FROM li1),
  links AS (
    SELECT page_id, url AS page_url, CAST(li_pos AS INTEGER) AS li_pos, replace(raw, '&amp;', '&') AS href
    FROM a WHERE raw <> '')"""

# The four links before each odd page's own, which the page's then follow.
_ODD = """,
  odd AS (
    SELECT page_id, url AS page_url, unnest([1, 2, 3, 4, 5]) AS li_pos,
           unnest(['/u/blob/' || page_id || '.pdf', '/v/' || page_id || '.txt', '/in&' || page_id || '&é.csv', '/in&' || page_id || '&é.csv',
                   'https://o.example/z/blob/same.pdf']) AS href FROM pages
    UNION ALL SELECT page_id, page_url, li_pos + 5, href FROM links)"""


def _file_urls(suffixes) -> str:
    ends = " OR ".join(f"ends_with(href, {q(s)})" for s in suffixes)
    return f"""WITH {_LINKS},
  f AS (SELECT *, replace(CASE WHEN starts_with(href, '/')
                    THEN array_to_string(string_split(page_url, '/')[1:3], '/') || href ELSE href END,
                    '/blob/', '/resolve/') AS url
        FROM links WHERE href <> '' AND ({ends}))
SELECT *, string_split(url, '/')[-1] AS key FROM f"""


ORACLE.update({
    "tasks_flat": "WITH" + fx.TASKS_SQL + _TASKS_FLAT,
    "tasks_loaded": "WITH" + fx.TASKS_SQL + _TASKS_FLAT,
    "tasks_latest": "WITH" + fx.TASK_LOADS_SQL + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY loaded_at DESC) AS rn FROM task_loads)
WHERE rn = 1""",
    "tasks_current_steps": "WITH" + fx.STEP_CHANGES_SQL + "," + _VALID_CHANGES + """,
  latest AS (SELECT task_id, steps AS new_steps, changed_at FROM (
      SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY changed_at DESC, seq DESC) AS rn FROM valid)
    WHERE rn = 1)
SELECT t.task_id, t.question, t.level, t.file_name, t.final_answer, coalesce(l.new_steps, t.steps) AS steps,
       t.number_of_steps, t.how_long, t.tools, t.number_of_tools, l.changed_at AS steps_changed_at
FROM tasks t LEFT JOIN latest l ON l.task_id = t.task_id""",
    "unmatched_step_updates": "WITH" + fx.STEP_CHANGES_SQL + "," + _VALID_CHANGES + """
SELECT * FROM valid WHERE task_id NOT IN (SELECT task_id FROM tasks)""",
    "rejected_step_changes": "WITH" + fx.STEP_CHANGES_SQL + f"""
SELECT * FROM step_changes WHERE NOT coalesce({strip_sql('steps')} <> '', false)""",
    "evaluations_valid": "WITH" + fx.VERDICTS_SQL + f""",
  c AS (SELECT *, coalesce(is_correct, false) AS ok, {strip_sql('user_feedback')} AS stripped FROM verdicts)
SELECT evaluation_id, task_id, ok AS is_correct, CASE WHEN ok THEN NULL ELSE stripped END AS user_feedback,
       evaluation_timestamp
FROM c WHERE NOT coalesce((ok AND user_feedback IS NOT NULL) OR (NOT ok AND (user_feedback IS NULL OR stripped = '')), false)""",
    "evaluations_rejected": "WITH" + fx.VERDICTS_SQL + f""",
  c AS (SELECT *, coalesce(is_correct, false) AS ok, {strip_sql('user_feedback')} AS stripped FROM verdicts)
SELECT evaluation_id, task_id, ok AS is_correct, user_feedback, evaluation_timestamp,
       CASE WHEN ok AND user_feedback IS NOT NULL THEN 'feedback_on_correct' ELSE 'empty_feedback' END AS reason
FROM c WHERE coalesce((ok AND user_feedback IS NOT NULL) OR (NOT ok AND (user_feedback IS NULL OR stripped = '')), false)""",
    "object_keys_split": "WITH" + fx.OBJECT_KEYS_SQL + """,
  keys AS (SELECT file_name FROM object_keys UNION ALL SELECT url FROM pages)
""" + _split("keys"),
    "task_files": "WITH" + fx.OBJECT_KEYS_SQL + f""",
  k AS ({_split("object_keys")})
SELECT t.task_id, k.file_name, k.file_ext, k.supported FROM tasks t LEFT JOIN k ON k.file_base_name = t.task_id""",
    "task_file_counts": "WITH" + fx.OBJECT_KEYS_SQL + f""",
  k AS ({_split("object_keys")})
SELECT t.task_id, count(k.file_name) AS n_files FROM tasks t LEFT JOIN k ON k.file_base_name = t.task_id
GROUP BY t.task_id""",
    "orphan_files": "WITH" + fx.OBJECT_KEYS_SQL + f""",
  k AS ({_split("object_keys")})
SELECT * FROM k WHERE file_base_name NOT IN (SELECT task_id FROM tasks)""",
    "links_all": f"WITH {_LINKS}\nSELECT * FROM links",
    "links_filtered": _file_urls(HARVEST_SUFFIXES),
    "links_filtered_e": _file_urls((".", "e")),
})


# --- extraction, prompts, completions ----------------------------------------------

from evallens.plans.fixtures import CSV_COLUMNS  # noqa: E402


def _nl(x: str) -> str:
    return f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')"


_PLAIN = """WITH f AS (
  SELECT CAST(doc_id AS VARCHAR) || ['.txt', '.py', '.pdb', '.json'][CAST(doc_id % 4 + 1 AS INTEGER)] AS key, text
  FROM documents),
  e AS (SELECT key, lower(regexp_extract(key, '(\\.[^./]*)$', 1)) AS ext, text FROM f)
SELECT key, ext,
       CASE WHEN ext IN ('.txt', '.py', '.pdb') THEN """ + _nl("text") + """
            ELSE 'Unsupported file type: ' || ext END AS text,
       CASE WHEN ext IN ('.txt', '.py', '.pdb') THEN 'ok' ELSE 'unsupported' END AS status
FROM e"""

_CSV = "WITH" + fx.CSV_FILES_SQL + f"""
SELECT CAST(l_orderkey AS VARCHAR) || '.csv' AS key, '.csv' AS ext,
       {q(",".join(CSV_COLUMNS))} || chr(10) || string_agg(line, chr(10) ORDER BY l_linenumber, line) || chr(10) AS text,
       'ok' AS status
FROM csv_lines GROUP BY l_orderkey"""

_ZIP = f"""WITH c AS (SELECT conv_id, turn, text FROM conversations),
  m AS (
    SELECT conv_id, 'conv' || conv_id || '/turn' || turn || '.txt' AS path,
           'Extracted from turn' || turn || '.txt:' || chr(10) || {_nl("coalesce(text, '')")} || chr(10) AS chunk
    FROM c
    UNION ALL SELECT DISTINCT conv_id, 'conv' || conv_id || '/meta.json',
           'Extracted from meta.json:' || chr(10) || 'Unsupported file type: .json' || chr(10) FROM c
    UNION ALL SELECT DISTINCT conv_id, 'conv' || conv_id || '/raw.bin', 'Skipped unsupported file: raw.bin' || chr(10) FROM c
    UNION ALL SELECT conv_id, 'conv' || conv_id || '/inner.zip',
           'Extracted from inner.zip:' || chr(10) || 'Extracted from first.txt:' || chr(10)
           || {_nl("coalesce(first_text, '')")} || chr(10) || chr(10)
    FROM (SELECT conv_id, arg_min(text, turn) AS first_text FROM c GROUP BY conv_id) WHERE conv_id % 2 = 0)
SELECT 'conv' || conv_id || '.zip' AS key, '.zip' AS ext, string_agg(chunk, '' ORDER BY path) AS text, 'ok' AS status
FROM m GROUP BY conv_id"""


def _prompts_sql(tasks_cte: str) -> str:
    """Prompts over `tasks_cte` (a CTE with task_id, question, steps) as CTE `pr_<tasks_cte>`."""
    n = tasks_cte
    return f""",
  ob_{n} AS (SELECT k.file_name AS key, coalesce(d.text, '') AS text
         FROM object_keys k LEFT JOIN (SELECT doc_id, text FROM documents) d ON d.doc_id = k.conv_id),
  sp_{n} AS (SELECT s.*, o.text FROM ({_SPLIT.format(src=f"ob_{n}").replace("file_name", "key")}) s
             JOIN ob_{n} o USING (key)),
  ex_{n} AS (SELECT file_base_name AS task_id, key,
                CASE WHEN file_ext = '.txt' THEN {_nl("text")}
                     ELSE 'No decoder for file type: ' || file_ext END AS text
         FROM sp_{n} WHERE file_ext IN ('.txt', '.pdf') AND file_base_name IN (SELECT task_id FROM {n})),
  tt_{n} AS (SELECT task_id, string_agg('Extracted Text from ' || key || ':' || chr(10) || text || chr(10), '' ORDER BY key)
                AS extracted_text FROM ex_{n} GROUP BY task_id),
  pr_{n} AS (
    SELECT t.task_id,
           'Steps:' || chr(10) || coalesce(t.steps, '') || chr(10) || chr(10) || 'Question:' || chr(10)
           || coalesce(t.question, '') || chr(10)
           || CASE WHEN coalesce(tt.extracted_text, '') <> '' THEN chr(10) || 'Extracted Text:' || chr(10) || tt.extracted_text
                   ELSE '' END AS prompt
    FROM {n} t LEFT JOIN tt_{n} tt ON tt.task_id = t.task_id)"""


_FP = "CAST(length(prompt) AS VARCHAR) || ':' || sha256(prompt)"

_EDITED = """,
  valid AS (SELECT * FROM step_changes WHERE """ + strip_sql("steps") + """ <> ''),
  latest AS (SELECT task_id, steps AS new_steps FROM (
      SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY changed_at DESC, seq DESC) AS rn FROM valid)
    WHERE rn = 1),
  edited AS (SELECT t.task_id, t.question, coalesce(l.new_steps, t.steps) AS steps
             FROM tasks t LEFT JOIN latest l ON l.task_id = t.task_id)"""

ORACLE.update({
    "extract_plain": _PLAIN,
    "extract_csv": _CSV,
    "extract_zip": _ZIP,
    "prompts": "WITH" + fx.OBJECT_KEYS_SQL + _prompts_sql("tasks") + "\nSELECT * FROM pr_tasks",
    "completions": "WITH" + fx.OBJECT_KEYS_SQL + _prompts_sql("tasks") + f"""
SELECT sha256(prompt) AS prompt_id, task_id, {_FP} AS response, CAST(NULL AS VARCHAR) AS error,
       CAST(1 AS INTEGER) AS attempts
FROM pr_tasks""",
    "rerun_completions": "WITH" + fx.OBJECT_KEYS_SQL + "," + fx.STEP_CHANGES_CTE + _EDITED
                         + _prompts_sql("tasks") + _prompts_sql("edited") + f"""
SELECT sha256(prompt) AS prompt_id, task_id, {_FP} AS response, CAST(NULL AS VARCHAR) AS error,
       CAST(1 AS INTEGER) AS attempts
FROM pr_edited WHERE sha256(prompt) NOT IN (SELECT sha256(prompt) FROM pr_tasks)""",
})


# --- object store and streaming ---------------------------------------------------

_DOC_KEYS = """WITH f AS (
  SELECT CAST(doc_id AS VARCHAR) || ['.txt', '.py', '.pdb', '.json'][CAST(doc_id % 4 + 1 AS INTEGER)] AS key, text
  FROM documents)"""

ORACLE.update({
    "object_listing": _DOC_KEYS + "\nSELECT key, CAST(strlen(text) + 1 AS BIGINT) AS length FROM f",
    "objects_landed": _PLAIN.replace("AS key, text\n  FROM documents", "AS key, text || chr(10) AS text\n  FROM documents"),
    "ingest_stream_result": EV + "\nSELECT * FROM evaluations",
    "live_summary_result": EV + _summary("evaluations"),
    "live_summary_replayed": EV + _summary("evaluations"),
})

ORACLE["links_parsed"] = f"WITH {_LINKS}{_ODD}\nSELECT page_id, page_url, CAST(li_pos AS INTEGER) AS li_pos, href FROM odd"
ORACLE["links_odd_files"] = f"""WITH {_LINKS}{_ODD},
  f AS (SELECT DISTINCT replace(CASE WHEN starts_with(href, '/') THEN array_to_string(string_split(page_url, '/')[1:3], '/') || href
                                     ELSE href END, '/blob/', '/resolve/') AS url
        FROM odd WHERE {" OR ".join(f"ends_with(href, {q(x)})" for x in HARVEST_SUFFIXES)})
SELECT url, string_split(url, '/')[-1] AS key FROM f"""

ORACLE["summary_display"] = EV + """, s AS (""" + _summary("evaluations") + """)
SELECT total_evaluations, correct_answers, incorrect_answers,
       printf('%.2f%%', correct_pct) AS correct_rate, printf('%.2f%%', incorrect_pct) AS incorrect_rate FROM s"""
ORACLE["report_incremental"] = EV + ", s AS (" + _summary("evaluations") + """),
  m AS (""" + _mean_gap("evaluations", "evaluation_timestamp") + "),\n  h AS (WITH" + _histogram(
    _gaps("evaluations", "evaluation_timestamp", "evaluation_id")) + "),\n  t AS (WITH e AS (SELECT * FROM evaluations)" + _top_words(
    "e", "user_feedback", "evaluation_id") + """)
SELECT 'summary' AS block, 'total' AS item, total_evaluations::DOUBLE AS value FROM s
UNION ALL SELECT 'summary', 'correct', correct_answers FROM s UNION ALL SELECT 'summary', 'incorrect', incorrect_answers FROM s
UNION ALL SELECT 'summary', 'correct_pct', correct_pct FROM s UNION ALL SELECT 'summary', 'incorrect_pct', incorrect_pct FROM s
UNION ALL SELECT 'distribution', 'Correct', correct_answers FROM s UNION ALL SELECT 'distribution', 'Incorrect', incorrect_answers FROM s
UNION ALL SELECT 'top_words', rank || ' ' || word, frequency FROM t
UNION ALL SELECT 'mean_gap', n_times::VARCHAR, mean_gap_minutes FROM m
UNION ALL SELECT 'histogram', bin::VARCHAR, n FROM h"""
ORACLE["report_empty"] = EV + """, e AS (SELECT * FROM evaluations WHERE evaluation_id IS NULL), s AS (""" + _summary("e") + """)
SELECT unnest(['summary', 'distribution', 'top_words', 'mean_gap', 'histogram', 'detail']) AS block,
       unnest([(SELECT count(*) FROM s), (SELECT 2 * count(*) FROM s), (SELECT least(count(*), 5) FROM e), 1, (SELECT count(*) FROM s),
               (SELECT count(*) FROM e)]) AS n"""
ORACLE["top_words_unnamed"] = EV + """, e AS (
  SELECT CASE WHEN evaluation_id % 3 <> 0 THEN evaluation_id ELSE 9223372036854775807 END AS evaluation_id,
         user_feedback || CASE WHEN evaluation_id % 3 = 0 THEN ' zebra zebra zebra zebra zebra zebra zebra zebra' ELSE '' END AS user_feedback
  FROM evaluations)""" + _top_words("e", "user_feedback", "evaluation_id")
ORACLE["evaluated_tasks"] = "WITH" + fx.TASKS_SQL + "," + fx.EVALUATIONS_SQL + """
SELECT * EXCLUDE (conv_id) FROM tasks WHERE task_id IN (SELECT task_id FROM evaluations)"""

ORACLE.update({
    "completions_resumed": "WITH" + fx.OBJECT_KEYS_SQL + _prompts_sql("tasks") + f"""
SELECT sha256(prompt) AS prompt_id, task_id, {_FP} AS response, CAST(NULL AS VARCHAR) AS error, CAST(1 AS INTEGER) AS attempts, 'done' AS state,
       CAST(CASE WHEN sha256(prompt)[1] IN ('a', 'b', 'c', 'd', 'e', 'f') THEN 2 ELSE 1 END AS BIGINT) AS times_sent
FROM pr_tasks""",
    "completions_shared": "WITH" + fx.TASKS_SQL + """,
  p AS (SELECT task_id, 'Steps:' || chr(10) || coalesce(steps, '') || chr(10) || chr(10) || 'Question:' || chr(10)
               || coalesce(question, '') || chr(10) AS prompt FROM tasks)
SELECT task_id, """ + _FP + """ AS response, CAST(1 AS BIGINT) AS times_sent FROM p
UNION ALL SELECT 'copy-' || task_id, """ + _FP + """, 1 FROM p""",
    "extract_csv_rewritten": """
SELECT CAST(o_custkey AS VARCHAR) || '.csv' AS key, '.csv' AS ext,
       'key,prio,status' || chr(10) || string_agg(o_orderkey || ',' || o_orderkey % 7 || '.5,'
         || CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE '' END || chr(10), '' ORDER BY o_orderkey) AS text, 'ok' AS status
FROM orders GROUP BY o_custkey""",
    "extract_encodings": """WITH f AS (
  SELECT doc_id % 9 = 0 AS none, doc_id % 3 = 2 AS bad, ['.txt', '.py', '.pdb'][CAST(doc_id // 3 % 3 + 1 AS INTEGER)] AS ext, doc_id,
         text FROM documents)
SELECT doc_id || ext AS key, ext,
       CASE WHEN none THEN NULL
            WHEN bad AND ext = '.py' THEN regexp_replace(text, '[^\x00-\x7F]', '?', 'g') || 'é'
            WHEN bad AND ext = '.pdb' THEN 'Error processing .pdb file: ''utf-8'' codec can''t decode the bytes: invalid UTF-8'
            WHEN bad THEN 'Error processing file: ''utf-8'' codec can''t decode the bytes: invalid UTF-8'
            ELSE replace(text, chr(13), chr(10)) END AS text,
       CASE WHEN none THEN 'missing' WHEN bad AND ext <> '.py' THEN 'error' ELSE 'ok' END AS status
FROM f""",
    "extract_decoded": """
SELECT doc_id || '.docx' AS key, strlen(text) || ' bytes' AS text, 'ok' AS status FROM documents WHERE doc_id % 4 = 3""",
    "ingest_stream_backfill": EV + """
SELECT true AS has_id, task_id, is_correct, user_feedback,
       evaluation_timestamp - to_days(CAST(60 * (evaluation_id % 3) AS INTEGER)) AS evaluation_timestamp FROM evaluations
UNION ALL SELECT true, task_id, is_correct, user_feedback, evaluation_timestamp
FROM evaluations, range(2) WHERE evaluation_id % 5 = 0""",
    "evaluations_stored": "WITH" + fx.VERDICTS_SQL + f""",
  c AS (SELECT *, {strip_sql('user_feedback')} AS stripped FROM verdicts)
SELECT task_id, is_correct, CASE WHEN NOT is_correct THEN stripped END AS user_feedback,
       CAST(2 AS BIGINT) AS ids, CAST(2 AS BIGINT) AS times
FROM c WHERE CASE WHEN is_correct THEN user_feedback IS NULL ELSE coalesce(stripped, '') <> '' END""",
    "objects_fetched": _DOC_KEYS + """
SELECT key, text || chr(10) AS text FROM f WHERE regexp_matches(key, '[05][.](txt|py)$')""",
    "objects_fetched_landed": _DOC_KEYS + """
SELECT key, text || chr(10) AS text FROM f WHERE regexp_matches(key, '^[0-9]*77[.]')""",
    "objects_landed_delta": """WITH f AS (
  SELECT CAST(doc_id AS VARCHAR) || ['.txt', '.py', '.pdb', '.json'][CAST(doc_id % 4 + 1 AS INTEGER)] AS key,
         text || CASE WHEN doc_id % 7 IN (1, 3) THEN ' (again)' ELSE '' END || chr(10) AS text FROM documents WHERE doc_id % 7 <> 2)
SELECT key, '.' || string_split(key, '.')[2] AS ext, CAST(strlen(text) AS BIGINT) AS length, text FROM f""",
    "tasks_lenient": "WITH" + fx.TASKS_SQL + _TASKS_FLAT + " WHERE conv_id % 11 <> 0",
    "tasks_rejected": "WITH" + fx.TASKS_SQL + """
SELECT left('{"task_id":"' || task_id || '","Question":"' || coalesce(question, ''), 20) AS record FROM tasks WHERE conv_id % 11 = 0""",
    "tasks_array": "WITH" + fx.TASKS_SQL + _TASKS_FLAT,
    "tasks_tied": "WITH" + fx.TASK_LOADS_SQL + """
SELECT * EXCLUDE (rn) REPLACE (TIMESTAMP '2024-03-01 00:00:00' AS loaded_at) FROM (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY question DESC NULLS LAST) AS rn FROM task_loads)
WHERE rn = 1""",
    "tasks_compacted": ORACLE["tasks_current_steps"],
    "tasks_versioned": ORACLE["tasks_current_steps"],
})
