"""Explicit schemas and the fixed values the reference behaviour depends on."""

from __future__ import annotations

from pyspark.sql import types as T

# Nested metadata record, as the question set ships it (root array of objects).
ANNOTATOR_METADATA = T.StructType([
    T.StructField("Steps", T.StringType()),
    T.StructField("Number of steps", T.StringType()),
    T.StructField("How long did this take?", T.StringType()),
    T.StructField("Tools", T.StringType()),
    T.StructField("Number of tools", T.StringType()),
])

TASK_JSON = T.StructType([
    T.StructField("task_id", T.StringType()),
    T.StructField("Question", T.StringType()),
    T.StructField("Level", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("Final answer", T.StringType()),
    T.StructField("Annotator Metadata", ANNOTATOR_METADATA),
])

TASKS = T.StructType([
    T.StructField("task_id", T.StringType(), False),
    T.StructField("question", T.StringType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("final_answer", T.StringType()),
    T.StructField("steps", T.StringType()),
    T.StructField("number_of_steps", T.StringType()),
    T.StructField("how_long", T.StringType()),
    T.StructField("tools", T.StringType()),
    T.StructField("number_of_tools", T.StringType()),
])

EVALUATIONS = T.StructType([
    T.StructField("evaluation_id", T.LongType()),
    T.StructField("task_id", T.StringType()),
    T.StructField("is_correct", T.BooleanType()),
    T.StructField("user_feedback", T.StringType()),
    T.StructField("evaluation_timestamp", T.TimestampNTZType()),
])

STEP_CHANGES = T.StructType([
    T.StructField("task_id", T.StringType()),
    T.StructField("steps", T.StringType()),
    T.StructField("changed_at", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

# --- Fixed values (must equal the reference for equal results) -------------

# Extensions the answer app extracts text from (compared after lower-casing).
SUPPORTED_EXTENSIONS = (
    ".json", ".pdf", ".png", ".jpeg", ".jpg", ".txt",
    ".xlsx", ".csv", ".pptx", ".docx", ".py", ".zip", ".pdb",
)

# Suffixes the link harvest keeps (case-sensitive `endswith`).
HARVEST_SUFFIXES = (
    ".json", ".pdf", ".png", ".jpeg", ".jpg", ".txt", ".xlsx", ".csv",
    ".zip", ".tar.gz", ".mp3", ".pdb", ".pptx", ".jsonld", ".docx", ".py",
)

# Words dropped from the feedback word counts.
STOPWORDS = (
    "the", "and", "is", "in", "it", "of", "to", "a", "for", "on",
    "with", "as", "this", "that", "but", "be", "have", "are", "was",
    "were", "or", "an", "at", "by", "from", "not", "your", "you",
)

# Fixed text of the completion request.
SYSTEM_MESSAGE = (
    "You are a helpful AI assistant. Please answer the questions based on the "
    "content of the provided files, and respond in English."
)
MAX_RESPONSE_TOKENS = 1500
TEMPERATURE = 0.7

TOP_WORDS_K = 5
HISTOGRAM_MAX_BINS = 30

# Prompt and text-chunk wording.
PROMPT_STEPS = "Steps:\n"
PROMPT_QUESTION = "\n\nQuestion:\n"
PROMPT_TEXT = "\nExtracted Text:\n"
CHUNK_HEAD = "Extracted Text from "
CHUNK_MID = ":\n"
CHUNK_END = "\n"
