"""Text extraction from stored files (E1-E7), as one Spark job.

Input rows are files: a key (object name) and its bytes, e.g. from the
`binaryFile` source or a landed-objects table.  Output: (key, ext, text,
status, error).  Plain-text formats, and CSV files whose pandas round trip is
the identity, are decoded inside the JVM.  Other CSV and ZIP files (and
caller-supplied decoders for rich formats) run in Python workers through a
scalar pandas UDF.  As in the reference, a failure becomes text (so it
reaches the prompt); `status`/`error` make it filterable.

Every file is read once: one projection routes each row, and the UDF gets
the bytes only of rows routed to Python (NULL for the others, whose text
never leaves the JVM).
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evallens.functions.text import splitext_ext, universal_newlines
from evallens.schemas import SUPPORTED_EXTENSIONS

EXTRACTED = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("ext", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])

# Formats the reference reads with format libraries; here they take a decoder.
RICH_FORMATS = (".pdf", ".docx", ".xlsx", ".pptx", ".png", ".jpg", ".jpeg")
PYTHON_FORMATS = (".csv", ".zip")

Decoder = Callable[[bytes], str]


# --- JVM path ------------------------------------------------------------------

# A CSV whose pandas round trip (`read_csv(...).to_csv(index=False)`) is provably
# the identity needs no Python: every field is a canonical int64 or plain text
# that pandas reads back as the same string (no digits, quotes, commas, control
# characters or edge spaces, and none of the NA / boolean / infinity words),
# every line has the header's field count, header names are unique, the file
# ends with one newline and has no blank line.  Anything else goes to pandas.
# Fixed values (pandas' default NA strings without digits, its boolean words,
# and the float words it parses), lower-cased:
CSV_SPECIAL_WORDS = ("n/a", "na", "<na>", "#na", "#n/a", "#n/a n/a", "null", "nan", "-nan", "+nan", "none",
                     "true", "false", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
# One search finds anything that breaks the rule: a quote or control character
# anywhere, a body of one line, or a field (after the start, ',' or '\n') that
# is empty, has an edge space, holds a digit outside a canonical int, or is one
# of the words.  Field tests start only at a delimiter, so most positions cost
# one character-class check; there is no repeated group, so a long file cannot
# overflow the regex stack.
_FIELD_END = r"(?=[,\n]|\z)"
CSV_BAD_FIELD = "|".join([
    r'[[\p{C}"]&&[^\n]]',
    r"\A[^\n]*\z",
    r"(?:\A|[,\n])(?:" + "|".join([
        _FIELD_END,
        r"[\s\p{Z}]",
        r"[^,\n]*[\s\p{Z}]" + _FIELD_END,
        r"(?!(?:-?[1-9][0-9]{0,17}|0)" + _FIELD_END + r")[^,\n]*\p{N}",
        "(?i:" + "|".join(w.replace("+", r"\+") for w in CSV_SPECIAL_WORDS) + ")" + _FIELD_END,
    ]) + ")",
])


def csv_round_trips(content: Column) -> Column:
    """True when pandas would give back the file's own text (see above); never NULL."""
    s = content.cast("string")
    body = F.left(s, F.length(s) - 1)
    # every line has the header's commas: removing each "<header skeleton>\n"
    # from the comma skeleton (plus a final '\n') leaves nothing
    skel = F.regexp_replace(body, r"[^,\n]+", "")
    line_skel = F.concat(F.substring_index(skel, "\n", 1), F.lit("\n"))
    same_shape = F.replace(F.concat(skel, F.lit("\n")), line_skel, F.lit("")) == ""
    header = F.split(F.substring_index(body, "\n", 1), ",", -1)
    ok = (F.is_valid_utf8(s) & s.endswith("\n") & ~body.rlike(CSV_BAD_FIELD) & same_shape
          & (F.size(F.array_distinct(header)) == F.size(header)))
    return F.coalesce(ok, F.lit(False))


def _native(ext: Column, content: Column, decoders: dict[str, Decoder]) -> tuple[Column, Column, Column]:
    """(text, status, error) for every format the JVM decodes; CSV only for files that pass csv_round_trips."""
    s = content.cast("string")
    valid = F.is_valid_utf8(s)
    as_text = universal_newlines(s)
    latin1 = universal_newlines(F.decode(content, "ISO-8859-1"))
    bad_utf8 = F.lit("'utf-8' codec can't decode the bytes: invalid UTF-8")
    err = F.when(content.isNull(), F.lit("no content")).when(ext.isin(".txt", ".pdb") & ~valid, bad_utf8)
    text = (F.when(content.isNull(), F.lit(None).cast("string"))
             .when(ext == ".csv", s)
             .when(ext == ".txt", F.when(valid, as_text).otherwise(F.concat(F.lit("Error processing file: "), bad_utf8)))
             .when(ext == ".py", F.when(valid, as_text).otherwise(latin1))
             .when(ext == ".pdb", F.when(valid, as_text).otherwise(F.concat(F.lit("Error processing .pdb file: "), bad_utf8)))
             .when(ext.isin(*[e for e in RICH_FORMATS if e not in decoders]),
                   F.concat(F.lit("No decoder for file type: "), ext))
             .otherwise(F.concat(F.lit("Unsupported file type: "), ext)))
    status = (F.when(content.isNull(), F.lit("missing"))
               .when(err.isNotNull(), F.lit("error"))
               .when(ext.isin(".txt", ".py", ".pdb", ".csv"), F.lit("ok"))
               .when(ext.isin(*RICH_FORMATS), F.lit("no_decoder"))
               .otherwise(F.lit("unsupported")))
    return text, status, err


# --- Python path ---------------------------------------------------------------

def py_splitext_ext(name: str) -> str:
    return posixpath.splitext(name)[1].lower()


def _newlines(s: str) -> str:
    return s.replace("\r\n", "\n").replace("\r", "\n")


def extract_bytes(name: str, data: bytes, decoders: dict[str, Decoder] | None = None) -> tuple[str, str, str | None]:
    """Python restatement of the per-file dispatch; used for ZIP members and CSV."""
    decoders = decoders or {}
    ext = py_splitext_ext(name)
    try:
        if ext == ".txt":
            return _newlines(data.decode("utf-8")), "ok", None
        if ext == ".py":
            try:
                return _newlines(data.decode("utf-8")), "ok", None
            except UnicodeDecodeError:
                return _newlines(data.decode("latin-1")), "ok", None
        if ext == ".pdb":
            try:
                return _newlines(data.decode("utf-8")), "ok", None
            except Exception as e:  # noqa: BLE001 - the message is the result
                return f"Error processing .pdb file: {e}", "error", str(e)
        if ext == ".csv":
            return pd.read_csv(io.BytesIO(data)).to_csv(index=False), "ok", None
        if ext == ".zip":
            return zip_text(data, decoders)
        if ext in decoders:
            return decoders[ext](data), "ok", None
        if ext in RICH_FORMATS:
            return f"No decoder for file type: {ext}", "no_decoder", None
        return f"Unsupported file type: {ext}", "unsupported", None
    except Exception as e:  # noqa: BLE001
        return f"Error processing file: {e}", "error", str(e)


class _Archive:
    """An open archive on the way down: its members left, in path order, and the text so far."""

    def __init__(self, name: str, data: bytes):
        self.name, self.out = name, []
        self.zf = zipfile.ZipFile(io.BytesIO(data))
        self.left = iter(sorted((i for i in self.zf.infolist() if not i.is_dir()), key=lambda i: i.filename))


def zip_text(data: bytes, decoders: dict[str, Decoder]) -> tuple[str, str, str | None]:
    """E5: each member in path order; supported members extracted, archives inside
    archives at any depth (a stack, no recursion).

    One member's bytes are open per level.  An archive that cannot be read on
    gives its error as text, as a file does.  Status `partial` if a member failed;
    `error` names the first one.
    """
    stack, faults = [_Archive("", data)], []
    while True:
        top = stack[-1]
        try:
            info = next(top.left, None)
            if info is None:
                text, done = "".join(top.out), True
            else:
                done = False
                base = posixpath.basename(info.filename)
                ext = py_splitext_ext(base)
                if ext not in SUPPORTED_EXTENSIONS:
                    top.out.append(f"Skipped unsupported file: {base}\n")
                    continue
                member = top.zf.read(info)
        except Exception as e:  # noqa: BLE001 - the message is the archive's text
            if len(stack) == 1:
                raise
            faults.append((top.name, str(e)))
            text, done = f"Error processing file: {e}", True
        if done:
            if len(stack) == 1:
                return text, "partial" if faults else "ok", f"{faults[0][0]}: {faults[0][1]}" if faults else None
            stack.pop()
            stack[-1].out.append(f"Extracted from {top.name}:\n{text}\n")
            continue
        if ext == ".zip":
            try:
                stack.append(_Archive(base, member))
                continue
            except Exception as e:  # noqa: BLE001
                text, status, err = f"Error processing file: {e}", "error", str(e)
        else:
            text, status, err = extract_bytes(base, member, decoders)
        if status == "error":
            faults.append((base, err))
        top.out.append(f"Extracted from {base}:\n{text}\n")


PY_RESULT = T.StructType([f for f in EXTRACTED.fields if f.name in ("text", "status", "error")])


def _python(decoders: dict[str, Decoder]):
    """Scalar pandas UDF (key, content) -> struct(text, status, error); NULL content gives NULL."""

    @F.pandas_udf(PY_RESULT)
    def run(keys: pd.Series, contents: pd.Series) -> pd.DataFrame:
        res = [extract_bytes(k, bytes(c), decoders) if c is not None else (None, None, None)
               for k, c in zip(keys, contents)]
        return pd.DataFrame(res, columns=["text", "status", "error"], dtype=object)

    return run


def extract_text(files: DataFrame, decoders: dict[str, Decoder] | None = None,
                 key: str = "key", content: str = "content", parallelism: int | None = None,
                 python_formats: tuple[str, ...] = PYTHON_FORMATS) -> DataFrame:
    """E1-E7 over a DataFrame of files; one output row per input file.

    `python_formats`: the formats among the files that may need Python; with
    none (and no decoder) the plan stays in the JVM, and a file of such a format
    gets status `not_routed`.  Files without content: status `missing`, NULL text.

    `decoders` maps a lower-case extension to a function bytes -> text for the
    rich formats (PDF, Office, images); without one such files get status
    `no_decoder`.  Keep `spark.sql.execution.arrow.maxRecordsPerBatch` small
    when files are large: a Python batch holds that many whole files.
    `parallelism` spreads the files over that many tasks first (use it when
    the input comes from a small shuffle that AQE packed together).
    """
    decoders = {k.lower(): v for k, v in (decoders or {}).items()}
    f = files.select(F.col(key).alias("key"), F.col(content).alias("content"),
                     *([F.col("ext")] if "ext" in files.columns else []))
    if "ext" not in files.columns:
        f = f.withColumn("ext", splitext_ext(F.col("key")))
    if parallelism:
        f = f.repartition(parallelism, "key")
    py_exts = sorted(set(python_formats) | set(decoders))
    ext, data = F.col("ext"), F.col("content")
    if not py_exts:
        text, status, err = _native(ext, data, decoders)
        left = ext.isin(*PYTHON_FORMATS) & data.isNotNull() & ~((ext == ".csv") & csv_round_trips(data))
        none = F.lit(None).cast("string")
        return f.select("key", "ext", F.when(left, none).otherwise(text).alias("text"),
                        F.when(left, F.lit("not_routed")).otherwise(status).alias("status"), F.when(left, none).otherwise(err).alias("error"))
    csv_plain = (ext == ".csv") & csv_round_trips(data)
    # the route is its own column, so the (costly) CSV check runs once per row
    routed = f.withColumn("_py", F.coalesce(data.isNotNull() & ext.isin(*py_exts) & ~csv_plain, F.lit(False)))
    in_py = F.col("_py")
    py = _python(decoders)(F.when(in_py, F.col("key")), F.when(in_py, data))
    text, status, err = _native(ext, data, decoders)
    both = routed.select("key", "ext", "_py", text.alias("_text"), status.alias("_status"), err.alias("_error"),
                         py.alias("_r"))
    return both.select(
        "key", "ext",
        *[F.when(in_py, F.col("_r")[c]).otherwise(F.col("_" + c)).alias(c) for c in ("text", "status", "error")])
