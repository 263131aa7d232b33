import io
import zipfile

from pyspark.sql import functions as F

from evallens.operators import extract as extract_op
from evallens.operators import prompts as prompts_op


def files(spark, rows):
    return spark.createDataFrame(rows, "key string, content binary")


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return buf.getvalue()


def test_extract_formats(spark):
    inner = _zip([("in.txt", b"deep")])
    rows = [
        ("a.txt", "é\r\nx\ry".encode("utf-8")),
        ("bad.TXT", b"\xff\xfe"),
        ("s.py", "é=1".encode("latin-1")),
        ("p.pdb", b"\xff"),
        ("m.json", b"{}"),
        ("d.csv", b"a,b\n1,\n2,x\n"),
        ("z.zip", _zip([("d/x.txt", b"hi"), ("q.bin", b"\x00"), ("n/inner.zip", inner)])),
        ("broken.zip", b"not a zip"),
        ("doc.pdf", b"%PDF"),
        ("x.bin", b"\x00"),
    ]
    got = {r.key: (r.text, r.status) for r in extract_op.extract_text(files(spark, rows)).collect()}
    assert got["a.txt"] == ("é\nx\ny", "ok")
    assert got["bad.TXT"][1] == "error" and got["bad.TXT"][0].startswith("Error processing file: ")
    assert got["s.py"] == ("é=1", "ok")
    assert got["p.pdb"][0].startswith("Error processing .pdb file: ")
    assert got["m.json"] == ("Unsupported file type: .json", "unsupported")
    assert got["d.csv"] == ("a,b\n1,\n2,x\n", "ok")
    assert got["z.zip"] == ("Extracted from x.txt:\nhi\n"
                            "Extracted from inner.zip:\nExtracted from in.txt:\ndeep\n\n"
                            "Skipped unsupported file: q.bin\n", "ok")
    assert got["broken.zip"][1] == "error" and got["broken.zip"][0].startswith("Error processing file: ")
    assert got["doc.pdf"] == ("No decoder for file type: .pdf", "no_decoder")
    assert got["x.bin"] == ("Unsupported file type: .bin", "unsupported")


def test_extract_decoder_plugin(spark):
    rows = [("doc.PDF", b"%PDF-1.4 hello"), ("boom.docx", b"?")]

    def pdf(b):
        return b.decode("ascii").split(" ", 1)[1]

    def docx(b):
        raise ValueError("bad docx")

    got = {r.key: (r.text, r.status) for r in
           extract_op.extract_text(files(spark, rows), decoders={".pdf": pdf, ".docx": docx}).collect()}
    assert got["doc.PDF"] == ("hello", "ok")
    assert got["boom.docx"] == ("Error processing file: bad docx", "error")


def test_prompt_blocks(spark):
    tasks = spark.createDataFrame([("t1", "Q1", None), ("t2", "Q2", "S2")], "task_id string, question string, steps string")
    ex = spark.createDataFrame([("t2.txt", ".txt", "body", "ok", None), ("t2.a.txt", ".txt", "x", "ok", None)],
                               "key string, ext string, text string, status string, error string")
    got = {r.task_id: r.prompt for r in prompts_op.build_prompts(tasks, ex).collect()}
    assert got["t1"] == "Steps:\n\n\nQuestion:\nQ1\n"
    assert got["t2"] == "Steps:\nS2\n\nQuestion:\nQ2\n\nExtracted Text:\nExtracted Text from t2.txt:\nbody\n"


def test_complete_retries_and_errors(spark):
    prompts = spark.createDataFrame([("t1", "ok"), ("t2", "fail")], "task_id string, prompt string")

    def fn(p):
        if p == "fail":
            raise RuntimeError("service down")
        return p.upper()

    got = {r.task_id: (r.response, r.error, r.attempts) for r in
           prompts_op.complete(prompts, fn, parallelism=2, max_attempts=2, backoff_seconds=0).collect()}
    assert got["t1"] == ("OK", None, 1)
    assert got["t2"] == (None, "RuntimeError: service down", 2)
    req = prompts_op.chat_request("p")
    assert req["max_tokens"] == 1500 and req["messages"][1]["content"] == "p"


def test_prompts_are_built_once_for_all_slices(spark, tmp_dir):
    """Prompts that differ each time they are built get their answers, from three slices and a second run."""
    out = f"{tmp_dir}/answers-once"
    p = spark.range(30).select(F.col("id").cast("string").alias("task_id"), F.concat(F.lit("p"), F.uuid()).alias("prompt"))
    assert prompts_op.complete_to_table(p, str.upper, out, slices=3).count() == 30
    assert {(r.state, r.times_sent) for r in prompts_op.queue_states(spark, out).collect()} == {("done", 1)}

    def down(prompt):
        raise RuntimeError("down")

    more = spark.createDataFrame([("a", "new"), ("b", "new"), ("c", "other")], "task_id string, prompt string")
    prompts_op.enqueue(more, out)
    states = lambda: sorted((r.state, r.times_sent) for r in prompts_op.queue_states(spark, out).collect() if r.times_sent != 1 or r.state != "done")
    assert states() == [("pending", 0)] * 2
    prompts_op.drain(spark, down, out, max_attempts=1)
    assert states() == [("failed", 1)] * 2
    prompts_op.drain(spark, str.upper, out, slices=2)
    assert states() == [("done", 2)] * 2
    got = prompts_op.complete_to_table(more, down, out)  # nothing is left to send
    assert sorted((r.task_id, r.response) for r in got.collect()) == [("a", "NEW"), ("b", "NEW"), ("c", "OTHER")]


def test_complete_to_table_sends_only_new(spark, tmp_dir):
    calls = spark.sparkContext.accumulator(0)
    p1 = spark.createDataFrame([("t1", "a"), ("t2", "b")], "task_id string, prompt string")

    def fn(p):
        calls.add(1)
        return p * 2

    out = f"{tmp_dir}/done"
    assert prompts_op.complete_to_table(p1, fn, out).count() == 2
    p2 = spark.createDataFrame([("t1", "a"), ("t2", "b2")], "task_id string, prompt string")
    res = prompts_op.complete_to_table(p2, fn, out)
    assert {(r.task_id, r.response) for r in res.collect()} == {("t1", "aa"), ("t2", "b2b2")}
    assert calls.value == 3


def test_completion_bookkeeping(spark, tmp_dir):
    """A failed prompt is sent again, equal prompts are sent once, every task gets a row."""
    import pytest

    calls = spark.sparkContext.accumulator(0)
    p = spark.createDataFrame([("t1", "a"), ("t2", "b"), ("t9", "a")], "task_id string, prompt string")

    def down(x):
        raise RuntimeError("down")

    def up(x):
        calls.add(1)
        return x * 2

    out = f"{tmp_dir}/answers"
    first = prompts_op.complete_to_table(p, down, out, max_attempts=1).collect()
    assert {(r.task_id, r.response) for r in first} == {("t1", None), ("t2", None), ("t9", None)}
    second = prompts_op.complete_to_table(p, up, out, slices=3).collect()
    assert {(r.task_id, r.response, r.error) for r in second} == {("t1", "aa", None), ("t2", "bb", None), ("t9", "aa", None)}
    assert calls.value == 2
    bad = f"{tmp_dir}/broken"
    import os
    os.makedirs(bad)
    with open(f"{bad}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):  # a fault is not "no table yet"
        prompts_op.complete_to_table(p, up, bad)
    assert calls.value == 2


_CSV_TOKENS = ["1", "0", "-3", "007", "+5", "-0", "1.5", "1e5", "12345678901234567890", "x", "abc", "N", "-", ".",
               "NA", "n/a", "None", "null", "NaN", "nan", "INF", "-Infinity", "True", "false", "T", "a b", " x", "y ",
               "", '"q"', "١٢", "é", "#", "1_0", "0x10", "﻿h", "x\ty", "<NA>", "#N/A"]


def _random_csvs(n):
    import random

    rnd = random.Random(7)
    out = []
    for _ in range(n):
        cols = rnd.randint(1, 4)
        pool = rnd.sample(_CSV_TOKENS, 6) if rnd.random() < 0.5 else ["1", "22", "x", "abc", "N", "-7"]
        header = [rnd.choice(["a", "b", "c", "a", "1", "Unnamed", ""]) for _ in range(cols)]
        rows = [[rnd.choice(pool) for _ in range(cols + (rnd.random() < 0.05))] for _ in range(rnd.randint(0, 4))]
        text = "\n".join(",".join(r) for r in [header] + rows)
        text += rnd.choice(["\n", "\n", "\n", "", "\n\n", "\r\n"])
        out.append(text)
    return out


def test_csv_identity_check_agrees_with_pandas(spark):
    """Where the JVM check says pandas would give the text back, pandas does."""
    import pandas as pd

    long = "k,v\n" + "".join(f"{i},x y\n" for i in range(200_000))  # one search over a long file
    texts = _random_csvs(3000) + [long, "l_orderkey,l_partkey\n1,155190\n1,67310\n"]
    df = spark.createDataFrame([(i, t.encode("utf-8")) for i, t in enumerate(texts)], "i int, content binary")
    flags = dict(df.select("i", extract_op.csv_round_trips(F.col("content")).alias("ok")).collect())
    assert flags[len(texts) - 1] is True and flags[len(texts) - 2] is True
    passed = 0
    for i, t in enumerate(texts):
        if flags[i]:
            passed += 1
            assert pd.read_csv(io.BytesIO(t.encode("utf-8"))).to_csv(index=False) == t, repr(t)
    assert passed > 100  # the check is not vacuous


def test_extract_csv_matches_python_dispatch(spark):
    texts = _random_csvs(400)
    rows = [(f"f{i}.csv", t.encode("utf-8")) for i, t in enumerate(texts)] + [("bad.csv", b"a\n\xff\n")]
    got = {r.key: (r.text, r.status) for r in extract_op.extract_text(files(spark, rows)).collect()}
    for k, b in rows:
        text, status, _ = extract_op.extract_bytes(k, b)
        assert got[k] == (text, status), k


def test_extract_reads_each_file_once(spark, tmp_dir):
    """One scan of the source, no union of per-route branches; Python sees only routed rows."""
    rows = [("a.txt", b"x\r\ny"), ("b.csv", b"k,v\n1,x\n"), ("c.csv", b"k,v\n1.50,x\n"), ("d.zip", b"PK")]
    spark.createDataFrame(rows, "key string, content binary").write.parquet(f"{tmp_dir}/files")
    out = extract_op.extract_text(spark.read.parquet(f"{tmp_dir}/files"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan and "ArrowEvalPython" in plan
    got = {r.key: (r.text, r.status) for r in out.collect()}
    assert got["a.txt"] == ("x\ny", "ok") and got["b.csv"] == ("k,v\n1,x\n", "ok")
    assert got["c.csv"] == ("k,v\n1.5,x\n", "ok")  # pandas re-emits the float
    assert got["d.zip"][1] == "error"


def test_text_only_plan_stays_in_the_jvm(spark):
    rows = [("a.txt", b"x\r\ny"), ("b.csv", b"k,v\n1,x\n"), ("c.csv", b"k,v\n1.50,x\n"), ("n.txt", None), ("n.zip", None), ("d.zip", b"PK")]
    out = extract_op.extract_text(files(spark, rows), python_formats=())
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.key: (r.text, r.status) for r in out.collect()}
    assert got == {"a.txt": ("x\ny", "ok"), "b.csv": ("k,v\n1,x\n", "ok"), "c.csv": (None, "not_routed"), "d.zip": (None, "not_routed"),
                   "n.txt": (None, "missing"), "n.zip": (None, "missing")}
    full = {r.key: r.status for r in extract_op.extract_text(files(spark, rows)).collect()}
    assert full["n.txt"] == full["n.zip"] == "missing" and full["c.csv"] == "ok"


def test_archives_nest_without_a_limit_and_report_faults():
    data = _zip([("deep.txt", b"bottom")])
    want = "Extracted from deep.txt:\nbottom\n"
    for _ in range(40):
        data, want = _zip([("in.zip", data)]), f"Extracted from in.zip:\n{want}\n"
    assert extract_op.extract_bytes("x.zip", data) == (want, "ok", None)
    text, status, err = extract_op.extract_bytes("x.zip", _zip([("a.txt", b"\xff"), ("b.zip", b"broken"), ("c.txt", b"ok")]))
    assert status == "partial" and err.startswith("a.txt: ") and text.endswith("Extracted from c.txt:\nok\n")
    assert "Extracted from b.zip:\nError processing file: File is not a zip file\n" in text
