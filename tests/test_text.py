import os
import re
import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evallens.functions.text import last_segment, py_strip, splitext_base, splitext_ext, tokens

SPLITEXT_CASES = ["a.tar.gz", ".env", "d.x/y", "d/.env", "a.PDF", "..x", "a.", "d/y.pdf", ".a.b", "", "/", "a/b.c/"]


def _rows(spark, values, col="s"):
    return spark.createDataFrame([(v,) for v in values], f"{col} string")


def test_splitext_edge_rows(spark):
    df = _rows(spark, SPLITEXT_CASES).select("s", splitext_base("s").alias("b"), splitext_ext("s").alias("e"))
    got = {r.s: (r.b, r.e) for r in df.collect()}
    for k in SPLITEXT_CASES:
        b, e = os.path.splitext(k)
        assert got[k] == (b, e.lower()), k


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab./.X", max_size=8), min_size=1, max_size=30))
def test_splitext_matches_python(spark, keys):
    df = _rows(spark, keys).select("s", splitext_base("s").alias("b"), splitext_ext("s", lower=False).alias("e"))
    for r in df.collect():
        assert (r.b, r.e) == os.path.splitext(r.s)


def test_tokens_unicode(spark):
    text = "Can't naïve_x ÉTÉ 42 日本語 ½"
    (r,) = _rows(spark, [text, "ét"]).select(tokens("s").alias("t")).collect()[:1]
    assert r.t == ["can", "t", "naïve_x", "été", "42", "日本語", "½"]
    assert r.t == re.findall(r"\b\w+\b", text.lower())
    (r2,) = _rows(spark, ["ét"]).select(tokens("s").alias("t")).collect()
    assert r2.t == re.findall(r"\b\w+\b", "ét")


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=string.ascii_letters + " _-'éÉß½٣́", max_size=20), min_size=1, max_size=20))
def test_tokens_match_python(spark, texts):
    got = [r.t for r in _rows(spark, texts).select(tokens("s").alias("t")).collect()]
    assert got == [re.findall(r"\b\w+\b", t.lower()) for t in texts]


def test_strip_edge_rows(spark):
    vals = ["\t hi　\n", "\x1ca\x1c", "  ", "x y", " z\u0085"]
    got = [r.t for r in _rows(spark, vals).select(py_strip("s").alias("t")).collect()]
    assert got == [v.strip() for v in vals]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x1c\x1f  ​　ab", max_size=12), min_size=1, max_size=20))
def test_strip_matches_python(spark, vals):
    got = [r.t for r in _rows(spark, vals).select(py_strip("s").alias("t")).collect()]
    assert got == [v.strip() for v in vals]


def test_last_segment(spark):
    vals = ["https://h/a/b.pdf", "a", "a/", "/x/y?z"]
    got = [r.t for r in _rows(spark, vals).select(last_segment(F.col("s")).alias("t")).collect()]
    assert got == [v.split("/")[-1] for v in vals]
