import datetime as dt
import json
import os

from pyspark.sql import functions as F

from evallens.operators import files as files_op
from evallens.operators import links as links_op
from evallens.operators import tasks as tasks_op
from evallens.operators import verdicts as verdicts_op
from evallens.schemas import EVALUATIONS, STEP_CHANGES
from evallens.sources import tasks as tasks_src

T0 = dt.datetime(2024, 2, 1)


def test_json_root_array_with_missing_and_null(spark, tmp_dir):
    recs = [
        {"task_id": "t1", "Question": "q1", "Level": 2, "file_name": "t1.pdf", "Final answer": "a",
         "Annotator Metadata": {"Steps": "s", "Number of steps": "3", "How long did this take?": "5 min",
                                "Tools": "web", "Number of tools": "1"}},
        {"task_id": "t2", "Question": "q2"},
        {"task_id": "t3", "Question": None, "Level": None, "Annotator Metadata": {"Steps": None}},
    ]
    p = os.path.join(tmp_dir, "metadata.json")
    with open(p, "w", encoding="utf-8") as f:
        json.dump(recs, f, indent=2)
    flat = tasks_src.flatten_tasks(tasks_src.read_task_json(spark, p))
    got = {r.task_id: r.asDict() for r in flat.collect()}
    assert got["t1"]["level"] == 2 and got["t1"]["how_long"] == "5 min" and got["t1"]["tools"] == "web"
    assert got["t2"] == {"task_id": "t2", "question": "q2", "level": 0, "file_name": "", "final_answer": "",
                         "steps": "", "number_of_steps": "", "how_long": "", "tools": "", "number_of_tools": ""}
    assert got["t3"]["question"] == "" and got["t3"]["level"] == 0 and got["t3"]["steps"] == ""
    out = os.path.join(tmp_dir, "tasks")
    tasks_src.write_tasks(flat, out)
    assert tasks_src.read_tasks(spark, out).count() == 3
    assert "level" not in tasks_src.read_tasks(spark, out).columns


def _tasks(spark):
    return spark.createDataFrame([("t1", "old1"), ("t2", None), ("t3", "old3")], "task_id string, steps string")


def test_step_updates(spark):
    ch = spark.createDataFrame([
        ("t1", "first", T0, 1), ("t1", "second ", T0 + dt.timedelta(hours=1), 2),
        ("t2", "  \t", T0 + dt.timedelta(hours=2), 3), ("zz", "orphan", T0, 4),
    ], STEP_CHANGES)
    cur = {r.task_id: r.steps for r in tasks_op.apply_step_updates(_tasks(spark), ch).collect()}
    assert cur == {"t1": "second ", "t2": None, "t3": "old3"}
    assert [r.task_id for r in tasks_op.unmatched_step_updates(_tasks(spark), ch).collect()] == ["zz"]
    assert [r.seq for r in tasks_op.rejected_step_changes(ch).collect()] == [3]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", "v1", 1), ("a", "v2", 2), ("b", "w", 1)], "task_id string, q string, loaded_at int")
    got = {r.task_id: r.q for r in tasks_op.latest_per_key(df).collect()}
    assert got == {"a": "v2", "b": "w"}
    tied = [("a", "new", 1), ("a", "old", 1), ("a", None, 1)]
    for rows in (tied, tied[::-1]):
        t = spark.createDataFrame(rows, "task_id string, q string, loaded_at int")
        assert [r.q for r in tasks_op.latest_per_key(t).collect()] == ["old"]


def test_broken_records_fail_or_are_kept_apart(spark, tmp_dir):
    import pytest

    p = os.path.join(tmp_dir, "lines.json")
    with open(p, "w", encoding="utf-8") as f:
        f.write('{"task_id": "t1", "Level": "2"}\n{"task_id": "t2", "Lev\n{"task_id": "t3", "Level": 1.0}\n{"task_id": "t4", "Level": "x"}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        tasks_src.read_task_json(spark, p, multiline=False).collect()
    read = tasks_src.read_task_json(spark, p, multiline=False, strict=False)
    got = {r.task_id: r.level for r in tasks_src.flatten_tasks(tasks_src.good_records(read)).collect()}
    assert got == {"t1": 2, "t3": 1, "t4": 0}
    assert [r.record for r in tasks_src.rejected_records(read).collect()] == ['{"task_id": "t2", "Lev']


def test_task_files_and_orphans(spark):
    tasks = spark.createDataFrame([("t1",), ("t2",)], "task_id string")
    keys = spark.createDataFrame([("t1.PDF",), ("t1.txt",), ("x.csv",)], "file_name string")
    got = sorted((r.task_id, r.file_name or "") for r in files_op.files_by_task(tasks, keys).collect())
    assert got == [("t1", "t1.PDF"), ("t1", "t1.txt"), ("t2", "")]
    assert [r.file_name for r in files_op.orphan_files(tasks, keys).collect()] == ["x.csv"]
    counts = {r.task_id: r.n_files for r in files_op.file_counts(tasks, keys).collect()}
    assert counts == {"t1": 2, "t2": 0}
    # every file is matched or an orphan
    assert files_op.files_by_task(tasks, keys).where(F.col("file_name").isNotNull()).count() + 1 == keys.count()


HTML = """<ul>
<li>no link here</li>
<li><span>x</span><a class="f" href="/d/blob/main/blob/a.pdf">a</a> <a href="/second.txt">b</a></li>
<li><a href="/d/B.PDF">upper</a></li>
<li><a href='https://other.example/x/y.csv'>abs</a></li>
<li><a href="/q?a=1&amp;b=2.txt">amp</a></li>
<li><a name="n">no href</a></li>
</ul>"""


def test_links_edge_rows(spark):
    pages = spark.createDataFrame([(1, "https://host.example/list/page", HTML)], "page_id long, url string, html string")
    links = links_op.harvest_links(pages)
    got = [(r.li_pos, r.href) for r in links.orderBy("li_pos").collect()]
    assert got == [(2, "/d/blob/main/blob/a.pdf"), (3, "/d/B.PDF"), (4, "https://other.example/x/y.csv"),
                   (5, "/q?a=1&b=2.txt")]
    urls = {r.href: (r.url, r.key) for r in links_op.file_urls(links).collect()}
    assert urls == {
        "/d/blob/main/blob/a.pdf": ("https://host.example/d/resolve/main/resolve/a.pdf", "a.pdf"),
        "https://other.example/x/y.csv": ("https://other.example/x/y.csv", "y.csv"),
        "/q?a=1&b=2.txt": ("https://host.example/q?a=1&b=2.txt", "q?a=1&b=2.txt"),
    }
    with_host = links_op.file_urls(links, host="https://h.example")
    assert {r.url for r in with_host.collect()} >= {"https://h.example/d/resolve/main/resolve/a.pdf"}


def test_verdicts(spark):
    v = spark.createDataFrame([
        (1, "a", True, "extra", T0), (2, "b", False, "  \t", T0), (3, "c", False, " x ", T0),
        (4, "d", True, None, T0), (5, "e", None, None, T0),
    ], EVALUATIONS)
    ok = {r.evaluation_id: r.user_feedback for r in verdicts_op.valid_verdicts(v).collect()}
    assert ok == {3: "x", 4: None}
    bad = {r.evaluation_id: (r.reason, r.user_feedback) for r in verdicts_op.rejected_verdicts(v).collect()}
    assert bad == {1: ("feedback_on_correct", "extra"), 2: ("empty_feedback", "  \t"), 5: ("empty_feedback", None)}


def brute_links(html):
    """(li_pos, href) by a stack over the tags that the standard library's parser finds."""
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.items, self.stack = [], []

        def handle_starttag(self, tag, attrs, alone=False):
            href = {k: v or "" for k, v in attrs}.get("href") if tag == "a" else None
            for _, li in self.stack if href is not None else ():
                if li is not None and self.items[li] is None:
                    self.items[li] = href
            if tag == "li":
                self.items.append(None)
            if tag not in links_op.VOID_TAGS and not alone:
                self.stack.append((tag, len(self.items) - 1 if tag == "li" else None))

        def handle_startendtag(self, tag, attrs):
            self.handle_starttag(tag, attrs, alone=True)

        def handle_endtag(self, tag):
            names = [t for t, _ in self.stack]
            if tag in names:
                del self.stack[len(names) - 1 - names[::-1].index(tag):]

    p = P()
    p.feed(html)
    p.close()
    return [(i + 1, h) for i, h in enumerate(p.items) if h]


def test_links_follow_the_tree(spark):
    import random

    r = random.Random(8)
    pieces = ["<ul>", "</ul>", "<li>", "</li>", "<li class='a>b'>", "<a href='/x{}.pdf'>", '<a name=n href="/y{}?a=1&amp;b=2">', "<a href=/z{}>", "</a>",
              "<div>", "</div>", "<br/>", "<img src=x>", "text", "<!-- <li><a href='/no'> -->", "<script>'<li><a href=/no>'</script>", "<li-icon>", "</li-icon>",
              "<a title='see href=/wrong{}.pdf' href='/right{}'>", "<a href>", '<a HREF="">', "<a href='/1{}' x href='/2{}'>", "<a href='/caf&eacute;{}&hellip;'>",
              "<a data-href='/d'>", "<a\nhref = '/s{}'>", "<a class=x/href=/u{}>", "<hr>", "<spacer>", "<OL>", "</OL>", "<a href='/e&#x26;{}&#233;&lt;'>", "<a>", "</p>", "<LI>"]
    docs = ["".join(r.choice(pieces).replace("{}", str(i)) for i in range(r.randrange(1, 40))) for _ in range(300)]
    docs += ["<ul><li><a href='/1'><li><a href='/2'></ul>", "", HTML]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)] + [(9999, None)], "page_id long, html string")
    got = {}
    for x in links_op.harvest_links(df).collect():
        got.setdefault(x.page_id, []).append((x.li_pos, x.href))
    for i, d in enumerate(docs):
        assert sorted(got.get(i, [])) == brute_links(d), d


def test_links_as_the_parser_sees_them(spark):
    html = ["<li><a title=\"see href=/wrong.pdf\" href=\"/right.pdf\">", "<li><a href='/caf&eacute;.pdf'>", "<li><a href><a href='/b.pdf'></li><li><a href='/c.pdf'>"]
    df = spark.createDataFrame(list(enumerate(html)), "page_id int, html string")
    got = sorted((r.page_id, r.li_pos, r.href) for r in links_op.harvest_links(df).collect())
    assert got == [(0, 1, "/right.pdf"), (1, 1, "/café.pdf"), (2, 2, "/c.pdf")]


def test_links_take_linear_time():
    import time

    def seconds(n):
        tags = ["<ul>"] + ["<li>", "<b>"] * n + ["<a href='/x'>"] + ["<li class=a>", "<i>", "</i>", "<a href=/y>", "</li>"] * n + ["</ul>"]
        best = []
        for _ in range(3):
            t = time.perf_counter()
            assert len(links_op.item_links(tags)) == 2 * n
            best.append(time.perf_counter() - t)
        return min(best)

    assert seconds(16000) < 40 * seconds(1000)


def test_task_store_versions(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    cols = "task_id string, question string, level int, file_name string, final_answer string, steps string, number_of_steps string, how_long string, tools string, number_of_tools string"
    rows = [(f"t{i}", "q", 1, "", "", f"old {i}", "", "", "", "") for i in range(40)]
    tasks = spark.createDataFrame(rows, cols)
    tasks_op.create_task_store(tasks, path, buckets=4)
    edits = "task_id string, steps string, changed_at timestamp_ntz, seq long"
    at = lambda d: T0 + dt.timedelta(days=d)
    logs = [[("t1", "five", at(5), 1), ("t2", "two", at(2), 1), ("t3", "  ", at(9), 1), ("none", "x", at(1), 1)],
            [("t1", "late", at(4), 9), ("t2", "again", at(2), 2), ("t4", "a", at(1), 1), ("t4", "b", at(1), 1)],
            [("t2", "earlier seq", at(2), 1), ("t4", "aa", at(1), 1), ("t5", "new", at(1), None)]]
    log = spark.createDataFrame([r for x in logs for r in x], edits)
    for i, x in enumerate(logs):
        assert tasks_op.append_step_edits(spark.createDataFrame(x, edits), path) == i
        if i == 0:
            assert tasks_op.compact_task_store(spark, path) == 1
        if i == 1:
            shown = tasks_op.read_current_tasks(spark, path)
            plan = shown._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Sort " not in plan and "ShuffledHashJoin" in plan
            assert tasks_op.compact_task_store(spark, path) == 2
    got = {r.task_id: (r.steps, r.steps_changed_at) for r in tasks_op.read_current_tasks(spark, path).collect()}
    want = {r.task_id: (r.steps, r.steps_changed_at) for r in tasks_op.apply_step_updates(tasks, log).collect()}
    assert got == want and got["t2"][0] == "again" and got["t4"][0] == "b" and got["t1"][0] == "five" and len(got) == 40


def test_pick_tasks(spark, tmp_dir):
    t = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "task_id string")
    assert tasks_op.pick_tasks(t, "").count() == 0
    assert tasks_op.pick_tasks(t, None).count() == 0
    assert [r.task_id for r in tasks_op.pick_tasks(t, "t2").collect()] == ["t2"]
    ids = spark.createDataFrame([("t1",), ("t3",), ("t3",)], "id string")
    assert sorted(r.task_id for r in tasks_op.pick_tasks(t, ids).collect()) == ["t1", "t3"]
    p = f"{tmp_dir}/t"
    t.write.parquet(p)
    plan = tasks_op.pick_tasks(spark.read.parquet(p), ["t2"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(task_id" in plan or "PushedFilters: [IsNotNull(task_id), EqualTo(task_id" in plan


def test_append_and_read_evaluations(spark, tmp_dir):
    from evallens.sources import evaluations as ev_src

    v = spark.createDataFrame([("t1", True, None), ("t2", False, "  wrong unit ")],
                              "task_id string, is_correct boolean, user_feedback string")
    path = f"{tmp_dir}/evals"
    ev_src.append_evaluations(verdicts_op.valid_verdicts(v), path)
    ev_src.append_evaluations(verdicts_op.valid_verdicts(v.where("task_id = 't1'")), path)
    got = ev_src.read_evaluations(spark, path).collect()
    assert len(got) == 3 and {r.user_feedback for r in got} == {None, "wrong unit"}
    assert all(r.evaluation_id is not None and r.evaluation_timestamp is not None for r in got)


def test_task_files_with_a_hot_task(spark):
    """One task owns a third of the files; results stay whole and equal to a plain left join."""
    n = 3000
    tasks = spark.range(n).select(F.col("id").cast("string").alias("task_id"))
    hot = spark.range(n // 2).select(F.concat(F.lit("0/"), F.col("id").cast("string"), F.lit(".txt")).alias("k"))
    keys = (spark.range(n).select(F.concat(F.col("id").cast("string"), F.lit(".txt")).alias("file_name"))
            .unionByName(spark.range(n // 2).select(F.concat(F.lit("0."), F.col("id").cast("string")).alias("file_name"))))
    got = files_op.files_by_task(tasks, keys)
    naive = tasks.join(files_op.split_keys(keys).select(F.col("file_base_name").alias("task_id"), "file_name"),
                       "task_id", "left")
    assert got.select("task_id", "file_name").exceptAll(naive).count() == 0
    assert naive.exceptAll(got.select("task_id", "file_name")).count() == 0
    assert got.where("task_id = '0'").count() == 1 + n // 2
    assert hot.count() == n // 2
