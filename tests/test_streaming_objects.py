import datetime as dt
import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from evallens.schemas import EVALUATIONS
from evallens.sources import objects as objects_src
from evallens.sources.paths import delete_path
from evallens.streaming import ingest

T0 = dt.datetime(2024, 1, 10)


def test_ingest_two_runs_dedupes(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    first = [(1, "a", True, None, T0), (2, "b", False, "x", T0 + dt.timedelta(hours=1)), (3, "c", True, None, None)]
    spark.createDataFrame(first, EVALUATIONS).write.parquet(f"{src}/b1")
    ingest.ingest_evaluations(spark, f"{src}/*", sink, ck).awaitTermination()
    second = [(2, "b", False, "x", T0 + dt.timedelta(hours=1)), (4, "d", True, None, T0 + dt.timedelta(days=1))]
    spark.createDataFrame(second, EVALUATIONS).write.parquet(f"{src}/b2")
    ingest.ingest_evaluations(spark, f"{src}/*", sink, ck).awaitTermination()
    rows = ingest.read_ingested(spark, sink).collect()
    assert sorted(r.evaluation_id for r in rows) == [1, 2, 3, 4]
    assert all(r.evaluation_timestamp for r in rows)  # a missing time is the batch's

    out, ck2 = os.path.join(tmp_dir, "summary"), os.path.join(tmp_dir, "ck2")
    ingest.live_summary(spark, sink, out, ck2).awaitTermination()
    r = ingest.read_summary(spark, out).collect()[0]
    assert (r.total_evaluations, r.correct_answers) == (4, 3)


def test_ingest_keeps_late_rows_and_equal_verdicts(spark, tmp_dir):
    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    for n, month in enumerate((3, 3, 3, 1)):  # the last file is two months older
        rows = [(n * 10 + i, "t", True, None, dt.datetime(2024, month, 1 + i)) for i in range(10)]
        spark.createDataFrame(rows, EVALUATIONS).coalesce(1).write.parquet(f"{src}/{n}")
    same = [(None, "t", False, "x", T0)] * 2
    spark.createDataFrame(same, EVALUATIONS).coalesce(1).write.parquet(f"{src}/9")
    ingest.ingest_evaluations(spark, f"{src}/*", sink, ck, max_files_per_trigger=1).awaitTermination()
    got = [r.evaluation_id for r in ingest.read_ingested(spark, sink).collect()]
    assert len(got) == 42 and len(set(got)) == 42 and None not in got


def test_replayed_batch_counts_once(spark, tmp_dir):
    src, sink, ck, out, ck2 = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck", "summary", "ck2"))
    rows = [(i, "t", i % 2 == 0, None, T0) for i in range(10)] + [(None, "t", True, None, None)] * 2
    spark.createDataFrame(rows, EVALUATIONS).write.parquet(f"{src}/b1")

    def run():
        ingest.ingest_evaluations(spark, f"{src}/*", sink, ck).awaitTermination()
        ingest.live_summary(spark, sink, out, ck2).awaitTermination()
        r = ingest.read_summary(spark, out).collect()[0]
        return r.total_evaluations, r.correct_answers, ingest.read_ingested(spark, sink).count()

    assert run() == (12, 7, 12)
    for _ in range(2):
        delete_path(spark, f"{ck}/commits/0")
        assert run() == (12, 7, 12)
    assert os.path.isdir(f"{ingest.ledger_path(sink)}/batch=0/attempt=2")
    spark.createDataFrame([(3, "t", True, None, T0), (90, "t", True, None, T0)], EVALUATIONS).write.parquet(f"{src}/b2")
    assert run() == (13, 8, 13)
    # a lost ledger is rebuilt from the table
    shutil.rmtree(ingest.ledger_path(sink))
    ingest.rebuild_ledger(spark, sink)
    out, ck2 = out + "-2", ck2 + "-2"
    assert run() == (13, 8, 13)


def test_ingest_reads_nothing_of_the_table(spark, tmp_dir):
    """Ids stored by earlier batches are known even if those files are gone."""
    src, sink, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    for n in range(4):
        rows = [(i, f"{n}", True, None, T0) for i in range(n * 10, n * 10 + 20)]
        spark.createDataFrame(rows, EVALUATIONS).coalesce(1).write.parquet(f"{src}/{n}")
        ingest.ingest_evaluations(spark, f"{src}/*", sink, ck).awaitTermination()
        stored = spark.read.schema(ingest.STORED).parquet(sink).where(f"batch = {n}").count()
        assert stored == (20 if n == 0 else 10)
        shutil.rmtree(f"{sink}/batch={n}")


def test_list_fetch_land(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    os.makedirs(os.path.join(store, "sub"))
    for rel, data in [("a.txt", b"one"), ("sub/a.txt", b"newer"), ("b.PY", b"x=1"), (".hidden", b"")]:
        with open(os.path.join(store, rel), "wb") as f:
            f.write(data)
    os.utime(os.path.join(store, "a.txt"), (1_000_000, 1_000_000))
    listing = objects_src.list_objects(spark, store)
    assert sorted(r.key for r in listing.collect()) == ["a.txt", "a.txt", "b.PY"]
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]
    wanted = spark.createDataFrame([("b.PY",)], "key string")
    assert [r.content for r in objects_src.fetch_objects(spark, store, wanted).collect()] == [b"x=1"]
    out = os.path.join(tmp_dir, "landed")
    objects_src.land_objects(spark, store, out)
    got = {r.key: (r.ext, bytes(r.content)) for r in objects_src.read_landed(spark, out).collect()}
    assert got == {"a.txt": (".txt", b"newer"), "b.PY": (".py", b"x=1")}


def test_land_paths_agree(spark, tmp_dir):
    """With and without a broadcast of the superseded paths the same rows land; a later landing wins."""
    store = os.path.join(tmp_dir, "store2")
    for rel, data, when in [("x/a.txt", b"old", 1_000), ("y/a.txt", b"new", 2_000), ("b.txt", b"b", 1_000),
                            ("x/c.py", b"c1", 5_000), ("y/c.py", b"c2", 5_000)]:
        os.makedirs(os.path.dirname(os.path.join(store, rel)), exist_ok=True)
        with open(os.path.join(store, rel), "wb") as f:
            f.write(data)
        os.utime(os.path.join(store, rel), (when, when))
    runs = {}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name, limit in (("broadcast", old), ("shuffle", "-1")):
        out = os.path.join(tmp_dir, "landed-" + name)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        objects_src.land_objects(spark, store, out)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        runs[name] = {r.key: bytes(r.content) for r in objects_src.read_landed(spark, out).collect()}
    # equal times: the greater path wins
    assert runs["broadcast"] == runs["shuffle"] == {"a.txt": b"new", "b.txt": b"b", "c.py": b"c2"}
    out = os.path.join(tmp_dir, "landed-single")
    objects_src.land_objects(spark, os.path.join(store, "x"), out)
    assert {r.key for r in objects_src.read_landed(spark, out).collect()} == {"a.txt", "c.py"}
    objects_src.land_objects(spark, os.path.join(store, "y"), out, landing=1)
    again = {r.key: bytes(r.content) for r in objects_src.read_landed(spark, out).collect()}
    assert again == {"a.txt": b"new", "c.py": b"c2"}


def _store(folder, files):
    for name, data in files.items():
        os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)
    return folder


def _contents(df):
    return {r.key: bytes(r.content) for r in df.collect()}


def test_three_landings_are_read_without_moving_objects(spark, tmp_dir):
    out = os.path.join(tmp_dir, "landed")
    want = {}
    for n in range(3):
        files = {f"{i}.txt": f"{n}-{i}".encode() for i in range(n * 20, n * 20 + 60)}
        want |= files
        objects_src.land_objects(spark, _store(os.path.join(tmp_dir, f"s{n}"), files), out, slot_bytes=40, landing=n)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = objects_src.read_landed(spark, out)
        assert _contents(df) == want
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan.replace("SortMerge", "") and plan.count("ShuffledHashJoin") >= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # a repeated landing overwrites itself
    objects_src.land_objects(spark, _store(os.path.join(tmp_dir, "s3"), {"1.txt": b"x", "70.txt": b"y"}), out, landing=2)
    want = {f"{i}.txt": f"{max(0, min(1, (i - 20) // 20 + 1 if i >= 20 else 0))}-{i}".encode() for i in range(80)} | {"1.txt": b"x", "70.txt": b"y"}
    got = _contents(objects_src.read_landed(spark, out))
    assert set(got) == set(want) and got["1.txt"] == b"x" and got["70.txt"] == b"y" and got["25.txt"] == b"1-25" and got["5.txt"] == b"0-5"


def test_fetch_reads_the_wanted_slots_only(spark, tmp_dir):
    out, files = os.path.join(tmp_dir, "landed"), {f"{i}.bin": os.urandom(500) for i in range(400)}
    store = _store(os.path.join(tmp_dir, "store"), files)
    objects_src.land_objects(spark, store, out, slot_bytes=1000)
    wanted = spark.createDataFrame([("7.bin",), ("7.bin",), ("88.bin",), ("120.bin",), ("nowhere",), (None,)], "key string")
    df = objects_src.fetch_landed(spark, out, wanted)
    assert _contents(df) == {k: files[k] for k in ("7.bin", "88.bin", "120.bin")}
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    picked, slots = map(int, re.search(r"SelectedBucketsCount: (\d+) out of (\d+)", plan).groups())
    assert slots == 200 and picked <= 4
    assert _contents(objects_src.fetch_landed(spark, out, wanted.limit(0))) == {}
    # and straight from the store
    assert _contents(objects_src.fetch_objects(spark, store, wanted)) == {k: files[k] for k in ("7.bin", "88.bin", "120.bin")}


def test_changes_between_inventories(spark, tmp_dir):
    out, store = os.path.join(tmp_dir, "landed"), os.path.join(tmp_dir, "store")
    _store(store, {"a.txt": b"a", "b.txt": b"b", "c.txt": b"c", "old/d.txt": b"d"})
    land = lambda n: {(r.key, r.change) for r in objects_src.land_changes(spark, out, objects_src.list_objects(spark, store), n).collect()}
    assert land(0) == {(k, "new") for k in ("a.txt", "b.txt", "c.txt", "d.txt")}
    assert land(1) == set()
    _store(store, {"b.txt": b"bb", "new/e.txt": b"e"})
    os.remove(os.path.join(store, "c.txt"))
    assert land(2) == {("b.txt", "changed"), ("c.txt", "deleted"), ("e.txt", "new")}
    _store(store, {"c.txt": b"back"})
    os.remove(os.path.join(store, "a.txt"))
    assert land(3) == {("c.txt", "new"), ("a.txt", "deleted")}
    assert _contents(objects_src.read_landed(spark, out)) == {"b.txt": b"bb", "c.txt": b"back", "d.txt": b"d", "e.txt": b"e"}
    assert sorted(r.key for r in objects_src.landed_listing(spark, out).collect()) == ["b.txt", "c.txt", "d.txt", "e.txt"]
    # only what changed was read
    rows = [spark.read.schema(objects_src.COLUMNS).parquet(f"{out}/landing={n}").where("not deleted").count() for n in range(4)]
    assert rows == [4, 0, 2, 1]
    gone = objects_src.list_objects(spark, store).withColumn("path", F.concat("path", F.lit("x"))).withColumn("key", F.lit("z"))
    with pytest.raises(Exception, match="(?i)exist"):
        objects_src.land_changes(spark, out, gone, 4)


def test_scratch_belongs_to_the_application(spark):
    from evallens.session import clear_scratch, scratch_path, shared_dir

    other = f"{shared_dir(spark)}/evallens/other-application/t"
    spark.range(1).write.mode("overwrite").parquet(other)
    own = scratch_path(spark, "t")
    assert own != scratch_path(spark, "t") and spark.sparkContext.applicationId in own
    spark.range(1).write.parquet(own)
    clear_scratch(spark)
    clear_scratch(spark)  # nothing left is no fault
    assert not os.path.exists(own.removeprefix("file:")) and spark.read.parquet(other).count() == 1


def test_backfill_writes_with_all_partitions(spark, monkeypatch):
    """No part goes through a single task, and several triggers still run, old times last."""
    from evallens.plans import catalog

    paths = {}
    real = catalog.scratch_path
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: paths.setdefault(name, real(s, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = catalog.ingest_stream_backfill(spark, "/root/testdata/sf0.001").count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(len(spark.read.parquet(f"{paths['backfill-in']}/part{i}").inputFiles()) > 1 for i in range(4))
    got = spark.read.parquet(paths["backfill-sink"]).where("evaluation_id is not null").groupBy("batch")
    first = [r.first for r in got.agg({"evaluation_timestamp": "min"}).toDF("batch", "first").orderBy("batch").collect()]
    assert n and len(first) >= 3 and first[0] > min(first)


@pytest.fixture(scope="module")
def many_files(tmp_path_factory):
    """3,000 small objects in 40 folders."""
    return _store(str(tmp_path_factory.mktemp("many")), {f"{i % 40}/{i}.txt": b"%d" % i for i in range(3_000)})


def _most_tasks(spark, run):
    """The most tasks that a stage had while `run` ran, and its result."""
    sc, group = spark.sparkContext, os.urandom(8).hex()
    sc.setJobGroup(group, "")
    try:
        out = run()
        tracker = sc.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        return max(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds if tracker.getStageInfo(s)), out
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_stored_files_share_folders(spark, tmp_dir):
    """A file per key, whose values are its lines; no folder per key."""
    from evallens.plans import catalog

    rows = [(f"{i}.txt", f"text {i}") for i in range(100)] + [("5.txt", "again"), (None, "none"), ("", "empty"), ("a/b.py", "ü"), ("n.txt", None)]
    docs = spark.createDataFrame(rows, "key string, value string").repartition(7)
    store = catalog._written(docs, os.path.join(tmp_dir, "store")).removeprefix("file:")
    folders = [(d, names) for d, _, names in os.walk(store) if d != store]
    assert len(folders) <= 4 * spark.sparkContext.defaultParallelism
    assert sum(len(names) for _, names in folders) == 103 and all(n.startswith("key=") for _, names in folders for n in names)
    got = _contents(objects_src.fetch_objects(spark, store, key_pattern=catalog.KEY_PATTERN))
    want = {f"{i}.txt": f"text {i}\n".encode() for i in range(100)}
    assert got == want | {"5.txt": b"again\ntext 5\n", catalog.NO_KEY: b"empty\nnone\n", "a%2Fb.py": "ü\n".encode(), "n.txt": b"\n"}
    empty = catalog._written(docs.limit(0), os.path.join(tmp_dir, "none"))
    assert objects_src.list_objects(spark, empty, key_pattern=catalog.KEY_PATTERN).count() == 0


def test_listing_deals_many_objects_a_task(spark, many_files):
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    listing = objects_src.list_objects(spark, many_files)
    assert listing.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert {(r.key, r.length) for r in listing.collect()} == {(f"{i}.txt", len(str(i))) for i in range(3_000)}
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_fetch_deals_many_objects_a_task(spark, many_files):
    keys = [f"{i}.txt" for i in range(3_000) if i % 10]
    wanted = spark.createDataFrame([(k,) for k in keys], "key string")
    tasks, got = _most_tasks(spark, lambda: _contents(objects_src.fetch_objects(spark, many_files, wanted)))
    assert tasks <= 4 * spark.sparkContext.defaultParallelism
    assert got == {k: k.split(".")[0].encode() for k in keys}


def test_landing_deals_many_objects_a_task(spark, many_files, tmp_dir):
    out = os.path.join(tmp_dir, "landed")
    tasks, _ = _most_tasks(spark, lambda: objects_src.land_objects(spark, many_files, out))
    assert tasks <= 4 * spark.sparkContext.defaultParallelism
    assert _contents(objects_src.read_landed(spark, out)) == {f"{i}.txt": b"%d" % i for i in range(3_000)}


def test_small_slots_share_files(spark, tmp_dir):
    """More slots than files: landings, deletions and fetches find the rows that count."""
    out, store = os.path.join(tmp_dir, "landed"), os.path.join(tmp_dir, "store")
    files = {f"{i}.bin": os.urandom(500) for i in range(700)}
    objects_src.land_objects(spark, _store(store, files), out, slot_bytes=100)
    assert objects_src._layout(spark, out) == (3500, objects_src.FEW_FILES)
    assert len(spark.read.parquet(f"{out}/landing=0").inputFiles()) <= objects_src.FEW_FILES
    later = {f"{i}.bin": os.urandom(400) for i in range(600, 800)}
    _store(store, later)
    for i in range(50):
        os.remove(os.path.join(store, f"{i}.bin"))
    objects_src.land_changes(spark, out, objects_src.list_objects(spark, store), 1)
    want = {k: v for k, v in (files | later).items() if int(k.split(".")[0]) >= 50}
    assert _contents(objects_src.read_landed(spark, out)) == want
    wanted = spark.createDataFrame([("7.bin",), ("88.bin",), ("650.bin",), ("799.bin",), ("nowhere",), (None,)], "key string")
    df = objects_src.fetch_landed(spark, out, wanted)
    assert _contents(df) == {k: want[k] for k in ("88.bin", "650.bin", "799.bin")}
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert all(int(picked) <= 5 for picked in re.findall(r"SelectedBucketsCount: (\d+) out of 256", plan)) and "out of 256" in plan
    # a store whose slots have a file each says nothing of files
    spark.range(200, 201).coalesce(1).write.parquet(os.path.join(tmp_dir, "older", "slots"))
    assert objects_src._layout(spark, os.path.join(tmp_dir, "older")) == (200, 200)


def test_changes_deal_many_objects_a_task(spark, many_files, tmp_dir):
    out, listing = os.path.join(tmp_dir, "landed"), objects_src.list_objects(spark, many_files)
    for n, part in enumerate((listing.where("key not like '%7.txt'"), listing.where("key not like '%3.txt'"))):
        tasks, changes = _most_tasks(spark, lambda: {(r.key, r.change) for r in objects_src.land_changes(spark, out, part, n).collect()})
        assert tasks <= 4 * spark.sparkContext.defaultParallelism
    assert changes == {(f"{i}.txt", "new" if i % 10 == 7 else "deleted") for i in range(3_000) if i % 10 in (3, 7)}
    assert _contents(objects_src.read_landed(spark, out)) == {f"{i}.txt": b"%d" % i for i in range(3_000) if i % 10 != 3}


def _rows(df):
    return sorted((r.path, r.length, r.modificationTime) for r in df.select("path", "length", "modificationTime").collect())


def _odd_store(folder):
    """Nested folders, names that are patterns, hidden names, links."""
    names = [f"d{i % 3}/e{i % 5}/f{i % 7}/{i}.txt" for i in range(60)] + ["a [1].txt", "d0/{x,y}*.txt", "d1/z=1%2F.csv", "_x=1/k.txt", "_metadata_/k.txt", "top.PY"]
    hidden = ["_no/1.txt", "d0/.h/2.txt", "d2/.3.txt", "d2/_4.txt", "d2/5._COPYING_", "_metadata"]
    _store(folder, {n: n.encode() for n in names + hidden} | {"d1/empty.txt": b""})
    os.makedirs(os.path.join(folder, "none"))
    os.symlink(os.path.join(folder, "d1"), os.path.join(folder, "linked"))
    os.symlink(os.path.join(folder, "nowhere"), os.path.join(folder, "broken"))
    return folder


def _no_index(monkeypatch):
    """Spark's own reader of files is not used."""
    def fail(*_):
        raise AssertionError("Spark lists the store, and the driver holds its files")

    monkeypatch.setattr(objects_src, "_reader", fail)


def test_listing_is_made_by_tasks(spark, tmp_dir, monkeypatch):
    """The rows of Spark's own listing, without the driver's index of files; in one round or in several."""
    store = _odd_store(os.path.join(tmp_dir, "store"))
    want = {glob: _rows(objects_src._reader(spark, glob).load(store)) for glob in (None, "*.{txt,csv}", "[0-4]*")}
    single = _rows(spark.read.format("binaryFile").load(os.path.join(store, "top.PY")))
    _no_index(monkeypatch)
    assert len(want[None]) > 80 and 0 < len(want["[0-4]*"]) < len(want["*.{txt,csv}"]) < len(want[None])
    for most in (10_000, 3):
        monkeypatch.setattr(objects_src, "ENTRIES_PER_TASK", most)
        assert all(_rows(objects_src.list_objects(spark, store, glob=glob)) == rows for glob, rows in want.items())
    assert _rows(objects_src.list_objects(spark, os.path.join(store, "top.PY"))) == single
    some = {r.key for r in objects_src.list_objects(spark, os.path.join(store, "d[01]/e{0,1}")).collect()}
    assert some == {f"{i}.txt" for i in range(60) if i % 3 < 2 and i % 5 < 2}
    with pytest.raises(Exception, match="does not exist"):
        objects_src.list_objects(spark, os.path.join(store, "absent"))
    hidden = spark._jvm.org.apache.spark.util.HadoopFSUtils.shouldFilterOutPathName
    for name in ("a", ".a", "_a", "_a=1", ".a=1", "a._COPYING_", "_metadata", "_common_metadata", "_metadata._COPYING_", "a_"):
        assert objects_src.hidden_name(name, True) == hidden(name)


def test_other_file_systems_are_listed_in_parts(spark, tmp_dir, monkeypatch):
    """A path that only Hadoop can open: the same rows, a part of the store at a time."""
    store = _odd_store(os.path.join(tmp_dir, "store"))
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.parts.link./in", f"file://{tmp_dir}")
    want = [(p.replace(f"file:{tmp_dir}", "viewfs://parts/in"), n, at) for p, n, at in _rows(objects_src._reader(spark, None).load(store))]
    for most in (20_000, 7):
        monkeypatch.setattr(objects_src, "PATHS_PER_JOB", most)
        assert _rows(objects_src.list_objects(spark, "viewfs://parts/in/store")) == want
    # fetched and landed, too
    keys = spark.createDataFrame([("a [1].txt",), ("{x,y}*.txt",), ("17.txt",)], "key string")
    assert _contents(objects_src.fetch_objects(spark, "viewfs://parts/in/store", keys)) == {
        "a [1].txt": b"a [1].txt", "{x,y}*.txt": b"d0/{x,y}*.txt", "17.txt": b"d2/e2/f3/17.txt"}
    out = os.path.join(tmp_dir, "landed")
    objects_src.land_objects(spark, "viewfs://parts/in/store", out)
    assert _contents(objects_src.read_landed(spark, out)) == _odd_contents(want, "viewfs://parts/in/store/")
    # of an inventory that names files of both kinds, none is left out
    both = objects_src.list_objects(spark, "viewfs://parts/in/store").where("key like '%7.txt'").unionByName(
        objects_src.list_objects(spark, store).where("key like '%8.txt'"))
    objects_src.land_changes(spark, out, both, 1)
    assert set(_contents(objects_src.read_landed(spark, out))) == {f"{i}.txt" for i in range(60) if i % 10 in (7, 8)}


def _odd_contents(rows, top):
    """What the store's keys hold: the latest file's name below the store, then the greatest path's."""
    best = {}
    for path, _, at in rows:
        best[path.rsplit("/", 1)[-1]] = max(best.get(path.rsplit("/", 1)[-1], (at, path)), (at, path))
    return {k: path.removeprefix(top).replace("linked/", "d1/", 1).encode() for k, (_, path) in best.items()}


def test_fetch_reads_in_tasks(spark, tmp_dir, monkeypatch):
    """Wanted files are read without the driver's index of files, whatever their names."""
    store = _odd_store(os.path.join(tmp_dir, "store"))
    _no_index(monkeypatch)
    wanted = spark.createDataFrame([("a [1].txt",), ("{x,y}*.txt",), ("17.txt",), ("empty.txt",), (None,)], "key string")
    want = {"a [1].txt": b"a [1].txt", "{x,y}*.txt": b"d0/{x,y}*.txt", "17.txt": b"d2/e2/f3/17.txt"}
    assert _contents(objects_src.fetch_objects(spark, store, wanted)) == want
    monkeypatch.setattr(objects_src, "BATCH_BYTES", 20)  # several batches a task
    assert _contents(objects_src.fetch_objects(spark, store, wanted)) == want
    assert len(objects_src.fetch_objects(spark, store).collect()) == objects_src.list_objects(spark, store).count()
    assert objects_src.fetch_objects(spark, store, wanted.limit(0)).count() == 0


def test_landing_reads_in_the_tasks_that_write(spark, tmp_dir, monkeypatch):
    """No index of files on the driver, and rows are dealt without their bytes."""
    store, out, plans = _odd_store(os.path.join(tmp_dir, "store")), os.path.join(tmp_dir, "landed"), []
    write = objects_src.write_bucketed

    def seen(df, path, *args, **kw):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, path, *args, **kw)

    _no_index(monkeypatch)
    monkeypatch.setattr(objects_src, "write_bucketed", seen)
    objects_src.land_objects(spark, store, out)
    read, dealt = plans[0].index("MapInArrow"), plans[0].index("RepartitionByExpression")
    assert read < dealt and "content" not in plans[0][dealt:]
    assert _contents(objects_src.read_landed(spark, out)) == _odd_contents(_rows(objects_src.list_objects(spark, store)), f"file:{store}/")


def test_fetch_of_most_files_names_no_slots(spark, tmp_dir):
    """The driver holds the wanted slots only if they spare it half the files."""
    out, files = os.path.join(tmp_dir, "landed"), {f"{i}.bin": os.urandom(500) for i in range(700)}
    objects_src.land_objects(spark, _store(os.path.join(tmp_dir, "store"), files), out, slot_bytes=100)
    for keys, named in ((list(files)[:600], False), (list(files)[:20], True)):
        df = objects_src.fetch_landed(spark, out, spark.createDataFrame([(k,) for k in keys], "key string"))
        assert ("slot IN (" in df._jdf.queryExecution().logical().toString().replace("'", "").replace("`", "") or "slot#" in "".join(re.findall(r"Filter (\S+) IN \(", df._jdf.queryExecution().analyzed().toString()))) == named
        assert _contents(df) == {k: files[k] for k in keys}


def test_changes_are_read_in_the_tasks_that_write(spark, tmp_dir, monkeypatch):
    """Paths of an inventory are not named by the driver; a landing whose files are missing leaves the store as it was."""
    out, store = os.path.join(tmp_dir, "landed"), _odd_store(os.path.join(tmp_dir, "store"))
    _no_index(monkeypatch)
    monkeypatch.setattr(objects_src, "_read_paths", lambda listing: pytest.fail("the driver names the files"))
    listing = objects_src.list_objects(spark, store)
    want = _odd_contents(_rows(listing), f"file:{store}/")
    changes = objects_src.land_changes(spark, out, listing, 0)
    assert {(r.key, r.change) for r in changes.collect()} == {(k, "new") for k in want}
    later = listing.where("key not like '%3.txt'").unionByName(
        listing.where("key = 'top.PY'").withColumn("key", F.lit("copy.py")))
    objects_src.land_changes(spark, out, later, 1)
    want = {k: v for k, v in want.items() if not k.endswith("3.txt")} | {"copy.py": b"top.PY"}
    assert _contents(objects_src.read_landed(spark, out)) == want
    absent = listing.withColumn("path", F.concat("path", F.lit("x")))
    for rows in (absent, absent.withColumn("path", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="does not exist"):
            objects_src.land_changes(spark, out, rows, 1)
    assert _contents(objects_src.read_landed(spark, out)) == want


def test_stored_files_of_single_keys_are_not_dealt(spark, tmp_dir, monkeypatch):
    """Only rows of repeated keys are dealt by key; with many of these, all are. The files are the same."""
    from evallens.plans import catalog

    docs = spark.createDataFrame([(f"{i % 90}.txt", f"text {i}") for i in range(100)] + [(None, "b"), ("", "a")], "key string, value string").repartition(7)
    dealt, real = [], type(docs).sortWithinPartitions
    monkeypatch.setattr(type(docs), "sortWithinPartitions", lambda df, *cols: dealt.append(df.count()) or real(df, *cols))
    stores = []
    for most in (10_000, 5):
        monkeypatch.setattr(catalog, "MOST_REPEATED", most)
        store = catalog._written(docs, os.path.join(tmp_dir, f"store{most}")).removeprefix("file:")
        stores.append({os.path.relpath(os.path.join(d, n), store): open(os.path.join(d, n), "rb").read() for d, _, names in os.walk(store) for n in names})
    assert dealt == [22, 102] and stores[0] == stores[1] and len(stores[0]) == 91
    assert {k.split("/")[1]: v for k, v in stores[0].items()}["key=3.txt"] == b"text 3\ntext 93\n"
