"""Object store: listing (S8), fetch (S9) and landing.

The store is any path Hadoop can read (local, HDFS, S3 through its connector,
with the caller's configuration).  The driver never holds the files of a store:
`file:` paths (a disk or a mount that all machines see) are listed and read by
tasks, others by Spark's `binaryFile` source, a part of the store at a time.
Keys are object names: by default the last path segment (the reference's bucket is
flat), or a regex group over the path.

A landed store is a folder:

    slots/       the numbers of slots and of the files that hold them, fixed by the first landing
    landing=N/   the objects of one landing, bucketed by slot (a hash of the key)
    gone=N/      after landing N: per slot, bitmaps of the rows that later objects
                 or deletions supersede, by landing

Bitmaps are found on metadata columns and applied while a landing is read: both are
bucketed by slot, so they meet without moving an object's bytes.  `gone=N` is
written last; a landing counts once it is there.
"""

from __future__ import annotations

import errno
import functools
import os
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from evallens.functions.text import last_segment, splitext_ext
from evallens.session import scratch_path, settings
from evallens.sources.buckets import read_bucketed, write_bucketed
from evallens.sources.paths import file_system, folder_numbers, hidden_name, literal_path, path_exists, roots

LISTING = ("path", "length", "modificationTime", "key")
ENTRY = "path string, length long, modified long, folder boolean"  # `modified` in milliseconds
ENTRIES_PER_TASK = 10_000  # a task that has listed so many entries leaves the folders it finds to the next round
SLOT_BYTES = 256 << 20
MAX_SLOTS = 1 << 16
FEW_FILES = 256  # slots share files beyond so many, as long as files would be smaller than FILE_BYTES
FILE_BYTES = 4 << 20
OPEN_BYTES = 64 << 10  # what opening an object counts as, when objects are dealt to tasks by their bytes
PATHS_PER_JOB = 20_000  # paths the driver names at a time when Spark's source lists or reads a part of a store
READ_BYTES = 64 << 20  # what a task fetches
BATCH_BYTES = 8 << 20


def _key(path: F.Column, key_pattern: str | None) -> F.Column:
    if key_pattern is None:
        return last_segment(path)
    return F.regexp_extract(path, key_pattern, 1)


def _reader(spark: SparkSession, glob: str | None):
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return r.option("pathGlobFilter", glob) if glob else r


@contextmanager
def _dealt(spark: SparkSession, metadata: bool = False):
    """Many small objects a task, for listings and reads planned meanwhile; by their number if only `metadata` is read.

    By Spark's defaults a task lists a folder or two and reads at most 32 objects.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    values = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": tasks, "spark.sql.files.openCostInBytes": OPEN_BYTES}
    if metadata:
        values["spark.sql.files.maxPartitionNum"] = tasks
    with settings(spark, {k: str(v) for k, v in values.items()}):
        yield


def _listed(batches):
    """Local folders -> ENTRY rows: their files and those below; of folders, the ones that are not listed here."""
    seen, rows = 0, []

    def batch():
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.bool_()))], names=["path", "length", "modified", "folder"])
        rows.clear()
        return out

    for given in (p for b in batches for p in b.column("path").to_pylist()):
        below = [given]
        while below:
            folder = below.pop()
            if folder != given and seen >= ENTRIES_PER_TASK:
                rows.append((folder, None, None, True))
                continue
            try:
                entries = os.scandir(folder.removeprefix("file:"))
            except FileNotFoundError:  # deleted meanwhile, as below; Spark's listings pass over both
                continue
            with entries:
                for e in entries:
                    path = f"{folder.rstrip('/')}/{e.name}"
                    try:
                        is_folder = e.is_dir()
                        if hidden_name(e.name, is_folder):
                            continue
                        stat = e.stat()
                    except OSError as x:
                        if x.errno not in (errno.ENOENT, errno.ELOOP):
                            raise
                        continue
                    seen += 1
                    if not is_folder:
                        rows.append((path, stat.st_size, stat.st_mtime_ns // 1_000_000, False))
                    elif seen < ENTRIES_PER_TASK:
                        below.append(path)
                    else:
                        rows.append((path, None, None, True))
                    if len(rows) >= ENTRIES_PER_TASK:
                        yield batch()
    if rows:
        yield batch()


def _list_in_tasks(spark: SparkSession, folders: list[str], out: str) -> None:
    """The files below local folders, in rounds: each lists the folders that the one before it found and left."""
    tasks, todo, i = 4 * spark.sparkContext.defaultParallelism, spark.createDataFrame([(p,) for p in folders], "path string"), 0
    while n := todo.count():
        todo.repartition(min(n, tasks), "path").mapInArrow(_listed, ENTRY).write.parquet(f"{out}/round={i}")
        todo, i = spark.read.schema(ENTRY).parquet(f"{out}/round={i}").where("folder").select("path"), i + 1


def _list_in_parts(spark: SparkSession, folders: list[str], out: str) -> None:
    """The files below folders of other file systems, by Spark's listing of PATHS_PER_JOB or so at a time.

    The driver holds the names of folders and the files of one part.
    """
    fs, path = file_system(spark, folders[0])
    todo, part, size, named = list(folders), [], 0, []
    at = lambda: f"{out}/part={len(folder_numbers(spark, out, 'part'))}"

    def listed():
        if part:
            with _dealt(spark, metadata=True):
                df = _reader(spark, None).load([literal_path(p) for p in part])
                df.select("path", "length", F.unix_millis("modificationTime").alias("modified"), F.lit(False).alias("folder")).write.parquet(at())
            part.clear()

    def written():
        if named:
            spark.createDataFrame(named, ENTRY).write.parquet(at())
            named.clear()

    while todo:
        folder = todo.pop()
        files = fs.getContentSummary(path(folder)).getFileCount()
        if files <= PATHS_PER_JOB:
            if part and size + files > PATHS_PER_JOB:
                listed()
            size = size + files if part else files
            part.append(folder)
            continue
        entries = fs.listStatusIterator(path(folder))
        while entries.hasNext():
            e = entries.next()
            if hidden_name(e.getPath().getName(), e.isDirectory()):
                continue
            if e.isDirectory():
                todo.append(e.getPath().toString())
            else:
                named.append((e.getPath().toString(), e.getLen(), e.getModificationTime(), False))
                if len(named) >= PATHS_PER_JOB:
                    written()
    listed()
    written()


def list_objects(spark: SparkSession, uri: str, key_pattern: str | None = None,
                 glob: str | None = None) -> DataFrame:
    """(path, key, length, modificationTime) of every file below `uri`.

    No file body is read.  Unlike the reference's single listing call, every object is
    listed.  Hidden files (names starting with `.` or `_`) and files of no bytes are
    skipped, as by Spark's readers.
    The listing is stored in the shared folder, when this is called, by the tasks that make it.
    """
    out, found = scratch_path(spark, "objects-listed"), roots(spark, uri)
    files = [(p, n, at, False) for p, n, at, folder in found if not folder and not hidden_name(p.rsplit("/", 1)[-1], False)]
    spark.createDataFrame(files, ENTRY).write.parquet(f"{out}/roots=0")
    if folders := [p for p, _, _, folder in found if folder]:
        (_list_in_tasks if folders[0].startswith("file:/") else _list_in_parts)(spark, folders, out)
    df = spark.read.schema(ENTRY).option("recursiveFileLookup", True).parquet(out).where("NOT folder AND length > 0")
    if glob is not None:
        name = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
        df = df.where(last_segment(F.col("path")).rlike(rf"(?s)\A(?:{name})\z"))
    return df.select("path", "length", F.timestamp_millis("modified").alias("modificationTime"), _key(F.col("path"), key_pattern).alias("key"))


def fetch_objects(spark: SparkSession, uri: str, wanted: DataFrame | None = None,
                  key_pattern: str | None = None, glob: str | None = None) -> DataFrame:
    """(key, content) of the objects below `uri`, optionally only the keys in `wanted`.

    Wanted keys are resolved to paths on the listing, without reading a byte, and only
    those files are read then (`file:` ones by the result's tasks, others into the shared
    folder, when this is called).
    For repeated reads of a large store, land it once (`fetch_landed`).
    """
    listing = list_objects(spark, uri, key_pattern, glob)
    if wanted is not None:
        listing = _stored(listing.join(wanted.select("key").distinct(), "key", "left_semi").select(*LISTING), "objects-wanted")
    rows = _read_others(listing)
    if "content" not in rows.columns:
        files, total = listing.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        tasks = max(4 * spark.sparkContext.defaultParallelism, -(-total // READ_BYTES))
        rows = _with_content(rows.repartition(max(1, min(files, tasks)), "path"))
    return rows.select("key", "content")


def _local(path: F.Column) -> F.Column:
    """Whether tasks open a path themselves; a row without a path fails there."""
    return F.coalesce(path.startswith("file:/"), F.lit(True))


def _with_content(rows: DataFrame) -> DataFrame:
    """Rows (path, ...) with their files' content, read by the tasks that have the rows; none for rows that are `deleted`."""
    def read(batches):
        for b in batches:
            paths = b.column("path").to_pylist()
            gone = b.column("deleted").to_pylist() if "deleted" in b.schema.names else [False] * len(paths)
            start, size, contents = 0, 0, []
            for i, path in enumerate(paths):
                contents.append(None if gone[i] else _content(path))
                size += len(contents[-1] or b"")
                if size >= BATCH_BYTES or i + 1 == len(paths):
                    part = b.slice(start, len(contents))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(contents, pa.binary())], names=[*part.schema.names, "content"])
                    start, size, contents = i + 1, 0, []

    return rows.mapInArrow(read, StructType([*rows.schema.fields, StructField("content", BinaryType())]))


def _content(path: str) -> bytes:
    if path is None:
        raise ValueError("a listed object has no path")
    try:
        with open(path.removeprefix("file:"), "rb") as f:
            return f.read()
    except FileNotFoundError:
        raise FileNotFoundError(f"{path} does not exist") from None


def _check_paths(listing: DataFrame) -> None:
    """Raises an error if a file that tasks are to open is not there."""
    def check(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                if path is None or not os.path.exists(path.removeprefix("file:")):
                    raise FileNotFoundError(f"{path} does not exist")
        return iter(())

    paths = listing.where(_local(F.col("path"))).select("path")
    paths.repartition(4 * listing.sparkSession.sparkContext.defaultParallelism).mapInArrow(check, "path string").count()


def _read_others(listing: DataFrame) -> DataFrame:
    """The listing, for `_with_content`; with its content already if it names files that tasks do not open themselves."""
    others = listing.where(~_local(F.col("path")))
    if others.isEmpty():
        return listing
    return _with_content(listing.where(_local(F.col("path")))).unionByName(_read_paths(others))


def _read_paths(listing: DataFrame) -> DataFrame:
    """The listing's rows with their files' content, read by Spark's source and stored; other files are not opened.

    The driver names the files, PATHS_PER_JOB or so at a time, and the rows of as many
    are broadcast to their bytes.  A file that cannot be found raises an error.
    """
    spark, wanted = listing.sparkSession, _stored(listing, "objects-wanted")
    total = wanted.count()
    parts = -(-total // PATHS_PER_JOB) or 1
    part, staged = F.pmod(F.xxhash64("path"), F.lit(parts)), scratch_path(spark, "objects-read")
    wanted.limit(0).withColumn("content", F.lit(None).cast("binary")).write.parquet(staged)
    for i in range(parts):
        rows = wanted.where(part == i)
        paths = [r.path for r in rows.select("path").distinct().collect()]
        if paths:
            with _dealt(spark):
                files = spark.read.format("binaryFile").load([literal_path(p) for p in paths]).select("path", "content")
                files.join(F.broadcast(rows), "path").select(*LISTING, "content").write.mode("append").parquet(staged)
    out = spark.read.parquet(staged)
    if out.count() != total:
        raise ValueError(f"{total - out.count()} of {total} listed paths name no file as Spark writes its path")
    return out


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- inventories ---------------------------------------------------------------------

def inventory_listing(inventory: DataFrame, path: str = "path", length: str = "length", modified: str = "modificationTime",
                      key_pattern: str | None = None) -> DataFrame:
    """S8 from an inventory table (as object stores deliver them), in the form of `list_objects`.

    The listing is then a scan like any other: no file is listed by the driver.
    """
    p = F.regexp_replace(F.col(path).cast("string"), "^file:/+", "file:/")  # as Spark writes local paths
    return inventory.select(p.alias("path"), F.col(length).cast("long").alias("length"), F.col(modified).cast("timestamp").alias("modificationTime"),
                            _key(p, key_pattern).alias("key"))


def _latest_rows(listing: DataFrame) -> DataFrame:
    """The listing's row per key that counts: the most recently modified, then the greatest path."""
    best = F.max(F.struct("modificationTime", "path", "length")).alias("b")
    return listing.groupBy("key").agg(best).select("b.path", "b.length", "b.modificationTime", "key")


def inventory_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What turns one listing into another, per key: (key, change, path, length, modificationTime).

    `change` is new, changed (another path, length or time) or deleted (then the other
    columns are NULL).  Keys that stay as they are have no row.
    """
    before = _latest_rows(old).select(F.col("key").alias("_k"), F.struct("path", "length", "modificationTime").alias("_old"))
    now = _latest_rows(new).select("key", F.struct("path", "length", "modificationTime").alias("_new"))
    both = now.join(before, F.col("key") == F.col("_k"), "full")
    change = F.when(F.col("_new").isNull(), "deleted").when(F.col("_old").isNull(), "new").when(~F.col("_new").eqNullSafe(F.col("_old")), "changed")
    return both.select(F.coalesce("key", "_k").alias("key"), change.alias("change"), "_new.*").where(F.col("change").isNotNull())


# --- landing -------------------------------------------------------------------------

COLUMNS = "slot int, row long, key string, ext string, path string, length long, modificationTime timestamp, deleted boolean, content binary"
GONE = "slot int, bits map<struct<landing:int,chunk:long>,binary>"


def _bucketed(spark: SparkSession, path: str, columns: str, files: int) -> DataFrame:
    return read_bucketed(spark, path, columns, "slot", files)


def _layout(spark: SparkSession, out: str, total_bytes: int | None = None, slot_bytes: int = SLOT_BYTES) -> tuple[int, int]:
    """The numbers of slots and of files; a file holds whole slots, one if it is not too small for that."""
    if total_bytes is not None and not path_exists(spark, f"{out}/slots/_SUCCESS"):
        n = min(MAX_SLOTS, max(spark.sparkContext.defaultParallelism, -(-total_bytes // slot_bytes)))
        files = min(n, max(FEW_FILES, -(-total_bytes // FILE_BYTES)))
        spark.range(n, n + 1).coalesce(1).withColumn("files", F.lit(files)).write.mode("overwrite").parquet(f"{out}/slots")
    row = spark.read.parquet(f"{out}/slots").first()
    return row[0], row[1] if len(row) > 1 else row[0]  # a store of an older form has a file per slot


def _slot(key: F.Column, slots: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def _landing(spark: SparkSession, out: str, n: int) -> DataFrame:
    return _bucketed(spark, f"{out}/landing={n}", COLUMNS, _layout(spark, out)[1]).withColumn("landing", F.lit(n))


def _landings(spark: SparkSession, out: str) -> list[int]:
    """The landings that count: those up to the last one whose bitmaps are written."""
    done = [n for n in folder_numbers(spark, out, "gone") if path_exists(spark, f"{out}/gone={n}/_SUCCESS")]
    return [n for n in folder_numbers(spark, out, "landing") if done and n <= max(done)]


def _write_landing(spark: SparkSession, out: str, landing: int, rows: DataFrame) -> None:
    """Objects (path, key, length, modificationTime, deleted) -> landing and bitmaps.

    Rows without their content are dealt without it: the task that writes a slot reads its objects.
    """
    slots, files = _layout(spark, out)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # dense in each writer's part, which holds whole slots
    rows = rows.withColumn("slot", _slot(F.col("key"), slots)).repartition(files, "slot").withColumn("row", at + 1)
    if "content" not in rows.columns:
        rows = _with_content(rows)
    write_bucketed(rows.select("slot", "row", "key", splitext_ext(F.col("key")).alias("ext"), "path", "length", "modificationTime", "deleted", "content"),
                   f"{out}/landing={landing}", "slot", files, dealt=True, compression="zstd")
    numbers = [n for n in folder_numbers(spark, out, "landing") if n <= landing]
    slim = ("slot", "row", "key", "path", "modificationTime", "deleted", "landing")
    every = functools.reduce(DataFrame.unionByName, [_landing(spark, out, n).select(*slim) for n in numbers])
    newest = Window.partitionBy("slot", "key").orderBy(F.desc("landing"), F.desc("modificationTime"), F.desc("path"))
    gone = every.withColumn("_r", F.row_number().over(newest)).where((F.col("_r") > 1) | F.col("deleted"))
    bits = gone.groupBy("slot", "landing", F.bitmap_bucket_number("row").alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("row")).alias("bits"))
    bits = bits.groupBy("slot").agg(F.map_from_entries(F.collect_list(F.struct(F.struct("landing", "chunk"), "bits"))).alias("bits"))
    write_bucketed(bits, f"{out}/gone={landing}", "slot", files)


def land_objects(spark: SparkSession, uri: str, out: str, key_pattern: str | None = None,
                 glob: str | None = None, slot_bytes: int = SLOT_BYTES, landing: int = 0) -> None:
    """Copy the whole store into a landed store, as landing number `landing`.

    Every object is scanned once and dealt by slot, a hash of its key; the first
    landing fixes the number of slots, about one per `slot_bytes` of data.  Where
    several paths have one key, the most recently modified (then the greatest
    path) counts, and a later landing's objects count before earlier ones: the
    others' rows are marked, not compared with while bytes are moved.  A landing
    that is repeated overwrites itself; landings are numbered upwards.
    """
    listing = list_objects(spark, uri, key_pattern, glob)
    _layout(spark, out, listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0], slot_bytes)
    _write_landing(spark, out, landing, _read_others(listing).withColumn("deleted", F.lit(False)))


def landed_listing(spark: SparkSession, out: str) -> DataFrame:
    """(path, length, modificationTime, key) of the objects that count, without reading their bytes."""
    return _live(spark, out, ("path", "length", "modificationTime", "key"))


def land_changes(spark: SparkSession, out: str, listing: DataFrame, landing: int, slot_bytes: int = SLOT_BYTES) -> DataFrame:
    """S11 for what changed: makes the landed store equal to `listing` and returns the changes.

    `listing` (path, length, modificationTime, key; see `inventory_listing`) is compared
    with what is landed; only new and changed objects are read, and deleted keys
    become rows without content that hide the earlier ones.
    """
    first = not _landings(spark, out)
    old = listing.limit(0) if first else landed_listing(spark, out)
    if first:
        _layout(spark, out, listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0], slot_bytes)
    changes = _stored(inventory_changes(old, listing), "inventory-changes")
    wanted = changes.where("change != 'deleted'").select(*LISTING)
    _check_paths(wanted)
    objects = _read_others(wanted).withColumn("deleted", F.lit(False))
    tombs = changes.where("change = 'deleted'").select(*LISTING, F.lit(True).alias("deleted"))
    _write_landing(spark, out, landing, objects.unionByName(tombs, allowMissingColumns=True))
    return changes


def _marked(bits: F.Column) -> F.Column:
    """Whether a row's bit is set in its slot's bitmaps."""
    here = F.element_at(bits, F.struct(F.col("landing"), F.bitmap_bucket_number("row").alias("chunk")))
    at = F.bitmap_bit_position("row")
    byte = F.conv(F.hex(F.substring(here, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


def _live(spark: SparkSession, out: str, columns, slots: list[int] | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """Columns of the rows that count, optionally of some slots and of the keys `wanted` (slot, keys) names."""
    numbers, files = _landings(spark, out), _layout(spark, out)[1]
    gone = _bucketed(spark, f"{out}/gone={max(numbers)}", GONE, files)
    parts = []
    for i in numbers:
        rows = _landing(spark, out, i)
        bits = gone
        if slots is not None:
            rows, bits = rows.where(F.col("slot").isin(slots)), gone.where(F.col("slot").isin(slots))
        # one row per slot on the right: a hash table of one row, no sort of the objects
        rows = rows.join(bits.hint("shuffle_hash"), "slot", "left").where(~_marked(F.col("bits")))
        if wanted is not None:
            rows = rows.join(wanted.hint("shuffle_hash"), "slot").where(F.array_contains("keys", F.col("key")))
        parts.append(rows.select(*columns))
    return functools.reduce(DataFrame.unionByName, parts)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The landed objects that count: the latest per key over all landings, deleted ones left out.

    No object is exchanged or sorted: each landing meets its bitmaps by slot.
    """
    return _live(spark, path, ("key", "ext", "length", "modificationTime", "content"))


def fetch_landed(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """S9 on a landed store: (key, content) of the keys in `wanted`.

    Their slots become a filter that leaves other slots' files unread, if these are half
    the files or more; else the driver holds no slots.  What is read meets the wanted keys
    slot by slot.
    """
    n, files = _layout(spark, path)
    keys = wanted.where(F.col("key").isNotNull()).select(_slot(F.col("key"), n).alias("slot"), "key")
    keys = keys.groupBy("slot").agg(F.collect_set("key").alias("keys"))
    folder = scratch_path(spark, "fetch-keys")
    write_bucketed(keys, folder, "slot", files)
    keys = _bucketed(spark, folder, "slot int, keys array<string>", files)
    opened = keys.select(F.pmod(F.hash("slot"), F.lit(files))).distinct().count()  # as Spark numbers buckets
    slots = [r.slot for r in keys.select("slot").collect()] if 2 * opened <= files else None
    return _live(spark, path, ("key", "content"), slots, keys)
