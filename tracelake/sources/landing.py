"""Files below a landing folder, listed and read by the tasks: the driver holds no row of a file, however many there are.

Spark's own file sources keep the status and the split of every file in the
driver and give a task a few small files. Here the folders of each level are
listed by tasks into a table, which is dealt to the tasks that read. Hidden and
empty files are left out, as Spark does. A folder in a store that pyarrow does
not open, a path with wildcards and compressed files are left to Spark's sources.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracelake.session import Scratch

#: Rows, or bytes of the files' texts, of one Arrow batch; what a task reads in one go; files and bytes that one reading task gets.
BATCH_ROWS, BATCH_BYTES, BLOCK, TASK_FILES, TASK_BYTES = 10_000, 4 << 20, 1 << 20, 5000, 32 << 20
#: Folders that one task lists, where there are many; named files that one looks up.
TASK_FOLDERS = FILES_PER_LISTER = 100
ENTRY = "rel string, folder boolean, length long, modified long"
# Fixed by Hadoop: endings of the names of files that it decompresses; what its URIs leave unquoted.
PACKED = r"\.(bz2|deflate|gz|lz4|passthrough|snappy|xz|zst|zstd)$"
PLAIN = string.ascii_letters + string.digits + "_-!.~'()*,;:$&+=/@"
ODD = re.compile(f"[^{re.escape(PLAIN)}]")


class Folder:
    """A folder of a store that tasks open: its path as Hadoop and as Spark's metadata write it, and as pyarrow takes it."""

    def __init__(self, path: str, uri: str):
        self.path, self.uri = path.removesuffix("/"), uri.removesuffix("/")
        self.local = path.startswith("file:")

    def in_uri(self, rel: str) -> str:
        """A file's path as _metadata.file_path has it; letters of other scripts stay unquoted."""
        return self.uri + ODD.sub(lambda c: c[0] if ord(c[0]) > 127 and c[0].isprintable() else quote(c[0], safe=""), rel)

    def files(self) -> tuple[pyarrow.fs.FileSystem, str]:
        if self.local:
            return pyarrow.fs.LocalFileSystem(), re.sub("^file:(//)?", "", self.path)
        return pyarrow.fs.FileSystem.from_uri(self.uri)


def find(spark: SparkSession, path: str) -> Folder | None:
    """None if there is no such folder, or if it is to be read by Spark's own sources."""
    if re.search(r"[\[\]{}*?\\]", path):
        return None
    jvm = spark.sparkContext._jvm
    plain = jvm.org.apache.hadoop.fs.Path(path)
    store = plain.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(plain) or not store.getFileStatus(plain).isDirectory():
        return None
    whole = store.makeQualified(plain)
    child = jvm.org.apache.hadoop.fs.Path(whole, "x")  # a file's URI has another form than a folder's
    folder = Folder(child.toString().removesuffix("x"), child.toUri().toString().removesuffix("x"))
    try:
        folder.files()
    except (pa.ArrowException, OSError):
        return None
    return folder


def _hidden(name: str) -> bool:
    """Spark's rule for the names of files and folders that it leaves out."""
    if name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(folder: Folder, rel: str) -> Iterator[tuple[str, bool, int, int]]:
    """Name, whether it is a folder, length and time in milliseconds of what lies in a folder; what has gone meanwhile is left out."""
    store, root = folder.files()
    if not folder.local:
        for x in store.get_file_info(pyarrow.fs.FileSelector(root + rel, allow_not_found=True)):
            yield x.base_name, x.type == pyarrow.fs.FileType.Directory, x.size or 0, (x.mtime_ns or 0) // 1_000_000
        return
    try:
        with os.scandir(root + rel or "/") as inside:
            for x in inside:
                try:
                    x.name.encode()
                    status = x.stat()
                    yield x.name, x.is_dir(), status.st_size, status.st_mtime_ns // 1_000_000
                except (FileNotFoundError, UnicodeEncodeError):
                    continue
    except FileNotFoundError:
        return


def _batches(rows: Iterable[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most BATCH_ROWS and about BATCH_BYTES; weight(row) says how many bytes a row has."""
    held, size = [], 0
    for row in rows:
        more = weight(row)
        if held and (len(held) == BATCH_ROWS or size + more > BATCH_BYTES):
            yield _batch(held, schema)
            held, size = [], 0
        held.append(row)
        size += more
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _lister(folder: Folder, wanted: str):
    schema = pa.schema([("rel", pa.string()), ("folder", pa.bool_()), ("length", pa.int64()), ("modified", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = re.compile(wanted, re.DOTALL)

        def rows():
            for batch in batches:
                for rel in batch.column("rel").to_pylist():
                    for name, below, length, modified in _entries(folder, rel):
                        if not _hidden(name) and (below or length and named.fullmatch(name)):
                            yield f"{rel}/{name}", below, length, modified

        yield from _batches(rows(), schema, lambda row: len(row[0]))

    return run


def listing(spark: SparkSession, folder: Folder, pattern: str) -> DataFrame | None:
    """rel (path below the folder), length, modified (milliseconds) of its files; None if Spark has to decompress some. Bodies are not read."""
    wanted = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
    scratch, number = Scratch(spark), 0
    folders, n = spark.createDataFrame([("",)], "rel string"), 1
    many = max(spark.sparkContext.defaultParallelism, 1)
    while n:
        tasks = max(min(n, many), -(-n // TASK_FOLDERS))
        found = scratch.write(f"listing/level={number}", folders.repartition(tasks).mapInArrow(_lister(folder, wanted), ENTRY))
        folders = found.filter("folder").select("rel")
        n, number = folders.count(), number + 1
    rows = spark.read.schema(f"{ENTRY}, level int").parquet(f"{scratch.folder}/listing").filter("not folder").select("rel", "length", "modified")
    if not pattern.endswith(".md") and not rows.filter(F.col("rel").rlike(PACKED)).isEmpty():
        return None
    return rows


def dealt(rows: DataFrame, size: str = "length") -> DataFrame:
    """The rows spread over tasks, so many that each gets a bounded part of the files and, on average, of their bytes."""
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows.repartition(max(min(n, rows.sparkSession.sparkContext.defaultParallelism), -(-n // TASK_FILES), -(-size // TASK_BYTES), 1))


def whole(folder: Folder, rows: DataFrame, plain: bool = False, missing: bool = False) -> DataFrame:
    """path, modified, content (binary) of the listed files.

    plain: the path is as the binaryFile source writes it, else as in _metadata.
    missing: files that have gone meanwhile are left out.
    """
    schema = pa.schema([("path", pa.string()), ("modified", pa.int64()), ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = folder.files()

        def read():
            for batch in batches:
                for rel, modified in zip(*(batch.column(c).to_pylist() for c in ("rel", "modified"))):
                    try:
                        with store.open_input_file(root + rel) as file:
                            content = file.readall()
                    except FileNotFoundError:
                        if missing:
                            continue
                        raise
                    yield folder.path + rel if plain else folder.in_uri(rel), modified, content

        yield from _batches(read(), schema, lambda row: len(row[2]))

    return dealt(rows).select("rel", "modified").mapInArrow(run, "path string, modified long, content binary")


def named(spark: SparkSession, paths: list[str]) -> tuple[Folder, DataFrame] | None:
    """The store of these files, and rel, length, modified of those that are there; None if Spark's own sources are to read them."""
    roots = {m and m[1] for m in (re.match(r"(file:(?=/[^/])|[a-z][\w+.-]*://[^/]+(?=/))", p) for p in paths)}
    if len(roots) != 1 or None in roots or any(re.search(PACKED, p) for p in paths):
        return None
    folder = Folder(*roots, *roots)
    try:
        folder.files()
    except (pa.ArrowException, OSError):
        return None
    schema = pa.schema([("rel", pa.string()), ("length", pa.int64()), ("modified", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = folder.files()
        for batch in batches:
            rels = batch.column("rel").to_pylist()
            there = [(rel, x.size, x.mtime_ns // 1_000_000) for rel, x in zip(rels, store.get_file_info([root + r for r in rels])) if x.is_file and x.size]
            yield from _batches(there, schema, lambda row: len(row[0]))

    rels = [(p.removeprefix(folder.path),) for p in dict.fromkeys(paths) if not _hidden(p.rpartition("/")[2])]
    listed = spark.createDataFrame(rels, "rel string").coalesce(max(1, -(-len(rels) // FILES_PER_LISTER)))
    return folder, Scratch(spark).write("named", listed.mapInArrow(run, "rel string, length long, modified long"))


def _lines(file, start: int, stop: int) -> Iterator[bytes]:
    """The lines, without their ends, that begin in a range; a byte order mark at the start is left out, as Spark does."""
    begun = max(start - 1, 0)
    file.seek(begun)
    skip, pending = start > 0, []
    while block := file.read(BLOCK):
        head, *more = block.split(b"\n")
        pending.append(head)
        for after in more:
            line = b"".join(pending)
            if not skip:
                yield line if begun else line.removeprefix(b"\xef\xbb\xbf")
            skip, pending = False, [after]
            begun += len(line) + 1
            if begun >= stop:
                return
    if (line := b"".join(pending)) and not skip:
        yield line if begun else line.removeprefix(b"\xef\xbb\xbf")


def lines(folder: Folder, rows: DataFrame, width: int) -> DataFrame:
    """path, range (where it begins), size, value, at: the lines of the listed files by ranges of `width` bytes; at orders those of a range."""
    schema = pa.schema([("path", pa.string()), ("range", pa.int64()), ("size", pa.int64()), ("value", pa.binary()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = folder.files()

        def read():
            for batch in batches:
                for rel, size, start in zip(*(batch.column(c).to_pylist() for c in ("rel", "length", "start"))):
                    named = folder.in_uri(rel)
                    with store.open_input_file(root + rel) as file:
                        for at, line in enumerate(_lines(file, start, min(start + width, size))):
                            yield named, start, size, line, at

        yield from _batches(read(), schema, lambda row: len(row[3]) + len(row[0]))

    ranges = rows.select("rel", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(width).cast("long"))).alias("start"))
    part = dealt(ranges.withColumn("part", F.least(F.lit(width).cast("long"), F.col("length") - F.col("start"))), "part")
    return part.mapInArrow(run, "path string, range long, size long, value binary, at long")


def path(folder: Folder, rel: str = "rel"):
    """The path as Spark's binaryFile source writes it."""
    return F.concat(F.lit(folder.path), F.col(rel))
