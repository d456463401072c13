"""Recursive repository reader.

Hidden, underscore and empty files are part of a repository, and the built-in
file sources skip them, so folders are listed here, in rounds of tasks. Listing gives
paths and sizes only; contents are read after a shuffle of the paths, so one
folder that holds most of the files does not end in one task.
"""

from __future__ import annotations

import os
from functools import reduce

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuscope.functions.text import extension
from corpuscope.session import materialize

FILES_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("ext", T.StringType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("content", T.StringType()),
        T.StructField("status", T.StringType()),  # ok | io | unexpected
        T.StructField("error", T.StringType()),
    ]
)
_FLUSH_BYTES = 16 << 20
_PARTITION_BYTES = 128 << 20
#: Entries below a folder that a task lists: in the first round, and at most.
_FIRST_ENTRIES, _MOST_ENTRIES = 64, 32_768
_FOLDERS_PER_TASK = 64
_ROWS = 10_000


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        return pafs.FileSystem.from_uri(root)
    return pafs.LocalFileSystem(), os.path.abspath(root)


def _children(filesystem: pafs.FileSystem, folder: str):
    """Files and sub-folders directly in ``folder``."""
    if isinstance(filesystem, pafs.LocalFileSystem):
        return _local_children(folder)
    files, folders = [], []
    for info in filesystem.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
        if info.type == pafs.FileType.File:
            files.append((info.path, info.size))
        elif info.type == pafs.FileType.Directory:
            folders.append(info.path)
    return files, folders


def _local_children(folder: str):
    """Linked folders are not entered; a link that leads nowhere counts as a file, so that
    reading it tells. Folders that cannot be opened are left out."""
    files, folders = [], []
    try:
        with os.scandir(folder) as entries:
            for entry in entries:
                if entry.is_dir(follow_symlinks=False):
                    folders.append(entry.path)
                elif entry.is_file():
                    files.append((entry.path, entry.stat().st_size))
                elif entry.is_symlink() and not os.path.exists(entry.path):
                    files.append((entry.path, 0))
    except OSError:
        pass
    return files, folders


def _walked(filesystem: pafs.FileSystem, folder: str, most: int):
    """(path, bytes, open) below a folder; after ``most`` entries the folders not looked into
    yet are given as open."""
    stack, seen = [folder], 0
    while stack:
        if seen >= most:
            yield from ((f, 0, True) for f in stack)
            return
        files, below = _children(filesystem, stack.pop())
        yield from ((path, size, False) for path, size in files)
        stack += below
        seen += 1 + len(files) + len(below)


def list_repository(spark: SparkSession, root: str, suffixes: tuple[str, ...]) -> DataFrame:
    """``path, n_bytes`` of every file whose name ends with one of ``suffixes``.

    Folders are listed in rounds: each takes the open folders as rows, dealt out anew, and a
    task walks below a folder only for so many entries, few in the first rounds. What is
    still open goes into the next round, so neither a deep nor a broad tree is one task.
    """
    _, top = _open(root)
    wanted = list(suffixes)
    schema = pa.schema([("path", pa.string()), ("n_bytes", pa.int64()), ("open", pa.bool_())])

    def lister(most: int):
        def run(batches):
            filesystem, _ = _open(root)
            rows: list[tuple] = []
            for batch in batches:
                for folder in batch.column(0).to_pylist():
                    for row in _walked(filesystem, folder, most):
                        if row[2] or row[0].rpartition("/")[2].endswith(tuple(wanted)):
                            rows.append(row)
                        if len(rows) >= _ROWS:
                            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), schema=schema)
                            rows = []
            if rows:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), schema=schema)

        return run

    cores = spark.sparkContext.defaultParallelism
    frontier = spark.createDataFrame([(top,)], "path string")
    found, most, tasks = [], _FIRST_ENTRIES, 1
    while True:
        # Each round is written, so that a lost executor does not list what is known again.
        listed = materialize(
            frontier.repartition(tasks, "path").mapInArrow(
                lister(most), "path string, n_bytes long, open boolean"
            )
        )
        found.append(listed.where("not open").select("path", "n_bytes"))
        frontier = listed.where("open").select("path")
        folders = frontier.count()
        if not folders:
            return reduce(DataFrame.union, found)
        most = min(8 * most, _MOST_ENTRIES)
        tasks = max(cores, -(-folders // _FOLDERS_PER_TASK))


def _decode(data: bytes):
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError as problem:
        return None, "unexpected", str(problem)
    return text.replace("\r\n", "\n").replace("\r", "\n"), "ok", None


def read_contents(listing: DataFrame, root: str, partitions: int | None = None) -> DataFrame:
    """Contents of the listed files. A file that cannot be read becomes a row
    with its problem instead of failing the job."""
    cores = listing.sparkSession.sparkContext.defaultParallelism
    if partitions is None:
        listing = materialize(listing)
        size = listing.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
        partitions = max(cores, -(-size // _PARTITION_BYTES))
    listing = listing.select("path", extension(F.col("path")).alias("ext"), "n_bytes")
    names = [f.name for f in FILES_SCHEMA.fields]
    arrow = pa.schema(
        [(f, pa.int64() if f == "n_bytes" else pa.string()) for f in names]
    )

    def run(batches):
        filesystem, _ = _open(root)
        rows, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    with filesystem.open_input_stream(row["path"]) as stream:
                        row["content"], row["status"], row["error"] = _decode(stream.read())
                except OSError as problem:
                    row["content"], row["status"], row["error"] = None, "io", str(problem)
                rows.append(row)
                held += row["n_bytes"] or 0
                if held >= _FLUSH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    # An explicit number: the shuffled paths are tiny, adaptive coalescing
    # would put all of them, and so all contents, into one task.
    return listing.repartition(partitions, "path").mapInArrow(run, FILES_SCHEMA)


def read_repository(
    spark: SparkSession,
    root: str,
    suffixes: tuple[str, ...],
    partitions: int | None = None,
) -> DataFrame:
    return read_contents(list_repository(spark, root, suffixes), root, partitions)
