"""Object listings and file contents.

Spark's file sources leave out names that start with ``_`` or ``.``; a bucket
lists them like any other. So folders are listed by tasks, round by round: each
round lists the folders that the last one found, and the driver lists none.
Contents are read by tasks as well, from a listing whose sizes are known.
"""

import math
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.operators.routing import select_objects
from labelmill.session import stored

# Tasks of a listing round at most, and bytes of contents that a task reads.
LISTING_TASKS = 1000
TASK_BYTES = 128 * 1024 * 1024
# Bytes of contents, and entries of a listing, handed on at a time.
BATCH_BYTES, BATCH_ENTRIES = 32 * 1024 * 1024, 10_000

_LISTED = "uri string, length long, modificationTime timestamp, folder boolean"
_CONTENTS = "uri string, length long, modificationTime timestamp, content binary"

# What opens a URI: gives a pyarrow file system and the path in it.
Opener = Callable[[str], tuple]


def _open_uri() -> Opener:
    # Made inside a function, it travels to the workers as code: they need not
    # have this package installed.
    def open_uri(uri: str):
        from pyarrow import fs

        scheme, colon, rest = uri.partition(":")
        if not colon or scheme == "file" or "/" in scheme:
            path = rest if colon and scheme == "file" else uri
            return fs.LocalFileSystem(), "/" + path.lstrip("/")
        authority, _, key = rest.removeprefix("//").partition("/")
        found, root = fs.FileSystem.from_uri(f"{scheme}://{authority}")
        return found, f"{root.rstrip('/')}/{key}"

    return open_uri


open_uri = _open_uri()


def below_prefix(path: str) -> str:
    """The path of all objects that begin with ``path``, for ``list_objects``.

    What follows the first ``*`` is ignored. A path that ends in a slash is a
    folder; any other also matches longer names.
    """
    base = path.split("*", 1)[0]
    return base if base.endswith("/") else base + "*"


def full_uri(path: str) -> str:
    """A path with its scheme; one without is local. Local URIs have one slash."""
    if "://" in path and not path.startswith("file:"):
        return path
    return "file:/" + path.removeprefix("file:").lstrip("/")


def list_objects(spark: SparkSession, path: str, opener: Opener = open_uri) -> DataFrame:
    """``(uri, length, modificationTime)`` of every file below a path, whatever its name.

    A path that ends in ``*`` stands for all that begins with what is before it;
    any other is a folder or one file. A path without files gives no rows. Each
    round of folders is stored, so a listing is made once. ``opener`` brings
    another file system.
    """
    path = full_uri(path)
    folder, start = path, None
    if path.endswith("*"):
        folder, _, start = path[:-1].rpartition("/")
        folder += "/"

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        rows = []

        def batch() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*rows)]
            kinds = [pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.bool_()]
            names = ["uri", "length", "modificationTime", "folder"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for given in batches:
            for uri, begins in zip(given["uri"].to_pylist(), given["begins"].to_pylist()):
                system, place = opener(uri)
                if begins is None and not uri.endswith("/"):
                    (own,) = system.get_file_info([place])
                    if own.type == fs.FileType.File:
                        rows.append((uri, own.size, (own.mtime_ns or 0) // 1000, False))
                        continue
                selector = fs.FileSelector(place, allow_not_found=True)
                for entry in system.get_file_info(selector):
                    name = entry.base_name
                    if not name.startswith(begins or ""):
                        continue
                    is_folder = entry.type == fs.FileType.Directory
                    child = f"{uri.rstrip('/')}/{name}" + ("/" if is_folder else "")
                    time = None if entry.mtime_ns is None else entry.mtime_ns // 1000
                    rows.append((child, None if is_folder else entry.size, time, is_folder))
                    if len(rows) >= BATCH_ENTRIES:
                        yield batch()
                        rows = []
        if rows:
            yield batch()

    todo, rounds = spark.createDataFrame([(folder, start)], "uri string, begins string"), []
    while True:
        level = stored(todo.mapInArrow(listed, _LISTED), "listing")
        rounds.append(level.filter("not folder").drop("folder"))
        folders = level.filter("folder").select("uri", F.lit(None).cast("string").alias("begins"))
        count = folders.count()
        if not count:
            return reduce(DataFrame.unionByName, rounds)
        todo = folders.repartition(min(count, LISTING_TASKS))


def list_files(spark: SparkSession, path: str, suffix: str = "", opener: Opener = open_uri) -> DataFrame:
    """``(uri, length, modificationTime, file_name, mime_type)`` below a path."""
    return select_objects(list_objects(spark, path, opener), suffix=suffix)


def read_contents(listing: DataFrame, opener: Opener = open_uri) -> DataFrame:
    """``(uri, length, modificationTime, content)`` of listed files, which are read here.

    Files are dealt to tasks by number, about ``TASK_BYTES`` each; take those
    that are too large out of the listing first. A file that is gone or cannot
    be read has a null content.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.binary()]
            names = ["uri", "length", "modificationTime", "content"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

        for given in batches:
            for uri, length, time in zip(*(given[c].to_pylist() for c in ("uri", "length", "modificationTime"))):
                try:
                    system, place = opener(uri)
                    with system.open_input_stream(place) as stream:
                        content = stream.read()
                except OSError:
                    content = None
                rows.append((uri, length, time, content))
                held += len(content or b"")
                if held >= BATCH_BYTES:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()

    files = listing.select("uri", "length", "modificationTime")
    total = files.agg(F.sum("length")).first()[0] or 0
    spread = max(1, math.ceil(total / TASK_BYTES), min(files.count(), files.sparkSession.sparkContext.defaultParallelism))
    return files.repartition(spread).mapInArrow(read, _CONTENTS)


def read_shards(spark: SparkSession, path: str, opener: Opener = open_uri) -> DataFrame:
    """Shard files ``(shard_uri, length, content)``, one row per JSON file.

    ``length`` comes from the listing, so sizes can be summed without opening
    a file. ``operators.shards.owned_shards`` finds the documents they belong to.
    """
    files = list_objects(spark, path, opener).filter(F.endswith("uri", F.lit(".json")))
    return read_contents(files, opener).withColumnRenamed("uri", "shard_uri").drop("modificationTime")
