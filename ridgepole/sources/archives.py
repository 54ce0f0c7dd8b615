"""ZIP archives: list, route and unpack members on the executors.

Members are addressed individually and dealt over tasks by their places, so a large
archive is unpacked by many tasks, each of which reads its directory once, streaming
through a fixed-size buffer.  No member is held whole, neither in a cell nor in a worker,
and an archive may be of any size.
"""

from __future__ import annotations

import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgepole.functions import paths, years
from ridgepole.operators.dedupe import keep_first, keep_last
from ridgepole.session import many_tasks, spread
from ridgepole.sources import files

BUFFER = 4 << 20

MEMBERS = "archive string, member string, position bigint, size bigint, readable boolean"


def _open(uri: str):
    """A seekable file on any file system Arrow knows (local, HDFS, object stores)."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def _read_directories(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import ArrowInvalid  # raised when a file is too short to seek to its directory

    for batch in batches:
        for uri in batch["path"]:
            system, where = _open(uri)
            try:
                with system.open_input_file(where) as handle, zipfile.ZipFile(handle) as archive:
                    rows = [
                        (uri, m.filename, i, m.file_size, True)
                        for i, m in enumerate(archive.infolist())
                        if not m.is_dir()
                    ]
            except (zipfile.BadZipFile, ArrowInvalid):
                rows = [(uri, None, None, None, False)]
            yield pd.DataFrame(rows, columns=["archive", "member", "position", "size", "readable"])


def list_members(spark: SparkSession, folder: str) -> DataFrame:
    """Every member of every ZIP directly in a folder; broken archives are marked.

    Only the archives' own directories are read.
    """
    archives = files.list_files(spark, folder, recursive=False).where(paths.extension(F.col("path")) == ".zip")
    return members_of(archives)


def members_of(archives: DataFrame) -> DataFrame:
    return spread(archives.select("path"), F.col("path")).mapInPandas(_read_directories, MEMBERS)


def members_containing(members: DataFrame, texts: Sequence[str] | None) -> DataFrame:
    """Members whose names hold one of ``texts``, as written; all of them without any."""
    named = members.where(F.col("member").isNotNull())
    return named if not texts else named.where(reduce(lambda a, b: a | b, [F.col("member").contains(t) for t in texts]))


def route(member: Column) -> Column:
    """Dictionaries and raw records by suffix; anything else is not wanted."""
    kind = paths.extension(member)
    return F.when(kind == ".pdf", F.lit("dictionary")).when(kind == ".txt", F.lit("raw"))


def member_year(archive: Column, member: Column) -> Column:
    """Year in the archive's name, else in the member's, else ``unknown``."""
    year = F.coalesce(years.year_in_name(paths.base_name(archive)), years.year_in_name(member))
    return F.coalesce(year.cast("string"), F.lit("unknown"))


def routed_members(members: DataFrame, last: bool = False) -> DataFrame:
    """Wanted members with route, year and target file name, one per target.

    Two members that flatten to the same target: the first is kept, or with ``last`` the
    last one, as copying one over the other would.
    """
    wanted = members.where(F.col("member").isNotNull()).select(
        "*",
        route(F.col("member")).alias("route"),
        member_year(F.col("archive"), F.col("member")).alias("year"),
        paths.base_name(F.col("member")).alias("base_name"),
    ).where(F.col("route").isNotNull())
    pick = keep_last if last else keep_first
    return pick(wanted, ["route", "year", "base_name"], ["archive", "position"])


def bronze_members(members: DataFrame, allowed: tuple[str, ...] | None = (".csv",)) -> DataFrame:
    """Members with an allowed suffix, one per base name: the last one wins."""
    wanted = members.where(F.col("member").isNotNull())
    if allowed:
        wanted = wanted.where(paths.extension(F.col("member")).isin(*[a.lower() for a in allowed]))
    named = wanted.withColumn("base_name", paths.base_name(F.col("member")))
    return keep_last(named, ["base_name"], ["archive", "position"])


# what reading a damaged, truncated, encrypted or unknown form of member raises
_BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError, IndexError)


def _copy(source, target_uri: str) -> int:
    """Stream to a temporary name, then move: a lost or repeated task leaves no half file."""
    system, where = _open(target_uri)
    system.create_dir(where.rsplit("/", 1)[0], recursive=True)
    part = f"{where}.{uuid.uuid4().hex}.part"
    copied = 0
    try:
        with system.open_output_stream(part) as out:
            while chunk := source.read(BUFFER):
                out.write(chunk)
                copied += len(chunk)
    except _BROKEN:
        system.delete_file(part)
        raise
    system.move(part, where)
    return copied


def _by_place(members: DataFrame) -> DataFrame:
    """Deal members over tasks as they lie: a task has a run of one archive or of a few.

    A directory is as long as its archive has members, so reading it for each member
    would take time with the square of their number.
    """
    tasks = many_tasks(members.sparkSession)
    return members.repartitionByRange(tasks, "archive", "position").sortWithinPartitions("archive", "position")


class _LastOpened:
    """The archive that was asked for last, which stays open."""

    def __init__(self) -> None:
        self._uri, self._archive, self._open = None, None, ExitStack()

    def __enter__(self) -> _LastOpened:
        return self

    def __exit__(self, *error) -> None:
        self._open.close()

    def member(self, uri: str, position: int):
        """By place, as two members may have one name."""
        if uri != self._uri:
            self._open.close()
            self._uri = None
            system, where = _open(uri)
            self._archive = self._open.enter_context(zipfile.ZipFile(self._open.enter_context(system.open_input_file(where))))
            self._uri = uri
        return self._archive.open(self._archive.infolist()[int(position)])


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    with _LastOpened() as opened:
        for batch in batches:
            done = []
            for uri, member, position, target in zip(batch["archive"], batch["member"], batch["position"], batch["target"]):
                copied, status, detail = None, "copied", None
                if member is None:
                    system, where = _open(uri)
                    with system.open_input_file(where) as source:
                        copied = _copy(source, target)
                else:
                    try:
                        with opened.member(uri, position) as source:
                            copied = _copy(source, target)
                    except _BROKEN as error:
                        status, detail = "failed", f"{type(error).__name__}: {error}"
                done.append((uri, member, target, copied, status, detail))
            out = pd.DataFrame(done, columns=["archive", "member", "target", "bytes", "status", "detail"])
            yield out.astype({"bytes": "Int64"})


REPORT = "archive string, member string, target string, bytes bigint, status string, detail string"


def unpack(members: DataFrame) -> DataFrame:
    """Copy each ``(archive, member, position)`` to ``target``; a null member copies the file itself.

    One row for each: ``copied`` with its bytes, or ``failed`` with the reason; a damaged
    member does not stop the others.  Lazy: run an action on the result to do the work.
    """
    position = F.col("position") if "position" in members.columns else F.lit(None).cast("bigint").alias("position")
    return _by_place(members.select("archive", "member", position, "target")).mapInPandas(_unpack, REPORT)


def unreadable(members: DataFrame) -> DataFrame:
    """Report rows of the archives whose directory cannot be read."""
    return members.where("not readable").select(
        "archive", F.lit(None).cast("string").alias("member"), F.lit(None).cast("string").alias("target"), F.lit(None).cast("bigint").alias("bytes"),
        F.lit("unreadable").alias("status"), F.lit("not a readable ZIP archive").alias("detail"),
    )


LINES = "archive string, member string, line_no bigint, value string"


def _lines_of(encoding: str, rows: int):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        with _LastOpened() as opened:
            for batch in batches:
                for uri, member, position in zip(batch["archive"], batch["member"], batch["position"]):
                    with io.TextIOWrapper(opened.member(uri, position), encoding=encoding, newline=None) as text:
                        numbers, values = [], []
                        for number, line in enumerate(text):
                            numbers.append(number)
                            values.append(line.rstrip("\n"))
                            if len(values) == rows:
                                yield pd.DataFrame({"archive": uri, "member": member, "line_no": numbers, "value": values})
                                numbers, values = [], []
                        if values:
                            yield pd.DataFrame({"archive": uri, "member": member, "line_no": numbers, "value": values})

    return read


def member_lines(members: DataFrame, encoding: str = "latin-1", rows_per_batch: int = 20_000) -> DataFrame:
    """Lines of text members without unpacking them first, in bounded batches.

    For repeated use, ``unpack`` once and read the files: those can be split.
    """
    return _by_place(members.select("archive", "member", "position")).mapInPandas(_lines_of(encoding, rows_per_batch), LINES)
