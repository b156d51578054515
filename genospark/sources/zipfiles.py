"""Zipped upload files -> one row per text line.

``binaryFile`` lists the archives without reading them; the wanted ones are
found by a join on the file name, and each task opens its archives from the
file system and streams the member, so neither the list of paths nor an
archive has to fit anywhere.  An archive is not splittable: parallelism is
over files.  Archives with more or fewer than one member, damaged,
encrypted or unsupported archives and non-UTF-8 text become a status instead
of an exception.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genospark.schemas import LINES_SCHEMA

LINES_PER_BATCH = 50_000
#: What opening or reading a bad archive raises: damage, password, unknown method, not UTF-8, cut off.
BAD_ARCHIVE = (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, UnicodeDecodeError, EOFError,
               OSError, ValueError)


def list_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """(path, file_name, length) of the archives under ``root`` (content not read)."""
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", glob).load(root))
    except AnalysisException:  # folder missing or holding no archive yet
        return spark.createDataFrame([], "path string, file_name string, length long")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")


def _empty(path: str, n: int, status: str) -> pd.DataFrame:
    return pd.DataFrame({"path": [path], "n_members": [n], "status": [status],
                         "line_no": pd.array([None], dtype="Int64"), "line": [None]})


class _Stream(io.RawIOBase):
    """A file of any file system; a seek before its start is an OSError, as ``zipfile`` expects."""

    def __init__(self, path: str):
        system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
        self.file = system.open_input_file(name)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            self.file.seek(offset, whence)
        except ValueError as e:
            raise OSError(str(e)) from e
        return self.file.tell()

    def close(self) -> None:
        self.file.close()
        super().close()


def _open(path: str) -> io.BufferedReader:
    """The archive as a seekable stream."""
    return io.BufferedReader(_Stream(path), 1 << 20)


def _explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path in pdf["path"]:
            n = 0
            try:
                with _open(path) as stream, zipfile.ZipFile(stream) as zf:
                    n = len(zf.namelist())
                    if n == 1:
                        yield from _member(path, zf)
                    else:
                        yield _empty(path, n, "members")
            except BAD_ARCHIVE:
                yield _empty(path, n, "corrupt")  # wins over the lines read before (archive_status)


def _member(path: str, zf: zipfile.ZipFile) -> Iterator[pd.DataFrame]:
    with zf.open(zf.namelist()[0]) as raw:
        buf, start = [], 0
        for line in io.TextIOWrapper(raw, encoding="utf-8"):
            buf.append(line.rstrip("\n"))
            if len(buf) >= LINES_PER_BATCH:
                yield _lines(path, start, buf)
                start += len(buf)
                buf = []
        if buf or start == 0:
            yield _lines(path, start, buf)


def _lines(path: str, start: int, lines: list[str]) -> pd.DataFrame:
    n = len(lines)
    return pd.DataFrame({"path": [path] * n, "n_members": [1] * n, "status": ["ok"] * n,
                         "line_no": pd.array(range(start, start + n), dtype="Int64"), "line": lines})


def first_of_name(files: DataFrame) -> DataFrame:
    """One archive for each name: where folders hold several, the first by path."""
    return files.groupBy("file_name").agg(F.min("path").alias("path"))


def zip_lines(spark: SparkSession, root: str, glob: str = "*.zip", names: DataFrame | None = None) -> DataFrame:
    """(path, file_name, n_members, status, line_no, line) for the archives under ``root``.

    An archive with one member yields its lines (status ok, line_no from 0);
    any other archive yields a row with a null line.  A damaged archive may
    yield lines before that row: ``archive_status`` and ``good_lines`` drop them.
    With ``names`` (a ``file_name`` column, e.g. the pending uploads) only the
    matching archives are opened, one for each name (``first_of_name``).
    """
    files = list_archives(spark, root, glob)
    if names is not None:
        files = first_of_name(files.join(names.select("file_name").distinct(), "file_name", "left_semi"))
    # one archive per task where there are enough tasks: they are of unlike size
    spread = files.select("path").repartition("path")
    return spread.mapInPandas(_explode, LINES_SCHEMA).withColumn("file_name", F.element_at(F.split("path", "/"), -1))


def archive_status(lines: DataFrame, keys: tuple[str, ...] = ("path", "file_name")) -> DataFrame:
    """One row per archive: member count, status, first line (the type check reads it).

    One corrupt row makes the archive corrupt, whatever lines came before it; then
    ``members``, then ``ok``.  Hash aggregates over numbers only; the first lines are picked
    by their line number.
    """
    def any_row(status: str):
        return F.max(F.col("status") == status)
    per = lines.groupBy(*keys).agg(
        F.max("n_members").alias("n_members"),
        F.when(any_row("corrupt"), "corrupt").when(any_row("members"), "members").otherwise("ok").alias("status"),
        F.count("line").alias("n_lines"), F.min("line_no").alias("line_no"))
    numbers = per.select(*keys, "line_no").where(F.col("line_no").isNotNull())
    first = (lines.join(numbers, [*keys, "line_no"], "left_semi")
             .groupBy(*keys).agg(F.min("line").alias("first_line")))
    return per.drop("line_no").join(first, list(keys), "left")


def good_lines(lines: DataFrame, status: DataFrame, keys: tuple[str, ...] = ("path", "file_name")) -> DataFrame:
    """The lines of the archives that are ok as a whole."""
    ok = status.where("status = 'ok'").select(*keys)
    return lines.where(F.col("status") == "ok").join(ok, list(keys), "left_semi")
