"""Text files under their own names: one file with one header for each value of the name column.

``write_named_files`` shuffles the rows by name, so one task has all lines of a file and streams them in
order; a file is as large as its rows and never held in memory.  A task writes under ``_unfinished`` in
the target folder, and the commit on the driver moves what the successful attempts wrote to its
name.  So a file is whole or not there, a repeated task adds nothing, and writing a name again replaces its file.  If the
driver is lost between two moves, the files moved so far are whole and another run writes the rest.

Every executor must reach the folder by a path or a uri that pyarrow's file systems know.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType


@dataclass
class Written(WriterCommitMessage):
    """The files of one task: (where they are now, their names)."""
    files: list[tuple[str, str]]


def file_name(name: str | None) -> str:
    """The name in a folder: as it is, but ``/``, ``%`` and control characters percent-encoded, and so a leading
    ``.`` or ``_``, which mark hidden files; ``null`` is ``%00``."""
    if not name:
        return "%00" if name is None else "%"
    safe = "".join(c if c >= " " and c not in "/%\x7f" else quote(c, safe="") for c in name)
    return f"%{ord(safe[0]):02X}{safe[1:]}" if safe[0] in "._" else safe


class _Lines:
    """A csv target over a binary stream."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, text: str) -> None:
        self.stream.write(text.encode("utf-8"))


class NamedFilesWriter(DataSourceWriter):
    """Rows sorted by their first column, the file name; the others are text."""

    def __init__(self, uri: str, sep: str, columns: list[str]):
        self.uri, self.sep, self.columns = uri, sep, columns
        self.unfinished = f"_unfinished/{uuid.uuid4().hex}"

    def _target(self) -> tuple[fs.FileSystem, str]:
        files, path = fs.FileSystem.from_uri(self.uri)
        return files, path.rstrip("/")

    def write(self, iterator: Iterator[Row]) -> Written:
        files, base = self._target()
        folder = f"{base}/{self.unfinished}/{uuid.uuid4().hex}"
        done: list[tuple[str, str]] = []
        name, stream, lines = None, None, None
        for row in iterator:
            if stream is None or row[0] != name:
                if stream is not None:
                    stream.close()
                else:
                    files.create_dir(folder, recursive=True)
                name = row[0]
                done.append((f"{folder}/{len(done)}", f"{base}/{file_name(name)}"))
                stream = files.open_output_stream(done[-1][0], buffer_size=1 << 20)
                lines = csv.writer(_Lines(stream), delimiter=self.sep, lineterminator="\n")
                lines.writerow(self.columns)
            lines.writerow(row[1:])
        if stream is not None:
            stream.close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        files, base = self._target()
        for message in messages:
            for now, name in message.files if message else ():
                files.move(now, name)
        self._clear(files, base)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*self._target())

    def _clear(self, files: fs.FileSystem, base: str) -> None:
        """Delete what this job's attempts left in its own folder of unfinished files."""
        if files.get_file_info(f"{base}/{self.unfinished}").type == fs.FileType.Directory:
            files.delete_dir(f"{base}/{self.unfinished}")


class NamedFiles(DataSource):
    """Options: ``path`` (a uri) and ``sep``."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], self.options.get("sep", ";"), schema.names[1:])


def write_named_files(rows: DataFrame, out_dir: str, name_col: str, order: list[str], sep: str = ";") -> None:
    """A file for each name in ``name_col`` with a header and the other columns, its lines by ``order``."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    path = spark._jvm.org.apache.hadoop.fs.Path(out_dir)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    uri = f"file://{uri.getPath()}" if uri.getScheme() == "file" else uri.toString()
    text = [F.col(c).cast("string").alias(c) for c in rows.columns if c != name_col]
    (rows.repartition(name_col).sortWithinPartitions(name_col, *order).select(F.col(name_col).cast("string"), *text)
     .write.format("named_files").option("path", uri).option("sep", sep).mode("append").save())
