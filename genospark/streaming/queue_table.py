"""The queue table itself as a streaming source (S1, T1).

The table is a folder of parquet files that the upload system adds to and rewrites.  The offset is the largest upload
id seen, with the number of pending rows up to it.  A micro-batch has the rows with larger ids and, of those before,
the ones that are pending: rows that came late under a smaller id, that were set back to pending, or that an earlier micro-batch
could not finish.  The handlers leave out uploads with a final status, so a row that comes
again is not decided twice.  A change in the number of pending rows alone also starts a micro-batch.

The driver reads file footers, and two columns of row groups that may have pending rows; rows are read in
tasks, one for each file that has any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

KEY, FLAG = "nume_cari", "bit_elaborato"
#: Before the first upload.
NOTHING = -(1 << 62)


@dataclass
class QueueFile(InputPartition):
    """The rows of a file with ids in (``after``, ``last``], and the pending ones up to ``after``."""
    path: str
    after: int
    last: int


def _wanted(after: int, last: int) -> pc.Expression:
    new = (pc.field(KEY) > after) & (pc.field(KEY) <= last)
    return new | ((pc.field(KEY) <= after) & (pc.field(FLAG) == 0))


def _last_id(file: ds.ParquetFileFragment) -> int:
    """The largest id of a file, from its footer where that has it."""
    last, meta = NOTHING, file.metadata
    column = meta.schema.names.index(KEY)
    for k in range(meta.num_row_groups):
        stats = meta.row_group(k).column(column).statistics
        if stats is not None and stats.has_min_max:
            last = max(last, stats.max)
        else:
            found = pc.max(file.subset(row_group_ids=[k]).to_table(columns=[KEY])[KEY]).as_py()
            last = last if found is None else max(last, found)
    return last


class QueueReader(DataSourceStreamReader):
    def __init__(self, uri: str, schema: StructType):
        self.uri = uri
        self.schema = to_arrow_schema(schema)

    def _files(self) -> list[ds.ParquetFileFragment]:
        files, path = fs.FileSystem.from_uri(self.uri)
        if files.get_file_info(path).type == fs.FileType.NotFound:
            return []
        # files that begin with _ or . are not rows
        return list(ds.dataset(path, filesystem=files, format="parquet").get_fragments())

    def initialOffset(self) -> dict:
        return {"id": NOTHING, "pending": 0}

    def latestOffset(self) -> dict:
        last, pending = NOTHING, 0
        for file in self._files():
            last = max(last, _last_id(file))
            pending += file.count_rows(filter=pc.field(FLAG) == 0)
        return {"id": last, "pending": pending}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        wanted = _wanted(start["id"], end["id"])
        return [QueueFile(file.path, start["id"], end["id"]) for file in self._files() if file.count_rows(filter=wanted)]

    def read(self, partition: QueueFile) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(self.uri)
        rows = ds.dataset(partition.path, filesystem=files, format="parquet")
        for batch in rows.to_batches(columns=self.schema.names, filter=_wanted(partition.after, partition.last)):
            if batch.num_rows:
                yield batch.cast(self.schema)


class QueueTable(DataSource):
    """Option ``path``: the table's folder as a uri."""

    @classmethod
    def name(cls) -> str:
        return "upload_queue"

    def streamReader(self, schema: StructType) -> QueueReader:
        return QueueReader(self.options["path"], schema)


def queue_table(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The queue table in folder ``table`` as a stream of its columns in ``schema``."""
    spark.dataSource.register(QueueTable)
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    uri = f"file://{uri.getPath()}" if uri.getScheme() == "file" else uri.toString()
    return spark.readStream.format("upload_queue").schema(schema).option("path", uri).load()
