"""Centroid clustering: Lloyd's rounds with the dimensions dealt to shards.

Vectors are scaled to integers, numbered in blocks of rows and cut into blocks of
columns, one shard for each; a table keeps the column blocks apart.  In a round, a task
computes the exact partial squared distances of a column block from its shard's slice of
the centroids.  The parts of a block of rows are added by key, first where a task
has several and then behind the shuffle, and the least sum names each row's centroid.  The
assignments (a byte a vector) go back to the column blocks; each shard adds up its
own columns and updates its own slice.  Only slices (centroids x dimensions numbers)
pass through the driver; parts travel in the narrowest integers that hold them.

Everything is integer arithmetic, so results do not depend on the order of rows or tasks.

Defined cases: a vector of another length, or with a null, NaN or infinite component, is left
out; so is a null vector.  A null id counts as the largest when centroids are
drawn; rows that repeat an id are vectors of their own, and of equal hashes the smaller
components come first.  With fewer vectors than centroids every vector starts as one; without
vectors there are no rows.  A scaled component beyond 2**27, whose squares could pass a
long, raises an arithmetic error.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genospark.llm.textarrays import bounded_batches
from genospark.session import scratch_path, stored

#: Vectors of a block of rows.
BLOCK = 4096
#: Largest scaled component.
LARGEST = 1 << 27

_SIGNED = [np.dtype(t) for t in ("i1", "i2", "i4", "i8")]
_UNSIGNED = [np.dtype(t) for t in ("u1", "u2", "u4", "u8")]


def narrow(values: np.ndarray) -> tuple[bytes, int]:
    """The integers in the narrowest type that holds them, and its bytes (negative: signed)."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    for kind in _SIGNED if low < 0 else _UNSIGNED:
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind).tobytes(), -kind.itemsize if low < 0 else kind.itemsize
    raise OverflowError("integers of more than 64 bits")


def wide(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"{'i' if size < 0 else 'u'}{abs(size)}").astype(np.int64)


def scaled(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """Id and integer components of the vectors that have ``dims`` finite ones."""
    x = F.col(vector_col).cast("array<double>")
    whole = (F.size(x) == dims) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fits = F.forall(x, lambda v: F.abs(v * F.lit(scale)) < F.lit(float(LARGEST)))
    return vectors.where(F.coalesce(whole, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"),
        F.when(fits, F.transform(x, lambda v: F.floor(v * F.lit(scale))))
        .otherwise(F.raise_error(F.lit("a scaled component is beyond 2**27")).cast("array<long>")).alias("q"))


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``<seed>:<id>``, in that order."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = points.select(draw.alias("draw"), "q").orderBy(F.asc_nulls_last("draw"), "q").limit(k).collect()
    return np.asarray([r["q"] for r in rows], np.int64)


_BLOCKS = "shard int, rows long, n int, size int, values binary, ids array<long>"


def _blocks(bounds: list[tuple[int, int]]):
    """Column blocks of blocks of rows; the ids go with the first shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                ids, q = (c.slice(a, BLOCK) for c in batch.columns)
                x = q.flatten().to_numpy(zero_copy_only=False).reshape(len(q), -1)
                parts = [narrow(x[:, i:j]) for i, j in bounds]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(len(bounds), dtype=np.int32)),
                    pa.array(np.full(len(bounds), rows)), pa.array(np.full(len(bounds), len(q), np.int32)),
                    pa.array([s for _, s in parts], pa.int32()), pa.array([p for p, _ in parts], pa.binary()),
                    pa.array([ids.to_pylist()] + [None] * (len(bounds) - 1), pa.list_(pa.int64()))],
                    names=["shard", "rows", "n", "size", "values", "ids"])
                rows += 1
    return run


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` from each centroid, exactly."""
    return (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)


_PART = pa.schema([("rows", pa.int64()), ("size", pa.int32()), ("part", pa.binary())])


def _parts(slices: list[np.ndarray]):
    """Partial distances of column blocks; those of the same rows that follow each other are added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, rows, n, size, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = distances(wide(values, size).reshape(n, -1), slices[shard])
                data, size = narrow(part)
                yield pa.RecordBatch.from_pylist([{"rows": rows, "size": size, "part": data}], schema=_PART)
    return run


def added(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Sums of the parts of each block of rows; the parts of a block follow each other."""
    rows, total = None, None
    for batch in batches:
        for key, size, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = wide(data, size)
            if key == rows:
                total = total + part
            else:
                if rows is not None:
                    yield rows, total
                rows, total = key, part
    if rows is not None:
        yield rows, total


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, total in added(batches):
        data, size = narrow(total)
        yield pa.RecordBatch.from_pylist([{"rows": rows, "size": size, "part": data}], schema=_PART)


_NEAREST = "rows long, cluster_size int, cluster binary, distance_size int, distance binary"


def _nearest(k: int):
    """The centroid with the least summed distance, of equal ones the smaller number."""
    schema = pa.schema([("rows", pa.int64()), ("cluster_size", pa.int32()), ("cluster", pa.binary()),
                        ("distance_size", pa.int32()), ("distance", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, total in added(batches):
            total = total.reshape(-1, k)
            at = total.argmin(1)
            (cluster, a), (distance, b) = narrow(at), narrow(total[np.arange(len(at)), at])
            yield pa.RecordBatch.from_pylist([{"rows": rows, "cluster_size": a, "cluster": cluster,
                                               "distance_size": b, "distance": distance}], schema=schema)
    return run


def _sums(k: int):
    """Per task: for each shard and centroid the number and the sums of its vectors' columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, n, size, values, cluster_size, cluster in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, at = wide(values, size).reshape(n, -1), wide(cluster, cluster_size)
                mine = total.setdefault(shard, np.zeros((k, x.shape[1] + 1), np.int64))
                np.add.at(mine, at, np.column_stack((np.ones(n, np.int64), x)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
            names=["shard", "sums"])
    return run


def _updated(slices: list[np.ndarray]):
    """A shard's new slice: floored means, or the old centroid where none is assigned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[shard] = total.get(shard, 0) + np.frombuffer(sums, np.int64)
        new = []
        for shard, sums in total.items():
            sums = sums.reshape(len(slices[shard]), -1)
            count = sums[:, :1]
            new.append(np.where(count > 0, sums[:, 1:] // np.maximum(count, 1), slices[shard]).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(new, pa.binary())],
                                         names=["shard", "slice"])
    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, cluster_size, cluster, distance_size, distance in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(wide(cluster, cluster_size).astype(np.int32)),
                 pa.array(wide(distance, distance_size))], names=["id", "cluster", "distance"])


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


class Lloyd:
    """``rounds`` rounds over the vectors of ``dims`` finite components, each turned into floor(scale * x).

    ``centroids`` are the final ones, a row of integers each; ``assigned()`` has a row for
    each vector.  ``shards`` is the number of column blocks.
    """

    def __init__(self, vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64,
                 seed: int = 1, shards: int = 4, id_col: str = "vec_id", vector_col: str = "embedding"):
        self.spark: SparkSession = vectors.sparkSession
        bounded_batches(self.spark)
        self.id_col = id_col
        points = scaled(vectors, dims, scale, id_col, vector_col)
        cuts = np.linspace(0, dims, min(shards, dims) + 1).astype(int).tolist()
        self.bounds = list(zip(cuts, cuts[1:], strict=False))
        path = scratch_path(self.spark, "column-blocks")
        points.mapInArrow(_blocks(self.bounds), _BLOCKS).write.partitionBy("shard").parquet(path)
        self.blocks = self.spark.read.schema(_BLOCKS).parquet(path)
        start = first_centroids(points, k, seed).reshape(-1, dims)
        self.k = len(start)
        self.slices = [np.ascontiguousarray(start[:, i:j]) for i, j in self.bounds]
        for _ in range(rounds if self.k else 0):
            self._update(self._assign().select("rows", "cluster_size", "cluster"))

    @property
    def centroids(self) -> np.ndarray:
        return np.concatenate(self.slices, axis=1)

    def _assign(self) -> DataFrame:
        """Nearest centroids and distances of each block of rows."""
        part = "rows long, size int, part binary"
        parts = (self.blocks.select("shard", "rows", "n", "size", "values").mapInArrow(_parts(self.slices), part)
                 .mapInArrow(_combine, part))
        return (parts.repartition("rows").sortWithinPartitions("rows").mapInArrow(_nearest(self.k), _NEAREST))

    def _update(self, nearest: DataFrame) -> None:
        both = self.blocks.join(nearest, "rows").select("shard", "n", "size", "values", "cluster_size", "cluster")
        new = (both.mapInArrow(_sums(self.k), "shard int, sums binary").repartition("shard")
               .mapInArrow(_updated(self.slices), "shard int, slice binary"))
        for shard, data in new.collect():  # a slice for each shard
            self.slices[shard] = np.frombuffer(data, np.int64).reshape(self.slices[shard].shape)

    def assigned(self) -> DataFrame:
        """Id, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and ``inertia`` (distances summed
        over the cluster and over all) and ``centroid_sha256`` of each vector."""
        if self.k:
            ids = self.blocks.where("shard = 0").select("rows", "ids")
            found = ids.join(self._assign(), "rows").select("ids", "cluster_size", "cluster", "distance_size", "distance")
            found = stored(found.mapInArrow(_rows, "id long, cluster int, distance long"), "assigned")
        else:
            found = self.spark.createDataFrame([], "id long, cluster int, distance long")
        sums = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())  # a row for each centroid
        about = self.spark.createDataFrame(
            [(c, int(s), sum(sums.values()), centroid_digest(self.centroids[c])) for c, s in sums.items()],
            "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
        return found.join(F.broadcast(about), "cluster").select(
            F.col("id").alias(self.id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> str:
    """The same in DuckDB."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = {dims}
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {dims}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY draw NULLS LAST, q) - 1 AS c, q FROM (
  SELECT sha256('{seed}:' || vec_id) AS draw, q FROM kept ORDER BY draw NULLS LAST, q LIMIT {k}))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT n, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT n, c, list_sum(list_transform(list_zip(v.q, c{r}.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
  FROM kept v, c{r}) GROUP BY n)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m.q, c{r}.q) AS q FROM c{r} LEFT JOIN (
  SELECT c, list(((s - ((s % w) + w) % w) // w)::BIGINT ORDER BY i) AS q FROM (
    SELECT c, i, sum(x)::BIGINT AS s, count(*) AS w FROM (
      SELECT a{r}.c, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM kept JOIN a{r} USING (n)) GROUP BY c, i)
  GROUP BY c) m USING (c))""")
    return f"""WITH {', '.join(steps)}
SELECT vec_id, a.c::INTEGER AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
       sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(z.q, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} a USING (n) JOIN c{rounds} z ON z.c = a.c
"""
