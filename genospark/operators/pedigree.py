"""Contradictions, generations, inbreeding and relationship of a recorded pedigree (documented extension X8).

A pedigree has rows (child, sire, dam) of sample ids; a null parent is unknown.  Rows without a child are
not read, repeated ones count once.

The pedigree is peeled layer by layer: a sample's generation is one more than the highest of its
parents, and it is known once all of them are.  What no peeling from either end removes lies on a cycle or between
two.  Relationship is the product of ancestors' contributions (the sum over all paths to an
ancestor of 1/2 to the power of its length) with the variance that each ancestor adds.  A generation's
contributions are sent on to its children once, under the child's generation, so a round reads
what it needs and no more.  They are one packed row of a sample and are kept of parents only: most
samples of a pedigree are nobody's parent.  Bytes grow with samples x their ancestors, and there are as
many rounds as generations.  Every round is a table in the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.operators.popgen import ancestors, bounded_batches, parent_pairs
from genospark.session import scratch_path, stored


def _records(pedigree: DataFrame) -> DataFrame:
    return pedigree.select("child", "sire", "dam").where("child IS NOT NULL").distinct()


def one_record_each(pedigree: DataFrame) -> DataFrame:
    """One record of each child: of several the least by (sire, dam), unknown first."""
    least = _records(pedigree).groupBy("child").agg(F.min(F.struct("sire", "dam")).alias("r"))
    return least.select("child", "r.sire", "r.dam")


def _peel(edges: DataFrame, samples: DataFrame) -> DataFrame:
    """(sample, generation) of all samples that are not on, or below, a cycle of the distinct (child, parent) edges.

    A round counts the parents that the last layer adds to each child; those that miss more wait.
    """
    spark = edges.sparkSession
    base = scratch_path(spark, "layers")
    sizes = edges.groupBy("child").agg(F.count(F.lit(1)).alias("n_parents"))
    edges = stored(edges.join(sizes, "child"), "pedigree-edges")
    layer = samples.join(edges.select(F.col("child").alias("sample")), "sample", "left_anti")
    waiting, generation = None, 0
    while True:
        layer.write.parquet(f"{base}/generation={generation}")
        layer = spark.read.schema("sample string").parquet(f"{base}/generation={generation}")
        if layer.isEmpty():
            return spark.read.schema("sample string, generation int").parquet(base)
        known = (edges.join(layer.withColumnRenamed("sample", "parent"), "parent")
                 .groupBy("child", "n_parents").agg(F.count(F.lit(1)).alias("n_known")))
        if waiting is not None:
            known = known.unionByName(waiting).groupBy("child", "n_parents").agg(F.sum("n_known").alias("n_known"))
        known = stored(known, "pedigree-round")
        waiting = known.where("n_known < n_parents")
        layer = known.where("n_known = n_parents").select(F.col("child").alias("sample"))
        generation += 1


def _samples(pedigree: DataFrame) -> DataFrame:
    one = pedigree.select(F.explode(F.array("child", "sire", "dam")).alias("sample"))
    return one.where("sample IS NOT NULL").distinct()


def _edges(pedigree: DataFrame) -> DataFrame:
    return parent_pairs(pedigree).select("child", "parent").distinct()


def generations(pedigree: DataFrame) -> DataFrame:
    """(sample, generation): 0 without a known parent, else one more than the highest of the parents.

    Samples on a cycle, and their descendants, have none and no row.
    """
    records = stored(_records(pedigree), "pedigree")
    return _peel(_edges(records), _samples(records))


def contradictions(pedigree: DataFrame) -> DataFrame:
    """(sample, contradiction, n), one row for each.

    ``own_ancestor``: the sample is on a cycle, the shortest of ``n`` steps.  ``sire_and_dam``: it is recorded as
    sire of some children and dam of others, ``n`` in the rarer role.  ``one_parent_twice``: sire and dam are the
    same, in ``n`` records.  ``several_records``: the child has ``n`` different records.

    Cycles are searched among the samples that peeling from founders and from the youngest leaves;
    the search lists pairs of those only.
    """
    records = stored(_records(pedigree), "pedigree")
    samples, edges = stored(_samples(records), "samples"), stored(_edges(records), "edges")
    left = stored(samples.join(_peel(edges, samples), "sample", "left_anti"), "on-or-below-cycles")
    inner = (edges.join(left.withColumnRenamed("sample", "child"), "child", "left_semi")
             .join(left.withColumnRenamed("sample", "parent"), "parent", "left_semi"))
    inner = stored(inner.select("child", "parent"), "edges-left")
    from_below = _peel(inner.select(F.col("parent").alias("child"), F.col("child").alias("parent")), left)
    for end in ("child", "parent"):
        inner = inner.join(from_below.select(F.col("sample").alias(end)), end, "left_anti")
    steps = ancestors(inner.select("child", F.col("parent").alias("sire"), F.lit(None).cast("string").alias("dam")))
    found = [steps.where("sample = ancestor").select("sample", F.lit("own_ancestor").alias("contradiction"),
                                                     F.col("generation").cast("long").alias("n"))]
    roles = (parent_pairs(records).distinct().groupBy("parent").agg(
        F.count(F.when(F.col("role") == "sire", 1)).alias("s"), F.count(F.when(F.col("role") == "dam", 1)).alias("d")))
    found.append(roles.where("s > 0 AND d > 0").select("parent", F.lit("sire_and_dam"), F.least("s", "d")))
    by_child = records.groupBy("child").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("sire") == F.col("dam"), 1)).alias("t"))
    found.append(by_child.where("t > 0").select("child", F.lit("one_parent_twice"), "t"))
    found.append(by_child.where("n > 1").select("child", F.lit("several_records"), "n"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _unpacked(contributions: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of ancestors in ascending order, their weights, and the variance that each adds."""
    n = len(contributions) // 24
    return (np.frombuffer(contributions, "<i8", n), np.frombuffer(contributions, "<f8", n, 8 * n),
            np.frombuffer(contributions, "<f8", n, 16 * n))


def _packed(numbers: np.ndarray, weights: np.ndarray, variances: np.ndarray) -> bytes:
    order = np.argsort(numbers)
    return numbers[order].astype("<i8").tobytes() + weights[order].tobytes() + variances[order].tobytes()


def _inherited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inbreeding and contributions of children from rows of their parents, which lie together."""
    def child(rows: list[tuple]) -> tuple:
        sample, _, number, parent, _, _ = rows[0]
        own = np.array([number])
        variance = 1 - sum(1 + r[4] for r in rows) / 4
        sides = [_unpacked(r[5]) for r in rows]
        related = 0.0
        if len(sides) == 2:
            _, at, of = np.intersect1d(sides[0][0], sides[1][0], assume_unique=True, return_indices=True)
            related = float((sides[0][1][at] * sides[1][1][of] * sides[0][2][at]).sum())
        if not parent:
            return sample, related / 2, None
        numbers, first, which = np.unique(np.concatenate([x[0] for x in sides]), return_index=True, return_inverse=True)
        weights = np.bincount(which, np.concatenate([x[1] for x in sides]), len(numbers)) / 2
        variances = np.concatenate([x[2] for x in sides])[first]
        return sample, related / 2, _packed(np.append(numbers, own), np.append(weights, 1.0), np.append(variances, variance))

    def out(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else ((), ) * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.binary()), strict=True)],
                                          names=["sample", "inbreeding", "contributions"])
    held: list[tuple] = []
    for batch in batches:
        done = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][0] != row[0]:
                done.append(child(held))
                held = []
            held.append(row)
        yield out(done)
    if held:
        yield out([child(held)])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Relationship of two samples from the contributions of both."""
    for batch in batches:
        found = []
        for one, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            (a, u, v), (b, w, _) = _unpacked(one), _unpacked(other)
            _, at, of = np.intersect1d(a, b, assume_unique=True, return_indices=True)
            found.append(float((u[at] * w[of] * v[at]).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["p", "q", "a"])


class Coefficients:
    """``members``: (sample, generation, inbreeding).  ``contributions``: (sample, contributions) of the samples that are
    parents, ``_packed``, the sample as its own ancestor included.  ``edges``: (child, role, parent).  Samples on or below a cycle
    are in none."""

    def __init__(self, members: DataFrame, contributions: DataFrame, edges: DataFrame):
        self.members, self.contributions, self.edges = members, contributions, edges

    def relationships(self, pairs: DataFrame) -> DataFrame:
        """(sample_1, sample_2, relationship) of the distinct pairs whose samples both have a generation: the
        sum over common ancestors, 0 without any; twice the coancestry.

        A sample that is nobody's parent has with any other half the relationships that its parents have; so contributions are
        compared of parents only, once for each pair of them.
        """
        pairs = pairs.select("sample_1", "sample_2").distinct()
        for name in pairs.columns:
            pairs = pairs.join(self.members.select(F.col("sample").alias(name)), name, "left_semi")
        pairs = stored(pairs.select("sample_1", "sample_2"), "pedigree-pairs")
        parents = self.contributions.select("sample", F.col("sample").alias("p"), F.lit(1.0).alias("w"))
        stands = parents.unionByName(
            self.edges.join(parents.select(F.col("sample").alias("child")), "child", "left_anti")
            .select(F.col("child").alias("sample"), F.col("parent").alias("p"), F.lit(0.5).alias("w")))
        stands = stored(stands, "pedigree-stands")
        terms = (pairs.where("sample_1 <> sample_2")
                 .join(stands.select(F.col("sample").alias("sample_1"), F.col("p").alias("p1"), F.col("w").alias("w1")), "sample_1")
                 .join(stands.select(F.col("sample").alias("sample_2"), F.col("p").alias("p2"), F.col("w").alias("w2")), "sample_2")
                 .select("sample_1", "sample_2", F.least("p1", "p2").alias("p"), F.greatest("p1", "p2").alias("q"),
                         F.expr("w1 * w2").alias("w")))
        terms = stored(terms, "pedigree-terms")
        of = {k: self.contributions.select(F.col("sample").alias(k), F.col("contributions").alias(f"of_{k}")) for k in ("p", "q")}
        compared = (terms.where("p <> q").select("p", "q").distinct().join(of["p"], "p").join(of["q"], "q")
                    .select("p", "q", "of_p", "of_q").mapInArrow(_shared, "p string, q string, a double"))
        own = self.members.select(F.col("sample").alias("p"), F.col("sample").alias("q"), F.expr("1 + inbreeding").alias("a"))
        shared = (terms.join(compared.unionByName(own), ["p", "q"])
                  .groupBy("sample_1", "sample_2").agg(F.sum(F.expr("w * a")).alias("a")))
        same = own.select(F.col("p").alias("sample_1"), F.col("q").alias("sample_2"), "a").join(pairs, ["sample_1", "sample_2"], "left_semi")
        return pairs.join(shared.unionByName(same), ["sample_1", "sample_2"], "left").select(
            "sample_1", "sample_2", F.coalesce("a", F.lit(0.0)).alias("relationship"))


_SENT = "child string, role string, number long, is_parent boolean, inbreeding double, contributions binary"
_KEPT = "sample string, inbreeding double, contributions binary"


def coefficients(pedigree: DataFrame) -> Coefficients:
    """Inbreeding and ancestors' contributions; of several records of a child the first counts (``one_record_each``)."""
    spark = pedigree.sparkSession
    bounded_batches(spark)
    base = scratch_path(spark, "contributions")
    records = stored(one_record_each(pedigree), "pedigree")
    edges = parent_pairs(records)
    placed = _peel(_edges(records), _samples(_records(pedigree)))
    named = edges.join(placed.select(F.col("sample").alias("child")), "child", "left_semi").select(
        F.col("parent").alias("sample"), F.lit(True).alias("is_parent")).distinct()
    placed = stored(placed.join(named, "sample", "left").select(
        "sample", "generation", F.coalesce("is_parent", F.lit(False)).alias("is_parent"),
        F.monotonically_increasing_id().alias("number")), "generations")
    to = placed.select(F.col("sample").alias("child"), F.col("generation").alias("to"), "number", "is_parent")
    edges = stored(edges.join(to, "child"), "pedigree-edges")
    last = placed.agg(F.max("generation")).first()[0]
    if last is None:
        empty = spark.createDataFrame([], _KEPT + ", generation int")
        return Coefficients(empty.select("sample", "generation", "inbreeding"), empty.select("sample", "contributions"),
                            edges.select("child", "role", "parent"))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.ones(1)
        for batch in batches:
            packed = [_packed(np.array([n]), one, one) if p else None for n, p in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.zeros(len(packed))), pa.array(packed, pa.binary())],
                                             names=["sample", "inbreeding", "contributions"])

    new = placed.where("generation = 0").select("sample", "number", "is_parent").mapInArrow(alone, _KEPT)
    for generation in range(last + 1):
        if generation:
            # a child's rows are one for each known parent
            new = (spark.read.schema(_SENT).parquet(f"{base}/sent/from=*/to={generation}").repartition("child")
                   .sortWithinPartitions("child", "role").mapInArrow(_inherited, _KEPT))
        new.write.parquet(f"{base}/kept/generation={generation}", compression="zstd")
        new = spark.read.schema(_KEPT).parquet(f"{base}/kept/generation={generation}").where("contributions IS NOT NULL")
        (edges.join(new.withColumnRenamed("sample", "parent"), "parent")
         .select("child", "role", "number", "is_parent", "inbreeding", "contributions", "to")
         .write.partitionBy("to").parquet(f"{base}/sent/from={generation}", compression="zstd"))
    kept = spark.read.schema(_KEPT + ", generation int").parquet(f"{base}/kept")
    return Coefficients(kept.select("sample", "generation", "inbreeding"),
                        kept.where("contributions IS NOT NULL").select("sample", "contributions"),
                        edges.select("child", "role", "parent"))


def recorded_pairs(pedigree: DataFrame) -> DataFrame:
    """The distinct pairs that records name: child and sire, child and dam, sire and dam."""
    records = _records(pedigree)
    pairs = [records.select(F.col(a).alias("sample_1"), F.col(b).alias("sample_2"))
             for a, b in (("child", "sire"), ("child", "dam"), ("sire", "dam"))]
    return (pairs[0].union(pairs[1]).union(pairs[2])
            .where("sample_1 IS NOT NULL AND sample_2 IS NOT NULL").distinct())
