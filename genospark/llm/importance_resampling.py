"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (unigrams and bigrams), each a
multinomial with add-one smoothing: the target's, from the documents labelled
good, and the raw one, from all documents.  A document's log importance weight is
the sum over its n-grams of the log ratio of the two.  Adding a Gumbel variate to
each log weight and keeping the k largest keys samples k documents without
replacement, in proportion to their weights.

The target's documents and the operating point come from at most LABELLED labelled
ids (all, if there are fewer; else those with the smallest hash), so the labels reach
the tasks as one array of bounded size and no text is shuffled.

``k`` is the number of keys above the operating point ``cut``, which is read off
the labelled documents: the one that splits them with the fewest errors, a lost
good document counting ``keep_cost`` times.  Both models and all weights cover
all documents and whole texts; the labelled keys that fix ``cut`` are reduced to a
histogram of fixed size.

Tokens are runs of letters, digits and non-ASCII characters, and runs of other
characters than white space; case is kept.  Noise is a function of the row's id and
``seed``, so a recomputed task draws the same.

Defined cases: a null or empty text has weight 0; labels that are null or of absent
documents are not used; of several labels of a document the lowest counts; with
no good label or no bad one all documents are kept; rows that repeat an id are
judged one by one (with equal noise); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.llm import textarrays as T
from genospark.session import stored

#: Hash buckets of n-grams; the models are two arrays of this size.
BUCKETS = 1 << 18
#: Counts travel in rows of this many buckets, so their sum is spread over tasks.
PART = 1 << 12
#: Histogram of labelled keys: bins of this width on an arcsinh scale.
BIN = 0.02
KEEP_COST = 4.0
#: Labelled documents used, at most.
LABELLED = 200_000


def _ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the n-grams of a slice of texts and the text number of each."""
    text, starts_at = T.spaced(data, offsets)
    solid = ~T.SPACE[text]
    kind = np.where(solid, 1 + T.ALNUM[text].astype(np.int8), 0).astype(np.int8)
    change = np.flatnonzero(np.diff(kind, prepend=np.int8(0), append=np.int8(0)))
    start, end = change[:-1], change[1:]
    token = kind[start] > 0
    start, end = start[token], end[token]
    word = T.SpanHash(text)(start, end)
    doc = np.searchsorted(starts_at, start, "right") - 1
    pair = T.mix(word[:-1] * np.uint64(3) + word[1:]) if len(word) else word
    same = doc[:-1] == doc[1:]
    gram = np.concatenate((word, pair[same])) & np.uint64(BUCKETS - 1)
    return gram.astype(np.int64), np.concatenate((doc, doc[:-1][same]))


class Labels:
    """Known ids, ascending, and whether each is good."""

    def __init__(self, ids: np.ndarray, good: np.ndarray):
        self.ids, self.good = ids, good

    def of(self, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Is the id labelled; is it good."""
        there = ids.is_valid().to_numpy(zero_copy_only=False)
        if not len(self.ids):
            return np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        value = ids.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(self.ids, value), len(self.ids) - 1)
        known = there & (self.ids[at] == value)
        return known, known & self.good[at]


def known_labels(labels: DataFrame, id_col: str, limit: int) -> Labels:
    known = (labels.where(f"{id_col} IS NOT NULL AND quality IS NOT NULL")
             .groupBy(F.col(id_col).cast("long").alias("id")).agg((F.min("quality") >= 1).alias("good"))
             .orderBy(F.xxhash64("id"), "id").limit(limit).toPandas().sort_values("id"))
    return Labels(known["id"].to_numpy(np.int64), known["good"].to_numpy(bool))


def _count(labels: Broadcast):
    """N-gram counts of a whole task: all rows, and the rows labelled good."""
    return T.releases(lambda batches: _count_task(batches, labels.value))


def _count_task(batches: Iterator[pa.RecordBatch], labels: Labels) -> Iterator[pa.RecordBatch]:
    raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        data, offsets = T.buffers(batch.column(1))
        _, target = labels.of(batch.column(0))
        for i, j in T.slices(offsets):
            gram, doc = _ngrams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            raw += np.bincount(gram, minlength=BUCKETS)
            good += np.bincount(gram[target[i:j][doc]], minlength=BUCKETS)
    parts = range(BUCKETS // PART)
    yield pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32())] + [pa.array([x[p * PART:(p + 1) * PART].tobytes() for p in parts], pa.binary())
                                         for x in (raw, good)], names=["part", "raw", "good"])


@T.releases
def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the rows of each part; a task holds one array for each part it has."""
    total: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for part, *counts in zip(*batch.to_pydict().values(), strict=True):
            arrays = [np.frombuffer(c, np.int64) for c in counts]
            if part in total:
                total[part] = [a + b for a, b in zip(total[part], arrays, strict=True)]
            else:
                total[part] = arrays
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32())] + [pa.array([v[k].tobytes() for v in total.values()], pa.binary())
                                               for k in (0, 1)], names=["part", "raw", "good"])


class Model:
    """Log ratio of the target's and the raw bucket probabilities."""

    def __init__(self, parts: list):
        raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for row in parts:
            at = slice(row["part"] * PART, (row["part"] + 1) * PART)
            raw[at], good[at] = np.frombuffer(row["raw"], np.int64), np.frombuffer(row["good"], np.int64)
        self.ratio = (np.log((good + 1) / (good.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS)))


WEIGHT_SCHEMA = "id long, log_weight double, key double, sort_key long, good boolean"


def _weigh(model: Broadcast, labels: Broadcast, seed: int):
    salt = np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)

    @T.releases
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.buffers(batch.column(1))
            weight = np.zeros(batch.num_rows)
            for i, j in T.slices(offsets):
                gram, doc = _ngrams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                weight[i:j] = np.bincount(doc, model.value.ratio[gram], minlength=j - i)
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            bits = T.mix(ids + salt) >> np.uint64(11)
            noise = -np.log(-np.log((bits.astype(np.float64) + 0.5) / 2.0**53))
            known, good = labels.value.of(batch.column(0))
            bits = (weight + noise).view(np.int64)
            order = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(weight), pa.array(weight + noise), pa.array(order),
                 pa.array(good, mask=~known)],
                names=["id", "log_weight", "key", "sort_key", "good"])
    return run


def train(docs: DataFrame, labels: Broadcast) -> Model:
    """Count the n-grams of (id, text) rows."""
    counts = docs.mapInArrow(_count(labels), "part int, raw binary, good binary")
    # two levels: partial sums by part and group of tasks, then one row for each part
    half = counts.repartition(2 * (BUCKETS // PART), "part", F.pmod(F.spark_partition_id(), F.lit(4)))
    schema = "part int, raw binary, good binary"
    return Model(half.mapInArrow(_sum, schema).repartition("part").mapInArrow(_sum, schema).collect())


def operating_point(weighed: DataFrame, keep_cost: float = KEEP_COST) -> float:
    """The cut on the keys with the least cost on the labelled rows."""
    scale = F.floor(F.asinh("key") / F.lit(BIN))
    hist = (weighed.where("good IS NOT NULL").groupBy(scale.alias("bin"))
            .agg(F.sum(F.col("good").cast("long")).alias("good"), F.count(F.lit(1)).alias("n")).toPandas())
    hist = hist.sort_values("bin")
    good, bad = hist["good"].to_numpy(float), (hist["n"] - hist["good"]).to_numpy(float)
    if not good.sum() or not bad.sum():
        return float("-inf")
    # cost of cutting below bin i: the good rows under it are lost, the bad rows over it stay
    cost = keep_cost * np.concatenate(([0], np.cumsum(good))) + bad.sum() - np.concatenate(([0], np.cumsum(bad)))
    best = int(cost.argmin())
    return float("-inf") if best == 0 else float(np.sinh((hist["bin"].iloc[best - 1] + 1) * BIN))


def kth_largest(weighed: DataFrame, k: int) -> int:
    """The k-th largest ``sort_key``, exactly, 16 bits at a time; a pass brings at most 2**16 counts."""
    prefix, left, rest = 0, k, weighed.select("sort_key")
    for shift in (48, 32, 16, 0):
        digit = F.shiftright("sort_key", shift)
        counts = sorted(rest.groupBy(digit.alias("d")).count().collect(), reverse=True)
        for row in counts:
            if left <= row["count"]:
                prefix = row["d"]
                break
            left -= row["count"]
        rest = rest.where(digit == F.lit(prefix).cast("long"))
    return prefix


class Resampling:
    """The two models fitted to ``docs`` and the key of the last document that is kept.

    ``labels`` has the id and ``quality`` (0 or 1).  ``k`` is the number of documents to keep;
    None takes it from the labelled documents.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 k: int | None = None, keep_cost: float = KEEP_COST, labelled: int = LABELLED, seed: int = 5):
        T.bounded_batches(docs.sparkSession, T.SMALL_BATCH_BYTES)
        context = docs.sparkSession.sparkContext
        self.id_col, self.text_col, self.seed = id_col, text_col, seed
        self.known = context.broadcast(known_labels(labels, id_col, labelled))
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        self.model = context.broadcast(train(rows, self.known))
        self.weighed = stored(rows.mapInArrow(_weigh(self.model, self.known, seed), WEIGHT_SCHEMA), "weights")
        n = self.weighed.count()
        if k is None:
            cut = operating_point(self.weighed, keep_cost)
            k = self.weighed.where(F.col("key") >= F.lit(cut)).count()
        most, least = (1 << 63) - 1, -(1 << 63)
        self.last = most if k <= 0 else least if k >= n else kth_largest(self.weighed, k)

    def decisions(self) -> DataFrame:
        """A row for each row of the documents: its id, ``log_weight``, ``gumbel_key`` and ``kept``
        (the k largest keys, and any equal to the last of them)."""
        return self.weighed.select(F.col("id").alias(self.id_col), "log_weight", F.col("key").alias("gumbel_key"),
                                   (F.col("sort_key") >= F.lit(self.last).cast("long")).alias("kept"))

    def kept_rows(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that stay, with all their columns; no row is shuffled."""
        weigh, last = _weigh(self.model, self.known, self.seed), self.last
        at_id, at_text = docs.columns.index(self.id_col), docs.columns.index(self.text_col)

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pair = pa.RecordBatch.from_arrays(
                    [batch.column(at_id).cast(pa.int64()), batch.column(at_text).cast(pa.string())],
                    names=["id", "text"])
                (weights,) = weigh(iter([pair]))
                yield batch.filter(pc.greater_equal(weights.column("sort_key"), pa.scalar(last, pa.int64())))
        return docs.mapInArrow(chosen, docs.schema)


def resample(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Judge every document; see ``Resampling``."""
    return Resampling(docs, labels, **options).decisions()
