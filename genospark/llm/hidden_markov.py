"""LM scoring with a hidden Markov language model.

Tokens are emitted by a chain of latent states.  A state chooses a token class (a
hash class of the token, CLASSES of them, and one for the end of a text), and the class
chooses the token by its smoothed frequency in the training texts:

    P(token | state) = emission[state, class] * (c + 1) / (n_class + v_class + 1)

with one unknown token in each class.  So the latent part has a fixed size, whatever the
vocabulary, and every token of the corpus has its own probability.

Baum-Welch runs over all training texts: each task adds up the expected counts of its
texts, and the sums give the next parameters.  Texts are cut into blocks of BLOCK
tokens; the transfer matrices of all blocks of a slice are found together, then chained
text by text with scaling, so the likelihood is exact for any length and the loops in
Python are as long as a block, not a text.

The vocabulary is never broadcast: counts live in shards by hash, each slice of
texts asks each shard for the counts of its distinct tokens, and the answers are
joined back to the slice.

Defined cases: a null or empty text is the end token alone; ids may be null or
repeated (each row is scored alone); other columns are not read; without training
texts all counts are 0 and the states stay at their start values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.llm import textarrays as T
from genospark.session import stored

STATES = 6
CLASSES = 1 << 15
ROUNDS = 3
#: Tokens of a block; tokens of the texts that the recursion handles at once.
BLOCK = 32
GROUP_TOKENS = 1 << 17
#: Distinct tokens of a shard, about.
SHARD_TOKENS = 500_000
#: Classes in a row of expected counts.
PART = 1 << 11
#: The end of a text, as a token.
END = np.uint64(0x5851F42D4C957F2D)


def class_of(hashes: np.ndarray) -> np.ndarray:
    return np.where(hashes == END, CLASSES, (hashes >> np.uint64(1)).astype(np.int64) & (CLASSES - 1))


# texts to token numbers

_SLICE = pa.schema([("slice", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
                    ("lengths", pa.list_(pa.int32())), ("hashes", pa.binary()), ("tokens", pa.binary())])
SLICE = "slice long, doc_ids array<long>, train array<boolean>, lengths array<int>, hashes binary, tokens binary"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    for batch in batches:
        data, offsets = T.buffers(batch.column(1))
        for i, j in T.slices(offsets, T.BATCH_BYTES):
            parts, lengths = [], []
            for a, b in T.slices(offsets[i:j + 1]):
                a, b = a + i, b + i
                own = offsets[a:b + 1] - offsets[a]
                word, first = T.words(data[offsets[a]:offsets[b]], own, ~T.SPACE)
                parts.append(np.insert(word, first[1:], END))
                lengths.append(np.diff(first) + 1)
            hashes, tokens = np.unique(np.concatenate(parts), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()),
                 pa.array([batch.column(0).slice(i, j - i).to_pylist()], pa.list_(pa.int64())),
                 pa.array([batch.column(2).slice(i, j - i).to_pylist()], pa.list_(pa.bool_())),
                 pa.array([np.concatenate(lengths).astype(np.int32)], pa.list_(pa.int32())),
                 pa.array([hashes.tobytes()], pa.binary()),
                 pa.array([tokens.astype(np.uint32).tobytes()], pa.binary())], schema=_SLICE)
            number += 1


class Slice:
    """One encoded row."""

    def __init__(self, row: dict):
        self.number = row["slice"]
        self.train = np.asarray(row["train"], bool)
        self.bounds = np.concatenate(([0], np.cumsum(np.asarray(row["lengths"], np.int64))))
        self.hashes = np.frombuffer(row["hashes"], np.uint64)
        self.tokens = np.frombuffer(row["tokens"], np.uint32)

    def training_tokens(self) -> np.ndarray:
        return self.tokens[np.repeat(self.train, np.diff(self.bounds))]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


# the vocabulary

COUNTS = "shard int, hashes binary, counts binary"
_COUNTS = pa.schema([("shard", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])


def merged(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal hashes."""
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word, where = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(where, np.concatenate(counts).astype(np.float64), len(word))
    return word, total.astype(np.int64)  # exact up to 2**53


def _cut(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the shards (by leading bits) in sorted hashes."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))


def _count(bits: int):
    def cut(word: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        at = _cut(word, bits)
        some = np.flatnonzero(np.diff(at))
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([word[at[s]:at[s + 1]].tobytes() for s in some], pa.binary()),
             pa.array([total[at[s]:at[s + 1]].tobytes() for s in some], pa.binary())], schema=_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, total = merged([], [])
        for row in _rows(batches):
            own = Slice(row)
            times = np.bincount(own.training_tokens(), minlength=len(own.hashes))
            word, total = merged([word, own.hashes[times > 0]], [total, times[times > 0]])
            if len(word) > 2_000_000:
                yield cut(word, total)
                word, total = merged([], [])
        yield cut(word, total)
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard in, one row for each shard out."""
    shard, word, total = None, *merged([], [])
    for row in _rows(batches):
        if row["shard"] != shard:
            if shard is not None:
                yield _shard(shard, word, total)
            shard, (word, total) = row["shard"], merged([], [])
        word, total = merged([word, np.frombuffer(row["hashes"], np.uint64)],
                             [total, np.frombuffer(row["counts"], np.int64)])
    if shard is not None:
        yield _shard(shard, word, total)


def _shard(shard: int, word: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([word.tobytes()], pa.binary()),
                                       pa.array([total.tobytes()], pa.binary())], schema=_COUNTS)


def _class_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, v = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
    for row in _rows(batches):
        kind = class_of(np.frombuffer(row["hashes"], np.uint64))
        n += np.bincount(kind, np.frombuffer(row["counts"], np.int64), CLASSES + 1).astype(np.int64)
        v += np.bincount(kind, minlength=CLASSES + 1)
    some = np.flatnonzero(v)
    yield pa.RecordBatch.from_arrays([pa.array(x[some], pa.int64()) for x in (np.arange(CLASSES + 1), n, v)],
                                     names=["class", "n", "v"])


# the chain

class Chain:
    """Parameters of the latent chain: start, step[i, j], emit[class, state]."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def first(cls, share: np.ndarray, states: int, seed: int) -> Chain:
        """Sticky steps, and emissions that scatter around the classes' shares."""
        noise = np.random.default_rng(seed).normal(0, 1, (len(share), states))
        emit = share[:, None] * np.exp(noise)
        step = np.full((states, states), 0.02 / max(states - 1, 1))
        np.fill_diagonal(step, 0.98 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


class Blocks:
    """The texts of a group cut into blocks, longest first, with the chain's transfer
    matrix of each block: X[b, i, j] carries weight i before the block to j after it."""

    def __init__(self, chain: Chain, kinds: np.ndarray, bounds: np.ndarray):
        self.chain = chain
        size = np.diff(bounds)
        self.count = -(-size // BLOCK)  # blocks of each text; a text has a token at least
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        text = np.repeat(np.arange(len(size)), self.count)
        index = np.arange(len(text)) - self.first[text]
        begin = bounds[text] + index * BLOCK
        length = np.minimum(BLOCK, bounds[text + 1] - begin)
        order = np.argsort(-length, kind="stable")
        self.place = np.argsort(order, kind="stable")  # of each block in the order by length
        self.begin, self.opens = begin[order], index[order] == 0
        self.live = np.searchsorted(-length[order], -np.arange(BLOCK), "left")  # blocks longer than t
        emit = chain.emit[kinds]
        top = emit.max(axis=1)
        self.emit = emit / top[:, None]
        self.log_top = np.add.reduceat(np.log(top), bounds[:-1])
        self.kinds = kinds
        k = len(chain.start)
        self.X = np.empty((len(order), k, k))
        for t in range(BLOCK):
            n = self.live[t]
            if not n:
                break
            e = self.emit[self.begin[:n] + t][:, None, :]
            if t:
                self.X[:n] = (self.X[:n].reshape(-1, k) @ chain.step).reshape(n, k, k) * e
            else:
                self.X[:] = np.where(self.opens[:, None, None], chain.start, chain.step) * e

    def chained(self) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood of each text, and the scaled forward weights before each block."""
        texts = np.argsort(-self.count, kind="stable")
        before = np.full((len(self.X), self.X.shape[1]), 1 / self.X.shape[1])
        log = self.log_top.copy()
        now = before[:len(texts)].copy()
        for index in range(int(self.count.max())):
            n = int(np.searchsorted(-self.count[texts], -index, "left"))
            at = self.place[self.first[texts[:n]] + index]
            before[at] = now[:n]
            after = np.einsum("bi,bij->bj", now[:n], self.X[at])
            scale = after.sum(axis=1)
            log[texts[:n]] += np.log(scale)
            now = after / scale[:, None]
        return log, before

    def after_weights(self) -> np.ndarray:
        """Scaled backward weights after each block."""
        texts = np.argsort(-self.count, kind="stable")
        after = np.ones((len(self.X), self.X.shape[1]))
        for index in range(int(self.count.max()) - 1, 0, -1):
            n = int(np.searchsorted(-self.count[texts], -index, "left"))
            at = self.place[self.first[texts[:n]] + index]
            back = np.einsum("bij,bj->bi", self.X[at], after[at])
            after[self.place[self.first[texts[:n]] + index - 1]] = back / back.sum(axis=1, keepdims=True)
        return after

    def expected(self) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Log likelihood and the expected counts: starts, steps, emissions[class, state]."""
        log, before = self.chained()
        step, k = self.chain.step, len(self.chain.start)
        weight = np.empty((len(self.kinds), k))  # forward, then the state probabilities
        now = before
        for t in range(BLOCK):
            n = self.live[t]
            if not n:
                break
            now = now[:n] @ step if t else np.where(self.opens[:, None], self.chain.start, before @ step)
            now = now * self.emit[self.begin[:n] + t]
            now /= now.sum(axis=1, keepdims=True)
            weight[self.begin[:n] + t] = now
        starts, steps = np.zeros(k), np.zeros((k, k))
        back = self.after_weights()
        for t in range(BLOCK - 1, -1, -1):
            n = self.live[t]
            if not n:
                continue
            at = self.begin[:n] + t
            here = self.emit[at] * back[:n]
            prior = weight[at - 1] if t else before
            both = weight[at] * back[:n]
            weight[at] = both / both.sum(axis=1, keepdims=True)
            if t == 0:
                starts += weight[at[self.opens]].sum(axis=0)
                prior, here_in = prior[~self.opens], here[~self.opens]
            else:
                here_in = here
            total = np.einsum("bi,bi->b", prior @ step, here_in)
            steps += (prior / total[:, None]).T @ here_in * step
            back[:n] = here @ step.T
            back[:n] /= back[:n].sum(axis=1, keepdims=True)
        emits = np.stack([np.bincount(self.kinds, weight[:, j], CLASSES + 1) for j in range(k)], axis=1)
        return float(log.sum()), starts, steps, emits


def _groups(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    return T.slices(bounds, GROUP_TOKENS)


EXPECTED = "part int, sums binary"
_EXPECTED = pa.schema([("part", pa.int32()), ("sums", pa.binary())])


def _expect(chain: Broadcast):
    """Expected counts of a whole task: part -1 has starts, steps and the log likelihood."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = chain.value
        k = len(model.start)
        small, emits = np.zeros(k + k * k + 1), np.zeros((CLASSES + 1, k))
        for row in _rows(batches):
            own = Slice(row)
            kinds = class_of(own.hashes)[own.training_tokens()]
            bounds = np.concatenate(([0], np.cumsum(np.diff(own.bounds)[own.train])))
            for i, j in _groups(bounds):
                group = Blocks(model, kinds[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
                log, starts, steps, more = group.expected()
                small += np.concatenate((starts, steps.ravel(), [log]))
                emits += more
        parts = [-1, *range(-(-(CLASSES + 1) // PART))]
        sums = [small.tobytes(), *(emits[p * PART:(p + 1) * PART].astype(np.float32).tobytes() for p in parts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(sums, pa.binary())], schema=_EXPECTED)
    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for row in _rows(batches):
        kind = np.float64 if row["part"] < 0 else np.float32
        own = np.frombuffer(row["sums"], kind).astype(np.float64)
        total[row["part"]] = total[row["part"]] + own if row["part"] in total else own
    sums = [v.astype(np.float64 if p < 0 else np.float32).tobytes() for p, v in total.items()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(sums, pa.binary())], schema=_EXPECTED)


def train_chain(slices: DataFrame, share: np.ndarray, states: int, rounds: int, seed: int) -> Chain:
    """Baum-Welch over the training texts of all slices."""
    chain = Chain.first(share, states, seed)
    context = slices.sparkSession.sparkContext
    parts = -(-(CLASSES + 1) // PART) + 1
    for _ in range(rounds):
        sent = context.broadcast(chain)
        sums = slices.select("train", "lengths", "hashes", "tokens", "slice").mapInArrow(_expect(sent), EXPECTED)
        half = sums.repartition(4 * parts, "part", F.pmod(F.spark_partition_id(), F.lit(4))).mapInArrow(_add, EXPECTED)
        got = {r["part"]: r["sums"] for r in half.repartition(parts, "part").mapInArrow(_add, EXPECTED).collect()}
        if not got:
            break
        small = np.frombuffer(got.pop(-1), np.float64)
        emits = np.concatenate([np.frombuffer(got[p], np.float32) for p in sorted(got)])
        emits = emits.astype(np.float64).reshape(-1, states)
        start, step = small[:states] + 1, small[states:-1].reshape(states, states) + 1
        # a class keeps a little of its overall share in each state
        emit = emits + share[:, None] * CLASSES
        chain = Chain(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
        sent.unpersist()
    return chain


# asking the shards, and scoring

ASKED = "shard int, slice long, hashes binary, counts binary"
_ASKED = pa.schema([("shard", pa.int32()), ("slice", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])


def _ask(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            word = np.frombuffer(row["hashes"], np.uint64)
            at = _cut(word, bits)
            some = np.flatnonzero(np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(np.full(len(some), row["slice"])),
                 pa.array([word[at[s]:at[s + 1]].tobytes() for s in some], pa.binary()),
                 pa.nulls(len(some), pa.binary())], schema=_ASKED)
    return run


_ANSWER = pa.schema([("slice", pa.int64()), ("shard", pa.int32()), ("counts", pa.binary())])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, its counts first; each question gets the counts of its tokens."""
    shard, word, count = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for row in _rows(batches):
        if row["shard"] != shard:
            shard, word, count = row["shard"], np.zeros(0, np.uint64), np.zeros(0, np.int64)
        asked = np.frombuffer(row["hashes"], np.uint64)
        if row["counts"] is not None:
            word, count = asked, np.frombuffer(row["counts"], np.int64)
            continue
        found = np.zeros(len(asked), np.int64)
        if len(word):
            at = np.minimum(np.searchsorted(word, asked), len(word) - 1)
            found = np.where(word[at] == asked, count[at], 0)
        yield pa.RecordBatch.from_arrays([pa.array([row["slice"]], pa.int64()), pa.array([shard], pa.int32()),
                                          pa.array([found.tobytes()], pa.binary())], schema=_ANSWER)


class Scorer:
    """What scoring needs beside the texts and their counts; of a fixed size."""

    def __init__(self, chain: Chain, class_total: np.ndarray, tokens: int, words: int):
        self.chain, self.tokens, self.words = chain, tokens, words
        self.log_class = np.log10(class_total)

    def score(self, own: Slice, count: np.ndarray) -> dict[str, np.ndarray]:
        kinds = class_of(own.hashes)
        log_count = np.log10(count + 1.0)
        begin = own.bounds[:-1]
        size = np.diff(own.bounds)
        seen = np.add.reduceat((count > 0)[own.tokens].astype(np.int64), begin)
        base = np.add.reduceat(log_count[own.tokens], begin) - size * np.log10(self.tokens + self.words + 1.0)
        inner = np.add.reduceat((log_count - self.log_class[kinds])[own.tokens], begin)
        kind = kinds[own.tokens]
        chain = np.concatenate([
            Blocks(self.chain, kind[own.bounds[i]:own.bounds[j]], own.bounds[i:j + 1] - own.bounds[i]).chained()[0]
            for i, j in _groups(own.bounds)])
        return {"n_tokens": size, "n_known": seen, "base_score": base, "score": chain / np.log(10) + inner}


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                     ("score", pa.float64())])


def _score(scorer: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            own = Slice(row)
            answers = sorted(row["answers"], key=lambda a: a["shard"])
            count = np.concatenate([np.frombuffer(a["counts"], np.int64) for a in answers])
            got = scorer.value.score(own, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(~own.train), pa.array(got["n_tokens"]),
                 pa.array(got["n_known"]), pa.array(np.full(len(own.train), scorer.value.tokens)),
                 pa.array(got["base_score"]), pa.array(got["score"])], schema=_SCORES)
    return run


def score_texts(docs: DataFrame, train_col: str, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
                rounds: int = ROUNDS, seed: int = 3) -> DataFrame:
    """Train on the rows where the boolean column ``train_col`` is true, and score all rows.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigram) and score (the model's log10 probability of the text).
    """
    spark = docs.sparkSession
    T.bounded_batches(spark)
    slices = stored(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"),
                                F.coalesce(F.col(train_col), F.lit(False))).mapInArrow(_encode, SLICE), "encoded")
    entries = (slices.agg(F.sum(F.length("hashes"))).first()[0] or 0) // 8
    bits = max(4, int(np.ceil(np.log2(max(1, entries / SHARD_TOKENS)))))
    vocabulary = stored(slices.select("slice", "train", "lengths", "hashes", "tokens").mapInArrow(_count(bits), COUNTS)
                        .repartition("shard").sortWithinPartitions("shard").mapInArrow(_merge, COUNTS), "vocabulary")
    sizes = (vocabulary.mapInArrow(_class_sizes, "class long, n long, v long")
             .groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toPandas())
    n, v = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    n[sizes["class"]], v[sizes["class"]] = sizes["n"], sizes["v"]
    total = n + v + 1
    chain = train_chain(slices, total / total.sum(), states, rounds, seed)
    scorer = spark.sparkContext.broadcast(Scorer(chain, total, int(n.sum()), int(v.sum())))

    asked = slices.select("slice", "hashes").mapInArrow(_ask(bits), ASKED)
    known = vocabulary.select("shard", F.lit(None).cast("long").alias("slice"), "hashes", "counts")
    answers = (known.unionByName(asked).repartition("shard").sortWithinPartitions("shard", F.col("counts").isNull())
               .mapInArrow(_answer, "slice long, shard int, counts binary")
               .groupBy("slice").agg(F.collect_list(F.struct("shard", "counts")).alias("answers")))
    return slices.join(answers, "slice").mapInArrow(_score(scorer), SCORES)
