"""Language identification by a mixture of languages in every document.

Each language has a character model: the probability of a byte symbol given the two
before it in the word, counted over all training texts.  A document is a mixture:
every word comes from one of the languages in its set, and expectation-maximisation
estimates their proportions from the words' likelihoods.  The set grows from the best
single language, at each step by the language that gains most, while the log likelihood
gains more than PENALTY * log(words) per language; a language that cannot gain this
much, or more than the best one of the step so far, even if every word took its better
choice is not tried.  The prediction is the language with
the largest proportion and the score is that proportion.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is
every text if nothing was learned; of equal languages the first in alphabetical order
wins; training rows with a null text or language are not used; rows that repeat an
id are judged one by one; only the columns named in the call are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genospark.llm import textarrays as T

SYMBOLS = 64
GRAMS = SYMBOLS**3
#: Counts travel in rows of this many n-grams.
PART = 1 << 14
#: Added to every count of a symbol.
SMOOTH = 0.1
PENALTY = 1.0
ROUNDS = 20

# a-z (A-Z lower-cased) are 1-26; continuation bytes 27-58; lead bytes 59-63; all else 0, between words
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[0x80:0xC0] = 27 + (np.arange(64) & 31)
_SYMBOL[0xC0:0x100] = 59 + np.minimum(np.arange(64) % 32 // 2, 4)


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Words of a slice: n-gram numbers by position (a word's letters and the end after
    them), the bounds of the words in them, and for each text the words before it."""
    text, starts_at = T.spaced(data, offsets)
    symbol = _SYMBOL[text]
    start, end = T.runs(symbol > 0)
    one = np.concatenate((np.zeros(1, np.int32), symbol[:-1]))
    two = np.concatenate((np.zeros(1, np.int32), one[:-1]))
    two[one == 0] = 0
    gram = (two * SYMBOLS + one) * SYMBOLS + symbol
    at = T.ranges(start, end - start + 1)
    return gram[at], np.concatenate(([0], np.cumsum(end - start + 1))), np.searchsorted(start, starts_at)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of each language over a whole task."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = T.buffers(batch.column(0))
        lang = np.asarray(batch.column(1).to_pylist(), object)
        for i, j in T.slices(offsets):
            gram, bounds, first = _grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            size = np.diff(bounds[first])  # of each text
            for name in sorted(set(lang[i:j])):
                own = np.bincount(gram[np.repeat(lang[i:j] == name, size)], minlength=GRAMS)
                total[name] = total[name] + own if name in total else own
    rows = [(name, p, x[p * PART:(p + 1) * PART].tobytes()) for name, x in total.items() for p in range(GRAMS // PART)]
    yield pa.RecordBatch.from_pylist([dict(zip(("lang", "part", "counts"), r, strict=True)) for r in rows], _COUNTS)


_COUNTS = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("counts", pa.binary())])
COUNTS = "lang string, part int, counts binary"


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for lang, part, counts in zip(*batch.to_pydict().values(), strict=True):
            own = np.frombuffer(counts, np.int64)
            total[lang, part] = total[lang, part] + own if (lang, part) in total else own
    yield pa.RecordBatch.from_pylist(
        [{"lang": k[0], "part": k[1], "counts": v.tobytes()} for k, v in total.items()], _COUNTS)


class Model:
    """Languages in alphabetical order and the log probabilities of their n-grams."""

    def __init__(self, rows: list):
        self.names = sorted({r["lang"] for r in rows})
        self.logp = np.zeros((len(self.names), GRAMS), np.float32)
        counts = {n: np.zeros(GRAMS) for n in self.names}
        for r in rows:
            counts[r["lang"]][r["part"] * PART:(r["part"] + 1) * PART] = np.frombuffer(r["counts"], np.int64)
        for k, name in enumerate(self.names):
            table = counts[name].reshape(-1, SYMBOLS) + SMOOTH
            self.logp[k] = np.log(table / table.sum(axis=1, keepdims=True)).ravel()


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Count the n-grams of all rows with a text and a language."""
    T.bounded_batches(docs.sparkSession)
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = known.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).mapInArrow(_count, COUNTS)
    # two levels, so that no task adds up the rows of all tasks
    half = counts.repartition(4 * (GRAMS // PART), "lang", "part", F.pmod(F.spark_partition_id(), F.lit(4)))
    return Model(half.mapInArrow(_sum, COUNTS).repartition("lang", "part").mapInArrow(_sum, COUNTS).collect())


def proportions(like: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """EM for the mixture of each document.

    ``like``: (languages, words) log likelihoods; ``doc``: the document of each word,
    ascending.  Returns (languages, documents) proportions and the log likelihoods.
    """
    top = like.max(axis=0)
    p = np.exp(like - top)
    words = np.maximum(np.bincount(doc, minlength=n_docs), 1)
    share = np.full((len(like), n_docs), 1 / len(like))
    for _ in range(ROUNDS):
        joint = p * share[:, doc]
        joint /= joint.sum(axis=0)
        new = np.stack([np.bincount(doc, row, minlength=n_docs) for row in joint]) / words
        moved = np.abs(new - share).max(initial=0)
        share = new
        if moved < 1e-3:
            break
    total = np.bincount(doc, np.log((p * share[:, doc]).sum(axis=0) + 1e-300) + top, minlength=n_docs)
    return share, total


def choose(like: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Predicted language and its proportion for each document (all have words)."""
    langs = len(like)
    single = np.stack([np.bincount(doc, row, minlength=n_docs) for row in like])
    words = np.bincount(doc, minlength=n_docs)
    penalty = PENALTY * np.log(np.maximum(words, 2))
    best = single.argmax(axis=0)
    best_share, total = np.ones(n_docs), single.max(axis=0)
    sets = best[None, :]  # the languages of each document's set
    active = np.arange(n_docs)
    for _ in range(langs - 1):
        member = np.zeros(n_docs, bool)
        member[active] = True
        w = member[doc]
        number = np.cumsum(member) - 1
        d, own = number[doc[w]], like[:, w]
        # the most that each further language can gain: every word takes the better choice
        now = own[sets[:, d], np.arange(len(d))].max(axis=0)
        bound = np.stack([np.bincount(d, np.maximum(now, row), minlength=len(active)) for row in own])
        bound[sets, np.arange(len(active))] = -np.inf
        # of those that can gain more than the penalty and the best one so far, the one that gains most
        gained, added = total[active] + penalty[active], np.full(len(active), -1)
        share = np.zeros((len(sets) + 1, len(active)))
        while (hope := bound.max(axis=0) > gained).any():
            at, go = np.flatnonzero(hope), hope[d]
            add = bound.argmax(axis=0)[at]
            trial, e = np.concatenate((sets[:, at], add[None])), (np.cumsum(hope) - 1)[d[go]]
            found, reached = proportions(own[:, go][trial[:, e], np.arange(len(e))], e, len(at))
            bound[add, at] = -np.inf
            better = reached > gained[at]
            at = at[better]
            gained[at], added[at], share[:, at] = reached[better], add[better], found[:, better]
        grown = added >= 0
        if not grown.any():
            break
        active, share, gained = active[grown], share[:, grown], gained[grown]
        sets = np.concatenate((sets[:, grown], added[None, grown]))
        total[active] = gained
        lead = share.argmax(axis=0)
        best[active] = sets[lead, np.arange(len(active))]
        best_share[active] = share[lead, np.arange(len(active))]
    return best, best_share


def _letters(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def _identify(model: Broadcast, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logp = model.value.names, model.value.logp
        for batch in batches:
            data, offsets = T.buffers(batch.column(0))
            pred, score = [], []
            for i, j in T.slices(offsets):
                raw, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                gram, bounds, first = _grams(raw, own)
                n = np.diff(first)
                lang, part = np.full(j - i, -1), np.zeros(j - i)
                if len(gram) and names:
                    like = np.stack([np.add.reduceat(row[gram].astype(np.float64), bounds[:-1]) for row in logp])
                    full = np.flatnonzero(n)
                    doc = np.repeat(np.arange(len(full)), n[full])
                    lang[full], part[full] = choose(like, doc, len(full))
                    ascii_letters = np.add.reduceat((_SYMBOL[raw] - 1 < 26) & (_SYMBOL[raw] > 0), own[:-1][full])
                    for k in full[ascii_letters == 0]:
                        if not _letters(raw[own[k]:own[k + 1]].tobytes()):
                            lang[k], part[k] = -1, 0
                pred += [names[k] if k >= 0 else "und" for k in lang]
                score += part.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(pred, pa.string()), pa.array(score, pa.float64())], schema=schema)
    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """A row for each row of ``docs``: its id, the columns in ``keep``, ``lang_pred`` and ``score``."""
    T.bounded_batches(docs.sparkSession)
    kept = docs.select(F.col(id_col), *(keep or []))
    out = kept.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    return (docs.select(F.col(text_col).cast("string").alias("__text"), F.col(id_col), *(keep or []))
            .mapInArrow(_identify(docs.sparkSession.sparkContext.broadcast(model), to_arrow_schema(out)), out))
