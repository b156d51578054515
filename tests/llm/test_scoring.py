"""LM scoring, quality classifier and language identification."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from genospark.llm import hidden_markov as H
from genospark.llm import importance_resampling as I
from genospark.llm import language_mixture as L
from genospark.llm import queries
from tests.llm.fixtures import documents, empty, folder, messy_texts

SF = "/root/testdata/sf0.001"


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w] + ["<end>"]


def held_out(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n == 2


def test_hidden_markov_base_score(spark, tmp_path):
    rows = messy_texts()
    got = queries.op3_hidden_markov(spark, folder(spark, str(tmp_path), documents=documents(spark, rows))).collect()
    count = collections.Counter(t for i, x in rows if not held_out(i, 7) for t in tokens(x))
    n, v = sum(count.values()), len(count)
    want = collections.Counter(
        (i, held_out(i, 7), len(tokens(x)), sum(count[t] > 0 for t in tokens(x)), n,
         round(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(x)), 6)) for i, x in rows)
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                               for r in got) == want
    assert all(r.score < 0 for r in got)


def test_chain_against_plain_recursions():
    rng = np.random.default_rng(0)
    k, sizes = 3, [1, 5, 32, 33, 64, 70, 200]
    emit = rng.random((H.CLASSES + 1, k))
    step, start = rng.random((k, k)), rng.random(k)
    chain = H.Chain(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    kinds = rng.integers(0, 17, bounds[-1])
    logs, starts, steps, emits = [], np.zeros(k), np.zeros((k, k)), np.zeros((17, k))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        seen = chain.emit[kinds[a:b]]
        fore, back = [chain.start * seen[0]], [np.ones(k)]
        for e in seen[1:]:
            fore.append(fore[-1] @ chain.step * e)
        for e in seen[:0:-1]:
            back.insert(0, chain.step @ (e * back[0]))
        total = fore[-1].sum()
        logs.append(math.log(total))
        for t, kind in enumerate(kinds[a:b]):
            emits[kind] += fore[t] * back[t] / total
            if t:
                steps += np.outer(fore[t - 1], seen[t] * back[t]) * chain.step / total
        starts += fore[0] * back[0] / total
    log, _ = H.Blocks(chain, kinds, bounds).chained()
    assert np.allclose(log, logs)
    total, s, x, e = H.Blocks(chain, kinds, bounds).expected()
    assert np.isclose(total, sum(logs)) and np.allclose(s, starts) and np.allclose(x, steps)
    assert np.allclose(e[:17], emits)


def test_token_probabilities_add_up(spark, tmp_path):
    """One known text: after any state, known tokens, one unknown token per class and the end add up to 1."""
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 300).astype(np.uint64)
    count = rng.integers(1, 50, 300)
    kind = H.class_of(words)
    n, v = np.bincount(kind, count, H.CLASSES + 1), np.bincount(kind, minlength=H.CLASSES + 1)
    chain = H.Chain.first((n + v + 1) / (n + v + 1).sum(), 4, 2)
    inside = (count + 1) / (n + v + 1)[kind]
    for state in range(4):
        known = (chain.emit[kind, state] * inside).sum()
        unknown = (chain.emit[:, state] / (n + v + 1)).sum()
        assert np.isclose(known + unknown, 1)


def test_hidden_markov_beats_unigrams_on_held_out_texts(spark):
    got = queries.op3_hidden_markov(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert len(got) > 100
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_hidden_markov_odd_tables(spark):
    docs = empty(spark, "doc_id long, text string, learn boolean")
    assert H.score_texts(docs, "learn").count() == 0
    unlearned = documents(spark, messy_texts(), clashing=False).withColumn("learn", F.lit(None).cast("boolean"))
    out = H.score_texts(unlearned, "learn").collect()
    assert len(out) == len(messy_texts()) and not any(r.n_known or r.train_tokens for r in out)


def test_resampling_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op5_importance_resampling(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert out.count() == docs.count()
    judged = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r.kept for r in judged if r.quality == 1], [r.kept for r in judged if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.3


def test_resampling_weights_by_hand(spark):
    """Log weights and counts against n-grams counted in Python; hash buckets may be shared."""
    rows = [(1, "a b. c"), (2, "a b. d!!"), (3, "x y"), (4, None), (5, "")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, 1), (None, 1), (3, None)], "doc_id long, quality int")
    out = {r.doc_id: r.log_weight for r in I.resample(documents(spark, rows), labels).collect()}

    def grams(text):
        w = re.findall(r"[a-z]+|[.!]+", text or "")
        return w + list(zip(w, w[1:], strict=False))
    raw = collections.Counter(g for _, t in rows for g in grams(t))
    good = collections.Counter(grams(rows[0][1]))
    n, m = sum(raw.values()) + I.BUCKETS, sum(good.values()) + I.BUCKETS
    for i, t in rows:
        want = sum(math.log((good[g] + 1) / m) - math.log((raw[g] + 1) / n) for g in grams(t))
        assert math.isclose(out[i], want, rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("k", [0, 1, 17, 73, 10_000])
def test_resampling_takes_the_k_largest_keys(spark, k):
    docs = documents(spark, messy_texts())
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    out = I.resample(docs, labels, k=k).collect()
    keys = sorted((r.gumbel_key for r in out), reverse=True)
    floor = math.inf if not k else -math.inf if k >= len(keys) else keys[k - 1]
    assert all(r.kept == (r.gumbel_key >= floor) for r in out)


def test_resampling_odd_tables(spark):
    no_labels = empty(spark, "doc_id long, quality int")
    assert I.resample(empty(spark), no_labels).count() == 0
    assert all(r.kept for r in I.resample(documents(spark, messy_texts()), no_labels).collect())
    docs = documents(spark, messy_texts())
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    chosen = I.Resampling(docs, labels, k=20)
    assert chosen.kept_rows(docs).columns == docs.columns
    assert chosen.kept_rows(docs).count() == chosen.decisions().where("kept").count()


def test_languages_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op10_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    rows = out.where("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_proportions_of_a_mixed_text(spark):
    rng = random.Random(2)

    def text(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))
    train = [(text("abcde", 50), "one"), (text("vwxyz", 50), "two"), (text("klmno", 50), "three"), (None, "one"), ("x", None)]
    model = L.fit(spark.createDataFrame(train, "text string, lang string"))
    assert model.names == ["one", "three", "two"]
    rows = [(1, text("abcde", 70) + " " + text("vwxyz", 30)), (2, text("klmno", 10)), (3, None), (4, "123 !?"), (5, ""),
            (6, "— “”"), (None, text("vwxyz", 3)), (7, "日本")]
    got = {r.doc_id: r for r in L.identify(documents(spark, rows), model).collect()}
    assert got[1].lang_pred == "one" and abs(got[1].score - 0.7) < 0.02
    assert got[2].lang_pred == "three" and got[2].score == 1 and got[None].lang_pred == "two"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (3, 4, 5, 6))
    assert got[7].lang_pred in model.names


def test_a_language_is_tried_after_the_one_with_the_best_bound():
    like = np.zeros((3, 1000))
    like[1, :500], like[1, 500:] = 0.5, -3  # could gain 250 at most, and gains nothing in a mixture
    like[2], like[2, -50:] = -20, 4  # could gain 200 at most, and gains 19
    like = np.tile(like, 2)
    like[:, 1000:] = like[[0, 2, 1], 1000:]
    best, share = L.choose(like, np.repeat([0, 1], 1000), 2)
    assert best.tolist() == [0, 0] and share[0] == share[1] and 0.96 < share[0] < 0.98


def test_languages_odd_tables(spark):
    nothing = L.fit(empty(spark, "text string, lang string"))
    out = L.identify(documents(spark, messy_texts()), nothing).collect()
    assert len(out) == len(messy_texts()) and {r.lang_pred for r in out} == {"und"}
    assert L.identify(empty(spark), nothing).count() == 0
