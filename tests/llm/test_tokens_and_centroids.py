"""op11, op12 and op13 against brute force, the tokenizers' own libraries and SQL."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from genospark.llm import byte_pairs, sharded_lloyd, token_alignment
from genospark.llm import queries as Q
from tests.llm import fixtures as X

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN

AWKWARD = ["", None, " ", "  two  spaces ", "tab\there\nand\r\nthere", "<s> </s> <unk> <|endoftext|>", "▁ mark", "ﬁ Å",
           "日本語テキスト😀👩‍👩‍👧", "don't we'll I'VE 1234567 3.14", "a" * 3000, "ab" * 1500, " 　​", "\0\x01", "é" * 999]


def rows() -> list[tuple[int | None, str | None]]:
    return X.messy_texts() + [(1000 + k, t) for k, t in enumerate(AWKWARD)]


# ---- op13


def tiktoken_encoding() -> tiktoken.Encoding:
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_query_equals_tiktoken(spark, tmp_path):
    folder = X.folder(spark, str(tmp_path), documents=X.documents(spark, rows()))
    encoding, want = tiktoken_encoding(), []
    for doc, text in rows():
        ids = encoding.encode_ordinary(text or "")
        want.append((hashlib.sha256(encoding.decode_bytes(ids)).hexdigest(), doc,
                     hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), len(ids)))
    got = Q.op13_byte_bpe(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert X.collected(got) == sorted(want, key=repr)


def test_byte_bpe_pieces_equal_tiktoken():
    vocabulary, encoding, rng = byte_pairs.loaded(RANKS, PATTERN), tiktoken_encoding(), random.Random(3)
    tokens = list(vocabulary.ranks)
    for _ in range(4000):
        piece = b"".join(rng.choice(tokens) if rng.random() < 0.6 else bytes([rng.randrange(256)])
                         for _ in range(rng.randint(1, 9)))
        assert vocabulary.encode_piece(piece) == encoding._core_bpe.encode_single_piece(piece)


@pytest.mark.parametrize("seed", range(6))
def test_byte_bpe_any_ranks(seed):
    """Ranks in no sensible order, tokens that no merge reaches, and ties."""
    rng = random.Random(seed)
    tokens = {bytes([c]) for c in b"abc"}
    while len(tokens) < 25:
        tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 6))))
    order = sorted(tokens)
    rng.shuffle(order)
    ranks = {t: k for k, t in enumerate(order)}
    vocabulary = byte_pairs.BytePairs(ranks, r"[^ ]+| +")
    encoding = tiktoken.Encoding("own", pat_str=r"[^ ]+| +", mergeable_ranks=ranks, special_tokens={})
    for _ in range(1500):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 30)))
        assert vocabulary.encode_piece(piece) == encoding.encode_ordinary(piece.decode())


def test_byte_bpe_long_pieces_memo_and_missing_bytes(monkeypatch):
    vocabulary = byte_pairs.BytePairs(byte_pairs.read_ranks(RANKS), PATTERN)
    encoding = tiktoken_encoding()
    text = " ".join(["x" * 70, "lorem ipsum", "y" * 65]) * 50
    monkeypatch.setattr(byte_pairs, "WHOLE_CHARS", 10)
    monkeypatch.setattr(byte_pairs, "HELD_PIECES", 7)
    assert np.frombuffer(vocabulary.encode(text), "<u4").tolist() == encoding.encode_ordinary(text)
    memo = byte_pairs.Memo(lambda k: k * 2, limit=4)
    assert [memo[k] for k in (1, 2, 3, 1, 2, 3, 4, 5)] == [2, 4, 6, 2, 4, 6, 8, 10] and len(memo) + len(memo.older) <= 4
    with pytest.raises(ValueError, match="lacks a byte"):
        byte_pairs.BytePairs({b"a": 0}, ".+").encode("ab")


def test_byte_bpe_keeps_columns_and_empty(spark):
    docs = X.documents(spark, [(1, "one two"), (1, "one two"), (None, None)])
    got = byte_pairs.decode(byte_pairs.encode(docs, RANKS, PATTERN, keep=["doc_id", "key"]), RANKS, PATTERN)
    assert got.columns == ["doc_id", "key", "ids", "decoded"]
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in got.collect()) == [(0, b""), (1, b"one two"), (1, b"one two")]
    assert byte_pairs.encode(X.empty(spark), RANKS, PATTERN).collect() == []


# ---- op11


def plain_alignment(rows):
    """All figures by plain loops over the libraries' own tokens."""
    a_side = Tokenizer.from_file(JSON)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    decode = token_alignment.byte_of_character()
    out, counts = [], Counter()
    for doc, text in rows:
        a, b = [], []
        if text:
            a = [(i, bytes(decode[c] for c in a_side.id_to_token(i))) for i in
                 a_side.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode())
                 for i, p in ((i, b_side.id_to_piece(i)) for i in b_side.encode(text))]
            whole = (" " + text).encode()
            if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
                a, b = [], []
        spans = []
        for side in (a, b):
            at, side_spans = 0, []
            for i, t in side:
                side_spans.append((i, at, at + len(t)))
                at += len(t)
            spans.append(side_spans)
        links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = ["|".join(",".join(str(i) for i, s, e in side if at <= s and e <= end) for side in spans)
                  for at, end in zip([0, *ends], ends, strict=False)]
        counts.update(links)
        out.append((doc, len(a), len(b), len(groups), links, ";".join(groups)))
    highest = Counter()
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    return [(doc, n_a, n_b, g, len(links), sum(counts[p] == highest[p[1]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if n_a else "")
            for doc, n_a, n_b, g, links, text in out]


def short_rows():
    return [(d, t[:400] if t else t) for d, t in rows()]


@pytest.mark.parametrize("entries", [1, 300, 1 << 18])
def test_alignment_equals_plain_loops(spark, entries):
    got = token_alignment.link_counts(X.documents(spark, short_rows()), JSON, MODEL, entries_of_chunk=entries)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(plain_alignment(short_rows()), key=repr)


def test_alignment_query_and_empty(spark, tmp_path):
    folder = X.folder(spark, str(tmp_path), documents=X.documents(spark, rows()))
    got = {tuple(r) for r in Q.op11_token_alignment(spark, folder).collect()}
    assert len(got) >= len({*rows()}) - 2 and (402, 0, 0, 0, 0, 0, 0, "") in got
    assert token_alignment.link_counts(X.empty(spark), JSON, MODEL).collect() == []


def test_align_returns_tokens_groups_and_links(spark):
    text = "Überlappung 日本 of tokens"
    row, = token_alignment.align(X.documents(spark, [(7, text)]), JSON, MODEL).collect()
    a, b = (token_alignment.loaded(p)[0].token for p in (JSON, MODEL))
    assert b"".join(a[i] for i in row.a_ids) == b"".join(b[i] for i in row.b_ids) == (" " + text).encode()
    for g in range(max(row.a_group) + 1):
        assert (b"".join(a[i] for i, x in zip(row.a_ids, row.a_group, strict=True) if x == g)
                == b"".join(b[i] for i, x in zip(row.b_ids, row.b_group, strict=True) if x == g) != b"")
    assert {(row.a_group[i], ) for i in row.a_link} == {(g, ) for g in row.a_group} and len(row.a_link) == len(row.b_link)
    assert token_alignment.align(X.documents(spark, [(7, "▁")]), JSON, MODEL).collect()[0].a_ids == []


def test_ranks_and_own_library_give_the_same_ids():
    fast, slow = token_alignment.ByteLevel(JSON), Tokenizer.from_file(JSON)
    slow.encode_special_tokens = True
    texts = [t for _, t in rows() if t]
    assert [list(i) for i in fast.encode(texts)] == [e.ids for e in slow.encode_batch([" " + t for t in texts])]


# ---- op12


def plain_lloyd(vectors, k=16, rounds=3, dims=64, scale=64, seed=1):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in vectors
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [list(q) for _, q in order[:k]]

    def assign():
        out = []
        for _, q in kept:
            d = [sum((x - y) ** 2 for x, y in zip(q, c, strict=True)) for c in centroids]
            out.append((min(range(len(d)), key=lambda c: (d[c], c)), min(d)))
        return out
    for _ in range(rounds):
        at = assign() if kept else []
        for c in range(len(centroids)):
            mine = [q for (_, q), (x, _) in zip(kept, at, strict=True) if x == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    at = assign() if kept else []
    inertia = Counter()
    for c, d in at:
        inertia[c] += d
    return [(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
            for (i, _), (c, d) in zip(kept, at, strict=True)]


def vectors(n=300, dims=64, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=dims)]) for i in range(n)]
    rows += [(rows[3][0], rows[9][1])] * 3 + [(None, rows[4][1]), (900, rows[5][1])] + [(901 + k, rows[6][1]) for k in range(150)]
    rows += [(2000, None), (2001, []), (2002, rows[0][1][:-1]), (2003, [None, *rows[0][1][1:]]),
             (2004, [float("nan"), *rows[0][1][1:]]), (2005, [float("-inf"), *rows[0][1][1:]]), (2006, [-0.0, *rows[0][1][1:]]),
             (2007, [1e5, *rows[0][1][1:]])]
    return rows


@pytest.mark.parametrize("shards", [1, 3, 4, 100])
def test_lloyd_equals_plain_loops(spark, shards, monkeypatch):
    monkeypatch.setattr(sharded_lloyd, "BLOCK", 37)
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "0 AS rows", "0 AS q", "0 AS id", "0 AS shard").repartition(5)
    got = sharded_lloyd.Lloyd(frame, shards=shards).assigned()
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(plain_lloyd(rows), key=repr)


def test_lloyd_small_and_wide_inputs(spark):
    schema = "vec_id long, embedding array<float>"
    assert sharded_lloyd.Lloyd(spark.createDataFrame([], schema)).assigned().collect() == []
    few = [(k, [float(k)] * 3) for k in range(4)]
    got = sharded_lloyd.Lloyd(spark.createDataFrame(few, schema), dims=3, shards=2)
    assert got.centroids.shape == (4, 3) and {r.distance for r in got.assigned().collect()} == {0}
    with pytest.raises(Exception, match="beyond 2"):
        sharded_lloyd.Lloyd(spark.createDataFrame([(1, [1e9] * 3)], schema), dims=3).assigned().collect()


def test_lloyd_query_equals_sql(spark, tmp_path):
    rows = vectors(200, seed=8)
    frame = spark.createDataFrame([r for r in rows if r[0] is not None], "vec_id long, embedding array<float>").repartition(3)
    folder = X.folder(spark, str(tmp_path), embeddings=frame)
    assert X.collected(Q.op12_centroid_clustering(spark, folder)) == X.in_duckdb(
        folder, Q.ORACLE["op12_centroid_clustering"], "embeddings")
