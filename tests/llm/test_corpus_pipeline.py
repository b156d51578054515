"""The pipeline, stage by stage, against what each operator and brute force say."""

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline as C
from genospark.llm import textarrays as T
from genospark.llm.bm25_packing import pack
from genospark.llm.decontamination import build_index
from genospark.session import stored
from tests.llm.fixtures import CLASHING, documents, folder, messy_texts, words
from tests.llm.test_texts import brute_components, check_pieces, shingle_sets

import random


def tables(spark, path, rows):
    rng = random.Random(1)
    labels = [(i, 1) for i in range(20)]
    items = [(0, words(rng, 3)), (1, " ".join(rows[20][1].split()[:15]) if rows else "none"), (2, None)]
    return folder(spark, path, documents=documents(spark, rows),
                  labels=spark.createDataFrame(labels, "doc_id long, quality int"),
                  benchmark=spark.createDataFrame(items, "item_id long, text string"))


def test_stages(spark, tmp_path):
    rows = messy_texts()
    path = tables(spark, str(tmp_path), rows)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    after = {}
    for name, stage in C.STAGES:
        docs = stored(stage(spark, docs, path), name)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", *CLASHING]
            after[name] = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(repr, after["quality"])) == sorted(map(repr, rows))  # no bad label: all stay
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert sorted((-1 if i is None else i, t or "") for i, t in after["exact_dedup"]) == sorted(
        (i, t) for t, i in best.items())
    sets = shingle_sets(after["exact_dedup"])
    stay = {i for i, _, c in brute_components(sets) if i == c}
    assert {i for i, _ in after["near_copies"]} == stay
    assert rows[20][0] not in {i for i, _ in after["decontamination"]}
    gone = stay - {i for i, _ in after["decontamination"]}
    windows = {tuple(rows[20][1].split()[k:k + 10]) for k in range(6)}
    for i, t in after["near_copies"]:
        w = (t or "").split()
        hit = any(tuple(w[k:k + 10]) in windows for k in range(len(w)))
        assert not hit or i in gone
    check_pieces(after["decontamination"], docs.collect(), 1)


def test_exact_stage_when_the_second_scan_is_split_otherwise(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i % 300}") for i in range(400)]
    docs = spark.read.parquet(f"{folder(spark, str(tmp_path), documents=documents(spark, rows))}/documents.parquet")
    judge, size = C.exact_dedup, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)

    def judge_then_split(*args, **options):
        found = judge(*args, **options)
        spark.conf.set(size, "300")  # as if the number of cores had changed
        return found

    monkeypatch.setattr(C, "exact_dedup", judge_then_split)
    try:
        for frame in (docs, docs.where("doc_id >= 0")):  # a table, and a frame over one
            spark.conf.set(size, before)
            got = C.exact(spark, frame, "").collect()
            assert sorted(r.doc_id for r in got) == list(range(100, 400))
    finally:
        spark.conf.set(size, before)


def test_one_bad_row_among_clean_ones_that_share_its_id(spark, tmp_path):
    rng = random.Random(3)
    clean = [words(rng, 40, 100_000) for _ in range(8)]
    near = [words(rng, 60, 100_000) for _ in range(3)]
    leak = words(rng, 30, 100_000)
    rows = [(None, t) for t in clean[:4]] + [(7, t) for t in clean[4:]]
    rows += [(None, near[0]), (3, near[0] + " end"),  # a near copy without id, among clean rows without id
             (7, near[1]), (7, near[1] + " end"),  # near copies that share an id
             (None, near[2]), (None, near[2] + " end"),  # near copies without id
             (None, f"{words(rng, 30, 100_000)} {leak}"), (7, f"{leak} {words(rng, 30, 100_000)}"), (8, "x"), (8, "y"), (None, None)]
    path = folder(spark, str(tmp_path), documents=documents(spark, rows), benchmark=spark.createDataFrame(
        [(1, leak)], "item_id long, text string"))
    docs = spark.read.parquet(f"{path}/documents.parquet")

    got = [(r.doc_id, r.text) for r in C.near(spark, docs, path).collect()]
    assert (3, near[0] + " end") in got and (None, near[0]) not in got
    for i, t in ((7, near[1]), (None, near[2])):
        assert sum(r in ((i, t), (i, t + " end")) for r in got) == 1
    assert len(got) == len(rows) - 3 and set(rows[:8]) <= set(got)

    got = [(r.doc_id, r.text) for r in C.decontamination(spark, docs, path).collect()]
    assert sorted(got, key=repr) == sorted((r for r in rows if leak not in (r[1] or "")), key=repr)


def test_run_on_generated_documents(spark):
    sf = "/root/testdata/sf0.001"
    pieces = C.run(spark, sf)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = pieces.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check_pieces([(i, texts[i]) for i in {r.doc_id for r in rows}], rows, 1)
    assert len({r.doc_id for r in rows}) > 100


def test_run_on_an_empty_table(spark, tmp_path):
    assert C.run(spark, tables(spark, str(tmp_path), [])).count() == 0


def test_rows_are_numbered_without_another_kind_of_workers(spark, tmp_path):
    path = folder(spark, str(tmp_path), documents=documents(spark, messy_texts()))
    rows = C.numbered(spark.read.parquet(f"{path}/documents.parquet"))
    assert "ExistingRDD" not in rows._jdf.queryExecution().executedPlan().toString()
    numbers = [r[0] for r in rows.select(C._ROW).collect()]
    assert len(numbers) == len(set(numbers)) == len(messy_texts())


def test_memory_of_intermediates(spark):
    """Rows of megabytes are not one page of a whole file, and the stages' batches and workers hold little."""
    chunk = F.expr("cast(concat_ws('', transform(sequence(1, 16000), x -> sha2(concat(id, '-', x), 256))) as binary)")
    rows = spark.range(0, 40, numPartitions=1).select("id", chunk.alias("data"))
    table = stored(rows, "large-rows")
    files = [pq.ParquetFile(f[len("file:"):].replace("///", "/")).metadata for f in table.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 40 and max(g.total_byte_size for g in groups) <= 20 << 20
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, docs = spark.conf.get(key), documents(spark, messy_texts(), clashing=False)
    try:
        for use in (build_index, lambda d: pack(d, public_tokenizers.path("word_bpe_49k.json"))):
            spark.conf.set(key, 256 << 20)
            use(docs)
            assert int(spark.conf.get(key)) == T.SMALL_BATCH_BYTES
    finally:
        spark.conf.set(key, before)
    T.SpanHash(np.zeros(5 << 20, np.uint8))
    T.give_back()
    assert len(T._POWERS.up) == len(T._POWERS.down) == 1
