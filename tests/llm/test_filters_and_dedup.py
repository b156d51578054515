"""URL filters, decontamination and exact dedup against DuckDB on awkward rows."""

import gc
import random
import weakref

import pyarrow as pa
import pytest

from genospark.llm import decontamination as D
from genospark.llm import exact_dedup, queries, url_filters
from genospark.session import scratch_path
from tests.llm.fixtures import collected, documents, empty, folder, in_duckdb, messy_texts, words


def test_url_filters(spark, tmp_path):
    urls = ["http://example.org/es/1", "https://www.Example.ORG/en/12?x#y", "http://example.org/en/2", "http://a.com/fr/",
            "http://a.com/fr", "http://b.com/de/x#/fr/", "http://com/de/", "http://notexample.org/es/2", "org/es/",
            "http://x.net/", "http://", "://org/", "http://org?a", None, "", "http://example.org:80/es/", "ftp://a.b.com/de/?q",
            "http://sub.sub.example.org/es/"] * 3 + ["http://hot.example.org/es/9"] * 200
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(4)
    pages = pages.selectExpr("*", "'x' as host", "'y' as path", "1 as row", "'z' as rule", "2 as bucket", "3 as key")
    path = folder(spark, str(tmp_path), pages=pages)
    got = collected(queries.op1_url_filters(spark, path))
    assert got == in_duckdb(path, url_filters.ORACLE_SQL, "pages")


def test_url_filters_many_nested_rules(spark):
    """Against every rule in turn; small buckets, so that rules reach over boundaries."""
    rng = random.Random(4)
    hosts = ["a.com", "b.a.com", "com", "c.b.a.com", "net", "x.net"]
    paths = ["/", "/p", "/p/q", "/p/q/r", "/z"]
    rules = list({(rng.choice(hosts), rng.choice(paths)): rng.choice(["allow", "block"]) for _ in range(40)}.items())
    urls = [f"http://{rng.choice(['', 'd.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '/p', '/q/r', 's'])}"
            for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rule_df = spark.createDataFrame([(h, p, v) for (h, p), v in rules], "host string, path string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.judge_urls(df, rule_df, buckets=13).collect()}
    for i, u in enumerate(urls):
        host, _, rest = u[7:].partition("/")
        fits = [(len(h + p), len(h), h + p, v) for (h, p), v in rules
                if (host == h or host.endswith("." + h)) and ("/" + rest).startswith(p)]
        assert got[i] == (max(fits)[2:] if fits else (None, "allow")), u


def test_url_filters_empty(spark):
    rules = spark.createDataFrame(url_filters.RULES, "host string, path string, verdict string")
    pages = empty(spark, "page_id long, url string")
    assert url_filters.judge_urls(pages, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/")], pages.schema)
    assert url_filters.judge_urls(one, rules.limit(0)).first().rule is None


def benchmark(spark):
    rng = random.Random(1)
    texts = [t for _, t in messy_texts()]
    items = [texts[1], " ".join(texts[3].split()[:4]), words(rng, 30), "", None, "x", "ONE two!", texts[5] + " tail",
             "déjà VU ß", texts[1]]
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string").selectExpr("*", "1 as phrase_id")


def test_decontamination(spark, tmp_path):
    rows = [r for r in messy_texts() if r[0] is not None][:-1]
    path = folder(spark, str(tmp_path), documents=documents(spark, rows), benchmark=benchmark(spark))
    want = in_duckdb(path, D.ORACLE_SQL, "documents", "benchmark")
    assert collected(queries.op2_benchmark_decontamination(spark, path)) == want


def test_decontamination_in_blocks_and_segments(spark, tmp_path, monkeypatch):
    rows = [r for r in messy_texts() if r[0] is not None][:-1]
    path = folder(spark, str(tmp_path), documents=documents(spark, rows), benchmark=benchmark(spark))
    whole = collected(queries.op2_benchmark_decontamination(spark, path))
    monkeypatch.setattr(D, "BLOCK", 7)
    assert collected(queries.op2_benchmark_decontamination(spark, path)) == whole


def test_decontamination_holds_one_block_of_phrases(spark, monkeypatch):
    made, alive, phrases = weakref.WeakSet(), [], D.Phrases

    def watched(ids, keys):
        gc.collect()
        alive.append(len(made))
        block = phrases(ids, keys)
        made.add(block)
        return block

    monkeypatch.setattr(D, "BLOCK", 7)
    monkeypatch.setattr(D, "Phrases", watched)
    out = D.decontaminate(documents(spark, messy_texts()), benchmark(spark))
    assert out.count() == len(messy_texts()) and len(alive) > 3 and set(alive) == {0}


def test_decontamination_odd_tables(spark):
    items = benchmark(spark)
    assert D.decontaminate(empty(spark), items).count() == 0
    docs = documents(spark, messy_texts())
    out = D.decontaminate(docs, empty(spark, "item_id long, text string")).collect()
    assert len(out) == len(messy_texts()) and not any(r.contaminated or r.n_items for r in out)
    assert D.decontaminate(docs, items).count() == len(messy_texts())


def test_near_matches(spark):
    """All terms within the phrase's length and two words more, in any order."""
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 40)))) for i in range(40)]
    items = [(0, "a b c"), (1, "c h"), (2, "g f e d")]
    index = D.build_index(documents(spark, docs))
    phrases, item_phrases = D.phrase_table(spark.createDataFrame(items, "item_id long, text string"))
    got = D.find_matches(index, phrases, D.near_matches(2)).join(item_phrases, "phrase_id").select("doc_id", "item_id")
    want = {(d, i) for d, text in docs for i, item in items
            if any(set(item.split()) <= set(text.split()[s:s + len(item.split()) + 2]) for s in range(len(text.split())))}
    assert {tuple(r) for r in got.distinct().collect()} == want
    spans = D.find_matches(index, phrases).join(item_phrases, "phrase_id").collect()
    texts, terms = dict(docs), dict(items)
    assert spans and all(texts[r.doc_id].split()[r.start:r.end] == terms[r.item_id].split() for r in spans)


def test_exact_dedup(spark, tmp_path):
    rows = [r for r in messy_texts() if r[0] is not None][:-1] + [(1000 + i, "hot") for i in range(500)]
    path = folder(spark, str(tmp_path), documents=documents(spark, rows))
    want = in_duckdb(path, exact_dedup.ORACLE_SQL, "documents")
    assert collected(queries.op4_exact_dedup(spark, path)) == want


def test_exact_dedup_odd_rows(spark):
    out = exact_dedup.exact_dedup(documents(spark, messy_texts())).collect()
    assert len(out) == len(messy_texts())
    kept = [r.text_sha256 for r in out if r.kept]
    assert len(kept) == len(set(kept)) == len({t or "" for _, t in messy_texts()})
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_digest_index_goes_on(spark):
    path = scratch_path(spark, "index")
    index = exact_dedup.DigestIndex(spark, path, "kept_digests", buckets=3)
    first = index.add(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string"))
    assert {(r.doc_id, r.keep_id, r.kept) for r in first.collect()} == {(1, 3, False), (2, 2, True), (3, 3, True)}
    again = exact_dedup.DigestIndex(spark, path, "kept_digests", buckets=3)
    second = again.add(spark.createDataFrame([(9, "a"), (10, "c"), (11, None)], "doc_id long, text string"))
    assert {(r.doc_id, r.keep_id, r.kept) for r in second.collect()} == {(9, 3, False), (10, 10, True), (11, 11, True)}
    assert again.rows().count() == 4
    plan = again.rows()._jdf.queryExecution().toString()
    assert "kept_digests" in plan
    assert spark.sql("DESCRIBE EXTENDED kept_digests").where("col_name = 'Num Buckets'").first().data_type == "3"


def index_of(spark, path, table, partitions, buckets=None):
    """The index as a session with an empty catalog and other settings opens it."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        return exact_dedup.DigestIndex(spark, path, table, buckets)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_index_keeps_its_number_of_buckets(spark, tmp_path):
    path, texts = str(tmp_path / "index"), [(k, f"text {k}") for k in range(40)]
    index = index_of(spark, path, "own_buckets", "4")
    assert index.buckets == 4 and sum(r.kept for r in index.add(documents(spark, texts)).collect()) == 40
    again = index_of(spark, path, "own_buckets", "7")
    assert again.buckets == 4
    got = again.add(documents(spark, [(k + 100, t) for k, t in texts] + [(7, "new")])).collect()
    assert [(r.doc_id, r.keep_id) for r in got if r.kept] == [(7, 7)] and again.rows().count() == 41
    assert {r.keep_id for r in got if not r.kept} == set(range(40))
    with pytest.raises(ValueError, match="has 4 buckets"):
        index_of(spark, path, "own_buckets", "4", buckets=5)
    spark.sql("DROP TABLE IF EXISTS own_buckets")


def test_rows_given_again_are_not_kept_again(spark, tmp_path):
    """Same ids and null ids in later batches."""
    rows = [(1, "a"), (2, "b"), (None, "c"), (None, None)]
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), "given_again", buckets=3)
    assert sum(r.kept for r in index.add(documents(spark, rows)).collect()) == 4
    for batch in (rows, rows + rows, [(2, "a"), (1, "b"), (3, "c")]):
        got = index.add(documents(spark, batch)).collect()
        assert len(got) == len(batch) and not any(r.kept for r in got)
    assert index.rows().count() == 4
    spark.sql("DROP TABLE given_again")


def test_decontamination_gives_memory_back(monkeypatch):
    """Workers are used again: what a task leaves in them stands beside the next stage's needs."""
    given = []
    monkeypatch.setattr(D.T, "give_back", lambda: given.append(1))
    texts = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([" ".join("abcdefghijklm")])], names=["doc_id", "text"])
    (row,) = D._index(iter([texts]))
    (windows,) = D._windows(10)(iter([texts]))
    phrases = D.Phrases(list(range(windows.num_rows)), windows.column(1).to_pylist())
    for task in (D._hits, D._matches):
        assert sum(b.num_rows for b in task(D.exact_matches, phrases)(iter([row]))) in (1, 4)
    assert len(given) == 4
