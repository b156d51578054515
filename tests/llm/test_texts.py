"""HTML extraction, packing, near copies and repeated strings."""

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from genospark.llm import bm25_packing as P
from genospark.llm import html_extraction as X
from genospark.llm import ngram_jaccard as N
from genospark.llm import suffix_dedup as S
from tests.llm.fixtures import collected, documents, empty, messy_texts, words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><header>Site</header><div class="cookie-notice">We use cookies</div>
<div id="main"><div class="post post-17"><h1>A &amp; B</h1><p>First <b>bold</b>,
 text&nbsp;here.<p>Second &lt;p&gt; one &copy; 2024<br>goes on</p><aside>Related</aside><form><p>Name</p><input></form>
<ul><li>item one<li>item two</ul><!-- <p>hidden</p> --><table><tr><td>x</td><td>y</td></tr></table></div>
<div class="comments"><p>Nice post, a very long comment that says more than the post itself does, on and on and on, and
again on and on and on and on and on, and does not stop.</p></div></div>
<div class="sidebar"><p>Side</p></div><div class="ad">Buy</div><footer>&copy; me</footer></body></html>"""
TEXT = "A & B\nFirst bold, text here.\nSecond <p> one © 2024 goes on\nitem one\nitem two\nx\ny"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 as host", "2 as path", "3 as id", "4 as votes")


def test_extraction_of_a_page(spark):
    rows = [(1, "http://h.org/a", PAGE), (2, None, PAGE), (3, "http://h.org/b", None), (4, "http://h.org/c", ""),
            (5, "http://h.org/d", "no markup &am"), (6, "http://h.org/e", PAGE[:420]), (None, "x", "<p>loose</p>"),
            (7, "http://h.org/f", "<div><div class='post post-18'>short<div class='x'>inner</div></div>"
             "<p>much more text outside</p></div>"),
            (8, "http://h.org/g", PAGE.replace("17", "18"))]
    got = {r.page_id: r for r in X.extract_pages(pages(spark, rows)).collect()}
    assert got[1].text == got[2].text == got[8].text == TEXT and got[1].n_chars == len(TEXT)
    assert (got[3].text, got[4].text, got[3].n_chars) == ("", "", 0)
    assert got[5].text == "no markup &am" and got[None].text == "loose"
    assert got[7].text == "short\ninner"  # its host's path wins over its own best container
    assert got[6].text.startswith("A & B")


def test_extraction_odd_tables(spark):
    assert X.extract_pages(empty(spark, "page_id long, url string, html string")).count() == 0
    deep = "<div>" * 3000 + "<p>deep</p>"
    rows = [(i, "http://one.host/x", PAGE) for i in range(50)] + [(99, "http://two/", deep), (99, "http://two/", deep)]
    got = X.extract_pages(pages(spark, rows)).collect()
    assert len(got) == 52 and sum(r.text == "deep" for r in got) == 2


PARA, LI = "<p>" + "a sentence of the text. " * 5 + "</p>", "<li>" + "an item of the list. " * 9 + "</li>"


@pytest.mark.parametrize("article, end", [
    (f"<article><h1>Title</h1><p>Lead</p><div class=body>{PARA * 9}</div></article>", ""),
    (f"<article><h1>Title</h1><section class=a>{PARA * 2}</section><section class=b>{PARA * 9}</section></article>", ""),
    (f"<article><h1>Title</h1>{PARA}<ul>{LI * 9}</ul>{PARA}</article>", "<article class=next><p>Next</p></article>"),
    (f"<article><h1>Title</h1>{PARA}<table><tr><td>{PARA * 20}</td></tr></table></article>", ""),
    (f"<main><h1>Title</h1><p>Lead</p><div class=body>{PARA * 9}</div></main>", "<div><p>Beside</p></div>"),
    (f"<div class=post><h1>Title</h1><div class=body>{PARA * 9}</div><div class=rest>{PARA * 4}</div></div>",
     "<div class=teasers><p><a href=x>A link to another page</a></p></div>"),
    (f"<div class=post><h1>Title</h1>{PARA}<ol>{LI * 9}</ol></div>", "<article><p>Another</p></article>")])
def test_extraction_of_whole_articles(spark, article, end):
    page = f"<body><nav><a href=/>Home</a></nav>{article}{end}<footer>me</footer></body>"
    short = "<body><article><h1>Short</h1><p>only</p></article></body>"
    want = "\n".join(" ".join(x.split()) for x in X.re.sub("<[^>]+>", "\0", article).split("\0") if x.strip())
    rows = [(1, "http://h/1", page), (2, "http://h/2", page), (3, "http://h/3", short)]
    got = {r.page_id: r.text for r in X.extract_pages(pages(spark, rows)).collect()}
    assert got == {1: want, 2: want, 3: "Short\nonly"}


@pytest.mark.parametrize("around", [
    "<div class='layout with-sidebar'>{}</div>", "<main class='no-sidebar'>{}</main>", "<div class='has-ads'>{}</div>",
    "<article class='post comments-open'>{}</article>", "<div id='search-result-page'>{}</div>",
    "<form id=page><main>{}</main></form>", "<div class=widget><article>{}</article></div>", "<div id=search>{}</div>",
    "<div class=promo><h1>Title</h1>{}</div><div><p>Beside</p></div>"])
def test_extraction_keeps_what_only_sounds_beside_the_text(spark, around):
    body = f"{PARA * 3}<figure><img src=x><figcaption>Caption</figcaption></figure>{PARA}"
    page = ("<body><nav><p>Home</p></nav><div class=cookie-notice><p>Cookies</p></div>"
            + around.format(f"{body}<div class='ad-container'><p>Buy</p></div><p class=comments--open>Nice</p>")
            + "<div class='sidebar sidebar-left'><p>Side</p></div><footer>me</footer></body>")
    line = " ".join(PARA[3:-4].split())
    want = [*["Title"] * ("Title" in around), line, line, line, "Caption", line]
    (row,) = X.extract_pages(pages(spark, [(1, "http://h/1", page)])).collect()
    assert row.text.split("\n") == want


@pytest.mark.parametrize("page, want", [
    ('<div><p class="x"">text one</p><p>two</p></div>', "text one\ntwo"),
    ("<div><p title='don't'>text one</p><p>it's two</p></div>", "text one\nit's two"),
    ("<div><p title=\"never closed>text one</p><p>two</p></div>", "text one\ntwo"),
    ("<div><p a = 'b>c' data-x=y'z\" d>text one</p><p title=\"a class='ad' b\">two</p></div>", "text one\ntwo"),
    ("<p>one</p><a href=/?q=1&r='2'>link</a><p>two", "one\nlink\ntwo")])
def test_extraction_of_malformed_attributes(page, want):
    assert X.extract(page, None) == want


def test_a_form_around_the_page_is_not_beside_its_text():
    page = ("<body><form id=aspnetForm><input type=hidden><div class=nav><p>Home</p></div><div id=c>{}</div>"
            "<div class=footer>me</div></form>{}</body>")
    line = " ".join(PARA[3:-4].split())
    assert X.extract(page.format(PARA * 3, ""), None) == "\n".join([line] * 3)
    assert X.extract(page.format("<p>Your name</p><input>", f"<div>{PARA * 3}</div>"), None) == "\n".join([line] * 3)


@pytest.mark.parametrize("tag", ["nav", "div", "div class=ad", "b", "span class=x", "li", "form", "q><p"])
def test_deep_pages_take_linear_time(tag):
    def seconds(n):
        page = f"<{tag}>text " * n + "<p>deep" + "</b></q>" * n
        start = time.process_time()
        X.extract(page, X.voted(*X.blocks(page)))
        return time.process_time() - start
    assert seconds(40_000) < 1 + 12 * seconds(10_000)


def test_containers_beyond_the_depth_are_siblings():
    page = "<div>" * (X.DEPTH + 50) + "<p>one</p><p>two</p>" + "</div>" * 60 + "<p>three</p>"
    found, paths = X.blocks(page)
    assert [b.text for b in found] == ["one", "two", "three"] and max(paths.depths) == X.DEPTH


def test_of_tied_votes_the_first_path_wins(spark):
    def page(kind):
        other = "b" if kind == "a" else "a"
        return f"<div class={kind}>{PARA * 2}</div><div class={other}><p>short</p></div>"
    rows = [(1, "http://h/1", page("b")), (2, "http://h/2", page("a")), (3, "http://g/1", page("b"))]
    paths = {r.host: (r.path, r.votes, r.pages) for r in X.host_paths(
        pages(spark, rows).selectExpr("regexp_extract(url, '://([^/]*)', 1) as host", "html")).collect()}
    assert paths == {"h": (">div.a", 1, 2), "g": (">div.b", 1, 1)}
    got = {r.page_id: r.text for r in X.extract_pages(pages(spark, rows)).collect()}
    assert got[1] == "short" and got[2] == got[3] != "short"


def test_extraction_of_the_generated_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in X.extract_pages(df).collect()}
    for row in df.collect():
        article = row.html.split("<article>")[1].split("</article>")[0]
        for tag in ("h1", "p"):
            article = article.replace(f"<{tag}>", "\0").replace(f"</{tag}>", "\0")
        lines = (" ".join(X.html.unescape(x.replace("<b>", "").replace("<br>", "")).split()) for x in article.split("\0"))
        assert got[row.page_id] == "\n".join(x for x in lines if x)


def check_pieces(rows, pieces, windows_short):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = sorted((str(i), tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t in rows)
    by_id = {}
    for i, ids in want:
        by_id.setdefault(i, []).append(ids)
    for i, texts in by_id.items():
        own = sorted((p for p in pieces if str(p.doc_id) == i), key=lambda p: p.start)
        if len(texts) == 1:
            assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
            for p in own:
                ids = np.asarray(texts[0][p.start:p.start + p.length], "<u4")
                assert p.ids_crc32 == zlib.crc32(ids.tobytes()) and p.doc_tokens == len(texts[0])
        assert sum(p.length for p in own) == sum(map(len, texts))
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    assert max(sequences.values(), default=0) <= P.WINDOW
    assert sum(n < P.WINDOW for n in sequences.values()) <= windows_short


@pytest.mark.parametrize("shard_tokens", [P.SHARD_TOKENS, 6000])
def test_packing_round_trip(spark, shard_tokens):
    rows = messy_texts() + [(500 + i, t) for i, t in enumerate(
        ["it's 2024, isn't it?", "A.B,c;d <|endoftext|>, x", "tab\tand\x0bother\x0cspace\x85here", "“quoted”, é́ ñ", "'s't,'s"])]
    pieces = P.pack(documents(spark, rows), TOKENIZER, shard_tokens=shard_tokens).collect()
    check_pieces(rows, pieces, 1 if shard_tokens > 6000 else 60)


def test_packing_odd_tables(spark):
    assert P.pack(empty(spark), TOKENIZER).count() == 0
    check_pieces([(1, None)], P.pack(documents(spark, [(1, None)]), TOKENIZER).collect(), 1)


def test_a_window_takes_the_most_related_rests():
    rng = np.random.default_rng(5)
    topics = [rng.integers(100 * k, 100 * k + 100, (20, 1000)) for k in range(4)]
    rests = [r.astype(np.uint16) for t in zip(*topics, strict=True) for r in t]
    ids = np.concatenate(rests)
    frequency = np.bincount(np.concatenate([np.unique(r) for r in rests]), minlength=500)
    windows = list(P.pack_shard(rests, P.Terms(frequency, len(rests), len(ids), np.dtype(np.uint16))))
    alike = [len({at % 4 for at, *_ in w}) == 1 for w in windows]
    assert np.mean(alike) > 0.7


def test_every_token_of_a_seed_is_looked_up():
    shared = np.arange(1000, 1040, dtype=np.uint16)  # less telling than the seed's own tokens
    seed = np.concatenate((np.arange(100, 140, dtype=np.uint16), shared, np.full(1900, 7, np.uint16)))
    rests = [np.full(600, 9, np.uint16)] * 5 + [np.concatenate((shared, np.full(500, 8, np.uint16)))] * 3 + [seed]
    frequency = np.zeros(2000, np.int64)
    for r in rests:
        frequency[np.unique(r)] += 1
    terms = P.Terms(frequency, len(rests), sum(map(len, rests)), np.dtype(np.uint16))
    window = next(iter(P.pack_shard(rests, terms)))
    assert [at for at, *_ in window][:4] == [8, 5, 6, 7]


def test_shard_plan_splits_what_is_too_large():
    plan = P.shard_plan([(1, 5), (2, 5), (3, 35), (4, 5), (5, 6)], 10)
    assert plan == {1: (0, 1), 2: (0, 1), 3: (1, 4), 4: (5, 1), 5: (6, 1)}


def shingle_sets(rows):
    out = []
    for i, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        out.append((i, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    return out


def brute_components(sets):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            one, two = sets[a][1], sets[b][1]
            if one and two and 100 * len(one & two) >= 80 * len(one | two):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(sets)), key=repr)


def chains():
    """Edits of edits, far apart at the ends; a hub of many near copies that are not alike; subsets; ties."""
    rng = random.Random(8)
    rows, text = [], words(rng, 120, 5000).split()
    for i in range(30):
        text = list(text)
        text[(7 * i) % 120] = f"new{i}"
        rows.append((1000 + i, " ".join(text)))
    hub = words(rng, 150, 5000).split()
    for i in range(60):
        copy = list(hub)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(150)] = f"h{i}_{rng.random()}"
        rows.append((2000 + i, " ".join(copy)))
    rows += [(3000 + n, " ".join(hub[:n])) for n in range(100, 150, 3)]
    rows += [(4000 + i, f"{words(rng, 3)} Released under the MIT License of old") for i in range(40)]
    return rows


@pytest.mark.parametrize("shards", ["whole", "small"])
def test_near_copies(spark, monkeypatch, shards):
    if shards == "small":
        monkeypatch.setattr(N, "SHARD_SHINGLES", 500)
        monkeypatch.setattr(N, "FRAGMENT_SHINGLES", 1000)
        monkeypatch.setattr(N, "BUNDLE", 3)
    rows = messy_texts() + chains()
    got = N.near_copies(documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(shingle_sets(rows))


def test_all_links_between_sets(spark):
    rows = [(k, t) for k, (_, t) in enumerate(messy_texts() + chains())]
    docs = documents(spark, rows)
    ids = {r.doc_id: r.set_id for r in N.near_copies(docs).collect()}
    sets = {ids[i]: s for i, s in shingle_sets(rows) if s}
    want = {(a, b) for a in sets for b in sets
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    got = [(r.set_u, r.set_v) for r in N.all_links(docs).collect()]
    assert len(got) == len(want) and set(got) == want and len(want) > 500
    assert N.all_links(empty(spark)).count() == 0


def test_near_copies_odd_tables(spark):
    assert N.near_copies(empty(spark)).count() == 0
    rows = [(1, None), (2, ""), (3, " ")]
    assert collected(N.near_copies(documents(spark, rows)).select("doc_id", "component_id")) == [(1, 1), (2, 2), (3, 3)] or (
        {r.doc_id: r.component_id for r in N.near_copies(documents(spark, rows)).collect()} == {1: 1, 2: 2, 3: 3})


def brute_repeats(rows):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    for k in order:
        raw = (rows[k][1] or "").encode()
        edge = np.zeros(len(raw) + 1, int)
        for t in range(len(raw) - 99):
            w = raw[t:t + 100]
            if w in seen:
                edge[t] += 1
                edge[t + 100] -= 1
            seen.add(w)
        gone = np.cumsum(edge[:-1]) > 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int(np.sum(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        out.append((rows[k][0], len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket, group", [(1_000_000, 20_000), (40, 3), (1_000_000, 3)])
def test_repeated_strings(spark, monkeypatch, bucket, group):
    monkeypatch.setattr(S, "BUCKET_ENTRIES", bucket)
    monkeypatch.setattr(S, "GROUP_RUNS", group)
    monkeypatch.setattr(S, "BUCKET_RUNS", 2 * group)
    rng = random.Random(9)
    passages = [words(rng, 40) for _ in range(3)]
    rows = messy_texts() + [(5000 + i, words(rng, i % 7) + rng.choice(passages)[i % 50:] + words(rng, 9)) for i in range(60)]
    rows += [(6000, "ab" * 400), (6001, "a" * 99), (6002, "a" * 100), (6003, "a" * 101), (6004, "é" * 130)]
    got = S.remove_repeats(documents(spark, rows))
    assert sorted(map(tuple, got.drop("kept").collect()), key=repr) == brute_repeats(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got.collect())


def test_repeated_strings_of_an_empty_table(spark):
    assert S.remove_repeats(empty(spark)).count() == 0


def test_counters_stop_at_255_in_any_number_of_steps(monkeypatch):
    """A shingle that comes more often than two bytes count, added in few or many steps: 255, the others as often as they come."""
    texts = pa.RecordBatch.from_arrays([pa.array(["a b c d e " * 20_000, "a b c d e f", None, "x y"])], names=["text"])

    def counts():
        (out,) = N._count(1 << 16)(iter([texts]))
        return np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(c), np.uint8)
                               for c in out.column(1).to_pylist()])
    whole = counts()
    assert whole.max() == 255 and sorted(set(whole.tolist())) == [0, 1, 255]
    monkeypatch.setattr(N, "ADDED", 7)
    assert (counts() == whole).all()


def test_frequencies_count_each_id_once_in_a_rest():
    rests = [np.array([5, 5, 1, 5], np.uint16), np.array([1], np.uint16), np.array([9, 5, 9], np.uint16)]
    batch = pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rests], pa.binary())], names=["rest"])
    (out,) = P._frequencies(10, np.dtype(np.uint16))(iter([batch]))
    assert dict(zip(*(c.to_pylist() for c in out.columns))) == {1: 2, 5: 2, 9: 1, 10: 3, 11: 8}


def test_no_task_of_near_copies_has_two_python_workers(spark, monkeypatch):
    """Two functions of one stage have a worker each, and both stay beside the next stages' work."""
    frame = type(spark.range(0))
    plain = frame.mapInArrow

    def checked(self, *args, **options):
        assert self._jdf.queryExecution().analyzed().nodeName() != "MapInArrow"
        return plain(self, *args, **options)
    monkeypatch.setattr(frame, "mapInArrow", checked)
    rows = [(i, "one two three four five six" + " seven" * (i % 3)) for i in range(6)]
    assert {r.component_id for r in N.near_copies(documents(spark, rows)).collect()} == {0, 1, 2}


def test_packing_starts_no_other_kind_of_workers(spark):
    plan = P.pack(documents(spark, [(1, "a b c"), (2, "a b")]), TOKENIZER)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ExistingRDD" not in plan


def test_words_are_encoded_by_the_task_alone(monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    P.WordCache(TOKENIZER)
    assert P.os.environ["TOKENIZERS_PARALLELISM"] == "false"


@pytest.mark.parametrize("bits,cached", [(1, 4), (2, 40), (19, 2_000_000)])
def test_words_that_share_a_place(monkeypatch, bits, cached):
    """Ids are right if words push each other out, and after the cache's older half went."""
    monkeypatch.setattr(P, "PLACE_BITS", bits)
    monkeypatch.setattr(P, "CACHED_WORDS", cached)
    monkeypatch.setattr(P, "_caches", {})
    tokenizer, rng = Tokenizer.from_file(TOKENIZER), random.Random(8)
    for _ in range(6):
        texts = [" ".join(words(rng, rng.randrange(30))) if k % 2 else words(rng, 12) for k in range(8)]
        data = [t.encode() for t in texts]
        ids, first = P.encode_texts(TOKENIZER, np.frombuffer(b"".join(data), np.uint8),
                                    np.cumsum([0, *map(len, data)]))
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [
            [*tokenizer.encode(t, add_special_tokens=False).ids, P.END_ID] for t in texts]


def test_a_place_is_filled_by_the_words_of_all_zeros_and_ones():
    places, odd = P.Places(), np.asarray([0, 2**64 - 1], np.uint64)
    assert not (places.words[places.of(odd)] == odd).any()
    places.put(odd, np.asarray([5, 6]), np.asarray([1, 2]))
    assert places.first[places.of(odd)].tolist() == [5, 6] and places.size[places.of(odd)].tolist() == [1, 2]
