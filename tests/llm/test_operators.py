"""Each operator against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from plumbline.llm import bpe, exact_dedup, html_text, mixing, near_dedup, pitman_yor, simhash, token_counts, topk_search, toxicity, warc
from plumbline.llm.common import bucketed, remainder
from plumbline.llm.components import components

SF = "/root/testdata/sf0.001"
LONG = "alpha beta gamma delta " * 5000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens int, fingerprint string, row string, score string, `kept` string, `a.b` int"
ROWS = [
    (1, "Hello  world again my friend", "en", "b", 5, 1, "x", "r", "s", "k", 1),
    (2, "Hello world\tagain my friend", "en", "b", 5, 1, "x", "r", "s", "k", 1),
    (2, "Hello world\tagain my friend", "en", "b", 5, 1, "x", "r", "s", "k", 1),
    (3, None, None, None, None, None, None, None, None, None, None),
    (4, "", "en", "a", 0, 1, "x", "r", "s", "k", 1),
    (5, " \t\n", "en", "a", 0, 1, "x", "r", "s", "k", 1),
    (None, "an id is missing here", "en", None, 0, 1, "x", "r", "s", "k", 1),
    (None, "an id is missing here", "en", None, 0, 1, "x", "r", "s", "k", 1),
    (7, LONG, "en", "c", 0, 1, "x", "r", "s", "k", 1),
    (8, "<|endoftext|> ΑΣ É á 100% 'll", "en", "c", 0, 1, "x", "r", "s", "k", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def bits(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def test_simhash_against_brute_force(corpus):
    got = {r.doc_id: r for r in simhash.near_classes(corpus, carry=["doc_id"]).collect()}
    texts = {r.doc_id: r.text for r in corpus.collect()}
    fp = {i: bits(t) for i, t in texts.items()}
    assert {i: f"{x:016x}" for i, x in fp.items()} == {i: r.fingerprint for i, r in got.items()}
    root = {i: i for i in fp}
    for i in fp:
        for j in fp:
            if (fp[i] ^ fp[j]).bit_count() <= 4 and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    assert root == {i: r.component_id for i, r in got.items()}


def test_simhash_edges(docs, none):
    got = simhash.near_classes(docs)
    assert "a.b" in got.columns and got.columns.count("fingerprint") == 1
    rows = got.collect()
    assert len(rows) == len(ROWS)
    blank = [r for r in rows if r.doc_id in (3, 4, 5)]
    assert {(r.fingerprint, r.component_id) for r in blank} == {("0" * 16, 3)}
    assert sorted(str(r.doc_id) for r in simhash.representatives(docs).collect()) == ["1", "3", "7", "8", "None"]
    assert simhash.representatives(none).count() == 0
    assert simhash.representatives(docs).columns == docs.columns


def test_blocks_that_are_dealt_out_lose_no_link(spark):
    rng = np.random.default_rng(3)
    fps = {0x1234567890ABCDEF}
    while len(fps) < 400:
        x = list(fps)[rng.integers(len(fps))]
        fps.add(x ^ 1 << int(rng.integers(63)) ^ 1 << int(rng.integers(20)))
    fps = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    whole = components(simhash.links(df)).groupBy("root").count().collect()
    dealt = components(simhash.links(df, block=16)).groupBy("root").count().collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, dealt))
    found = set()
    u = np.array(sorted(fps)).view(np.uint64)
    for a, b in simhash.within(u, np.zeros(len(u), int)):
        found |= set(zip(a.tolist(), b.tolist(), strict=True))
    assert found == {(i, j) for i in range(len(u)) for j in range(i + 1, len(u)) if int(u[i] ^ u[j]).bit_count() <= 4}


def test_near_copies_go_and_others_stay(spark):
    rng = np.random.default_rng(11)
    texts = []
    for i in range(60):
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        texts.append(words)
        for changes in (1, 3, 5, 6, 12, 25):
            copy = list(words)
            for at in rng.choice(300, changes, replace=False):
                copy[at] = f"x{rng.integers(1 << 40)}"
            texts.append(copy)
    rows = [(int(i), " ".join(t)) for i, t in zip(rng.permutation(len(texts)), texts)] + [(None, rows_) for rows_ in (" ".join(texts[0]), "", " ")]
    kept = {r.doc_id for r in near_dedup.without_near(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: {" ".join(t.split()[k:k + 5]) for k in range(max(1, len(t.split()) - 4))} for i, t in rows if i is not None}
    near = {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    hit = {j for _, j in near}
    assert len(hit) > 150 and sum(len(sets[i] & sets[j]) < 0.9 * len(sets[i] | sets[j]) for i, j in near) > 50
    assert kept - {None} <= set(sets) and set(sets) - kept <= hit and len(hit & kept) <= 0.02 * len(hit)
    assert None in kept


def test_texts_alike_but_not_near_make_few_pairs(spark, monkeypatch):
    """A large group that shares blocks: only pairs within the radius of the SimHash become rows, and none that is near is lost."""
    rng = np.random.default_rng(5)
    base, rows = [f"w{x}" for x in rng.integers(0, 5000, 200)], []
    for i in range(240):
        words = list(base)
        for at in rng.choice(200, (2, 10, 11, 12, 13, 14)[i % 6], replace=False):
            words[at] = f"x{rng.integers(1 << 40)}"
        rows.append((i, " ".join(words)))
    rows += [(240 + i, " ".join(f"s{j}" for j in range(i % 3, 6 + i % 4))) for i in range(24)]
    sets = {i: near_dedup.shingles(t.encode()) for i, t in rows}
    near = {(i, j) for i in sets for j in sets if i < j and near_dedup.similar(sets[i], sets[j])}
    bits = {i: simhash.long_fingerprint(near_dedup.hashes(x), near_dedup.WORDS).view(np.uint8) for i, x in sets.items()}
    for i, j in near:
        most = near_dedup.RADIUS if min(len(sets[i]), len(sets[j])) >= near_dedup.FEW else near_dedup.WIDE
        assert np.unpackbits(bits[i] ^ bits[j]).sum() <= most
    seen, plain = [], near_dedup._near

    def counted(pairs, texts):
        seen.append(pairs.count())
        return plain(pairs, texts)

    monkeypatch.setattr(near_dedup, "_near", counted)
    kept = {r.doc_id for r in near_dedup.without_near(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = {j for _, j in near}
    assert set(sets) - kept <= hit and len(hit & kept) <= 0.02 * len(hit)
    assert not any(i in kept and j in kept for i, j in near)
    group = [i for i in kept if i < 240]
    assert len(group) > 100 and sum(seen) < 0.2 * len(group) ** 2 / 2


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[1000 + i] == 1000 for i in range(1, 50))


def test_bpe_equals_the_library(spark, docs, none, corpus):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    for df in (docs, corpus):
        for r in bpe.encoded(df, path, carry=["doc_id", "text"]).collect():
            ids = t.encode(r.text or "", add_special_tokens=False).ids
            assert r.ids == ids and r.decoded == t.decode(ids, skip_special_tokens=False)
    digest = bpe.digests(bpe.encoded(docs.filter("doc_id = 8"), path), "doc_id").first()
    ids = t.encode(ROWS[-1][1], add_special_tokens=False).ids
    assert digest.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and digest.n_tokens == len(ids)
    assert bpe.encoded(none, path).count() == 0


def test_counts_equal_the_library(docs, none, corpus):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    for df in (docs, corpus):
        texts = Counter((r.doc_id, len((r.text or "").encode()), len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect())
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.counted(df, path).collect()) == texts
    assert token_counts.counted(none, path).count() == 0
    text = "a  b c\n d 'e <|endoftext|> f " * 50
    parts = token_counts.parts(text, 7)
    assert "".join(parts) == text and sum(token_counts.lengths(parts, path)) == token_counts.lengths([text], path)[0]


def test_counts_of_long_runs_without_a_safe_boundary(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = ["a" + " " * 1_200_000 + "b", "a" + "\n" * 1_200_000 + "b", " " * 1_200_000, "x y " * 50_000 + "  " * 600_000 + "end <|endoftext|>"]
    got = token_counts.counted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}


def test_mixture_comes_near_its_targets(corpus):
    rows = mixing.mixture(corpus, carry=["doc_id", "source"]).collect()
    assert len(rows) == corpus.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    total = sum(r.size for r in rows)
    targets = {r.source: (r.target, r.source_size) for r in rows}
    assert math.isclose(sum(t for t, _ in targets.values()), total) and all(t <= 3 * s for t, s in targets.values())
    for source, (target, _) in targets.items():
        assert abs(sum(r.taken for r in rows if r.source == source) - target) <= 0.05 * target + 16
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in mixing.mixture(corpus.repartition(5), carry=["doc_id"]).collect()}


def test_mixed_rows_have_the_words_of_the_targets(spark):
    words = {"a": 4000, "b": 3000, "c": 20, "d": 50, "e": 2000}
    rows = [(i, "w " * (5 + i % 7), s) for s, n in words.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = {r.source: (r.target, r.source_size) for r in mixing.mixture(df).select("source", "target", "source_size").distinct().collect()}
    mix = mixing.mixed(df)
    got = {r.source: r.n for r in mix.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")).collect()}
    assert any(t > 1.5 * n for t, n in target.values()) and any(t < 0.9 * n for t, n in target.values())
    for s, (t, n) in target.items():
        assert abs(got.get(s, 0) - t) <= 0.04 * t + 60
    assert mix.groupBy("source", "doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert sorted(map(tuple, mix.collect())) == sorted(map(tuple, mixing.mixed(df.repartition(5)).collect()))


def test_sainte_lague_against_all_quotients(spark):
    votes = {h: [(h * 37 + i * i * 11) % 97 + (i % 3) / 2 for i in range(9)] for h in range(6)}
    parties = spark.createDataFrame([(h, i, float(v)) for h, vs in votes.items() for i, v in enumerate(vs)], "h int, i int, v double")
    got = mixing.sainte_lague(parties.withColumn("s", F.col("h") * 7 + 3), "h", "v", F.col("s"), "i").collect()
    for h, vs in votes.items():
        quotients = sorted((-v / (2 * k + 1), i, k) for i, v in enumerate(vs) if v for k in range(80))[:h * 7 + 3]
        seats = Counter(i for _, i, _ in quotients)
        assert {r.i: r.quota for r in got if r.h == h} == {i: seats[i] for i in range(9)}


def test_mixture_edges(docs, none):
    rows = mixing.mixture(docs).collect()
    assert len(rows) == len(ROWS) and {r["size"] for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert mixing.mixture(none).count() == 0 and mixing.mixed(docs).columns == docs.columns


def test_exact_classes_edges(docs, none):
    rows = exact_dedup.exact_classes(docs).collect()
    by = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows]
    assert sorted(x for x in by if x[0] in (1, 2)) == [(1, 1, 3, True), (2, 1, 3, False), (2, 1, 3, False)]
    assert sorted((x for x in by if x[0] in (3, 4)), key=str) == [(3, 3, 2, True), (4, 3, 2, False)]
    assert sorted(x[3] for x in by if x[0] is None) == [False, True]
    assert exact_dedup.exact_classes(none).count() == 0
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    blank = next(r for r in rows if r.doc_id == 5)
    assert blank.text_sha256 == hashlib.sha256(b" ").hexdigest() and blank.kept


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = [rng.normal(size=12).tolist() for _ in range(300)]
    x += [x[0]] * 60 + [[0.0] * 12] * 40 + [[1.0, None] + [0.0] * 10, [math.inf] * 12, None, [], [0.5, 0.25]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)] + [(None, x[1]), (4, x[4])], "vec_id long, embedding array<double>")
    v = topk_search.whole_numbers(df, "vec_id", "embedding")
    got = topk_search.top_k(v, v.filter("id % 20 = 0"), shard=60, block=7).collect()
    whole = {i: [math.floor(64 * c) for c in e] for i, e in enumerate(x) if e is not None and all(c is not None and math.isfinite(c) for c in e)}
    want = set()
    for q in whole:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], e)), i) for i, e in whole.items() if i != q and len(e) == len(whole[q]))
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:20])}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk_search.top_k(v.limit(0), v.limit(0)).count() == 0


def test_archives_come_back(spark, tmp_path):
    big = "é" * 700
    pages = [(1, "http://a/1", big), (2, "http://a/2", big), (9, "http://a/9\r\nX: y", big), (3, None, None), (4, "u", "short"), (5, "u", "short"),
             (None, "n", big), (6, "z", "<p>" + LONG)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    records = warc.planned(df)
    manifest = warc.write_archives(records, str(tmp_path / "w"), file_bytes=500)
    rows = warc.read_archives(manifest, str(tmp_path / "w")).collect()
    assert manifest.count() > 1 and len(rows) == len(pages) and not list((tmp_path / "w").glob("_temporary*"))
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in rows}
    assert kinds == {1: ("revisit", 9), 2: ("revisit", 9), 9: ("response", None), 3: ("response", None), 4: ("response", None),
                     5: ("response", None), None: ("revisit", 9), 6: ("response", None)}
    for r in rows:
        html = next(h for i, _, h in pages if i == r.page_id) or ""
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == hashlib.sha1(html.encode()).hexdigest()
        assert r.payload == (html.encode() if r.record_type == "response" else None)
    again = warc.write_archives(records.repartition(3), str(tmp_path / "v"), file_bytes=500)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, manifest.collect()))
    empty = warc.write_archives(records.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(empty, str(tmp_path / "e")).count() == 0


def test_main_text(spark):
    page = ('<html><head><title>t</title></head><body class="has-sidebar"><header>Top</header><article><header><h1>A &amp; B</h1></header><p>one<br>two '
            '<b>three</p><aside>x</aside><p>c&nbsp; d<div class="comments"><p>bad</p></div><div id="ad-1">y</div>'
            '<script>if (a<b) {"</p>"}</script><p>e &lt;f&gt;</article><footer>f</footer>')
    plain = "<body><div>Site</div><div>{}</div><div>Imprint</div>"
    rows = [(1, "http://h/1", page), (2, "http://k/a", plain.format("first")), (3, "http://k/b", plain.format("second")),
            (4, "http://k/z", None), (5, None, ""), (None, "http://m", "no tags & more"), (7, "http://h/1", page)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()
    text = Counter((r.page_id, r.text, r.n_chars) for r in got)
    want = "A & B\none two three\nc d\ne <f>"
    assert text == Counter([(1, want, len(want)), (7, want, len(want)), (2, "first", 5), (3, "second", 6), (4, "", 0), (5, "", 0), (None, "no tags & more", 14)])
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_every_page_is_compared_with_the_nearest_path(spark):
    """Against a plain pairing and a plain table of the longest common subsequence, for any number of tasks."""
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    plain = "<body><div>Site</div><div>{}</div><div>Imprint</div>"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    rows += [(10_000 + i, f"http://hot/{p}", plain.format(f"text of {p}{i % 2}")) for i in range(90) for p in ("a", "b", "b", "b")[i % 4]]
    rows += [(20_000 + i, f"http://copies/{i}", plain.format("the same")) for i in range(3)]
    rows += [(30_000, "http://marked/1", "<nav>Menu</nav><article><h1>Head</h1><p>one</article>"), (30_001, "http://marked/2", "<nav>Menu</nav><article><h1>Head</h1><p>two</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_text.main_text(df).collect()
    for size in (40_000, 5_000):
        assert sorted(map(tuple, html_text.main_text(df.repartition(7), task_bytes=size).collect())) == sorted(map(tuple, got))
    key = {i: re.match("(?:https?://)?([^/:]*)[^/]*(.*)", url.lower(), re.S).groups() for i, url, _ in rows}
    first = {}
    for i in sorted(key):
        first.setdefault(key[i], i)
    order, html = sorted(first), {i: h for i, _, h in rows}

    def same(a, b):
        return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    compared = 0
    for r in got:
        at = order.index(key[r.page_id])
        near = [k for k in order[max(0, at - 1):at] + order[at + 1:at + 2] if k[0] == key[r.page_id][0]]
        if near and r.page_id not in (20_000, 20_001, 20_002):
            near = max(near, key=lambda k: same(k[1], key[r.page_id][1]))
            want = length(*([t for t, _ in html_text.blocks(html[i])[0]] for i in (r.page_id, first[near])))
            assert r.n_shared == want
            compared += want > 0
    assert compared > 50
    text = {r.page_id: (r.text, r.n_shared, r.n_restored) for r in got}
    assert all(text[10_000 + i][0] == "text of " + "abbb"[i % 4] + str(i % 2) for i in range(90))
    # A page whose neighbours are copies is no template, and what articles share belongs to them.
    assert all("the same" in text[20_000 + i][0] for i in range(3))
    assert text[30_000] == ("Head\none", 2, 1) and text[30_001] == ("Head\ntwo", 2, 1)


@pytest.mark.parametrize("page, want", [
    ('<nav>n</nav><article class="post has-comments"><p>one<p>two</article><div>x</div>', "one\ntwo"),
    ('<nav>n</nav><article class="entry search-result"><p>one</article><article class="comment"><p>c</article><div>x</div>', "one"),
    ('<nav>n</nav><div class="content with-sidebar"><article><p>one</article></div><div>x</div>', "one"),
    ('<div class="layout sidebar-right"><nav>n</nav><article><p>one<aside>a</aside></article></div><div>x</div>', "one"),
    ('<div class="search"><main><p>one</main></div><article class="teaser"><p>t</article>', "one\nt"),
    ('<form action="/"><div class="top">n</div><article><h1>A</h1><p>one</article></form><footer>f</footer>', "A\none"),
    ('<article><p>one</article><div id="comments" class="comments-area"><article class="comment-body"><p>c</article></div>', "one"),
    ('<form><p>one</p><nav>n</nav></form>', "one"),
    ('<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be<xmp>a <b> &amp; c</xmp><p>end</article>', "Let x=2 be\na <b> &amp; c\nend"),
])
def test_marks_on_articles_and_around_them(page, want):
    assert "\n".join(html_text.lines(f"<html><body>{page}</body></html>")[0]) == want


def test_toxicity_of_held_out_and_disguised_texts(spark, docs, none):
    folder = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held_out = remainder("doc_id", 3) == 1
    scorer = toxicity.fitted(d, labels, "doc_id", "text", ~held_out)
    rows = toxicity.scored(d.withColumn("h", held_out).filter("h"), scorer, carry=["doc_id"]).join(labels, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert right >= 0.93 * len(rows) and not any(r.predicted for r in rows if not r.toxic and r.score < 0.7)
    for word, plain in (("p@th3t1c", "pathetic"), ("m.o.r.o.n", "moron"), ("stuuupid", "stupid"), ("tr4sh", "trash")):
        assert scorer[word] == scorer[plain] > 0.3
    assert scorer.score("s c u m") > 0.6 and scorer.score("") < 0.1
    assert all(0 <= r.score <= 1 for r in toxicity.scored(docs, scorer).collect())
    assert toxicity.clean(docs, labels).columns == docs.columns
    assert toxicity.clean(none, labels.limit(0)).count() == 0


def test_disguises_at_ends_without_letters_in_long_pieces_and_over_blanks(spark):
    folder = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scorer = toxicity.fitted(d, labels, "doc_id", "text", F.lit(True))
    read = scorer.reader.readings
    assert "moron" in read("m0r0n!") and "moron" in read("(moron)") and "scum" in read("scu*") and "cretin" in read("(retin")
    assert read("@$$") and read("7245#") and read("...") == []
    assert scorer["you.are.such.a.m0r0n.and.everybody.knows.it.m.o.r.o.n"] == scorer["moron"] > 0.3
    for text in ("mo ron", "m0 r0n", " ".join("he is a moron" * 9)):
        assert scorer.score(text) > 0.3, text
    assert scorer.score("this is all as it was and so we go on") < 0.3
    assert len(scorer.reader.readings("ab1c." * 20_000)) > 0


def test_what_was_read_is_remembered_by_letters_and_for_all_tasks(spark):
    """Joins are remembered by the letters that matter, not by words; tasks of a process share the readings; counts are those of plain Python."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdeé"), n)) for n in rng.integers(1, 8, 4000)]
    docs = spark.createDataFrame([(" ".join(words[i:i + 100]),) for i in range(0, 4000, 100)], "text string").repartition(3)
    counts = Counter()
    for w in words:
        a = [0, 0, *map(toxicity.letter, w), 0]
        counts.update(zip(a, a[1:], a[2:]))
    found = toxicity.character_counts(docs).reshape((toxicity.LETTERS,) * 3)
    assert {tuple(map(int, k)): int(found[tuple(k)]) for k in np.argwhere(found)} == counts
    model = toxicity.CharacterModel(found)
    reader = toxicity.Reader(model)
    expected, made = set(), words[0]
    for before, after in zip(words, words[1:]):
        if max(len(before), len(after)) <= toxicity.SHORT and model.joins(made, after):
            made += after
            continue
        if made is not before:
            expected.add(re.sub(r"(.)\1+", r"\1", made))
        made = after
    if made is not words[-1]:
        expected.add(re.sub(r"(.)\1+", r"\1", made))
    assert reader.joined(words) == expected and len(expected) > 10
    short = {w for w in words if len(w) <= toxicity.SHORT}
    assert len(reader.known) <= len({w[-2:] for w in short}) * len({w[:2] for w in short}) and all(len(x) <= 2 for k in reader.known for x in k)
    one, two = (pickle.loads(pickle.dumps(model)) for _ in range(2))
    assert one.decode("m0r*n") == model.decode("m0r*n") and two.known is one.known and two.known
    other = pickle.loads(pickle.dumps(toxicity.CharacterModel(found[::-1].copy())))
    assert other.known == {}


def test_workers_forget_words_after_a_task(spark, corpus):
    """What a Python worker has read as tokens is not held while it runs tasks of later stages."""
    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe.encoded(corpus.repartition(8), path).filter("size(ids) > 0").count() > 0

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(bpe.vocabulary(path).known)], pa.int64())], ["n"])

    assert {r.n for r in spark.range(0, 8, 1, 8).mapInArrow(run, "n long").collect()} == {0}


def test_model_probabilities(spark, docs, none, corpus):
    rows = pitman_yor.scored(corpus, "doc_id", "text", remainder("doc_id", 7) == 2).collect()
    tokens = {r.doc_id: [*(r.text or "").encode().translate(pitman_yor._LOWER).split(), b"\n"] for r in corpus.collect()}
    count = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(count.values()), len(count)
    for r in rows:
        t = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in count for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert pitman_yor.scored(none, "doc_id", "text", F.lit(False)).count() == 0
    edge = pitman_yor.scored(docs, "doc_id", "text", F.lit(False)).collect()
    assert len(edge) == len(ROWS) and {r.n_tokens for r in edge if r.doc_id in (3, 4, 5)} == {1}
    assert all(r.score <= 0 for r in pitman_yor.scored(docs, "doc_id", "text", F.lit(True)).collect())


def test_predictive_probabilities_sum_to_one():
    words = np.arange(1, 6, dtype=np.uint64)
    s = pitman_yor._Slice(words, np.full(5, 2, np.int32), np.array([97 << 8 | 98, 99 << 8 | 98] * 5, np.uint16))
    n = np.arange(1, 11)
    seats = (np.ones(10, int), np.ones(10, int), np.ones(5, int))
    rows = [tuple(x) for x in zip(*pitman_yor._totals(s, n, *seats).values(), strict=True)]
    all_ = pitman_yor.Totals(rows)
    for i in range(3):
        seats = pitman_yor.sweep(s, n, *seats, all_, np.random.default_rng(i))
        all_ = pitman_yor.Totals([tuple(x) for x in zip(*pitman_yor._totals(s, n, *seats).values(), strict=True)], all_.discounts)
    tf, tc, tw = seats
    assert (tf >= 1).all() and (tf <= n).all()
    cc, cw = np.bincount(s.group_of, tf), np.bincount(s.group_word, tc)
    # Five known words and one unknown, in the restaurant of one context.
    root = np.append(all_.down(pitman_yor.ROOT, 2, cw, tw, 1 / 6), all_.down(pitman_yor.ROOT, 2, 0, 0, 1 / 6))
    coarse = all_.down(pitman_yor.COARSE + 97, 1, np.append(cc[::2], 0), np.append(tc[::2], 0), root)
    fine = all_.down(97 << 8 | 98, 0, np.append(n[::2], 0), np.append(tf[::2], 0), coarse)
    assert math.isclose(fine.sum(), 1)


def test_whole_words_before_are_restaurants_across_slices(spark):
    """Of every word, frequent or rare, the totals are those of all slices, and what may follow it sums to one."""
    rng = np.random.default_rng(3)
    vocabulary = [f"{x}{i}ed" for i in range(40) for x in ("ab", "cd")]  # one ending, so that only whole words tell contexts apart
    texts = [" ".join(vocabulary[j] for j in np.minimum(rng.geometric(0.05, 60) - 1, 79)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t.encode(), i == 7) for i, t in enumerate(texts)], "id long, text binary, held boolean")
    frequent = {w.encode(): i for i, w in enumerate(vocabulary[:3], 1)}
    asked = pitman_yor.tokens(docs.coalesce(2), "held", 3, 500, frequent).filter("kind = 1").select("block", "slice", *"abcdef")
    endings = np.zeros(pitman_yor.RARE, np.uint16)
    endings[1:4] = [pitman_yor.context(w) for w in frequent]
    state = asked.groupBy("slice").applyInArrow(pitman_yor._merger(endings, 2), pitman_yor._STATE).cache()
    totals = [pitman_yor._gathered(state)]
    swept = state.groupBy("slice").cogroup(pitman_yor._told(state).groupBy("slice")).applyInArrow(
        pitman_yor._sweeper(totals[0], (1, 2), False, 2), pitman_yor._STATE).cache()
    totals = [pitman_yor._gathered(swept, totals[0].discounts)]
    count = Counter()
    for i, t in enumerate(texts):
        words = t.encode().split()
        count.update(x for x in zip([b"", *words], [*words, pitman_yor.END]) if i != 7)
    follow = Counter(u for u, _ in count.elements())
    states = {r["slice"]: r.asDict() for r in swept.collect()}
    told = {n: sorted((r.bucket, r.c, r.t) for r in pitman_yor._told(swept).collect() if r.slice == n) for n in states}
    assert len(states) == 3 and totals[0].tokens == sum(count.values()) and list(totals[0].before[0][:4]) == [follow[u] for u in (b"", *frequent)]
    number = {xxhash.xxh64_intdigest(w, 0): w for w in [*(v.encode() for v in vocabulary), pitman_yor.END]}
    tables = Counter()
    for n, row in states.items():
        s, f, samples, _ = pitman_yor._read(row)
        c = pitman_yor._joined([b for b, _, _ in told[n]], [c for _, c, _ in told[n]])
        assert [follow[number[h]] for h in f.rare.tolist()] == c.tolist()
        before = [b"", *frequent, *[None] * (pitman_yor.RARE - 4), *(number[h] for h in f.rare.tolist())]
        for of, ctx, k, t in zip(f.of, f.ctx, f.n, samples[-1][0], strict=True):
            assert count[before[ctx], number[int(s.words[s.word_of[of]])]] == k and 1 <= t <= k
            tables[before[ctx]] += int(t)
    for n, row in states.items():
        f = pitman_yor._read(row)[1]
        t = pitman_yor._joined([b for b, _, _ in told[n]], [t for _, _, t in told[n]])
        assert [tables[number[h]] for h in f.rare.tolist()] == t.tolist()
    pack, answer = pitman_yor._pack, pitman_yor._answers(totals, endings)
    trained = {w for _, w in count}
    for u in (vocabulary[0].encode(), vocabulary[20].encode(), vocabulary[41].encode(), b""):
        total = 0.0
        for n, row in states.items():
            words = np.array(sorted([h for h, w in number.items() if h % 3 == n and w in trained] + [6] * (n == 0)), np.uint64)  # one word is unknown
            k, rare = len(words), u not in frequent and u != b""
            hashes = np.full(k if rare else 0, xxhash.xxh64_intdigest(u, 0), np.uint64)
            piece = {"block": 0, "slice": n, "a": pack(words), "b": pack(np.ones(k, np.int32)), "e": pack(hashes),
                     "c": pack(np.full(k, pitman_yor.RARE if rare else frequent.get(u, 0), np.uint16)), "f": pack(np.full(len(hashes), pitman_yor.context(u) if u else 0, np.uint16))}
            replies = [{**dict.fromkeys(piece), "block": -1 - b, "slice": n, "a": c, "b": t} for b, c, t in told[n]]
            out = answer((pa.scalar(n, pa.int32()),), pa.Table.from_pylist([row], schema=pitman_yor._arrow(pitman_yor._STATE)), pa.Table.from_pylist([piece, *replies]))
            total += (10.0 ** pitman_yor._unpack(out["score"][0].as_py()).astype(float)).sum()
        assert math.isclose(total, 1, rel_tol=1e-5), u


def test_slices_are_written_once(spark, corpus, monkeypatch):
    """After a sweep only seatings and totals are new, and the number of buckets changes no score."""
    kept: dict[str, list] = {}

    def noted(df, purpose, *rest):
        kept.setdefault(purpose, []).append(out := bucketed(df, purpose, *rest))
        return out

    monkeypatch.setattr(pitman_yor, "bucketed", noted)
    made = {}
    for most in (50_000, 2):
        kept.clear()
        monkeypatch.setattr(pitman_yor, "MOST_BUCKETS", most)
        made[most] = sorted(pitman_yor.scored(corpus, "doc_id", "text", remainder("doc_id", 7) == 2, slice_bytes=100_000).collect())
        assert len(kept["slices"]) == 1 and kept["slices"][0].count() > 2
        assert len(kept["seating"]) == 3 and not {"words", "before", "pairs", "n"} & {c for t in kept["seating"] for c in t.columns}
    assert made[50_000] == made[2]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("slices_", "seating_", "tokens_"))]


def test_words_with_the_same_ending_predict_differently(spark):
    """Held-out texts of pairs that only whole words tell apart."""
    pairs = [(f"{x}{i}ing", f"then{i}") for i in range(50) for x in ("red", "far")]
    rows = [(i, " ".join(f"{a} {b}" for a, b in pairs[i % 7:] + pairs[:i % 7])) for i in range(40)]
    got = pitman_yor.scored(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", F.col("doc_id") % 5 == 0, slice_bytes=10_000).filter("held_out").collect()
    # Of 200 tokens half follow from the word before, the others from the order.
    assert len(got) == 8 and all(r.score > -0.2 * r.n_tokens for r in got)


def test_lattice_against_all_readings():
    rng = np.random.default_rng(5)
    model = toxicity.CharacterModel(rng.integers(0, 50, toxicity.LETTERS ** 3))

    def every(raw, i=0, a=0, b=0):
        """All readings of what is left of a piece, with their log probabilities."""
        if i == len(raw):
            return [(model.cost[a][b][0], "")]
        out = []
        for emitted, channel in model.options(raw[i], i > 0 and raw[i - 1] == raw[i]):
            if emitted == " ":
                if b:
                    out += [(channel + model.cost[a][b][0] + p, " " + t) for p, t in every(raw, i + 1, 0, 0)]
            elif emitted:
                n = toxicity.letter(emitted)
                out += [(channel + model.cost[a][b][n] + p, emitted + t) for p, t in every(raw, i + 1, b, n)]
            else:
                out += [(channel + p, t) for p, t in every(raw, i + 1, a, b)]
        return out

    for raw in ("b4d", "s**t", "(l0wn!", "aa-b.b", "1111", "*", "x*y*z", "€éñ$$", "a.*.b", "sh1t**", "m 0 r"):
        best = {}
        for p, t in every(raw):
            best[t] = max(p, best.get(t, -1e300))
        want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:toxicity.BEST]
        got = model.ahead(False, raw, 0, 0)
        assert [t for _, t in got] == model.decode(raw)
        assert np.allclose([p for p, _ in got], [p for _, p in want]), raw
        # The pass for long pieces finds the best reading too, as far as its states suffice.
        assert raw.count("*") or model.decode_long(raw) == [want[0][0]]


def jaccard(a, b):
    a, b = near_dedup.shingles((a or "").encode()), near_dedup.shingles((b or "").encode())
    return len(a & b) / len(a | b) if a | b else 1


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        if name != "bpe":
            assert after.columns == columns and after.join(before, columns, "left_anti").count() == 0
            after = spark.createDataFrame(after.collect(), after.schema)
            assert after.count() > 0
        if name not in ("mixture", "bpe"):
            # No row stays more often than it came.
            assert after.exceptAll(before).count() == 0
        if name == "exact dedup":
            normal = [re.sub(r"[ \t-\r]+", " ", r.text) for r in after.collect()]
            assert sorted(normal) == sorted({re.sub(r"[ \t-\r]+", " ", r.text) for r in before.collect()})
        if name == "near dedup":
            kept, all_ = after.collect(), before.collect()
            ids = {r.doc_id for r in kept}
            assert all(jaccard(x.text, y.text) < 0.8 for i, x in enumerate(kept) for y in kept[:i])
            assert all(any(jaccard(x.text, y.text) >= 0.8 for y in kept if y.doc_id < x.doc_id) for x in all_ if x.doc_id not in ids)
        if name == "mixture":
            planned = mixing.mixture(before, carry=["doc_id", "source"]).collect()
            wanted, longest, target, have = Counter(), Counter(), {}, Counter()
            for r in planned:
                wanted[r.source] += r.taken
                longest[r.source] = max(longest[r.source], r.size)
                target[r.source] = r.target
            for r in after.collect():
                have[r.source] += len((r.text or "").split())
            for source, words in wanted.items():
                # Rows are whole, so a source is off by roundings of its rows, of which about the root of their number adds up.
                n = sum(r.source == source for r in planned)
                assert abs(words - target[source]) <= mixing.BLOCK_WORDS * 60
                assert abs(have[source] - words) <= longest[source] * (1 + math.sqrt(n)), source
        before = after
    assert before.columns == ["doc_id", "ids", "decoded"]
    assert corpus_pipeline.run(spark, SF).count() == before.count()
