"""The ten training-data operators and the pipeline against brute force, and odd tables."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from vecloom.llm import bpe, queries
from vecloom.llm.components import components
from vecloom.llm.decontaminate import leaks, tiles
from vecloom.llm.html_extract import extract, main_text
from vecloom.llm.language_id import held_out, identify, train
from vecloom.llm.license_scan import scan_licenses
from vecloom.llm.line_dedup import remove_boilerplate
from vecloom.llm.ngram_join import one_of_each, similar_documents
from vecloom.llm.packing import best_fit, pack, write_packed
from vecloom.llm.prefix_forest import nearest
from vecloom.llm.repeats import remove_repeats
from vecloom.llm.wordhash import ngrams

SF = "/root/testdata/sf0.001"
WORDS_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTES_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

rng = random.Random(3)
PLAIN = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(90)) for _ in range(6)]
LONG = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60_000))
ODD = [
    (1, PLAIN[0], "en", "a", 1),
    (1, PLAIN[0], "en", "a", 1),  # a repeated row
    (2, PLAIN[0], "fr", "b", 1),  # a copy
    (3, PLAIN[1] + " tail", "en", None, None),
    (4, PLAIN[1], None, "a", 3),
    (None, PLAIN[2], "en", "a", 1),
    (5, None, "en", "a", 0),
    (6, "", "en", "a", 0),
    (7, " \n\t ", "en", "a", 0),
    (8, LONG, "en", "a", 0),
    (9, "one two", "en", "a", 7),
    (10, "123 456", "en", "a", 7),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def split(text):
    return [w for w in re.split(r"[ \t\n\v\f\r]+", text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = split(lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def linked(texts):
    """Smallest index reachable by links, for each text."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            c = len(a & b)
            if a and b and 100 * c >= 80 * (len(a) + len(b) - c):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


# 1


def test_forest_recall_and_order(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    v = np.array([r.embedding for r in rows], float)
    ids = np.array([r.vec_id for r in rows])
    found = {}
    for r in queries.op1_prefix_forest(spark, SF).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        scores = v @ v[ids == q][0]
        best = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        own = sorted(found[q])
        assert [x[0] for x in own] == list(range(1, 21))
        assert all(abs(s - scores[ids == i][0]) < 1e-12 for _, i, s in own)
        assert own == sorted(own, key=lambda x: (-x[2], x[1]))
        hits += len({x[1] for x in own} & set(ids[best]))
        total += 20
    assert hits / total >= 0.9


def test_forest_odd_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(50)] + [
        (50, [3.0, 0.5]), (51, None), (52, [0.0, 0.0]), (53, [1.0, None]), (54, [float("nan"), 1.0]), (50, [3.0, 0.5]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "2 AS score")
    got = nearest(table, table.where("vec_id in (0, 51, 52)"), 5).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [
        (0, k + 1, i) for k, i in enumerate([1, 2, 3, 4, 5])
    ]
    assert nearest(table.limit(0), table.limit(0)).count() == 0


def test_forest_outside_a_hot_cluster(spark):
    """Over 40,000 vectors, a third in one cluster; few of the queries are in it, and one is alone."""
    import pandas as pd

    made = np.random.default_rng(5)
    v = made.standard_normal((42_000, 32))
    v[:14_000] = made.standard_normal(32) * 3 + 0.05 * v[:14_000]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[41_999] = -v[0]
    asked = np.r_[0:10, 20_000:20_060, 41_999]
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(v)), "embedding": list(v)})).repartition(4)
    found = {}
    for r in nearest(table, table.where(f"vec_id in ({','.join(map(str, asked))})"), 20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    shares = []
    for q in asked:
        best = np.argsort(-(v @ v[q]), kind="stable")
        assert len(found.get(q, ())) == 20
        shares.append(len(found[q] & set(best[best != q][:20])) / 20)
    assert min(shares) >= 0.7 and np.mean(shares) >= 0.95, (min(shares), np.mean(shares))


# 2


def test_leaks_equal_brute_force(spark):
    docs = {r.doc_id: split(lower(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: split(lower(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    expected = set()
    for d, words in docs.items():
        runs = {tuple(words[i : i + 8]) for i in range(len(words) - 7)}
        for i, item in items.items():
            held = set()
            for j in range(len(item) - 7):
                if tuple(item[j : j + 8]) in runs:
                    held.update(range(j, j + 8))
            if len(held) >= 0.5 * len(item):
                expected.add((d, i))
    got = {(r.doc_id, r.item_id) for r in queries.op2_string_tiling(spark, SF).collect()}
    assert got == expected and expected


def test_moved_passages_and_odd_tables(spark, odd, none):
    item = [f"q{i}" for i in range(40)]
    moved = " ".join(["x"] * 9 + item[20:] + ["y"] * 5 + item[:20])
    docs = odd.unionByName(spark.createDataFrame([(77, moved, "en", "a", 1), (78, "is tiny item", "en", "a", 1)], DOCS))
    items = spark.createDataFrame(
        [(1, " ".join(item)), (2, None), (3, ""), (4, "TINY item"), (4, "TINY item")], "item_id long, text string"
    )
    got = {(r.doc_id, r.item_id): (r.coverage, len(r.tiles)) for r in leaks(docs, items).collect()}
    assert got == {(77, 1): (1.0, 2), (78, 4): (1.0, 1)}
    assert leaks(none, items).count() == leaks(docs, items.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=30))
def test_tiles_are_common_and_free(a, b):
    a, b = np.array(a, np.uint64), np.array(b, np.uint64)
    used_a, used_b = set(), set()
    for i, j, n in tiles(a, b, 4):
        assert (a[i : i + n] == b[j : j + n]).all() and n >= min(4, len(b))
        assert used_a.isdisjoint(range(i, i + n)) and used_b.isdisjoint(range(j, j + n))
        used_a.update(range(i, i + n))
        used_b.update(range(j, j + n))


# 3


def test_license_places(spark, none):
    texts = [
        "Under THE MIT\nlicense! under the mit license",
        "apache license, version 2.0; cc-by-nc cc by nc",
        "under the mitt license; éunder the mit license",
        None,
        "",
        "This work is licensed under the GNU General Public License, version 3.",
        "All rights reserved.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "0 AS word")
    got = [
        (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)
        for r in scan_licenses(docs).orderBy("doc_id").collect()
    ]
    assert got == [
        (8, 2, 0, 4, "mit", "mit"),
        (11, 3, 0, 8, "apache-2,cc-by-nc", "apache-2,cc-by-nc"),
        (8, 0, None, None, "", ""),
        (0, 0, None, None, "", ""),
        (0, 0, None, None, "", ""),
        (12, 0, None, None, "", "gpl-3"),
        (3, 0, None, None, "", "all-rights-reserved"),
    ]
    assert scan_licenses(none).count() == 0


# 4


def test_bpe_equals_library(spark, odd, none):
    file = Tokenizer.from_file(WORDS_FILE)
    texts = [
        "Hello, World's É  x<|endoftext|>Y\n123 don't I'VE ſ's", "ΑΣ ΣΑΣ", "日本 á İ K ﬁ", "՘Ᲊ x", "a\x1cb",
        "<|startoftext|><|endoftext|", "a" * 700, "ab" * 400, "", " ", None,
        *(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()),
        *("".join(rng.choice("aeiouthnsrl'") for _ in range(rng.randint(1, 25))) for _ in range(400)),
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    both = bpe.decode(bpe.encode(table, WORDS_FILE), WORDS_FILE)
    for r in both.collect():
        ids = file.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids
        assert r.decoded == file.decode(ids, skip_special_tokens=False)
    digests = {r.doc_id: r for r in bpe.encoded_digests(odd.where("doc_id = 3"), WORDS_FILE).collect()}
    ids = file.encode(ODD[3][1], add_special_tokens=False).ids
    assert digests[3].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encode(odd, WORDS_FILE).count() == len(ODD) and bpe.encode(none, WORDS_FILE).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(odd.withColumnRenamed("lang", "ids"), WORDS_FILE)


# 5


def test_boilerplate_lines(spark, odd, none):
    rows = [(200 + i, f"own {i}\nshared line\nend {i}", "en", f"s{i % 4}", 1) for i in range(8)]
    rows += [(100 + i, "copied\nwhole\npage", "en", f"s{i % 4}", 1) for i in range(8)]
    docs = spark.createDataFrame(rows, DOCS).unionByName(odd)
    got = {}
    for r in remove_boilerplate(docs, min_sites=4).collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_removed))
    assert got[3] == [(ODD[3][1], 1, 0)] and got[5] == [(None, 0, 0)] and len(got[1]) == 2
    assert all(got[200 + i] == [(f"own {i}\nend {i}", 3, 1)] for i in range(8))
    assert all(got[100 + i] == [("copied\nwhole\npage", 3, 0)] for i in range(8))
    assert remove_boilerplate(none).count() == 0


# 6


PAGE = (
    '<html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><a>Menu</a></nav>'
    '<div class="x">{same}</div><article><h1>Head &amp; {n}</h1><p>Some  <b>bold\n text<p>Next &lt;{n}&gt;'
    '<div class="comments"><p>I agree</p></div></article><footer>&copy; me</footer>'
)


def test_main_text_of_pages(spark):
    rows = [(i, f"http://Host.example/{i}", PAGE.format(n=i, same="Sign up now")) for i in range(30)]
    rows += [(100, None, None), (101, "x", ""), (102, "http://host.example/z", "no markup at  all"), (0, *rows[0][1:])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS host")
    got = {}
    for r in extract(table).collect():
        got.setdefault(r.page_id, []).append((r.text, r.n_chars))
    for i in range(30):
        text = f"Head & {i}\nSome bold text\nNext <{i}>"
        assert got[i] == [(text, len(text))] * (2 if i == 0 else 1)
    assert got[100] == got[101] == [("", 0)] and got[102] == [("no markup at all", 16)]
    assert extract(table.limit(0)).count() == 0
    assert main_text("<p>a<!-- b --> c<br>d</p><ul><li>e<li>f</ul>", set()) == "a c d\ne\nf"


def test_articles_of_given_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r.text for r in queries.op6_style_trees(spark, SF).collect()}
    import html

    for r in rows:
        inner = r.html[r.html.index("<article>") : r.html.index("</article>")]
        blocks = [html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", b))) for b in re.split("</?(?:p|h1|article)>", inner)]
        assert got[r.page_id] == "\n".join(" ".join(b.split()) for b in blocks if b.strip())


def texts_of(spark, pages):
    rows = [(i, f"http://{host}.example/{i}", page) for i, (host, page) in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in extract(table).collect()}


def test_branches_and_notices_without_marks(spark):
    menu = "<div class='x'><ul>" + "".join(f"<li>Part {c}</li>" for c in "abcdefghij") + "</ul></div>"
    body = "<article><h1>Head {n}</h1><p>First {n}<div class='box'><p>Try our new plan</p></div><p>Last {n}</article>"
    got = texts_of(spark, [("a", menu + body.format(n=n)) for n in range(30)])
    assert got == {n: f"Head {n}\nFirst {n}\nLast {n}" for n in range(30)}


def test_marks_that_name_no_role():
    for page in (
        "<body class='has-sidebar'><p>Text</p></body>",
        "<div id='main' class='no-sidebar'><p>Text</p></div>",
        "<article class='post comments-open'><p>Text</p></article>",
        "<article class='banner-post'><p>Text</p></article>",
        "<div class='banner-post'><h1>Text</h1></div><div class='site-footer'>F</div>",
        "<p>Text<div class='comments-area'><p>Far longer than the text</p></div>",
        "<p>Text<div class='post sidebar'>Side</div><div id='cookieNotice'>Cookies</div>",
    ):
        assert main_text(page, set()) == "Text", page


def test_copies_leave_other_pages_alone(spark):
    plain = lambda n, m: "".join(f"<p>{n} line {k}</p>" for k in range(10)) + f"<div class='x'>Sign up</div>{m}"
    pages = [("a", plain("Copy", "")) for _ in range(270)] + [("a", plain(f"Own {n}", "")) for n in range(30)]
    side = lambda n, m: f"<article>{plain(n, '')}</article><div class='y'>Seen by {m}</div>"
    pages += [("b", side("Copy", m)) for m in range(270)] + [("b", side(f"Own {n}", n)) for n in range(30)]
    got = texts_of(spark, pages)
    for first, end in ((0, ""), (300, "\nSeen by {n}")):
        for n in range(30):
            lines = "\n".join(f"Own {n} line {k}" for k in range(10))
            assert got[first + 270 + n] == lines + end.format(n=n)
        assert got[first].startswith("\n".join(f"Copy line {k}" for k in range(10)))


# 7


def test_repeats_equal_brute_force(spark, odd, none):
    got = sorted(remove_repeats(odd, window=20).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    rows = sorted(ODD, key=lambda r: (r[0] is None, r[0] or 0))
    count = {}
    for r in rows:
        w = split(r[1])
        for i in range(len(w) - 19):
            count[tuple(w[i : i + 20])] = count.get(tuple(w[i : i + 20]), 0) + 1
    for r, row in zip(got, rows, strict=True):
        w = split(row[1])
        gone = set()
        for i in range(len(w) - 19):
            if count[tuple(w[i : i + 20])] > 1:
                gone.update(range(i, i + 20))
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept == " ".join(x for i, x in enumerate(w) if i not in gone)
        assert {i for s in r.removed for i in range(s.first, s.end)} == gone
    assert remove_repeats(none).count() == 0
    within = spark.createDataFrame([(1, " ".join(["la"] * 50))], "doc_id long, text string")
    assert remove_repeats(within).first().n_removed == 50


# 8


def test_similar_documents(spark, odd, none):
    base = [f"t{i}" for i in range(60)]
    texts = [" ".join(base[:k] + [f"new{k}"] + base[k + 1 :]) for k in range(0, 60, 3)] + [" ".join(base)] * 3
    texts += [r[1] for r in ODD if r[1] != LONG] + ["a b", "A B", "a  b\n", "c"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, node int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(docs).collect()}
    roots = linked(texts)
    assert got == {i: (len(shingles(t)), roots[i]) for i, t in enumerate(texts)}
    left = {r.doc_id for r in one_of_each(docs).collect()}
    assert left == set(roots)
    stays = one_of_each(odd).collect()
    assert len([r for r in stays if r.text == PLAIN[0]]) == 1 and {5, 6, 7} <= {r.doc_id for r in stays}
    assert similar_documents(none).count() == one_of_each(none).count() == 0


def test_components(spark):
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in pairs if a != b for x in (a, b)}


# 9


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit(lengths):
    rows = best_fit(lengths, 64)
    assert sorted(k for row in rows for k in row) == list(range(len(lengths)))
    room = []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        fits = [r for r in room if r >= lengths[k]]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - lengths[k])
        else:
            room.append(64 - lengths[k])
    assert sorted(64 - sum(lengths[k] for k in row) for row in rows) == sorted(room)


def test_packing_round_trip(spark, odd, none, tmp_path):
    import base64

    import tiktoken
    from vecloom.llm.packing import PATTERN

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES_FILE, "rb"))}
    made = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    packed = pack(odd, BYTES_FILE, capacity=512)
    found = {}
    for r in packed.collect():
        ids, positions = (np.frombuffer(x, "<i4").tolist() for x in (r.ids, r.positions))
        assert len(ids) == len(positions) == 512 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        for k, (d, first) in enumerate(zip(r.doc_ids, r.first_tokens, strict=True)):
            b, e = r.cu_seqlens[k : k + 2]
            assert positions[b:e] == list(range(e - b))
            found.setdefault(d, []).append((first, ids[b:e]))
    for d in {r[0] for r in ODD}:
        own = [made.encode_ordinary(r[1] or "") for r in ODD if r[0] == d]
        parts = sorted(found.get(d, []))
        assert sum(len(p) for _, p in parts) == sum(map(len, own))
        if len(own) == 1:
            assert [x for _, p in parts for x in p] == own[0]
    write_packed(packed, str(tmp_path / "packed"))
    row = spark.read.parquet(str(tmp_path / "packed")).first()
    assert len(row.ids) == 4 * 512
    assert pack(none, BYTES_FILE).count() == 0


# 10


def test_language_held_out(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify(docs, train(docs.where(~held_out()))).where(held_out()).collect()
    assert len(found) > 200 and all(0 <= r.score <= 1 for r in found)
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.95
    got = {r.doc_id: (r.lang_pred, r.rejected) for r in identify(odd, train(docs)).collect()}
    assert got[5] == got[6] == got[7] == got[10] == ("und", True)
    assert identify(odd, train(none)).where("lang_pred <> 'und'").count() == 0
    assert identify(none, {}).count() == 0


# The pipeline


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rejected = {r.doc_id for r in identify(docs, train(docs)).where("rejected").collect()}
    rows = [r for r in docs.orderBy("doc_id").collect() if r.doc_id not in rejected]
    sites, pages = {}, {}
    for r in rows:
        lines = [x.strip(" ") for x in r.text.split("\n")]
        for x in lines:
            sites.setdefault(x, set()).add(r.source)
            pages.setdefault(x, set()).add(max(((len(y), y) for y in lines if y != x), default=(0, "")))
    gone = {x for x in sites if x and len(sites[x]) >= 10 and len(pages[x]) >= 10}
    texts = ["\n".join(x for x in r.text.split("\n") if x.strip(" ") not in gone) for r in rows]
    kept = [i for i, root in enumerate(linked(texts)) if i == root]
    items = [split(lower(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    file, expected = Tokenizer.from_file(WORDS_FILE), {}
    for i in kept:
        words = split(lower(texts[i]))
        runs = {tuple(words[k : k + 8]) for k in range(len(words) - 7)}
        covers = [sum(any(tuple(t[s : s + 8]) in runs for s in range(max(0, j - 7), j + 1)) for j in range(len(t))) / len(t) for t in items]
        if max(covers) < 0.5:
            expected[rows[i].doc_id] = (texts[i], file.encode(texts[i], add_special_tokens=False).ids)
    got = {r.doc_id: (r.text, r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected


def test_stages_on_odd_tables(spark, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, none):
            out = stage(spark, docs, SF)
            assert set(docs.columns) <= set(out.columns)
            assert out.count() <= docs.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns and out.dtypes == docs.dtypes


def test_benchmark_stage_takes_out_rows_not_ids(spark):
    leaked = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(i, t, "en", "a", 1) for i in (None, 5) for t in ("before " + leaked + " after", PLAIN[0], PLAIN[0], None)]
    docs = spark.createDataFrame([*rows, (6, leaked, "en", "a", 1), (7, "", "en", "a", 1)], DOCS)
    left = corpus_pipeline.benchmark(spark, docs, SF)
    assert left.columns == docs.columns
    expected = [(i, t) for i in (None, 5) for t in (PLAIN[0], PLAIN[0], None)] + [(7, "")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(expected, key=str)


def test_ngram_hash_is_the_same_anywhere():
    words = np.arange(50, dtype=np.uint64) % np.uint64(10)
    grams = ngrams(words, 7)
    assert (grams[:34] == grams[10:44]).all() and len(set(grams[:10].tolist())) == 10
    assert math.isclose(len(ngrams(words, 51)), 0)
