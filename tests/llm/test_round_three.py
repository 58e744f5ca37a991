"""Exact copies, whitening and the prefix trie against brute force, and odd tables."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from brute_trie import trie
from pyspark.sql import functions as F

import corpus_pipeline
from vecloom.llm import blocks, html_extract, language_id, license_scan, queries
from vecloom.llm.exact_dedup import drop_copies, mark_copies
from vecloom.llm.html_extract import main_text
from vecloom.llm.line_dedup import remove_boilerplate
from vecloom.llm.packing import token_ids
from vecloom.llm.prefix_forest import nearest
from vecloom.llm.prefix_trie import prefix_trie
from vecloom.llm.runs import MASK, numbered
from vecloom.llm.skew import join_counted
from vecloom.llm.whitening import one_sided_jacobi, pivoted_cholesky, principal_axes, whiten
from vecloom.session import materialize

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, keep_id string, size int, text_sha256 string"
LONG = " ".join(f"w{i * i % 9973}" for i in range(60_000))
HEAD = "the same first characters of many texts, which are more than what the head of a text may hold, "
ODD = [
    (3, "a b\tc", "x", 1, "y"),
    (1, "abc", "x", 1, "y"),
    (2, " abc ", "x", 1, "y"),
    (4, "a  bc", None, None, None),
    (4, "a  bc", None, None, None),  # a repeated row, and the longest of its group
    (5, None, "x", 1, "y"),
    (6, "", "x", 1, "y"),
    (7, " \n\x0b\x0c\r", "x", 1, "y"),
    (None, "lone", "x", 1, "y"),
    (None, "pair é", "x", 1, "y"),
    (8, "pairé", "x", 1, "y"),
    (9, "pair é", "x", 1, "y"),  # no white space of the contract
    (10, LONG, "x", 1, "y"),
    (11, LONG.replace(" ", "\n"), "x", 1, "y"),
    (12, LONG[:-1] + "!", "x", 1, "y"),
    *[(20 + i, HEAD + str(i % 7), "x", 1, "y") for i in range(30)],
]


def copies(rows):
    """Sorted (doc_id, keep_id, group_size, kept, digest)."""
    groups = defaultdict(list)
    for at, (i, text, *_) in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), i is None, i or 0, at, i))
    out = []
    for bare, members in groups.items():
        first, digest = min(members), hashlib.sha256(bare.encode()).hexdigest()
        out += [(str(m[4]), str(first[4]), len(members), m == first, digest) for m in members]
    return sorted(out)


def marked(result):
    return sorted((str(r[0]), str(r[1]), *r[2:]) for r in result.collect())


# 11


@pytest.mark.parametrize("broadcast_heads", [1000, 0])
def test_copies_of_odd_rows(spark, broadcast_heads):
    docs = spark.createDataFrame(ODD, DOCS)
    found = mark_copies(docs, digests=True, broadcast_heads=broadcast_heads)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert marked(found) == copies(ODD)


def test_only_shared_heads_are_hashed(spark):
    rows = [(1, "one"), (2, "two"), (3, "four four"), (4, HEAD + "a"), (5, HEAD + "b"), (6, HEAD + "a")]
    found = {r[0]: r for r in mark_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i].text_sha256 is None for i in range(1, 7)] == [True, True, True, False, False, False]
    assert [found[i].keep_id for i in range(1, 7)] == [1, 2, 3, 4, 5, 4]


def test_dropped_copies_keep_all_columns(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    left = drop_copies(docs)
    assert left.schema == docs.schema
    keep = [r for r in copies(ODD) if r[3]]
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(r[0] for r in keep)


def test_no_documents(spark):
    none = spark.createDataFrame([], DOCS)
    assert mark_copies(none).count() == 0 and drop_copies(none).count() == 0


def test_hot_copies_stay_where_they_are(spark):
    """Half of all rows are one text: their group is broadcast, no stage gathers them."""
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "hot text").otherwise(F.concat(F.lit("t"), "id")).alias("text")
    )
    found = mark_copies(docs)
    hot = found.where("group_size > 1").collect()
    assert len(hot) == 10_000 and sum(r.kept for r in hot) == 1 and {r.keep_id for r in hot} == {0}
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_exact_dedup(spark):
    plan = queries.op11_refined_copies(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 12


def whitened(rows, k=4):
    """{vec_id: (deviation, components)} by numpy, with the eigenvalues' shares."""
    x = {i: [int(np.floor(256 * float(c))) for c in v] for i, v in rows}
    distinct = np.array(sorted(set(map(tuple, x.values()))))
    n, sums = len(distinct), [sum(map(int, c)) for c in distinct.T]
    values, axes = np.linalg.eigh(np.cov(distinct.T, bias=True))
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    out = {}
    for i, own in x.items():
        place = (np.array(own) - np.array(sums) / n) @ axes / np.sqrt(values)
        out[i] = (sum((n * a - s) ** 2 for a, s in zip(own, sums, strict=True)), place)
    return n, out, values / np.trace(np.cov(distinct.T, bias=True))


def test_whitening_equals_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, expected, share = whitened(rows)
    found = queries.op12_cholesky_jacobi(spark, SF).collect()
    assert len(found) == 4 * len(rows)
    signs = {}
    for r in found:
        deviation, place = expected[r.vec_id]
        assert r.n == n and r.deviation == deviation and r.identity_error < 1e-9
        other = place[r.component - 1]
        assert abs(abs(r.whitened) - abs(other)) < 1e-8
        assert abs(r.explained - share[r.component - 1]) < 1e-12
        if abs(other) > 1e-6:
            signs.setdefault(r.component, set()).add(r.whitened * other > 0)
    assert all(len(s) == 1 for s in signs.values())


VECTORS = "vec_id long, embedding array<float>, n int, whitened string"


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    copied = [(100 + i, good[0][1]) for i in range(200)]
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [float("nan")] * 5)]
    bad += [(204, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (205, [1.0, 2.0]), (206, [1.0] * 9)]
    rows = [(i, v, 1, "x") for i, v in good + copied + bad] + [(None, good[1][1], None, None)]
    found = whiten(spark.createDataFrame(rows, VECTORS), 5).collect()
    n, expected, _ = whitened([(i, np.float32(v)) for i, v in good + copied], 5)
    assert n == 40 and len(found) == 5 * (40 + 200 + 1)
    for r in found:
        deviation, place = expected[1 if r.vec_id is None else r.vec_id]
        assert (r.n, r.deviation) == (40, deviation) and abs(abs(r.whitened) - abs(place[r.component - 1])) < 1e-8


def test_fewer_directions_than_components(spark):
    flat = [(i, [float(i), 2.0 * i, 7.0], 0, "") for i in range(9)]
    found = whiten(spark.createDataFrame(flat, VECTORS)).collect()
    assert {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-12
    assert found[0].identity_error < 1e-12
    same = [(i, [1.0, 2.0], 0, "") for i in range(3)]
    assert whiten(spark.createDataFrame(same, VECTORS)).count() == 0
    assert whiten(spark.createDataFrame([], VECTORS)).count() == 0


def test_large_entries_stay_exact_or_null(spark):
    rows = [(1, [3.0e6, 0.0], 0, ""), (2, [-3.0e6, 1.0], 0, ""), (3, [3.0e30, 5.0], 0, "")]
    found = whiten(spark.createDataFrame(rows[:2], VECTORS)).where("component = 1").orderBy("vec_id").collect()
    x = [[256 * 3_000_000, 0], [-256 * 3_000_000, 256]]
    sums = [x[0][k] + x[1][k] for k in (0, 1)]
    assert [r.deviation for r in found] == [sum((2 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    assert [r.deviation for r in whiten(spark.createDataFrame(rows, VECTORS)).where("component = 1").collect()] == [None] * 3


def test_factor_and_rotations():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(30, 12)) * 10.0 ** -np.arange(12)
    scatter = a.T @ a
    low, order = pivoted_cholesky(scatter)
    assert np.abs(low @ low.T - scatter[np.ix_(order, order)]).max() < 1e-12 * np.trace(scatter)
    assert (np.diff(np.diag(low)) <= 0).all()
    turned = one_sided_jacobi(low)
    products = turned.T @ turned
    assert np.abs(products - np.diag(np.diag(products))).max() < 1e-12 * products.max()
    values, axes = principal_axes(scatter)
    assert np.abs(values[:6] / np.linalg.eigvalsh(scatter)[::-1][:6] - 1).max() < 1e-6
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-6


# 13

TURNS = "conv_id long, turn long, role string, text string, depth string, at int"


def nodes(result):
    return sorted((-1 if r[2] is None else r[2], *r[:2], *r[3:]) for r in result.collect())


def expected_nodes(rows):
    return sorted((r[2], *r[:2], *r[3:]) for r in trie(rows))


def test_trie_equals_dictionaries(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    found = queries.op13_collapsed_sequences(spark, SF)
    assert nodes(found) == expected_nodes(rows)


def test_trie_of_odd_turns(spark):
    rng = random.Random(8)
    rows = []
    for c in [*range(-7, 60), 101, 777, 10**12]:
        if c in (0, 15, 25):  # conversations without a base
            continue
        for t in range(rng.choice([1, 1, 2, 4, 12])):
            rows.append((c, rng.choice([None, t, t]), rng.choice(["user", None]), rng.choice(["a", "é", "", None, "b"]), "x", 1))
    rows += [(None, 1, "user", "gone", "x", 1)] + rows[:20]  # no conversation; repeated rows
    found = prefix_trie(spark.createDataFrame(rows, TURNS))
    expected = expected_nodes([r[:4] for r in rows])
    assert nodes(found) == expected
    assert found.where("depth = 0").select("n_convs").first()[0] == len({r[0] for r in rows} - {None})


def test_one_conversation_with_most_turns(spark):
    """It lies on several tasks; the others share its first turns."""
    rows = [(5, t, "user", f"turn {t % 3}" * (t % 5)) for t in range(3000)]
    rows += [(c, t, "user", f"turn {t % 3}" * (t % 5)) for c in range(6, 40) for t in range(c)]
    found = prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert nodes(found) == expected_nodes(rows)


def test_most_conversations_equal(spark):
    rows = [(c, t, "user", "same" if c % 3 else f"own {c}") for c in range(900) for t in range(3)]
    found = prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert nodes(found) == expected_nodes(rows)


def test_no_turns(spark):
    assert prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b", "x", 1)], TURNS)).count() == 0


# Helpers


def test_running_sums_over_tasks(spark):
    rng = random.Random(2)
    rows = [(0 if i < 700 else i % 5, i, rng.randrange(MASK)) for i in range(1000)]
    out = numbered(spark.createDataFrame(rows, "g long, o long, v long"), "g", ["g", "o"], ["v"], ["o"])
    sums, count, expected = defaultdict(int), defaultdict(int), []
    for g, o, v in sorted(rows):
        sums[g] = (sums[g] + v) & MASK
        expected.append((g, count[g], sums[g], o))
        count[g] += 1
    assert sorted(map(tuple, out.collect())) == sorted(expected)


def test_join_with_heavy_keys(spark):
    rows = spark.range(5000).select((F.when(F.col("id") < 4000, 1).otherwise(F.col("id"))).alias("k"), "id")
    rows = rows.unionByName(spark.sql("SELECT CAST(NULL AS long) AS k, -1L AS id"))
    groups = rows.where("k < 4500").groupBy("k").agg(F.count("*").alias("n"))
    got = join_counted(rows, groups, ["k"], "n", 5001)
    assert got.count() == 5001
    assert got.where("k < 4500 and n is null").count() == 0 and got.where("k >= 4500 and n is not null").count() == 0


def test_equal_rows_part_into_blocks(spark, tmp_path):
    text = "word " * 20_000
    spark.range(60).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).write.parquet(str(tmp_path / "equal"))
    docs = spark.read.parquet(str(tmp_path / "equal"))
    total = 6 * blocks.BLOCK_BYTES
    dealt = blocks.blocked(docs, total, ["text"]).select("block", F.spark_partition_id().alias("p"))
    found = dealt.groupBy("block", "p").count().collect()
    assert len(found) == 6 == len({r.p for r in found}) == len({r.block for r in found})
    assert max(r["count"] for r in found) < 25


def test_packed_groups_hold_equal_rows_apart(spark, tmp_path):
    spark.range(200).select(F.lit(1).alias("doc_id"), F.lit("same text " * 30).alias("text")).write.parquet(str(tmp_path / "t"))
    ids = token_ids(spark.read.parquet(str(tmp_path / "t")), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert ids.select("h").distinct().count() == 200


CLASHES = {"score": "own", "rejected": "own", "n_lines": "own", "ids": "own", "n_tokens": "own", "__hash": "own", "__id": "own"}


def test_stages_leave_own_columns_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = materialize(docs.withColumns({c: F.lit(v) for c, v in CLASHES.items()}), "clashes")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        assert {tuple(r) for r in out.select(*CLASHES).distinct().collect()} <= {tuple(CLASHES.values())}
    assert out.columns[len(docs.columns) :] == ["ids_", "n_tokens_"] and out.count() == docs.count()


def test_queries_ignore_columns_of_output_names(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"labels": F.lit("own"), "n_lines": F.lit("own")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for query in (queries.op3_license_scan, queries.op5_line_spread):
        assert query(spark, str(tmp_path)).count() == docs.count()


def test_inner_lines_of_a_block_go_and_copied_pages_stay(spark):
    """A header of three lines, blank lines between; the same page on many sites."""
    block = "Head one\n\nHead two, inner\n\nHead three"
    rows = [(i, f"{block}\n\nOwn words of page {i}, longer than the head", f"s{i}") for i in range(12)]
    rows += [(100 + i, "A page that is copied\n\nto every site\nas it is", f"s{i}") for i in range(12)]
    rows += [(200 + i, f"only {i}\nfew sites", f"s{i % 9}") for i in range(30)]
    found = remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for r in found:
        assert r.n_removed == (3 if r.doc_id < 100 else 0)


def test_pages_in_forms_and_sections_named_by_their_topic():
    for page, text in (
        ("<form id='f'><div class='menu'>M</div><article><h1>H</h1><p>Long enough text</p></article></form>", "H\nLong enough text"),
        ("<form><article><p>Text without a heading</p></article><input name=q><button>Go</button></form>", "Text without a heading"),
        ("<p>Text</p><form><p>Your name</p></form>", "Text"),
        ("<article><p>A</p><section class='social-history'><p>B</p></section><section id='related-work'>C</section></article>", "A\nB\nC"),
        ("<article><p>A</p><div class='related-posts'>R</div><div class='share-buttons'>S</div></article>", "A"),
    ):
        assert main_text(page, set()) == text, page


def test_elements_within_a_line_do_not_cut_it():
    for page, text in (
        ("<p>Some <script>x</script>text <custom-x>more</custom-x> end</p>", "Some text more end"),
        ("<p>a <button>b</button>c <input>d</foo> e <select><option>f</select>g</p>", "a c d e g"),
        ("<p>a <button>never closed, but<p>b</p>", "a never closed, but\nb"),
        ("<p>a <svg><title>t</title></svg>b<hr>c</section> d</p>", "a b\nc d"),
        ("<title>t</title><p>a</p>", "a"),
    ):
        assert " ".join(main_text(page, set()).split(" ")) == text, page


def test_deep_pages_cost_what_long_pages_cost():
    for page in ("<div>x" * 16_000, "<h2>x" * 16_000, "<div><p>x" * 8_000 + "</section>" * 8_000, "<svg>x" * 8_000):
        start = time.perf_counter()
        main_text(page, {(0, 0, 0)})
        html_extract.node_values(page)
        assert time.perf_counter() - start < 4


def style_trees_by_dictionaries(pages, threshold=0.35, prior=20, least=8):
    """Texts that stay on pages of <div class=..> branches with one line each, without marks: a page is (host, [(cls, text)])."""
    counts, everywhere = defaultdict(Counter), defaultdict(Counter)
    seen = set()
    for host, lines in pages:
        content = (host, "\n".join(t for _, t in lines))
        if content not in seen:
            seen.add(content)
            for cls, text in lines:
                counts[host, cls][text] += 1
                everywhere[cls][text] += 1

    def importance(counter):
        t = sum(counter.values())
        return (math.log(t) - sum(n * math.log(n) for n in counter.values()) / t) / math.log(t) if t > 1 else 1.0

    def low(host, cls):
        own, both = counts[host, cls], everywhere[cls]
        t = sum(own.values())
        mixed = (importance(own) * t + importance(both) * prior) / (t + prior)
        return mixed < threshold and max(t, sum(both.values())) >= least

    return ["\n".join(t for c, t in lines if not (low(host, c) and everywhere[c][t] >= least)) for host, lines in pages]


def test_style_trees_equal_dictionaries(spark):
    rng = random.Random(9)
    pages = []
    for n in range(240):
        host = rng.choice(["a", "a", "b", "c"])
        lines = [("x", "Same everywhere"), ("y", f"Host line {host}"), ("z", f"Own text {n}"), ("w", rng.choice(["one", "two"]))]
        lines += [("v", f"rare {rng.randrange(40)}")] if rng.random() < 0.6 else []
        rng.shuffle(lines)
        pages.append((host, lines))
    rows = [
        (i, f"http://{host}.example/", "".join(f"<div class='{c}'>{t}</div>" for c, t in lines))
        for i, (host, lines) in enumerate(pages)
    ]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    expected = style_trees_by_dictionaries(pages)
    assert {r.page_id: r.text for r in got} == dict(enumerate(expected))
    bare = [main_text(html, set()) for _, _, html in rows]
    assert sum(a != b for a, b in zip(expected, bare, strict=True)) == len(rows)  # the trees decide, no mark does


# 3


def brute_licenses(texts):
    """Notices by the same rule, with dictionaries."""
    split = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UPPER)) for t in texts]
    df = Counter(w for ws in split for w in set(ws))
    listed = [(label, p, p, True) for label, p in license_scan.BASE.items()] + [(*t, False) for t in license_scan.TEMPLATES]
    out = [[] for _ in texts]
    for label, notice, key, base in listed:
        parts, phrase = notice.split(), key.split()
        at = next(i for i in range(len(parts)) if parts[i : i + len(phrase)] == phrase)
        rare = sorted(set(parts), key=lambda w: (df[w], w))[: license_scan.RARE]
        for ws, found in zip(split, out, strict=True):
            for s in range(-len(parts), len(ws)):
                here = lambda i: 0 <= s + i < len(ws) and ws[s + i]  # noqa: B023, E731
                if all(here(parts.index(w)) == w for w in rare) and all(here(at + i) == w for i, w in enumerate(phrase)):
                    found.append((label, s, base))
    return [sorted(f) for f in out], split


UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_licenses_equal_brute_force(spark):
    notices = [t[1] for t in license_scan.TEMPLATES]
    long = " ".join(f"w{i % 997} public license software" for i in range(20_000)) + " " + notices[-1]
    texts = [
        *notices,
        *(n.upper().replace(" ", ", ") for n in notices),
        *(f"x {n} y {n}" for n in notices[11:20]),
        *(" ".join(n.split()[2:]) for n in notices),  # the beginning is missing
        *(" ".join(n.split()[:-1] + ["other"]) for n in notices),
        *[notices[12]] * 5,
        *license_scan.BASE.values(),
        " ".join(notices), long, None, "", " . ", "license", "\u212a cc by nc",
    ]
    docs = spark.createDataFrame([(i, t, "own", 5) for i, t in enumerate(texts)], "doc_id long, text string, labels string, __scan_words int")
    expected, split = brute_licenses(texts)
    rows = license_scan.scan_licenses(docs, names={"labels": "found_labels"}).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for r, want, ws in zip(rows, expected, split, strict=True):
        base = [s for _, s, b in want if b]
        assert sorted((p.label, p.word) for p in r.places) == [(label, s) for label, s, _ in want]
        assert (r.n_words, r.n_base) == (len(ws), len(base))
        assert (r.first_word, r.last_word) == ((min(base), max(base)) if base else (None, None))
        assert r.found_labels == ",".join(sorted({label for label, *_ in want}))
        assert r.base_labels == ",".join(sorted({label for label, _, b in want if b}))
        assert (r.labels, r["__scan_words"]) == ("own", 5)
        assert 0 <= r.score <= 1 and (r.score == 1) >= bool(base) and (r.score > 0) == bool(want)
    assert all(label in {x[0] for x in want} for (label, *_), want in zip(license_scan.TEMPLATES, expected, strict=False))
    with pytest.raises(ValueError, match="other output names"):
        license_scan.scan_licenses(docs)


# 10


def test_languages_equal_plain_compression(spark):
    """Every text against every dictionary, without Spark; training from the labelled rows that are not held out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = language_id.train(docs.where(~language_id.held_out()))
    labelled = {}
    for r in docs.where(~language_id.held_out()).collect():
        if r.text and r.lang:
            labelled.setdefault(r.lang, set()).add(r.text)
    assert learned.keys() == labelled.keys() and len(learned) > 2
    for lang, content in learned.items():
        own = [t[:1000] if len(t) <= 1000 else None for t in labelled[lang]]
        assert all(t in content for t in own if t) if len(own) <= language_id.PIECES else content
    books = {}
    for lang, content in learned.items():
        book = zstandard.ZstdCompressionDict(content.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        book.precompute_compress(level=3)
        books[lang] = zstandard.ZstdCompressor(
            level=3, dict_data=book, write_checksum=False, write_content_size=False, write_dict_id=False
        )
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(-1, None), (-2, ""), (-3, "12 34 ..."), (-4, " ".join(t for _, t in rows if t)), (-5, rows[0][1]), (-5, rows[0][1])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(((r.doc_id, r.text or "", r.lang_pred, r.score, r.rejected) for r in language_id.identify(table, learned).collect()))
    expected = []
    for doc_id, text in rows:
        if not any(c.isalpha() for c in text or ""):
            expected.append((doc_id, text or "", "und", 0.0, True))
            continue
        data = text.lower().encode()
        sizes = {
            lang: sum(len(c.compress(data[i : i + 2048])) for i in range(0, len(data), 2048)) for lang, c in books.items()
        }
        (least, lang), (second, _), *_ = sorted((n, lang) for lang, n in sizes.items())
        expected.append((doc_id, text, lang, 1 - least / second, 1 - least / second < language_id.MARGIN))
    assert got == sorted(expected)


# 1


def test_vectors_of_another_width_take_no_part(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 9)] + [(20, [1.0, 2.0, 3.0]), (21, [5.0]), (22, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for r in nearest(table, table, 3).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert {q: [i for _, i in sorted(v)] for q, v in found.items()} == {
        q: [i for i in range(8, 0, -1) if i != q][:3] for q in range(1, 9)
    }
