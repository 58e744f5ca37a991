"""Contract queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import license_scan
from vecloom.llm.bpe import encoded_digests
from vecloom.llm.decontaminate import leaks
from vecloom.llm.exact_dedup import mark_copies
from vecloom.llm.html_extract import extract
from vecloom.llm.language_id import held_out, identify, train
from vecloom.llm.line_dedup import remove_boilerplate
from vecloom.llm.ngram_join import similar_documents
from vecloom.llm.packing import pack
from vecloom.llm.prefix_forest import nearest
from vecloom.llm.prefix_trie import prefix_trie
from vecloom.llm.repeats import remove_repeats
from vecloom.llm.whitening import whiten

MIN_SITES = 10


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_prefix_forest(spark, sf_dir):
    vectors = _read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op2_string_tiling(spark, sf_dir):
    return leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_license_scan(spark, sf_dir):
    found = license_scan.scan_licenses(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_bpe_prefixes(spark, sf_dir):
    return encoded_digests(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_line_spread(spark, sf_dir):
    cleaned = remove_boilerplate(_read(spark, sf_dir, "documents").select("doc_id", "text", "source"), min_sites=MIN_SITES)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op6_style_trees(spark, sf_dir):
    return extract(_read(spark, sf_dir, "pages"))


def op7_phrase_automata(spark, sf_dir):
    found = remove_repeats(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_grouped_prefixes(spark, sf_dir):
    return similar_documents(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_best_fit_packing(spark, sf_dir):
    return pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op10_compression_language(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    learned = train(docs.where(~held_out()))
    found = identify(docs.select("doc_id", "text"), learned)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op11_refined_copies(spark, sf_dir):
    return mark_copies(_read(spark, sf_dir, "documents"), digests=True)


def op12_cholesky_jacobi(spark, sf_dir):
    return whiten(_read(spark, sf_dir, "embeddings"))


def op13_collapsed_sequences(spark, sf_dir):
    return prefix_trie(_read(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_prefix_forest,
        op2_string_tiling,
        op3_license_scan,
        op4_bpe_prefixes,
        op5_line_spread,
        op6_style_trees,
        op7_phrase_automata,
        op8_grouped_prefixes,
        op9_best_fit_packing,
        op10_compression_language,
        op11_refined_copies,
        op12_cholesky_jacobi,
        op13_collapsed_sequences,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _license_sql() -> str:
    listed = [(f"b{i}", label, p, p, "true") for i, (label, p) in enumerate(license_scan.BASE.items())]
    listed += [(f"t{i}", *t, "false") for i, t in enumerate(license_scan.TEMPLATES)]
    rows = []
    for k, label, notice, key, base in listed:
        at = len(notice[: f" {notice} ".index(f" {key} ")].split())
        rows.append(f"('{k}', '{label}', string_split('{notice}', ' '), string_split('{key}', ' '), {at}, {base})")
    return rf"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
t(k, label, ws, phrase, pos, base) AS (VALUES {", ".join(rows)}),
tw AS (SELECT k, word, min(i) AS i FROM (
  SELECT k, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM t) GROUP BY k, word),
flat AS MATERIALIZED (SELECT doc_id, word, i FROM (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM w) WHERE word IN (SELECT word FROM tw)),
df AS (SELECT word, count(DISTINCT doc_id) AS n FROM flat GROUP BY word),
rare AS (SELECT k, word, i FROM tw LEFT JOIN df USING (word)
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY coalesce(n, 0), word) <= {license_scan.RARE}),
shares AS (SELECT k, any_value(label) AS label, any_value(base) AS base, any_value(phrase) AS phrase,
  any_value(pos) AS pos, count(*) AS n,
  (count(*) FILTER (i < pos OR i >= pos + len(phrase)) + any_value(len(phrase))) / any_value(len(ws)) AS share
  FROM rare JOIN t USING (k) GROUP BY k),
met AS (SELECT doc_id, k, flat.i - rare.i AS s, count(*) AS n FROM flat JOIN rare USING (word) GROUP BY ALL),
found AS (SELECT doc_id, s, label, base, share FROM met JOIN shares USING (k, n) JOIN w USING (doc_id)
  WHERE s + pos >= 0 AND list_slice(ws, s + pos + 1, s + pos + len(phrase)) = phrase),
per_doc AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word,
  max(s) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
  string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share FROM found GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN per_doc USING (doc_id)"""


ORACLE_SQL = {
    "op3_license_scan": _license_sql(),
    "op5_line_spread": f"""
WITH l AS MATERIALIZED (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
near AS MATERIALIZED (SELECT *, trim(line, ' ') AS x FROM l),
long AS (
  SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY length(x) DESC, x DESC) AS place
  FROM (SELECT DISTINCT doc_id, x FROM near WHERE x <> '')),
tops AS (SELECT doc_id, max(x) FILTER (place = 1) AS first, max(x) FILTER (place = 2) AS second FROM long GROUP BY doc_id),
gone AS (
  SELECT x FROM near JOIN tops USING (doc_id) WHERE x <> '' GROUP BY x
  HAVING count(DISTINCT coalesce(source, '')) >= {MIN_SITES}
    AND count(DISTINCT CASE WHEN x = first THEN coalesce(second, '') ELSE first END) >= {MIN_SITES}),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(gone.x) AS n_removed,
    string_agg(line, chr(10) ORDER BY pos) FILTER (gone.x IS NULL) AS text
  FROM near LEFT JOIN gone USING (x) GROUP BY doc_id)
SELECT doc_id, n_lines::INTEGER AS n_lines, n_removed::INTEGER AS n_removed,
  sha256(coalesce(text, '')) AS text_sha256 FROM kept""",
    "op7_phrase_automata": r"""
WITH w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS MATERIALIZED (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
win AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM w WHERE len(ws) >= 35)),
again AS (SELECT doc_id, i FROM win SEMI JOIN (SELECT h FROM win GROUP BY h HAVING count(*) > 1) USING (h)),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS i FROM again),
kept AS (
  SELECT p.doc_id, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY p.i) FILTER (gone.i IS NULL) AS text
  FROM p LEFT JOIN gone ON p.doc_id = gone.doc_id AND p.i = gone.i GROUP BY p.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op8_grouped_prefixes": rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i : i + 4], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (h)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT x, y FROM common JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id
  WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT a, y FROM reach JOIN links ON b = x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS least_id FROM reach GROUP BY a) ON a = w.doc_id""",
    "op11_refined_copies": r"""
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY h) AS group_size, row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id) = 1 AS kept,
  h AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)""",
}
