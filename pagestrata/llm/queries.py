"""Thin queries: each operator over its whole table, with the contract's columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import op1_pii, op2_suffixes, op3_lines, op4_rans, op5_counts, op6_decontaminate, op7_quality, op8_neardup, op9_packing, op10_blocks, op11_sentencepiece, op12_spelling, op13_whitening
from .common import read_table


def op1_pii_query(spark, sf_dir):
    return op1_pii.digest(op1_pii.find_pii(read_table(spark, sf_dir, "documents")))


def op2_substring_suffixes(spark, sf_dir):
    found = op2_suffixes.repeated_bytes(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_line_dedup(spark, sf_dir):
    found = op3_lines.dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_token_files(spark, sf_dir):
    return op4_rans.round_trip(read_table(spark, sf_dir, "documents"))


def op5_token_counts(spark, sf_dir):
    return op5_counts.token_counts(read_table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir):
    return op6_decontaminate.digest(op6_decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


def op7_quality_rules(spark, sf_dir):
    return op7_quality.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_near_duplicates(spark, sf_dir):
    return op8_neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_packing_query(spark, sf_dir):
    return op9_packing.pack(read_table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op10_substring_blocks(spark, sf_dir):
    found = op10_blocks.repeated_words(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_sentencepiece_query(spark, sf_dir):
    return op11_sentencepiece.digest(op11_sentencepiece.encode(read_table(spark, sf_dir, "documents")))


def op12_spelling_variants(spark, sf_dir):
    return op12_spelling.spelling_groups(read_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark, sf_dir):
    return op13_whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_pii": op1_pii_query,
    "op2_substring_suffixes": op2_substring_suffixes,
    "op3_line_dedup": op3_line_dedup,
    "op4_token_files": op4_token_files,
    "op5_token_counts": op5_token_counts,
    "op6_decontamination": op6_decontamination,
    "op7_quality_rules": op7_quality_rules,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_packing": op9_packing_query,
    "op10_substring_blocks": op10_substring_blocks,
    "op11_sentencepiece": op11_sentencepiece_query,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLES = {
    "op3_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, i AS pos, ls[i] AS line,
         translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
held AS (SELECT k, min(doc_id) AS first_doc FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT l.*, h.k IS NOT NULL AND l.doc_id <> h.first_doc AS gone FROM lines l LEFT JOIN held h ON l.k = h.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op12_spelling_variants": r"""
WITH RECURSIVE tab_ AS (SELECT list(v ORDER BY n) AS tab FROM (SELECT n, list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END) AS v FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n))),
runs_ AS (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY doc_id, run),
bytes_ AS (SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(c) - 64 AS BIGINT)] END)) AS b FROM runs_ WHERE length(run) >= 5),
crc_ AS (SELECT run, k, xor(CAST(4294967295 AS BIGINT), list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) AS h FROM bytes_, tab_),
words_ AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM crc_) WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut_ AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words_)),
pairs_ AS (SELECT c.word AS a, w.word AS b FROM cut_ c JOIN words_ w ON c.v = w.word UNION SELECT w.word, c.word FROM cut_ c JOIN words_ w ON c.v = w.word UNION SELECT x.word, y.word FROM cut_ x JOIN cut_ y ON x.i = y.i AND x.v = y.v AND x.word <> y.word),
near_ AS (SELECT a, b, n, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS r, count(*) OVER (PARTITION BY a) AS n_near FROM pairs_ JOIN words_ ON word = b),
forms_ AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN t.n >= 2 * w.n THEN b END AS form, CASE WHEN t.n >= 2 * w.n THEN t.n END AS form_n FROM words_ w LEFT JOIN near_ t ON a = word AND r = 1),
walk_ AS (SELECT word, form AS top FROM forms_ WHERE form IS NOT NULL UNION ALL SELECT k.word, f.form FROM walk_ k JOIN forms_ f ON f.word = k.top WHERE f.form IS NOT NULL),
last_ AS (SELECT k.word, k.top FROM walk_ k JOIN forms_ f ON f.word = k.top WHERE f.form IS NULL)
SELECT f.word, form, coalesce(top, f.word) AS root, n, n_near, form_n FROM forms_ f LEFT JOIN last_ l ON l.word = f.word""",
}
