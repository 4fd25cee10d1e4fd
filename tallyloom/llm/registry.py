"""The thin queries of this subpackage, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, content_sort, decontaminate, hamming_topk, language_crf, license_scan, near_dups, packing, phrase_mining, pseudo_likelihood, rans_files, turn_repair, unigram_counts
from .common import Work, table


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score_corpus(spark, table(spark, sf_dir, "documents"))


def op2_license_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op3_unigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op4_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = language_crf.labelled(spark, docs.select("doc_id", "text"), language_crf.learn(docs))
    return rows.select("doc_id", language_crf.held_out().alias("held_out"), "language.lang_pred", "language.score")


def op5_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    one = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(one)
    return chat.digests(*chat.format_conversations(spark, turns))


def op6_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming_topk.sign_code("embedding").alias("code"))
    return hamming_topk.top_k(spark, rows, rows.filter("id % 50 = 0").withColumnRenamed("id", "query_id"))


def op7_benchmark_edit_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.found(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Work(spark, "rans-files").path("out")
    rans_files.write_ids(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), path)
    return rans_files.read_ids(spark, path)


def op10_odd_sketch_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(spark, table(spark, sf_dir, "documents"), near_dups.Similarity(width=2, percent=80))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turn_repair.repaired_digests(turns, *turn_repair.repair(spark, turn_repair.damage(turns)))


def op12_phrase_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.mine(spark, table(spark, sf_dir, "documents"))


def op13_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.duplicates(spark, table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_masked_pseudo_likelihood,
        op2_license_compression,
        op3_unigram_counts,
        op4_language_crf,
        op5_chat_prefix_targets,
        op6_hamming_topk,
        op7_benchmark_edit_matches,
        op8_best_fit_packing,
        op9_rans_token_files,
        op10_odd_sketch_near_dups,
        op11_turn_repair,
        op12_phrase_filters,
        op13_content_sort,
    )
}

_ESCAPED = "(length({0}) + length({0}) - length(replace({0}, '\\', '')) + length({0}) - length(replace({0}, '<', '')) + length({0}) - length(replace({0}, '#', '')))"

_CODE = " + ".join(f"(CASE WHEN embedding[{i + 1}] > 0 AND NOT isnan(embedding[{i + 1}]) THEN {1 << i}::UBIGINT ELSE 0::UBIGINT END)" for i in range(64))


def _moved(stays: str, comes: str, initial: str) -> str:
    """SQL: the least (cost, audit) of a state after a row: deleted, kept or given another role."""
    options = [f"{{'c': {stays}.c + 2, 'a': {stays}.a || 'D'}}"] if stays != "NULL" else []
    if comes != "NULL":
        options += [f"CASE WHEN NOT goes AND initial = {initial} THEN {{'c': {comes}.c + more, 'a': {comes}.a || 'K'}} END"]
        if initial != "'s'":
            options += [f"CASE WHEN NOT goes THEN {{'c': {comes}.c + 1 + more, 'a': {comes}.a || 'R'}} END"]
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x.c IS NOT NULL))"


ORACLE = {
    "op6_hamming_topk": f"""
WITH codes AS (SELECT DISTINCT vec_id AS id, {_CODE} AS code FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) >= 64),
ranked AS (
  SELECT q.id AS query_id, c.id, bit_count(xor(q.code, c.code))::INTEGER AS distance,
    row_number() OVER (PARTITION BY q.id, q.code ORDER BY bit_count(xor(q.code, c.code)), c.id)::INTEGER AS rank
  FROM codes q JOIN codes c ON q.id <> c.id WHERE q.id % 50 = 0
)
SELECT query_id, rank, id, distance FROM ranked WHERE rank <= 10
""",
    "op10_odd_sketch_near_dups": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words
),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  WHERE least(p.n, q.n) * 100 >= greatest(p.n, q.n) * 80
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM sizes UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sizes s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = s.doc_id
""",
    "op5_chat_prefix_targets": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) AS v(conv_id, turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({_ESCAPED.format("role")} + length(role) - length(replace(role, ':', '')) + {_ESCAPED.format("text")} + 14)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples
FROM turns GROUP BY conv_id
""",
    "op11_turn_repair": rf"""
WITH RECURSIVE crcs AS (
  SELECT list(list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) AS r(i)
),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT) AS bytes
  FROM conversations
),
kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind FROM keyed, crcs
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)
),
timed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS time FROM damaged
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, time) AS k,
    CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'x' END AS initial, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS said
  FROM timed
),
faulty AS (
  SELECT *, CASE WHEN said = '' THEN 'blank' WHEN time > 1 THEN 'duplicate' WHEN said[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS pair
  FROM placed
),
closed AS MATERIALIZED (
  SELECT conv_id, k, initial, fault IN ('blank', 'duplicate') AS goes, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM faulty
),
search(conv_id, k, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0, 'a': ''}}, NULL::STRUCT(c INTEGER, a VARCHAR), {{'c': 5, 'a': 'I'}}, {{'c': 10, 'a': 'II'}} FROM closed
  UNION ALL
  SELECT conv_id, k, n0, n1, list_min(list_filter([n2, {{'c': n0.c + 5, 'a': n0.a || 'I'}}, {{'c': n1.c + 5, 'a': n1.a || 'I'}}, {{'c': n3.c + 5, 'a': n3.a || 'I'}}], lambda x: x.c IS NOT NULL)),
    list_min(list_filter([n3, {{'c': n2.c + 5, 'a': n2.a || 'I'}}, {{'c': n0.c + 10, 'a': n0.a || 'II'}}, {{'c': n1.c + 10, 'a': n1.a || 'II'}}], lambda x: x.c IS NOT NULL))
  FROM (
    SELECT r.conv_id, r.k, {_moved("s0", "NULL", "NULL")} AS n0, {_moved("s1", "s0", "'s'")} AS n1,
      list_min(list_filter([{_moved("s2", "s0", "'u'")}, {_moved("NULL", "s1", "'u'")}, {_moved("NULL", "s3", "'u'")}], lambda x: x.c IS NOT NULL)) AS n2, {_moved("s3", "s2", "'a'")} AS n3
    FROM search s JOIN closed r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.k = s.k + 1
  )
),
ended AS (
  SELECT conv_id, list_min(list_filter([s0, s3], lambda x: x.c IS NOT NULL)) AS best FROM search QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1
),
letters AS (
  SELECT conv_id, i, best.a[i] AS letter FROM ended, unnest(range(1, length(best.a) + 1)) AS u(i)
),
numbered AS (
  SELECT *, sum((letter <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY i) AS k, sum((letter <> 'D')::INT) OVER (PARTITION BY conv_id ORDER BY i) AS j FROM letters
),
finals AS (
  SELECT l.conv_id, l.i, l.j, l.letter, f.role, CASE WHEN l.letter = 'I' THEN '' ELSE f.text END AS text,
    first_value(l.letter = 'K' AND f.initial = 's') OVER (PARTITION BY l.conv_id ORDER BY l.j)::INT AS shift
  FROM numbered l LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.k = l.k WHERE l.letter <> 'D'
),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (j - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS said FROM finals GROUP BY conv_id
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT i.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
  coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.best.c, 0)::BIGINT AS cost, coalesce(e.best.a, '') AS audit, sha256(coalesce(t.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM i.conv_id
""",
    "op12_phrase_filters": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
f AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS g, count(*) AS f
  FROM lists, (VALUES (1), (2), (3), (4)) AS v(m), unnest(range(1, len(w) - m + 2)) AS u(i) GROUP BY ALL
),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, g, f AS a, string_split(g, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
longer AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS g, max(a) AS longer FROM candidates, (VALUES (2), (3)) AS v(s), unnest(range(1, m - s + 2)) AS u(i) WHERE s < m GROUP BY ALL
),
cuts AS (
  SELECT c.lang, c.g, c.a, k, l.f AS l, r.f AS r, ((2000000 * c.a::HUGEINT) // (l.f::HUGEINT + r.f::HUGEINT))::BIGINT AS score
  FROM candidates c, unnest(range(1, m)) AS u(k)
  JOIN f l ON l.lang = c.lang AND l.g = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.g = array_to_string(w[k + 1:], ' ')
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.g) AS rank, b.g AS phrase, b.a, b.l, b.r, b.score
  FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.g = b.g WHERE o.longer IS NULL OR 100 * o.longer < 80 * b.a
)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000
""",
    "op13_content_sort": r"""
WITH rows AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content, length(coalesce(text, '')) AS chars FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY content)::BIGINT AS group_size, row_number() OVER best = 1 AS kept, sha256(content) AS text_sha256
FROM rows WINDOW best AS (PARTITION BY content ORDER BY chars DESC, doc_id NULLS LAST)
""",
}
