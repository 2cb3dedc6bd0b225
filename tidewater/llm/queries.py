"""The registered queries of this subpackage and their DuckDB statements."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, exact_dedup, language_id, ngram_join, online_packing, packing, pii, quality_rules,
               spelling_variants, subword_sampling, toxicity, turn_repair, url_filters)
from ._spark import held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), url_filters.RULES)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~held_out(F.col("doc_id"))))
    return (language_id.identify(docs, model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct segmentations of every document and of every conversation turn. Rows of the two
    tables draw apart, and turns by the hash of their conversation and turn, whatever their ids."""
    number = F.expr("try_add(try_multiply(conv_id, 1000000), turn)").alias("doc_id")
    texts = {"documents": (table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]),
             "conversations": (table(spark, sf_dir, "conversations").select(number, "conv_id", "turn", "text"), ["conv_id", "turn"])}
    parts = [subword_sampling.sample_segmentations(rows, tokenizer_file("piece_bpe_32k.model"), k=2,
                                                   key=F.xxhash64(F.lit(name), *ids))
             .withColumn("input", F.lit(name)) for name, (rows, ids) in texts.items()]
    return parts[0].unionByName(parts[1])


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_conversations(table(spark, sf_dir, "conversations"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    index = toxicity.fit(docs, labels)
    return (toxicity.score_documents(docs, index)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(table(spark, sf_dir, "documents"))


def op11_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return online_packing.pack_online(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damage(turn_repair.plain(table(spark, sf_dir, "conversations"))))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_url_filters": op2_url_filters,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_id": op4_language_id,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_chat_format": op8_chat_format,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_online_packing": op11_online_packing,
    "op12_turn_repair": op12_turn_repair,
    "op13_spelling_variants": op13_spelling_variants,
}

#: A one-row table ``crc_table`` with the 256 steps of the checksum, and the checksum of ASCII text.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps)"""


def _crc_sql(codes: str) -> str:
    """DuckDB expression: CRC-32 of a list of byte values, where ``crc_table`` is joined."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
            "lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])))")


ORACLE: dict[str, str] = {
    # all pairs of distinct sets with a shingle in common: for tables of some thousand documents
    "op1_ngram_jaccard": """
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, r, list_sort(list_distinct(CASE WHEN len(w) >= 4
           THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g
  FROM words),
kinds AS (SELECT g, min(doc_id) AS rep, len(g) AS n FROM sets WHERE doc_id IS NOT NULL AND len(g) > 0 GROUP BY g),
grams AS (SELECT rep, n, unnest(g) AS gram FROM kinds),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS a, rep AS b FROM kinds UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(c.root, s.doc_id) AS component_id
FROM sets s LEFT JOIN kinds k ON k.g = s.g AND s.doc_id IS NOT NULL LEFT JOIN roots c ON c.a = k.rep
""",
    "op2_url_filters": """
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(rule, rhost, rpath, verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
hits AS (
  SELECT p.page_id, p.url, r.rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id, p.url ORDER BY length(r.rule) DESC) AS n
  FROM parts p JOIN rules r
    ON (p.host = r.rhost OR suffix(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON h.page_id = p.page_id AND h.url IS NOT DISTINCT FROM p.url AND h.n = 1
""",
    "op6_exact_dedup": """
WITH each AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS n,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM each)
SELECT doc_id, keep_id, group_size, n = 1 AS kept, text_sha256 FROM ranked
""",
    "op12_turn_repair": f"""
WITH RECURSIVE {_CRC_TABLE},
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations),
kinds AS (
  SELECT *, {_crc_sql("list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)")} % 20 AS kind
  FROM keyed CROSS JOIN crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT * FROM kinds UNION ALL SELECT * FROM kinds WHERE kind = 3) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS repeated,
         NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank
  FROM damaged),
judged AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
         CASE WHEN blank THEN 'blank' WHEN repeated THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM placed),
-- states: 0 nothing, 1 a system turn, 2 an open user turn, 3 whole pairs; up to two turns put in first
fills(state, n, pos, letters, added) AS (VALUES
  (0, 0, 0, '', []::VARCHAR[]), (1, 0, 1, '', []), (2, 0, 2, '', []), (3, 0, 3, '', []),
  (0, 1, 2, 'I', ['user:']), (1, 1, 2, 'I', ['user:']), (2, 1, 3, 'I', ['assistant:']), (3, 1, 2, 'I', ['user:']),
  (0, 2, 3, 'II', ['user:', 'assistant:']), (1, 2, 3, 'II', ['user:', 'assistant:']),
  (2, 2, 2, 'II', ['assistant:', 'user:']), (3, 2, 3, 'II', ['user:', 'assistant:'])),
edits(pos, letter, initial, goes, price) AS (VALUES
  (0, 'D', NULL, 0, 2), (1, 'D', NULL, 1, 2), (2, 'D', NULL, 2, 2), (3, 'D', NULL, 3, 2),
  (0, 'R', NULL, 2, 1), (1, 'R', NULL, 2, 1), (2, 'R', NULL, 3, 1), (3, 'R', NULL, 2, 1),
  (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0)),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS turns
  FROM conversations
  UNION ALL
  SELECT conv_id, i, state, cost, audit, turns FROM (
    SELECT w.conv_id, j.i, e.goes AS state,
           w.cost + 5 * f.n + e.price + CASE WHEN e.letter <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
           w.audit || f.letters || e.letter AS audit,
           w.turns || f.added || CASE e.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [j.role || ':' || j.text]
             ELSE [CASE WHEN e.pos = 2 THEN 'assistant:' ELSE 'user:' END || j.text] END AS turns
    FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1
    JOIN fills f ON f.state = w.state
    JOIN edits e ON e.pos = f.pos AND (e.letter <> 'K' OR e.initial = j.initial)
                AND (e.letter = 'D' OR j.fault NOT IN ('blank', 'duplicate')))
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
stats AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ends AS (
  SELECT w.conv_id, s.gaps, s.blank, s.duplicate, s.truncated, s.illegal, w.cost + 5 * f.n AS cost,
         w.audit || f.letters AS audit, w.turns || f.added AS turns
  FROM walk w LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM w.conv_id
  JOIN fills f ON f.state = w.state AND f.pos IN (0, 3)
  WHERE w.i = coalesce(s.n, 0)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + 5 * f.n, w.audit || f.letters) = 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
       sha256(array_to_string(turns, chr(10))) AS repaired_sha256
FROM ends
""",
    "op13_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
each AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, times, {_crc_sql("""flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                   ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64]::BIGINT[] END))""")} AS h
  FROM each CROSS JOIN crc_table),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
without AS (SELECT word, n, pos, left(word, pos - 1) || substr(word, pos + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM words)),
pairs AS (
  SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM without a JOIN without b
    ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM without a JOIN words b ON a.rest = b.word),
near AS (SELECT a, count(*) AS n_near, max(bn) AS best_n, arg_min(b, struct_pack(l := -bn, w := b)) AS best FROM pairs GROUP BY a),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
         CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near ON a = w.word),
chain AS (
  SELECT word, word AS root, form AS up FROM forms
  UNION ALL SELECT c.word, c.up, f.form FROM chain c JOIN forms f ON f.word = c.up)
SELECT f.word, form, c.root, n, n_near, form_n FROM forms f JOIN chain c ON c.word = f.word AND c.up IS NULL
""",
}
