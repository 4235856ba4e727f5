"""The operators of this package, each applied to its whole table, and oracle SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (bbit_minhash, chained_passages, chat_format, compression_quality, contour_whitening, graph_search, host_rules, licence_spans,
                         packing, pareto_mix, prefix_trie, simhash, token_counts)
from kestrel.llm.common import table


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression_quality.score(docs, compression_quality.fit(docs, table(spark, sf_dir, "labels")), 0.7)


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` has no URL; its source is the host."""
    return host_rules.judge(table(spark, sf_dir, "documents"), host="source").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "shrunk_rate", "kept")


OP2_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3),
marked AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM grams),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM marked WHERE n > 1) GROUP BY r),
rules AS (
  SELECT words.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words) AS words LEFT JOIN covered USING (r)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM rules),
hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS f FROM failed GROUP BY source),
sums AS (SELECT sum(n) AS n, sum(f) AS f, count(*) AS k, sum(n * n) AS n2, sum(f * f / n) AS ff FROM hosts),
prior AS (
  SELECT m, CASE WHEN rho > 0 THEN least(n, 1 / least(rho, 1.0) - 1) ELSE n END AS strength FROM (
    SELECT n, m, (round(ff - f * f / n, 6) / (m * (1 - m)) - (k - 1)) / greatest(n - n2 / n - (k - 1), 1.0) AS rho
    FROM (SELECT *, (f + 0.5) / (n + 1) AS m FROM sums))),
verdicts AS (SELECT source, round((f + greatest(strength, 1.0) * m) / (n + greatest(strength, 1.0)), 9) AS shrunk_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, shrunk_rate, NOT base_failed AND shrunk_rate <= 0.3 AS kept
FROM failed JOIN verdicts ON failed.source IS NOT DISTINCT FROM verdicts.source
"""

#: A conversation whose texts are control strings (fixed values of the contract).
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    for conv, turn, role, text in PROBE:
        turns = turns.unionByName(spark.range(1).select(F.lit(conv).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"),
                                                        F.lit(role).alias("role"), F.lit(text).alias("text")))
    back = chat_format.read_back(chat_format.render(chat_format.segments(turns)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("trained", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid")


OP3_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(replace(role, '\', '\\'), '([<\[])(\|turn\|>|\|text\|>|\|end\|>|s>|/s>|INST\]|/INST\]|\|endoftext\|>)', '\1\\\2', 'g') AS r,
         regexp_replace(replace(text, '\', '\\'), '([<\[])(\|turn\|>|\|text\|>|\|end\|>|s>|/s>|INST\]|/INST\]|\|endoftext\|>)', '\1\\\2', 'g') AS x,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS b FROM turns),
ordered AS (SELECT *, CASE coalesce(b, '') WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant'
                           WHEN 'assistant' THEN role = 'user' ELSE false END AS ok FROM escaped)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(r) + length(x) + length('<|turn|><|text|><|end|>')) AS BIGINT) AS formatted_chars, bool_and(ok) AS valid
FROM ordered GROUP BY conv_id
"""


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = pareto_mix.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, max_copies=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), 4096)


def op6_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10)


def op7_licence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_spans.scan(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct(F.col("phrases.label")))
    both = F.array_sort(F.array_distinct(F.concat(F.col("phrases.label"), F.col("spans.label"))))
    return found.select("doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min("phrases.word").alias("first_word"),
                        F.array_max("phrases.word").alias("last_word"), F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
                        F.coalesce(F.array_max("spans.cover"), F.when(F.size("phrases") > 0, 0.5).otherwise(0.0)).alias("score"))


def op8_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 4096, 1), 4096)


def op9_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op10_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chained_passages.passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "start_word", "n_words", "other_doc_id", "other_start_word", "other_n_words", "n_matched", "identity")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_trie.shared_starts(prefix_trie.numbered(table(spark, sf_dir, "conversations")), every=5, longest=9)
    return prefix_trie.trie(rows).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


OP11_SQL = r"""
WITH turns AS (
  SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, list(x ORDER BY n) AS l FROM turns GROUP BY conv_id),
coded AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))),
    lambda c, d: list_reduce(list_prepend(xor(c, d), CAST(range(8) AS BIGINT[])), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)),
    4294967295::BIGINT) % 9 AS h FROM convs),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.l[1:a.h], []), a.l[a.h + 1:]) AS l FROM coded AS a LEFT JOIN convs AS b ON b.conv_id = a.conv_id - a.conv_id % 5),
paths AS (SELECT conv_id, len(l) AS ends, d AS depth, md5(to_json(l[1:d])::VARCHAR) AS k, md5(to_json(l[1:d - 1])::VARCHAR) AS p, strlen(l[d].t) AS bytes
          FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT depth, k, min(p) AS p, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(min(bytes), 0) AS bytes,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends = depth), '')) AS ends_sha256 FROM paths GROUP BY depth, k),
children AS (SELECT p, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON nodes.k = children.p AND nodes.depth = children.depth),
totals AS (  -- a node counts for all the nodes on the path of its smallest member down to it
  SELECT a.depth, a.k, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved
  FROM full_nodes AS v JOIN paths AS a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY a.depth, a.k)
SELECT f.conv_id, f.depth, CASE WHEN f.depth > 0 THEN up.conv_id END AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes AS f JOIN totals ON f.depth = totals.depth AND f.k = totals.k LEFT JOIN nodes AS up ON f.p = up.k AND f.depth - 1 = up.depth
"""


def op12_contour_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = contour_whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)
    return white.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=85)


OP13_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                       ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
met AS (SELECT a.r AS u, b.r AS v, count(*) AS n FROM shingles AS a JOIN shingles AS b USING (s) WHERE a.r != b.r GROUP BY ALL),
linked AS (SELECT u, v FROM met JOIN sizes AS a ON u = a.r JOIN sizes AS b ON v = b.r WHERE 100 * met.n >= 85 * (a.n + b.n - met.n)),
reach AS (SELECT r, r AS v FROM words UNION SELECT reach.r, linked.v FROM reach JOIN linked ON reach.v = linked.u),
least AS (SELECT reach.r, min(words.doc_id) AS component_id FROM reach JOIN words ON reach.v = words.r GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM words JOIN least USING (r) LEFT JOIN sizes USING (r)
"""


QUERIES = {f.__name__: f for f in (
    op1_compression_quality, op2_host_rules, op3_chat_format, op4_pareto_mix, op5_token_counts, op6_graph_search, op7_licence_spans,
    op8_certified_packing, op9_simhash_anchors, op10_chained_passages, op11_prefix_trie, op12_contour_whitening, op13_bbit_minhash)}
ORACLE = {"op2_host_rules": OP2_SQL, "op3_chat_format": OP3_SQL, "op11_prefix_trie": OP11_SQL, "op13_bbit_minhash": OP13_SQL}
