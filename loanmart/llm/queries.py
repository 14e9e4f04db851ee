"""Queries of the operators over the driver's tables, and their DuckDB SQL
where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .embedding_dedup import near_vectors
from .exact_dedup import exact_dedup
from .filter_audit import filter_audit
from .importance import importance_resample
from .line_dedup import line_dedup
from .lm_scoring import lm_scores
from .packing import pack
from .pieces import encode_round_trip
from .quality import classify
from .simhash import simhash_groups
from .substring_dedup import repeated_spans
from .token_counts import token_counts
from .warc import pages_round_trip


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_spans(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "start", "stop", "cluster", F.col("keep_id").alias("keep_doc_id"), "removed")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = """
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
     keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
     common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
                GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
     marked AS (SELECT k.*, c.key IS NOT NULL AND c.last <> k.doc_id AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_round_trip(read(spark, sf_dir, "pages"))


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS bytes FROM pages),
     g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, bytes::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM g
"""

def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_round_trip(read(spark, sf_dir, "documents"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH step AS (SELECT list(c ORDER BY i) AS crc_of_byte FROM (
       SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
       FROM range(256) t(i))),
     found AS (SELECT 'corpus' AS side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
               UNION ALL
               SELECT 'target', NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
     each_word AS (SELECT side, doc_id, unnest(words) AS word FROM found),
     vocabulary AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM each_word)),
     hashed AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT)),
                       lambda c, b: xor(crc_of_byte[xor(c & 255, b) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM vocabulary, step),
     placed AS (SELECT side, doc_id, bucket FROM each_word JOIN hashed USING (word)),
     counts AS (SELECT bucket, count(*) FILTER (WHERE side = 'corpus') AS s, count(*) FILTER (WHERE side = 'target') AS t FROM placed GROUP BY bucket),
     totals AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM counts),
     gain AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (ss + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (tt + 10000)::DOUBLE)))::BIGINT AS g FROM counts, totals),
     weights AS (SELECT doc_id, sum(g)::BIGINT AS weight FROM placed JOIN gain USING (bucket) WHERE side = 'corpus' GROUP BY doc_id),
     scored AS (SELECT f.doc_id, len(f.words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                       coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || f.doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
                FROM found f LEFT JOIN weights w ON f.doc_id = w.doc_id WHERE side = 'corpus'),
     drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored s LEFT JOIN drawn d ON s.doc_id = d.doc_id
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
     orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
                WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
     steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
     told AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                     min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
     rated AS (SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
     fails AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                      CASE WHEN len(words) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
                      || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
                      || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN first < told.doc_id THEN 'E' ELSE '' END AS failed
               FROM told LEFT JOIN rated ON told.doc_id = rated.doc_id),
     kinds AS (SELECT part, good, toxic, failed, count(*) AS n FROM fails GROUP BY ALL),
     met AS (SELECT part, filter_order, step, good, toxic, n, substr(filter_order, step, 1) AS letter, failed, contains(failed, substr(filter_order, step, 1)) AS here,
                    len(list_filter(range(1, step), lambda k: contains(failed, substr(filter_order, k, 1)))) > 0 AS earlier FROM kinds, steps),
     counted AS (SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (WHERE NOT here AND NOT earlier), 0)::BIGINT AS kept,
                        coalesce(sum(n) FILTER (WHERE here AND NOT earlier), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (WHERE here AND earlier), 0)::BIGINT AS redundant,
                        coalesce(sum(n) FILTER (WHERE failed = letter), 0)::BIGINT AS unique_fails,
                        coalesce(sum(n) FILTER (WHERE here AND NOT earlier AND good), 0)::BIGINT AS good_lost,
                        coalesce(sum(n) FILTER (WHERE here AND NOT earlier AND toxic), 0)::BIGINT AS toxic_lost
                 FROM met GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley FROM counted
"""


QUERIES = {"op1_token_counts": op1_token_counts, "op2_packing": op2_packing, "op3_exact_dedup": op3_exact_dedup, "op4_substring_dedup": op4_substring_dedup, "op5_embedding_dedup": op5_embedding_dedup,
           "op6_quality": op6_quality, "op7_line_dedup": op7_line_dedup, "op8_simhash": op8_simhash, "op9_warc": op9_warc,
           "op10_sentencepiece": op10_sentencepiece, "op11_lm_scoring": op11_lm_scoring, "op12_importance": op12_importance, "op13_filter_audit": op13_filter_audit}
ORACLE_SQL = {"op3_exact_dedup": OP3_SQL, "op7_line_dedup": OP7_SQL, "op9_warc": OP9_SQL, "op12_importance": OP12_SQL, "op13_filter_audit": OP13_SQL}
