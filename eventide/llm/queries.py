"""Registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (bpe, conv_repair, hard_negatives, html_cut, licences, ngram_join, packing, quality_rules,
               quotes, sharding, topk, toxicity, url_filter)
from .common import table

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
             ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
             ("block", "net", "/fr/")]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.similar_groups(table(spark, sf_dir, "documents"), size=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"), 40)


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(table(spark, sf_dir, "embeddings"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "labels"))


def op6_reply_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_ordered(table(spark, sf_dir, "conversations"))


def op7_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_cut.extract(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv_repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    seventh = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), seventh)


def op13_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.verdicts(table(spark, sf_dir, "pages"), rules)


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_bpe_round_trip, op3_balanced_shards, op4_exact_topk,
    op5_quality_rules, op6_reply_ordered, op7_min_slack_packing, op8_main_text, op9_toxicity,
    op10_licence_scan, op11_conversation_repair, op12_hard_negatives, op13_url_cascade)}

SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
          SELECT doc_id, list_distinct(CASE
              WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2),
                                                   lambda i: array_to_string(w[i:i + 3], ' '))
              WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
              ELSE [] END) AS s FROM w),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        pairs AS (
          SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n
          HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
        reach AS (
          SELECT doc_id, doc_id AS root FROM sets
          UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.root)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.root) AS component_id
        FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, s.s""",
    "op3_balanced_shards": """
        WITH steps AS (      -- CRC-32 of every byte value
          SELECT list_transform(range(256), lambda b: list_reduce(
            [b, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, e: xor(a >> 1, 3988292384 * (a & 1)))) AS tab),
        d AS (
          SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
                 xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
                   regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                   lambda x: ('0x' || x)::BIGINT)),
                   lambda a, e: xor(a >> 8, tab[(xor(a, e) & 255) + 1]))) AS text_crc32
          FROM documents, steps),
        placed AS (
          SELECT *, row_number() OVER o AS nth, SUM(size) OVER () AS total,
                 SUM(size) OVER (o ROWS UNBOUNDED PRECEDING) AS upto
          FROM d WINDOW o AS (ORDER BY doc_id NULLS FIRST, text_crc32, size)),
        cut AS (
          SELECT *, least(39, (2 * upto - size) * 40 // (2 * total))::INTEGER AS shard FROM placed)
        SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY nth) - 1 AS slot,
               NULL::INTEGER AS grown_shard
        FROM cut""",
    "op6_reply_ordered": r"""
        WITH RECURSIVE m AS (
          SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS raw FROM conversations),
        k AS (SELECT *, md5(concat_ws(chr(10), role, raw)) AS key,
                     str_split(raw, chr(10)) AS ls FROM m),
        l AS (SELECT conv_id, turn, role, key, unnest(ls) AS line,
                     generate_subscripts(ls, 1) AS pos FROM k),
        q AS (SELECT *, length(regexp_replace(regexp_extract(line, '^[ \t]*(?:>[ \t]*)+'),
                                              '[^>]', '', 'g')) AS level,
                     regexp_replace(line, '^[ \t]*(?:>[ \t]*)+', '') AS rest FROM l),
        b AS (SELECT conv_id, turn, role, key,
                     trim(regexp_replace(coalesce(string_agg(rest, chr(10) ORDER BY pos)
                       FILTER (WHERE level = 0), ''), '\n{3,}', chr(10) || chr(10), 'g'), ' ') AS body,
                     count(*) FILTER (WHERE level > 0) AS quoted_lines,
                     max(level) AS quote_levels
              FROM q GROUP BY ALL),
        -- whole bodies, paragraphs, lines, and the sentences of both; chr(1) ends a sentence
        parts AS (
          SELECT conv_id, turn, body, regexp_split_to_array(body, '\n[ \t]*\n') AS paras,
                 str_split(body, chr(10)) AS ls FROM b),
        units AS (
          SELECT DISTINCT conv_id, turn,
            md5(trim(regexp_replace(lower(u), '[^\p{L}\p{N}]+', ' ', 'g'), ' ')) AS hash,
            length(trim(regexp_replace(lower(u), '[^\p{L}\p{N}]+', ' ', 'g'), ' ')) AS size
          FROM (SELECT conv_id, turn, unnest(list_concat([body], paras, ls, flatten(list_transform(
                  list_concat(paras, ls), lambda x: str_split(regexp_replace(regexp_replace(x,
                  '([.!?…]["'')\]”’]{0,2})[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'),
                  '([。！？])', '\1' || chr(1), 'g'), chr(1)))))) AS u
                FROM parts)),
        runs AS (
          SELECT *, pos - row_number() OVER (PARTITION BY conv_id, turn, key, level ORDER BY pos) AS run
          FROM q WHERE level > 0),
        quoted AS (
          SELECT conv_id, turn, key, level, run, string_agg(rest, chr(10) ORDER BY pos) AS whole,
                 list(rest ORDER BY pos) AS ls FROM runs GROUP BY ALL),
        split AS (
          SELECT *, regexp_split_to_array(whole, '\n[ \t]*\n') AS paras FROM quoted),
        texts AS (
          SELECT conv_id, turn, key, level, run, 0 AS priority, whole AS t FROM split
          UNION ALL SELECT conv_id, turn, key, level, run, 1, unnest(paras) FROM split
          UNION ALL SELECT conv_id, turn, key, level, run, 2, unnest(list_concat(ls, flatten(
            list_transform(list_concat(paras, ls), lambda x: str_split(regexp_replace(regexp_replace(x,
                  '([.!?…]["'')\]”’]{0,2})[ \t\n\x0B\f\r]+', '\1' || chr(1), 'g'),
                  '([。！？])', '\1' || chr(1), 'g'), chr(1))))))
          FROM split),
        probes AS (
          SELECT conv_id, turn, key, level, run, priority,
            length(trim(regexp_replace(lower(t), '[^\p{L}\p{N}]+', ' ', 'g'), ' ')) AS size,
            md5(trim(regexp_replace(lower(t), '[^\p{L}\p{N}]+', ' ', 'g'), ' ')) AS hash
          FROM texts),
        found AS (
          SELECT p.conv_id, p.turn, p.key, p.level, p.run, p.priority, p.size, max(u.turn) AS source
          FROM probes p JOIN units u ON p.conv_id = u.conv_id AND p.hash = u.hash
            AND u.turn < p.turn AND p.size > 0
          GROUP BY ALL),
        best AS (
          SELECT * FROM found QUALIFY row_number() OVER (
            PARTITION BY conv_id, turn, key, level, run
            ORDER BY priority, size DESC, source DESC) = 1),
        levels AS (
          SELECT conv_id, turn, key, level, max(source) AS source FROM best GROUP BY ALL),
        links AS (
          SELECT conv_id, turn, key, source AS answers FROM levels
          QUALIFY row_number() OVER (PARTITION BY conv_id, turn, key ORDER BY level) = 1),
        ups AS (SELECT conv_id, turn, max(answers) AS up FROM links GROUP BY ALL),
        climb AS (
          SELECT conv_id, turn, up FROM ups
          UNION SELECT c.conv_id, c.turn, u.up FROM climb c
          JOIN ups u ON u.conv_id = c.conv_id AND u.turn = c.up),
        roots AS (SELECT conv_id, turn, min(up) AS thread_turn FROM climb GROUP BY ALL)
        SELECT b.conv_id, b.turn, b.role, b.body, b.quoted_lines::BIGINT AS quoted_lines,
               b.quote_levels::BIGINT AS quote_levels, k.answers,
               coalesce(r.thread_turn, b.turn) AS thread_turn
        FROM b LEFT JOIN links k ON k.conv_id = b.conv_id AND k.turn = b.turn AND k.key = b.key
        LEFT JOIN roots r ON r.conv_id = b.conv_id AND r.turn = b.turn""",
    "op4_exact_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 list_dot_product(q.v, c.v)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
          FROM scored)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_conversation_repair": r"""
        WITH RECURSIVE k AS (
          SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn,
                 coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS key
          FROM conversations),
        kinds AS (          -- CRC-32: a byte is followed by eight shifts
          SELECT *, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
              string_split(key, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
              lambda a, e: CASE WHEN e >= 0 THEN xor(a, e)
                                ELSE xor(a >> 1, 3988292384 * (a & 1)) END)) % 20 AS kind
          FROM k),
        d AS (
          SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END))
          FROM kinds WHERE kind <> 0),
        o AS (
          SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS seen,
                 rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS shown
          FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i
                FROM d)),
        f AS (
          SELECT *, left(role, 1) AS x,
                 CASE WHEN shown = '' THEN 'b' WHEN seen > 1 THEN 'd'
                      WHEN right(shown, 1) IN ('.', '!', '?') THEN '' ELSE 't' END AS fault,
                 lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
          FROM o),
        stats AS (
          SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                 count(*) FILTER (fault = 't') AS truncated,
                 count(*) FILTER (before IS NOT NULL
                                  AND before || x NOT IN ('su', 'ua', 'au')) AS illegal,
                 max(i) AS n
          FROM f GROUP BY c),
        -- per row from the end: (cost, initial, edits, repaired rows) for the grammar's states
        -- 0 nothing yet, 1 after the system row, 2 after a user, 3 after an assistant
        best AS (
          SELECT c, n + 1 AS i, {'c': 0::BIGINT, 'e': '', 'a': '', 'r': []::VARCHAR[]} AS s0,
                 {'c': 4::BIGINT, 'e': 'I', 'a': 'II', 'r': ['user:', 'assistant:']} AS s1,
                 {'c': 2::BIGINT, 'e': 'I', 'a': 'I', 'r': ['assistant:']} AS s2,
                 {'c': 0::BIGINT, 'e': '', 'a': '', 'r': []::VARCHAR[]} AS s3
          FROM stats
          UNION ALL
          SELECT c, i,
            list_min([b0, {'c': 2 + b2.c, 'e': 'I', 'a': 'I' || b2.a,
                           'r': list_prepend('user:', b2.r)}]),
            list_min([b1, {'c': 2 + b2.c, 'e': 'I', 'a': 'I' || b2.a,
                           'r': list_prepend('user:', b2.r)}]), b2, b3
          FROM (
            SELECT c, i, n0 AS b0, n1 AS b1,
              list_min([n2, {'c': 2 + n3.c, 'e': 'I', 'a': 'I' || n3.a,
                             'r': list_prepend('assistant:', n3.r)}]) AS b2,
              list_min([n3, {'c': 2 + n2.c, 'e': 'I', 'a': 'I' || n2.a,
                             'r': list_prepend('user:', n2.r)}]) AS b3
            FROM (
              SELECT c, i,
                list_min([{'c': 3 + s0.c, 'e': 'D', 'a': 'D' || s0.a, 'r': s0.r},
                  CASE WHEN stays AND x = 's' THEN {'c': t + s1.c, 'e': 'K', 'a': 'K' || s1.a,
                                                    'r': list_prepend(own, s1.r)}
                       WHEN stays AND x = 'u' THEN {'c': t + s2.c, 'e': 'K', 'a': 'K' || s2.a,
                                                    'r': list_prepend(own, s2.r)} END,
                  CASE WHEN stays THEN {'c': 2 + t + s2.c, 'e': 'R', 'a': 'R' || s2.a,
                                        'r': list_prepend('user:' || text, s2.r)} END]) AS n0,
                list_min([{'c': 3 + s1.c, 'e': 'D', 'a': 'D' || s1.a, 'r': s1.r},
                  CASE WHEN stays AND x = 'u' THEN {'c': t + s2.c, 'e': 'K', 'a': 'K' || s2.a,
                                                    'r': list_prepend(own, s2.r)} END,
                  CASE WHEN stays THEN {'c': 2 + t + s2.c, 'e': 'R', 'a': 'R' || s2.a,
                                        'r': list_prepend('user:' || text, s2.r)} END]) AS n1,
                list_min([{'c': 3 + s2.c, 'e': 'D', 'a': 'D' || s2.a, 'r': s2.r},
                  CASE WHEN stays AND x = 'a' THEN {'c': t + s3.c, 'e': 'K', 'a': 'K' || s3.a,
                                                    'r': list_prepend(own, s3.r)} END,
                  CASE WHEN stays THEN {'c': 2 + t + s3.c, 'e': 'R', 'a': 'R' || s3.a,
                                        'r': list_prepend('assistant:' || text, s3.r)} END]) AS n2,
                list_min([{'c': 3 + s3.c, 'e': 'D', 'a': 'D' || s3.a, 'r': s3.r},
                  CASE WHEN stays AND x = 'u' THEN {'c': t + s2.c, 'e': 'K', 'a': 'K' || s2.a,
                                                    'r': list_prepend(own, s2.r)} END,
                  CASE WHEN stays THEN {'c': 2 + t + s2.c, 'e': 'R', 'a': 'R' || s2.a,
                                        'r': list_prepend('user:' || text, s2.r)} END]) AS n3
              FROM (
                SELECT f.c, f.i, f.x, f.text, role || ':' || f.text AS own, s0, s1, s2, s3,
                       fault NOT IN ('b', 'd') AS stays, CASE fault WHEN 't' THEN 1 ELSE 0 END AS t
                FROM best JOIN f ON f.c = best.c AND f.i = best.i - 1)))),
        found AS (SELECT c, s0 FROM best WHERE i = 1)
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
               coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0) AS cost,
               coalesce(s0.a, '') AS audit,
               sha256(coalesce(array_to_string(s0.r, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT c, conv_id FROM k) LEFT JOIN stats USING (c) LEFT JOIN found USING (c)""",
    "op12_hard_negatives": """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                 list_dot_product(a.v, c.v)::BIGINT AS score
          FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        ranked AS (
          SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                 row_number() OVER (PARTITION BY anchor_id, positive_id
                                    ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
          FROM positives p JOIN scored s USING (anchor_id)
          WHERE NOT s.same AND 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM ranked WHERE rank <= 10""",
    "op13_url_cascade": r"""
        WITH u AS (
          SELECT page_id, CASE WHEN strpos(url, '://') > 0
                               THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest
          FROM pages),
        p AS (
          SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        rules(verdict, rh, rp) AS (
          VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
                 ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'),
                 ('block', 'net', '/fr/')),
        r AS (
          SELECT p.*, (SELECT max_by({'rule': rh || rp, 'verdict': verdict}, length(rh || rp))
                       FROM rules WHERE (p.host = rh OR ends_with(p.host, '.' || rh))
                                    AND starts_with(p.path, rp)) AS won
          FROM p)
        SELECT page_id, host, path, won.rule AS rule, coalesce(won.verdict, 'allow') AS verdict
        FROM r""",
}
