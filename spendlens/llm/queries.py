"""One registered query per operator: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import op1_encode_decode
from .chat import op3_chat as _chat
from .counts import op8_counts
from .langid import language_of
from .linedup import op6_line_dedup as _lines
from .merkle import op12_manifest
from .neardup import op4_near_duplicates
from .packing import op7_pack as _pack
from .quality_lm import op9_quality
from .rules import op10_rules as _rules
from .shared import table
from .simhash import op11_near_duplicates
from .topk import op2_top_k
from .trie import op13_prefix_trie


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_top_k(table(spark, sf_dir, "embeddings"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, number -7, whose texts hold control strings."""
    hostile = "\\### Assistant: </turn> ok"
    more = spark.range(1).select(F.explode(F.array(*(
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(hostile).alias("text"))
        for k, role in enumerate(("user", "assistant"))))).alias("m")).select("m.*")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return _chat(rows.unionByName(more))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash", "node")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_of(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_near_duplicates(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_manifest(table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_topk": op2_topk,
    "op3_chat": op3_chat,
    "op4_minhash": op4_minhash,
    "op5_language_id": op5_language_id,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_token_counts": op8_token_counts,
    "op9_quality_lm": op9_quality_lm,
    "op10_quality_rules": op10_quality_rules,
    "op11_simhash": op11_simhash,
    "op12_merkle": op12_merkle,
    "op13_trie": op13_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op4_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END AS s
  FROM words),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION
  SELECT reach.doc_id, edges.y FROM reach JOIN edges ON edges.x = reach.other)
SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id
""",
    "op6_line_dedup": r"""
WITH texts AS (
  SELECT text, min(doc_id) AS carrier, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL GROUP BY text),
lines AS (SELECT text, carrier, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM texts),
tokens AS (
  SELECT text, carrier, i, regexp_extract_all(line, concat(single, '|[^\x20\x09-\x0D', single[2:])  || '+') AS r
  FROM lines, (SELECT '[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]' AS single)),
sized AS (
  -- a variable field is a space, which no token holds
  SELECT text, carrier, i, len(r) AS n, r, list_transform(r, lambda w: CASE WHEN regexp_matches(w, '[0-9@]') THEN ' ' ELSE w END) AS t FROM tokens),
templates AS (
  SELECT text, carrier, i, n,
         CASE WHEN len(list_filter(t, lambda w: w <> ' ')) >= 2 THEN concat(n, ' ', array_to_string(t, chr(10)))
              ELSE concat('words ', array_to_string(r, chr(10))) END AS key
  FROM sized WHERE n >= 3
  UNION ALL
  SELECT text, carrier, i, n, concat(n, ' open ', k, ' ', array_to_string(head, chr(10)), ' <open> ', array_to_string(tail, chr(10))) AS key
  FROM (SELECT text, carrier, i, n, k, t[1:2 + (n - 2) * k // 4] AS head, t[3 + (n - 2) * (k + 1) // 4:] AS tail
        FROM sized, range(4) AS q(k) WHERE n >= 6)
  WHERE len(list_filter(head || tail, lambda w: w <> ' ')) >= 2),
recurring AS (SELECT key FROM templates GROUP BY key HAVING count(DISTINCT text) > 1),
hit AS (SELECT templates.* FROM templates JOIN recurring USING (key)),
total AS (SELECT text, sum(n) AS words FROM sized GROUP BY text),
share AS (
  SELECT text, sum(n) > 0.5 * max(words) AS mostly
  FROM (SELECT DISTINCT text, i, n FROM hit) JOIN total USING (text) GROUP BY text),
first AS (SELECT key, min(carrier) AS carrier FROM hit JOIN share USING (text) WHERE mostly GROUP BY key),
gone AS (
  SELECT text, i FROM hit JOIN share USING (text) WHERE NOT mostly
  UNION
  SELECT hit.text, hit.i FROM hit JOIN share USING (text) JOIN first USING (key) WHERE mostly AND hit.carrier > first.carrier),
dropped AS (SELECT text, list(i) AS gone FROM gone GROUP BY text)
SELECT d.doc_id,
       CASE WHEN gone IS NULL THEN d.text
            ELSE array_to_string(list_filter(string_split(d.text, chr(10)), lambda x, j: NOT list_contains(gone, j)), chr(10)) END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN dropped ON d.text = dropped.text
""",
    "op3_chat": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL
  SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
said AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         -- marker, role, separator, escaped text, end of turn
         sum(4 + length(role) + 2
             + length(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>')) + 8) AS formatted_chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
""",
    "op2_topk": """
WITH rows AS (
  SELECT vec_id AS id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.id AS query_id, c.id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.id % 50 = 0 AND c.id <> q.id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op12_merkle": r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || list_transform(range(8), lambda k: CAST(0 AS BIGINT)),
                        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
plain AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, text, CAST(doc_id AS VARCHAR) AS id,
         concat(CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id) END,
                CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
                CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
                CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars) END) AS head
  FROM documents),
leaves AS (
  SELECT row_id, doc_id, lang, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END) AS leaf,
         CASE WHEN xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(id, ''), lambda x: CAST(ord(x) AS BIGINT)),
                       lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 3 = 0
              THEN sha256(head || CASE WHEN text IS NULL THEN '-'
                                       ELSE concat(strlen(text), ':', translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) END)
         END AS changed
  FROM plain, crc_table),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
-- one row per language: all nodes of its current level
level AS (
  SELECT lang, 0 AS depth, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, depth + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
  FROM level WHERE len(nodes) > 1),
subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY CASE WHEN lang IS NULL THEN 0 ELSE 1 END, encode(coalesce(lang, ''))) - 1 AS pos
  FROM level WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS depth, list(subroot ORDER BY pos) AS nodes FROM subroots
  UNION ALL
  SELECT depth + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
  FROM top WHERE len(nodes) > 1),
height AS (SELECT lang, max(depth) AS h FROM level GROUP BY lang),
steps AS (
  -- every level at which a leaf's ancestor has a run, up to the root
  SELECT p.row_id, l.depth, l.nodes, p.pos // CAST(pow(8, l.depth) AS BIGINT) AS place FROM placed p
  JOIN level l ON l.lang IS NOT DISTINCT FROM p.lang AND len(l.nodes) > 1
  UNION ALL
  SELECT p.row_id, h.h + t.depth, t.nodes, s.pos // CAST(pow(8, t.depth) AS BIGINT) FROM placed p
  JOIN height h ON h.lang IS NOT DISTINCT FROM p.lang JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
  JOIN top t ON len(t.nodes) > 1),
sides AS (
  SELECT row_id, list({'l': array_to_string(nodes[place // 8 * 8 + 1:place], ''), 'r': array_to_string(nodes[place + 2:place // 8 * 8 + 8], '')} ORDER BY depth) AS sides
  FROM steps GROUP BY row_id),
proved AS (
  SELECT p.row_id, doc_id, lang, leaf, coalesce(sides, []) AS sides, coalesce(changed, leaf) AS start
  FROM placed p LEFT JOIN sides USING (row_id))
SELECT doc_id, leaf, subroot, top.nodes[1] AS root, sha256(array_to_string(list_transform(sides, lambda s: s.l || s.r), '')) AS proof_sha256,
       list_reduce([start] || list_transform(sides, lambda s: s.l || ' ' || s.r),
                   lambda d, s: sha256(string_split(s, ' ')[1] || d || string_split(s, ' ')[2])) AS folded_root,
       folded_root = top.nodes[1] AS verified
FROM proved JOIN subroots ON proved.lang IS NOT DISTINCT FROM subroots.lang JOIN top ON len(top.nodes) = 1
""",
    "op13_trie": """
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || list_transform(range(8), lambda k: CAST(0 AS BIGINT)),
                        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
turns AS (
  SELECT conv_id, concat(length(coalesce(role, '')), ':', role, length(coalesce(text, '')), ':', text) AS said, length(coalesce(text, '')) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
             lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, i, said, chars FROM convs c JOIN turns t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1, i, said, chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h),
listed AS (
  SELECT c.conv_id, coalesce(list(said ORDER BY part, i) FILTER (said IS NOT NULL), []) AS said,
         coalesce(list(chars ORDER BY part, i) FILTER (said IS NOT NULL), []) AS chars
  FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
prefixes AS (
  SELECT conv_id, d AS depth, sha256(array_to_string(said[1:d], '')) AS key, CASE WHEN d > 0 THEN sha256(array_to_string(said[1:d - 1], '')) END AS up,
         CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars, d = len(said) AS whole
  FROM (SELECT conv_id, said, chars, unnest(range(len(said) + 1)) AS d FROM listed)),
nodes AS (
  SELECT depth, key, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (whole), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, key),
kids AS (SELECT depth - 1 AS depth, up AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.depth = nodes.depth AND kids.key = nodes.key),
-- a node lies in the subtrees of all prefixes of its smallest member that are not longer
subtrees AS (
  SELECT p.depth, p.key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY p.depth, p.key)
SELECT c.conv_id, c.depth, u.conv_id AS parent_conv_id, c.n_convs, CAST(c.n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s ON s.depth = c.depth AND s.key = c.key LEFT JOIN nodes u ON u.depth = c.depth - 1 AND u.key = c.up
""",
}
