"""Queries of this folder and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adresponse.llm import ann, centroids, chat, decontam, neardup, ngramlm, packing, partcodes, pieces, pii, quality, rangecoder, urlmodel
from adresponse.llm.store import table


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find_groups(table(spark, sf_dir, "documents"), k=3, share=(85, 100))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_all(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlmodel.filter_urls(table(spark, sf_dir, "pages"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramlm.score_documents(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    file = rangecoder.write_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1)
    return rangecoder.read_documents(file)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partcodes.codes(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_near_dup, op2_pii, op3_decontaminate, op4_quality, op5_url_filter, op6_lm_score, op7_chat, op8_token_file, op9_packing, op10_nearest, op11_sentencepiece, op12_centroids, op13_vector_codes)}

#: 3-word shingles, all pairs that share one, exact similarity, transitive closure.
_OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
         WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, w.b FROM reach r JOIN ways w ON w.a = r.other),
groups AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN groups USING (doc_id)"""

#: The table holds no tool calls, so every row is a plain message (tests cover calls).
_OP7_SQL = """
SELECT conv_id, turn, role, 'message' AS part, CAST(0 AS INTEGER) AS item, CAST(NULL AS VARCHAR) AS call_id, turn AS order_turn,
       CAST(0 AS INTEGER) AS order_part, CAST(NULL AS BOOLEAN) AS linked, '' AS error,
       CAST(to_json({content: coalesce(text, ''), role: role}) AS VARCHAR) AS json
FROM conversations"""



def _vectors_sql(scale: int, length: str) -> str:
    """``kept``: a row number, vec_id, label and whole numbers of every vector that takes part; ``x``: a row a component."""
    return f"""
finite AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, len(embedding) AS size,
         list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)),
kept AS MATERIALIZED (SELECT * FROM finite WHERE size = {length}),
x AS MATERIALIZED (SELECT r, unnest(range(size)) AS d, unnest(v) AS x FROM kept)"""


_FLOOR = "(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)"  # of sum / count


def _op12_sql(clusters: int = 16, rounds: int = 3) -> str:
    """Rounds of assigning every vector to the nearest centroid and moving each to the floor of its mean."""
    steps = [f"""
c0 AS MATERIALIZED (
  SELECT c, unnest(range(size)) AS d, unnest(v) AS x
  FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), r) - 1 AS c, size, v FROM kept) WHERE c < {clusters})"""]
    for i in range(rounds + 1):
        steps.append(f"""
m{i} AS MATERIALIZED (
  SELECT r, min(distance * {clusters} + c) AS m
  FROM (SELECT x.r, c, sum((x.x - k.x) * (x.x - k.x)) AS distance FROM x JOIN c{i} k ON k.d = x.d GROUP BY x.r, c) GROUP BY r),
c{i + 1} AS MATERIALIZED (
  SELECT k.c, k.d, coalesce(n.x, k.x) AS x FROM c{i} k
  LEFT JOIN (SELECT m % {clusters} AS c, d, {_FLOOR} AS x FROM m{i} JOIN x USING (r) GROUP BY 1, 2) n ON n.c = k.c AND n.d = k.d)""")
    return f"""WITH {_vectors_sql(64, "64")}, {",".join(steps)},
names AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS name FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(m % {clusters} AS INTEGER) AS cluster, CAST(m // {clusters} AS BIGINT) AS distance,
       CAST(sum(m // {clusters}) OVER (PARTITION BY m % {clusters}) AS BIGINT) AS cluster_inertia,
       CAST(sum(m // {clusters}) OVER () AS BIGINT) AS inertia, name AS centroid_sha256
FROM m{rounds} JOIN kept USING (r) JOIN names ON c = m % {clusters}"""


def _op13_sql(entries: int = 256, rounds: int = 4) -> str:
    """Rounds over codebooks of the parts: assign to the nearest entry, move each entry to the floor of its mean."""
    steps = [f"""
p AS MATERIALIZED (SELECT r, d // (size // 4) AS part, d % (size // 4) AS pos, x FROM x JOIN kept USING (r)),
b0 AS MATERIALIZED (
  SELECT part, e, pos, x
  FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, r) - 1 AS e FROM kept) USING (r) WHERE e < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
m{i} AS MATERIALIZED (
  SELECT r, part, min(distance * {entries} + e) AS m
  FROM (SELECT p.r, p.part, b.e, sum((p.x - b.x) * (p.x - b.x)) AS distance
        FROM p JOIN b{i} b ON b.part = p.part AND b.pos = p.pos GROUP BY p.r, p.part, b.e) GROUP BY r, part),
b{i + 1} AS MATERIALIZED (
  SELECT b.part, b.e, b.pos, coalesce(n.x, b.x) AS x FROM b{i} b
  LEFT JOIN (SELECT part, m % {entries} AS e, pos, {_FLOOR} AS x FROM m{i} JOIN p USING (r, part) GROUP BY 1, 2, 3) n
  ON n.part = b.part AND n.e = b.e AND n.pos = b.pos)""")
    return f"""WITH {_vectors_sql(1024, "(SELECT size FROM finite GROUP BY size ORDER BY count(*) DESC, size DESC LIMIT 1)")}, {",".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', CAST(m % {entries} AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error
  FROM m{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, pos)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)"""


ORACLE: dict[str, str] = {"op1_near_dup": _OP1_SQL, "op7_chat": _OP7_SQL, "op12_centroids": _op12_sql(), "op13_vector_codes": _op13_sql()}
