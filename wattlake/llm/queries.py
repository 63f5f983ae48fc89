"""The registered queries of this subpackage and their DuckDB SQL.

``QUERIES`` maps a name to a function of (spark, sf_dir); ``ORACLE_SQL`` has
the SQL of those that SQL can express.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.common import read_table, stored
from wattlake.llm import bpe, centroids, decontaminate, hard_negatives, langid, mixing, quality, token_files, url_filter
from wattlake.llm.fingerprint import fingerprints
from wattlake.llm.line_dedup import line_dedup
from wattlake.llm.near_dedup import near_duplicates


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_deleted_lines", F.sha2("text", 256).alias("text_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("copies") * F.col("size")).alias("taken"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.count_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    n_bytes = F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long"))
    return out.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), tokenizer_path(), ["doc_id"])
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    files = stored(token_files.segments(docs, tokenizer_path()), "token-files")
    return token_files.read_documents(files, docs.schema["doc_id"].dataType)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, final = centroids.clustered(read_table(spark, sf_dir, "embeddings"))
    names = F.array(*[F.lit(x) for x in centroids.digests(final)]).cast("array<string>")
    return out.withColumn("centroid_sha256", F.get(names, F.col("cluster")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_id": op3_language_id,
    "op4_source_mixing": op4_source_mixing,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op6_url_filter": op6_url_filter,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_token_files": op9_token_files,
    "op10_fingerprints": op10_fingerprints,
    "op11_decontamination": op11_decontamination,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_hard_negatives": op13_hard_negatives,
}


def _clustering_sql(rounds: int = centroids.ROUNDS) -> str:
    """Every round of assignment and new means as common table expressions of their own."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF isfinite(x)]) = 64
)""",
        """c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT 16)
)""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, c, k.v, list_sum([(k.v[j] - m.v[j]) * (k.v[j] - m.v[j]) FOR j IN range(1, 65)])::BIGINT AS distance
  FROM kept k CROSS JOIN c{r} m QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) = 1
)""")
        steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.v, o.v) AS v FROM c{r} o LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v
    FROM (SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS j FROM a{r}) GROUP BY c, j) GROUP BY c
  ) n USING (c)
)""")
    return "WITH " + ",\n".join(steps[:-1]) + f"""
SELECT vec_id, c::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} m USING (c)
"""


ORACLE_SQL = {
    "op1_line_dedup": """
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
),
line AS (
  SELECT doc_id, pos, parts[pos] AS line,
         len(regexp_extract_all(parts[pos], '[^\\x20\\x09-\\x0D]+')) AS wc
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos FROM split)
),
worded AS (
  SELECT *, row_number() OVER w AS idx, sum(wc) OVER w AS upto
  FROM line WHERE wc > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
-- runs of 50 words or more that lose that with their first or their last line
run AS (
  SELECT a.doc_id, a.idx AS i, b.idx AS e
  FROM worded a JOIN worded b ON a.doc_id = b.doc_id AND b.idx BETWEEN a.idx AND a.idx + 49
  WHERE b.upto - a.upto + a.wc >= 50 AND (b.upto - a.upto < 50 OR b.upto - b.wc - a.upto + a.wc < 50)
),
content AS (
  SELECT run.doc_id, i, e, string_agg(line, chr(10) ORDER BY idx) AS body
  FROM run JOIN worded w ON w.doc_id = run.doc_id AND w.idx BETWEEN i AND e GROUP BY ALL
),
copy AS (
  SELECT doc_id, i, e FROM content QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, i) > 1
),
gone AS (
  SELECT DISTINCT w.doc_id, w.pos, w.idx FROM worded w JOIN copy c ON w.doc_id = c.doc_id AND w.idx BETWEEN c.i AND c.e
),
cut AS (
  SELECT doc_id, min(pos) AS first, max(pos) AS last
  FROM (SELECT *, idx - row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS island FROM gone) GROUP BY doc_id, island
),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM line
  WHERE NOT EXISTS (FROM cut WHERE cut.doc_id = line.doc_id AND line.pos BETWEEN cut.first AND cut.last) GROUP BY doc_id
)
SELECT s.doc_id, coalesce(len(parts), 0)::BIGINT AS n_lines,
       (SELECT count(*) FROM gone WHERE gone.doc_id = s.doc_id)::BIGINT AS n_deleted_lines,
       CASE WHEN s.text IS NULL THEN NULL ELSE sha256(coalesce(kept.text, '')) END AS text_sha256
FROM split s LEFT JOIN kept USING (doc_id)
""",
    "op4_source_mixing": """
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source
),
-- rounds: whoever would pass its cap is fixed there, the rest is shared again
rounds AS (
  SELECT 0 AS n, source, source_size, w, false AS capped FROM s
  UNION ALL
  SELECT n + 1, source, source_size, w, capped OR lvl * w >= 3.0 * source_size
  FROM (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(CASE WHEN capped THEN 3.0 * source_size END) OVER (), 0))
              / sum(CASE WHEN NOT capped THEN w END) OVER () AS lvl
    FROM rounds
  ) WHERE n < (SELECT count(*) FROM s)
),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN 3.0 * source_size ELSE w * (sum(source_size) OVER ()
           - coalesce(sum(CASE WHEN capped THEN 3.0 * source_size END) OVER (), 0))
           / sum(CASE WHEN NOT capped THEN w END) OVER () END::DOUBLE AS target
  FROM rounds WHERE n = (SELECT count(*) FROM s)
),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-6) ELSE 0 END::BIGINT AS copies FROM t
),
r AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.copies,
         floor(b.target - b.copies * b.source_size + 1e-6)::BIGINT AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS words
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       ((copies + (upto <= rest OR (upto - words <= rest AND 2 * (rest - upto + words) >= words))::BIGINT) * size)::BIGINT AS taken
FROM r
""",
    "op5_minhash_near_dedup": """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM d WHERE len(w) > 0)
),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM common JOIN size sa ON a = sa.doc_id JOIN size sb ON b = sb.doc_id WHERE 100 * common.n >= 80 * (sa.n + sb.n - common.n)
),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
root AS (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id,
       least(doc_id, coalesce(least, doc_id)) = doc_id AS kept
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN root USING (doc_id)
""",
    "op11_decontamination": """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item WHERE len(w) > 0)
),
gram AS (
  SELECT doc_id, s, k, array_to_string(w[s : s + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM d) JOIN (SELECT DISTINCT k FROM win) ON s + k - 1 <= len(w)
),
hit AS (SELECT doc_id, s, k, item_id FROM gram JOIN win USING (k, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hit) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
""",
    "op12_centroid_clustering": _clustering_sql(),
    "op13_hard_negatives": """
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF isfinite(x)]) = len(embedding)
),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_sum([a.v[j] * b.v[j] FOR j IN range(1, len(a.v) + 1)])::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
""",
}
