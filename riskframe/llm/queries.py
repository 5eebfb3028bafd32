"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (byte_bpe, centroid_clustering, chat_format, cotrain, exact_dedup, jaccard_join, line_dedup, packing,
                           quality_rules, repair_store, simhash_dedup, spelling_variants, token_counts)
from riskframe.llm.common import prepare, read_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run
    return add


LINE_KEYS_SQL = """
WITH d AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, line, pos, trim({lower}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM d),
r AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.line, k.pos, r.key IS NOT NULL AND r.last_doc <> k.doc_id AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""".format(lower=LOWER_SQL.format("line"))


@query("op1_line_dedup", LINE_KEYS_SQL)
def op1(spark, sf_dir):
    return line_dedup.digests(read_table(spark, sf_dir, "documents"))


@query("op2_quality_rules")
def op2(spark, sf_dir):
    return quality_rules.verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op3_byte_bpe")
def op3(spark, sf_dir):
    return byte_bpe.round_trip(spark, read_table(spark, sf_dir, "documents"),
                               public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op4_packing")
def op4(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_repair_store")
def op5(spark, sf_dir):
    shards = repair_store.write_shards(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return repair_store.read_documents(shards)


@query("op6_chat_format")
def op6(spark, sf_dir):
    turns = chat_format.with_probe(read_table(spark, sf_dir, "conversations"))
    return chat_format.read_back(chat_format.formatted_table(turns))


@query("op7_quality_classifier")
def op7(spark, sf_dir):
    return cotrain.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op8_token_counts")
def op8(spark, sf_dir):
    counts = token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


@query("op9_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256({t}) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY {t})""".format(t=LOWER_SQL.format("coalesce(text, '')")))
def op9(spark, sf_dir):
    return exact_dedup.groups(read_table(spark, sf_dir, "documents"))


@query("op10_jaccard_join")
def op10(spark, sf_dir):
    return jaccard_join.link_components(read_table(spark, sf_dir, "documents"))


def _lloyd_sql(clusters: int = 40, rounds: int = 5, dims: int = 64, seed: int = 2) -> str:
    """Rounds of assignment and integer means, each centroid compared with each vector."""
    parts = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS j, v AS c FROM
  (SELECT sha256('{seed}:' || vec_id) AS h, v FROM v ORDER BY h LIMIT {clusters}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, arg_min(j, d * {clusters} + j) AS j, min(d) AS d FROM
  (SELECT vec_id, v, j, CAST(list_sum(list_transform(generate_series(1, {dims}), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS d FROM v, c{r}) GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT j, coalesce(m, c) AS c FROM c{r} LEFT JOIN
  (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM
    (SELECT j, i, sum(x) AS s, count(*) AS n FROM (SELECT j, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY j, i) GROUP BY j) USING (j))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (j)"""


@query("op11_centroid_clustering", _lloyd_sql())
def op11(spark, sf_dir):
    return centroid_clustering.cluster(read_table(spark, sf_dir, "embeddings"))


@query("op12_simhash_near_dedup")
def op12(spark, sf_dir):
    return simhash_dedup.link_components(read_table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13(spark, sf_dir):
    return spelling_variants.variants(read_table(spark, sf_dir, "documents"))
