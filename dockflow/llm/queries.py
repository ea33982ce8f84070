"""The registered queries of the corpus operators, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm import (
    byte_bpe,
    centroids,
    exact_dedup,
    language,
    license_scan,
    packing,
    periodic_runs,
    simhash,
    substring_dedup,
    surrogates,
    token_files,
    topk,
    toxicity,
)
from dockflow.llm.common import read_table
from dockflow.llm.oracles import PERIODIC_RUNS, clusters_sql, licenses_sql
from dockflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.with_surrogates(read_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path)
    return token_files.read_tokens(spark, path, digest=True)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = byte_bpe.decode(byte_bpe.encode(read_table(spark, sf_dir, "documents")))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return both.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op10_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def _made_periodic(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts, by a hash of the id, repeat their words from some word on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    w = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, w).alias("w")).withColumn("n", F.size("w"))
    placed = chosen.withColumn("a", (F.col("g") % F.greatest("n", F.lit(1))).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    again = F.transform("w", lambda word, i: F.when(i >= F.col("a"), F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))).otherwise(word))
    return placed.withColumn("p", period).select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_made_periodic(read_table(spark, sf_dir, "documents")))
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda top, run: F.when(more(run, top), run).otherwise(top))
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    listed = F.array_join(F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_substring_dedup,
        op3_pii_surrogates,
        op4_token_files,
        op5_simhash,
        op6_exact_topk,
        op7_byte_bpe,
        op8_language_id,
        op9_exact_dedup,
        op10_bestfit_packing,
        op11_centroids,
        op12_periodic_runs,
        op13_license_scan,
    )
}

ORACLES: dict[str, str] = {
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k FROM starts),
again AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM windows JOIN again USING (k) CROSS JOIN range(0, 35) AS t(j)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
""",
    "op6_exact_topk": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op9_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
FROM d JOIN g USING (body)
""",
    "op11_centroids": clusters_sql(),
    "op12_periodic_runs": PERIODIC_RUNS,
    "op13_license_scan": licenses_sql(),
}
