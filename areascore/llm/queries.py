"""The operators as queries over the test bed's tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.llm import (
    block_naming,
    embedding_graph,
    language_id,
    line_windows,
    minhash,
    packing,
    periodic_runs,
    piece_sampling,
    quality,
    relative_lz,
    token_alignment,
    token_counts,
    toxicity,
)
from areascore.llm.batches import documents, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(documents(spark, sf_dir))


OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, array_to_string(w[i:i + 19], ' ') AS s FROM words
), places AS (
  SELECT doc_id, i, min((doc_id, i)) OVER (PARTITION BY s) AS earliest FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM places WHERE (doc_id, i) > earliest
), each_word AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, w[k] AS word FROM words
), left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n
  FROM each_word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (doc_id)
"""


@query("op2_relative_lz_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = relative_lz.parse(documents(spark, sf_dir))
    return parsed.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf_dir), labels(spark, sf_dir))


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reached r JOIN both_ways e ON e.a = r.other
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""


@query("op4_minhash_near_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(documents(spark, sf_dir))


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, coalesce(string_split(text, chr(10)), []) AS l FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(l) - 1)) AS i, array_to_string(l[i:i + 2], chr(10)) AS w FROM lines
), found AS (
  SELECT doc_id, i, min((doc_id, i)) OVER (PARTITION BY w) AS earliest FROM windows
  WHERE regexp_matches(w, '[^\x20\x09-\x0D]')
), covered AS (
  SELECT doc_id, list_distinct(flatten(list([i, i + 1, i + 2]))) AS gone
  FROM found WHERE (doc_id, i) > earliest GROUP BY doc_id
), left_over AS (
  SELECT doc_id, text, l, list_filter(range(1, len(l) + 1), lambda k: NOT list_contains(coalesce(gone, []), k)) AS kept
  FROM lines LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, len(l) AS n_lines, len(l) - len(kept) AS n_removed,
       CASE WHEN text IS NOT NULL THEN array_to_string(list_transform(kept, lambda k: l[k]), chr(10)) END AS text
FROM left_over
"""


@query("op5_line_dedup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.line_dedup(documents(spark, sf_dir))


@query("op6_piece_sampling")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.encode(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir))


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_path())


@query("op9_embedding_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_graph.near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP10_SQL = r"""
WITH normalised AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM normalised WINDOW same AS (PARTITION BY t)
"""


@query("op10_exact_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_dedup(documents(spark, sf_dir))


@query("op11_language_id")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    paths = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
    return token_alignment.align(documents(spark, sf_dir), *paths, digest).withColumnRenamed("groups", "groups_sha256")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs``, of which one text in ten (by crc32 of its doc_id) repeats a stretch of itself to its end."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    n = F.size(words)
    g = F.floor(number / 10)
    a = (g % F.nullif(n, F.lit(0))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(repeated, F.lit(1), n - a)), " ")
    return docs.withColumn("text", F.when((number % 10 == 0) & (n > 0), planted).otherwise(F.col("text")))


def longest_run(runs: str) -> Column:
    """The run of greatest length in periods; the first of equal ones."""
    kind = "struct<start: bigint, length: bigint, period: bigint>"
    return F.aggregate(
        runs,
        F.lit(None).cast(kind),
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_runs(documents(spark, sf_dir))).withColumn("best", longest_run("runs"))
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    listed = F.array_join(F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("collapsed_sha256"),
    )
