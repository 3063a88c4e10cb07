"""The registered queries of this subpackage, and SQL for those that SQL can express.

Each applies its operator with production settings to the whole table and derives the digest columns from its output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqloom.llm import alignment, embedding_dedup, line_dedup, lm_scoring, mixing, near_dedup, packing, periodic_runs, personal_data, quality, quality_rules, secret_scan, top_k
from reqloom.llm.shared import WORD, fold, table
from reqloom.operators.staging import stage


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under word frequencies and under context-tree weighting."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 10) == 0).alias("held_out"))
    return lm_scoring.score(docs)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    draws, documents = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = draws.groupBy("_row").agg(F.sum("words").alias("taken"))
    return documents.join(taken, "_row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret with the forest's verdict; the run itself stays out of the result."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "position", "offset", F.length("run").alias("length"), F.sha2("run", 256).alias("run_sha256"), "score", "is_secret")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    classes = near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.select("doc_id", "class_id", "class_size")


def quality_weights(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Weights of the quality classifier, learnt from labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    return quality.train(docs.select("doc_id", "text"), labels.select("doc_id", F.col("quality").alias("label")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_weights(spark, docs, sf_dir))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", predicted)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from every document, and a digest of what stays."""
    kept = line_dedup.drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def _is(number: int):
    return lambda value: value == number


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans."""
    found = personal_data.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("base", lambda span: span["kind"])
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(personal_data.KINDS)]
    digest = F.sha2(personal_data.written(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, personal_data.written(F.col("spans")).alias("spans"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per document, and the verdict of counts and likelihood ratio."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    measured = stage(quality_rules.measure(docs, quality_rules.ratio_table(docs, trusted)))
    least = quality_rules.threshold_of(measured, trusted)
    kept = ~F.col("base_failed") & (F.col("ratio") >= F.lit(least))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return measured.select("doc_id", *counts, "base_failed", kept.alias("kept"), "ratio")


def _with_periods(docs: DataFrame) -> DataFrame:
    """Texts whose id's crc32 is divisible by ten get a periodic end: from word a on, the p words there repeat."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    chosen = docs.where(crc % 10 == 0).select("doc_id", "text", F.floor(crc / 10).alias("_g"), words.alias("_w"))
    n = F.size("_w")
    placed = chosen.withColumn("_a", F.when(n > 0, F.col("_g") % n).cast("int"))
    placed = placed.withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    times = F.ceil((n - F.col("_a")) / F.col("_p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice("_w", F.col("_a") + 1, F.col("_p")), times)), F.lit(1), n - F.col("_a"))
    whole = F.array_join(F.concat(F.slice("_w", F.lit(1), F.col("_a")), again), " ")
    periodic = placed.select("doc_id", F.when(n > 0, whole).otherwise(F.col("text")).alias("text"))
    return docs.where(crc % 10 != 0).select("doc_id", "text").unionByName(periodic)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of every document, and digests of all runs and of the words that stay."""
    found = periodic_runs.runs(_with_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longer = lambda a, b: F.when(b["length"] > a["length"], b).otherwise(a)
    longest = F.when(F.size("runs") > 0, F.aggregate("runs", F.col("runs")[0], longer))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[longest[name].alias(name) for name in ("start", "length", "period")],
        F.floor(longest["length"] * 1000 / longest["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, a digest of the groups, and corpus-wide figures of the links of every document."""
    found = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_dedup.linked(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_mixing": op2_mixing,
    "op3_packing": op3_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_near_dedup": op5_near_dedup,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_personal_data": op8_personal_data,
    "op9_top_k": op9_top_k,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_embedding_dedup": op13_embedding_dedup,
}

ORACLE: dict[str, str] = {
    "op9_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op13_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id
    AND list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON least.a = e.vec_id
""",
    "op7_line_dedup": """
WITH lines AS (
  SELECT doc_id, rn, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM (SELECT doc_id, text, row_number() OVER () AS rn FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE key IN (SELECT key FROM common)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE key NOT IN (SELECT key FROM common)), '')) AS kept_sha256
FROM keyed GROUP BY rn, doc_id
""",
}
