"""One query per operator of this package, with SQL where SQL can ask the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from llm.topk import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings"), k=20, query_step=20, scale=64.0)


ORACLES["op6_exact_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, q.c AS query, c.vec_id,
           CAST(list_sum(list_transform(range(1, least(len(q.c), len(c.c)) + 1), lambda i: q.c[i] * c.c[i])) AS BIGINT) AS score
    FROM (SELECT DISTINCT * FROM v WHERE vec_id % 20 = 0) q JOIN v c ON q.vec_id <> c.vec_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id) AS place FROM s
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from llm.tokenfiles import token_counts
    from llm.tokens import word_bpe_path

    return token_counts(table(spark, sf_dir, "documents"), word_bpe_path())


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from llm.packing import pack_documents
    from llm.tokens import word_bpe_path

    return pack_documents(table(spark, sf_dir, "documents"), word_bpe_path(), capacity=2048, separator=0)


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from llm.decontaminate import benchmark_overlaps

    return benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


@query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from llm.pii import KINDS, personal_data, spans_text

    rows = personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    counts = {f"n_{kind}": count(kind) for kind in KINDS}
    every = F.array_sort(F.array_union("base", "added"))
    digest = F.sha2(spans_text(F.col("base")).cast("binary"), 256)
    return rows.withColumns({**counts, "base_sha256": digest, "spans": spans_text(every)}).select("doc_id", *counts, "base_sha256", "spans")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from llm.substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), width=13, deepest=13).drop("longest")


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from llm.lines import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), width=4, percent=85)


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from llm.centroids import lloyd

    return lloyd(table(spark, sf_dir, "embeddings"), k=40, rounds=5, scale=256, dim=64, seed=2)


def _lloyd_sql(k: int, rounds: int) -> str:
    """One assignment and one update after the other, as steps of a single statement."""
    steps = ["""v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
)""", f"""c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS cluster, x FROM (
        SELECT x, sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, x LIMIT {k})
)"""]  # fmt: skip
    nearest = """a{r} AS MATERIALIZED (
    SELECT vec_id, x, cluster, distance FROM (
        SELECT v.vec_id, v.x, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))) AS distance,
            row_number() OVER (PARTITION BY n ORDER BY distance, c.cluster) AS place
        FROM (SELECT *, row_number() OVER () AS n FROM v) v CROSS JOIN c{r} c) WHERE place = 1
)"""
    moved = """m{r} AS (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
        SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, 65) AS t(i) GROUP BY cluster, i) GROUP BY cluster
), c{next} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (cluster))"""
    for r in range(rounds):
        steps += [nearest.format(r=r), moved.format(r=r, next=r + 1)]
    steps.append(nearest.format(r=rounds))
    return "WITH " + ", ".join(steps) + f"""
SELECT a.vec_id, a.cluster, CAST(a.distance AS BIGINT) AS distance,
    CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)"""  # fmt: skip


ORACLES["op11_centroid_clustering"] = _lloyd_sql(40, 5)


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from llm.fim import fill_in_middle, restored

    digest = lambda text: F.sha2(text.cast("binary"), 256)
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=1, plain_from=90, spm_below=20)
    digests = (digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op12_fill_in_middle"] = """
WITH h AS (
    SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), g AS (
    SELECT *, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS g FROM h
), d AS (
    SELECT doc_id, t, n, least(g[1] % (n + 1), g[2] % (n + 1)) AS a, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR g[3] % 100 >= 90 THEN 'plain'
             WHEN g[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM g
), p AS (
    SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM d
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""


@query
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from llm.bpe import round_trip_documents
    from llm.tokens import word_bpe_path

    made = round_trip_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), word_bpe_path())
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(ids).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))
