"""Registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstone.llm.common import table

QUERIES = {}
CHECKS = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql.strip()
        return function

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tillstone.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_ngram_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.ngram_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), 3, 90).select(
        "id", "n_shingles", "component_id").withColumnRenamed("id", "doc_id")


@query("op6_substring_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents"))


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.suffix_dedup import suffix_dedup

    return suffix_dedup(table(spark, sf_dir, "documents"))


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.decontaminate import contaminated_spans

    return contaminated_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


@query("op3_topk_search")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.topk_search import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


@query("op4_html_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents"))


MIX_SQL = """
WITH sizes AS (
    SELECT source, sum(greatest(coalesce(length(text), 0), 1)) AS size FROM documents GROUP BY source
), rates AS (
    SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes
), steps AS (
    SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS reached
    FROM rates, range(0, 200) AS r(k)
), drawn AS (
    SELECT d.*, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source
                 AND s.reached * pow(16, 13) <= ('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT) AS copies
    FROM documents d
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, ('0x' || substr(md5('mix-1:' || doc_id || ':' || copy), 1, 13))::BIGINT AS mix_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn)
"""


@query("op9_source_mix", MIX_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents"))


@query("op10_license_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.license_scan import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.spelling_variants import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def cluster_sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Plain rounds: all distances, the least by distance and number, floors of exact means."""
    parts = [f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v FROM kept
    ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v LIMIT {k}
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
    SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min((d, c)) AS best FROM (
        SELECT kept.*, c, list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{i}
    ) GROUP BY r
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
    SELECT c, coalesce(any_value(moved), any_value(v)) AS v FROM c{i} LEFT JOIN (
        SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS moved FROM (
            SELECT best[2] AS c, place, sum(x)::BIGINT AS s, count(*) AS n
            FROM (SELECT best, unnest(v) AS x, unnest(range({dims})) AS place FROM a{i}) GROUP BY ALL
        ) GROUP BY c
    ) USING (c) GROUP BY c
)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, c::INTEGER AS cluster, best[1] AS distance, (sum(best[1]) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c = best[2]"""


@query("op13_centroid_clustering", cluster_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.centroid_clustering import cluster_vectors

    return cluster_vectors(table(spark, sf_dir, "embeddings"))


@query("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tillstone.llm.personal_data import personal_data

    return personal_data(table(spark, sf_dir, "documents"))
