"""Registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from marketlake.llm.token_counts import token_counts

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")).drop("text")


@query
def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.host_rules import judge

    out = judge(documents(spark, sf_dir, "source"), reuse_measures=True)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from marketlake.llm.bpe_codec import encode_decode

    return encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), results=("ids_sha256", "decoded_sha256")).drop("text")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.secrets import find_secrets

    return find_secrets(documents(spark, sf_dir))


@query
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.minhash import Similar, near_duplicates

    return near_duplicates(documents(spark, sf_dir), Similar(words=3, percent=85))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketlake.llm.sharding import record_size, write_shards
    from marketlake.session import scratch_path

    docs = documents(spark, sf_dir)
    path = scratch_path(spark, "shards")
    write_shards(docs, path, shards=24, seed=20, text="text")
    placed = spark.read.schema(f"{docs.schema.simpleString()[7:-1].replace(':', ' ')}, slot bigint, shard int").parquet(path)
    size, crc = record_size("text").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    return placed.select("doc_id", size, crc, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.fuzzy_lines import line_report

    return line_report(documents(spark, sf_dir))


@query
def op6_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.substring import remove_repeats

    return remove_repeats(documents(spark, sf_dir), digests=True).drop("text")


@query
def op1_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.weak_quality import classify

    return classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels")).drop("text")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.decontam import benchmark_overlaps

    return benchmark_overlaps(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


@query
def op11_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.walsh_clusters import cluster

    return cluster(read_table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, seed=2)


@query
def op12_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm.cross_polytope import near_vectors

    return near_vectors(read_table(spark, sf_dir, "embeddings"))


@query
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketlake.llm.fill_middle import fill_in_middle, restored

    formed = fill_in_middle(documents(spark, sf_dir))
    digests = [F.sha2(c, 256).alias(name) for c, name in ((F.col("output"), "output_sha256"), (restored(F.col("output"), F.col("form")), "restored_sha256"))]
    return formed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def _clusters_sql(clusters: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """Every vector against every centroid, ``rounds`` times and once more."""
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS k, v AS c FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {clusters}))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min((d, k)) AS m FROM
      (SELECT vec_id, v, k::BIGINT AS k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{r}) GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT k, coalesce(moved, c) AS c FROM c{r} LEFT JOIN (SELECT g, list(mean ORDER BY j) AS moved FROM
      (SELECT g, j, (s - ((s % n) + n) % n) // n AS mean FROM (SELECT m[2] AS g, j, sum(x)::BIGINT AS s, count(*) AS n FROM
        (SELECT m, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{r}) GROUP BY ALL)) GROUP BY g) ON g = k)""")
    return "WITH " + ",\n    ".join(steps) + f"""
    SELECT vec_id, m[2]::INTEGER AS cluster, m[1] AS distance, sum(m[1]) OVER (PARTITION BY m[2])::BIGINT AS cluster_inertia, sum(m[1]) OVER ()::BIGINT AS inertia,
      sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON k = m[2]"""


ORACLE["op11_walsh_clusters"] = _clusters_sql()

ORACLE["op12_cross_polytope"] = """
    WITH RECURSIVE usable AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id"""

ORACLE["op13_fill_middle"] = r"""
    WITH cut AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, sha256('42:' || doc_id) AS h FROM documents),
    drawn AS (SELECT doc_id, x, w, len(w)::BIGINT AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS h FROM cut),
    placed AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS i, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS j,
      CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h[3] % 100 >= 50 THEN 'plain' WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    parts AS (SELECT *, coalesce(array_to_string(w[1:i], ''), '') AS p, coalesce(array_to_string(w[i + 1:j], ''), '') AS m, coalesce(array_to_string(w[j + 1:], ''), '') AS s FROM placed)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
      sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE x END) AS output_sha256,
      sha256(CASE form WHEN 'plain' THEN x ELSE p || m || s END) AS restored_sha256 FROM parts"""
