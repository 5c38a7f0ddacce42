"""The registered queries of the corpus operators, each with SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger.llm import bpe, exact_dedup, licenses, mask_ranking, mixing, orchard, phrase_dedup, quality_model, quality_rules, secrets, simhash, substring_dedup, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


@query("op1_bpe_encoding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.decode(bpe.encode(documents(spark, sf_dir), tokenizer_path()), tokenizer_path())
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_model.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.withColumnsRenamed({"host": "source", "path": "lang"})


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, spans = secrets.scan(documents(spark, sf_dir)), F.col("spans")
    of_kind = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{n}") for k, n in enumerate(secrets.KINDS[:3])]
    return rows.select("doc_id", *counts, F.sha2(secrets.joined(spans, (0, 1, 2)), 256).alias("base_sha256"), secrets.joined(spans, (0, 1, 2, 3)).alias("spans"))


@query("op4_suffix_array_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.remove_repeats(documents(spark, sf_dir))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return rows.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rules = quality_rules.learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.judged(docs, rules).select("doc_id", *(F.col(f"_quality.{n}") for n in names))


@query("op6_warc_archive", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages),
         h AS (SELECT *, sha1(html) AS x FROM p)
    SELECT page_id, octet_length(encode(html)) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(x, 1 + 10 * (i // 8), 10))::UBIGINT >> (35 - 5 * (i % 8))::UBIGINT) & 31)::INT, 1)), '') AS payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM least THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
    FROM h
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scan(documents(spark, sf_dir))
    labels = F.array_sort(F.array_union("base", F.transform("matches", lambda m: m["label"])))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), "score")


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_classes(documents(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_source_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole, _ = mixing.mix(documents(spark, sf_dir))
    return whole.select("doc_id", "size", "source_size", "target", "taken")


@query("op10_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


_LOWER = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op12_lexical_search", f"""
    WITH w AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS ts FROM documents),
         docs AS MATERIALIZED (SELECT d, doc_id, len(ts) AS n FROM w WHERE len(ts) > 0),
         tfs AS MATERIALIZED (SELECT d, {_LOWER} AS term, count(*) AS tf FROM (SELECT d, unnest(ts) AS t FROM w) GROUP BY ALL),
         nl AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM docs),
         asked AS (SELECT DISTINCT r, item_id, {_LOWER} AS term FROM (SELECT row_number() OVER () AS r, item_id, unnest({_TERMS}) AS t FROM benchmark)),
         weight AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, nl GROUP BY term),
         scored AS (
             SELECT r, item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))))::BIGINT AS score
             FROM asked JOIN weight USING (term) JOIN tfs USING (term) JOIN docs USING (d), nl GROUP BY ALL)
    SELECT item_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_ranking.best_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op13_phrase_dedup", r"""
    WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
         windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
         later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, i) > 1),
         gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, range(20) t(j)),
         words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
         kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = phrase_dedup.remove_passages(documents(spark, sf_dir))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return rows.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def _op11_sql(dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3) -> str:
    """Rounds of assignment and means over (vector, component, whole number) rows."""
    steps = [f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1 AS cluster, v AS c FROM kept
            ORDER BY sha256('1:' || vec_id::VARCHAR) LIMIT {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
        d{n} AS (
            SELECT r, vec_id, v, cluster, list_sum(list_transform(range(1, {dims + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS distance FROM kept, c{n}),
        a{n} AS MATERIALIZED (
            SELECT * FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1)""")
        if n < rounds:
            steps.append(f"""
        m{n} AS (
            SELECT cluster, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS x FROM a{n}, range(1, {dims + 1}) t(i) GROUP BY cluster, i),
        c{n + 1} AS MATERIALIZED (
            SELECT c{n}.cluster, coalesce(m.c, c{n}.c) AS c
            FROM c{n} LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS c FROM m{n} GROUP BY cluster) m USING (cluster))""")
    return ",".join(steps) + f"""
        SELECT vec_id, a{rounds}.cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY a{rounds}.cluster)::BIGINT AS cluster_inertia,
               sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (cluster)"""


@query("op11_centroid_clustering", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = orchard.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256"))
