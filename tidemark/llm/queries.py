"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_dir
from . import (
    bpe, centroids, exact_dedup, fill_middle, license_scan, ngram_lm, packing, simhash, substring,
    token_rollup, topk, toxicity, word_bpe,
)
from .common import documents, stored

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


def of_id(modulus: int):
    """crc32 of the id as text, by which contracts part learning from held-out rows."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(documents(spark, sf_dir), of_id(10) == 0)


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.learn(docs, labels.filter(of_id(5) != 0))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", (of_id(5) == 0).alias("held_out"),
                         F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).drop("ids")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    cut = license_scan.signed(docs)  # stored; both read it
    return license_scan.license_report(docs, license_scan.train(docs, cut=cut), cut=cut)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after loads with provisional counts, a revision, a takedown and two retries.

    Rows without an id are in the first load, and no takedown names them.
    """
    docs = documents(spark, sf_dir)
    path = work_dir(spark, "token-totals")
    rows = stored(token_rollup.counted(docs, {
        "words-1": token_rollup.word_count(F.col("text")),
        "bytes-1": token_rollup.byte_count(F.col("text"))}, keep=("n_chars",)), "token-counts")
    bad = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 0").select("doc_id")
    loads = {f"load-{n}": token_rollup.inserts(rows.filter(F.coalesce(of_id(4), F.lit(0)) == n), "n_chars")
             for n in range(4)}
    later = {"revision": token_rollup.revisions(rows, "n_chars"),
             "takedown": token_rollup.deletes(rows.join(bad, "doc_id", "left_semi"))}
    batches = loads | later
    for name in (*batches, "load-2", "revision"):
        token_rollup.commit(batches[name], path, name)
    return token_rollup.totals(spark, path)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(documents(spark, sf_dir), width=3, radius=2)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return centroids.assignments(centroids.fit(vectors))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fill_middle.digests(fill_middle.transform(docs))


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.round_trip(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_topk_search": op1_topk_search,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_license_scan": op5_license_scan,
    "op6_token_counts": op6_token_counts,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_simhash": op8_simhash,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_centroids": op11_centroids,
    "op12_fill_middle": op12_fill_middle,
    "op13_word_bpe": op13_word_bpe,
}


def _clustering_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds one after another, each as a table of its centroids."""
    assigned = """
        SELECT vec_id, v, number, distance FROM (
            SELECT x.rowid AS id, x.vec_id, x.v, c.number,
                   list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(x.v, c.c)])::BIGINT
                       AS distance,
                   row_number() OVER (PARTITION BY x.rowid ORDER BY distance, c.number) AS place
            FROM kept x, {centroids} c)
        WHERE place = 1"""
    steps = [f"""
        kept AS MATERIALIZED (
            SELECT row_number() OVER () AS rowid, vec_id,
                   [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings WHERE len(embedding) = 64 AND len(
                [x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""", f"""
        c0 AS MATERIALIZED (
            SELECT v AS c, row_number() OVER (ORDER BY h) - 1 AS number
            FROM (SELECT v, sha256('3:' || vec_id) AS h FROM kept ORDER BY h LIMIT {k}))"""]
    for i in range(rounds):
        steps.append(f"""
        c{i + 1} AS MATERIALIZED (
            SELECT number, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN (
                SELECT number, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
                    SELECT number, i, sum(v[i])::BIGINT AS s, count(*) AS n
                    FROM ({assigned.format(centroids=f'c{i}')}), range(1, 65) t(i)
                    GROUP BY number, i) GROUP BY number) m USING (number))""")
    return f"""
        WITH {','.join(steps)},
        done AS MATERIALIZED ({assigned.format(centroids=f'c{rounds}')})
        SELECT vec_id, CAST(number AS INTEGER) AS cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY number) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM done JOIN c{rounds} USING (number)"""


ORACLES: dict[str, str] = {
    "op1_topk_search": """
        WITH good AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(
                [x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
            FROM good q JOIN good c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
        ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op6_token_counts": """
        WITH live AS (
            SELECT source, lang, coalesce(text, '') AS t FROM documents
            WHERE doc_id IS NULL OR doc_id NOT IN (
                SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)),
        counted AS (
            SELECT source, lang, 'words-1' AS tokenizer,
                   len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS n FROM live
            UNION ALL SELECT source, lang, 'bytes-1', strlen(t) FROM live)
        SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens
        FROM counted GROUP BY ALL""",
    "op7_exact_dedup": """
        WITH norm AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM norm WINDOW same AS (PARTITION BY t)""",
    "op11_centroids": _clustering_sql(),
    "op12_fill_middle": """
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
                   [CAST('0x' || substr(sha256('1:' || doc_id), 8 * i + 1, 8) AS BIGINT)
                    FOR i IN range(4)] AS h FROM documents),
        cut AS (
            SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a,
                   greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>')
                             OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                        WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
        parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m,
                         substr(t, b + 1) AS s FROM cut)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                      WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts""",
}
