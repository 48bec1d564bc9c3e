"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm import (centroids, decontaminate, exact_dedup, language, licenses, line_dedup,
                           mixing, pii, secrets, simhash, token_shards, warc, whitening)
from citeweave.llm.common import collapse_space, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        "contaminated")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", F.col("mix_size").alias("size"),
                       F.col("mix_source_size").alias("source_size"),
                       F.col("mix_target").alias("target"),
                       (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.exact_groups(docs, "doc_id", collapse_space(F.col("text"))).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs)).select(
        F.col("id").alias("doc_id"), language.held_out(F.col("id")).alias("held_out"),
        "lang_pred", "score", "rejected")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "license", "containment")


def _license_sql() -> str:
    """Windows of two blocks per template class, containment counted over exact shingles."""
    rows = ", ".join("('{}', '{}')".format(n.replace("'", "''"), t.replace("'", "''"))
                     for n, t in licenses.TEMPLATES)
    tokens = ("regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
    return f"""
        WITH t AS (SELECT license, {tokens.format("text")} AS w FROM (VALUES {rows})
                   v(license, text)),
             ts AS (SELECT DISTINCT license, array_to_string(w[i:i + 4], ' ') AS shingle
                    FROM (SELECT license, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
             size AS (SELECT license, count(*) AS n FROM ts GROUP BY 1),
             block AS (SELECT a.license, a.n, max(b.n) AS block
                       FROM size a JOIN size b ON b.n >= a.n AND a.n >= 0.6 * b.n GROUP BY 1, 2),
             d AS (SELECT doc_id, {tokens.format("text")} AS w FROM documents),
             ds AS (SELECT doc_id, i - 1 AS place, array_to_string(w[i:i + 4], ' ') AS shingle
                    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
             hit AS (SELECT doc_id, license, n, block, shingle, place // block AS k
                     FROM ds JOIN ts USING (shingle) JOIN block USING (license)),
             win AS (SELECT * FROM hit
                     UNION ALL SELECT doc_id, license, n, block, shingle, k - 1 FROM hit
                               WHERE block > 1 AND k > 0),
             c AS (SELECT doc_id, license, k, count(DISTINCT shingle)::DOUBLE / any_value(n) AS c
                   FROM win GROUP BY 1, 2, 3)
        SELECT doc_id, license, max(c) AS containment FROM c WHERE c >= 0.8 GROUP BY 1, 2"""


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "lines_deleted", "words_deleted", "text")


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = token_shards.shard_folder(spark)
    shards = token_shards.write_token_shards(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), out)
    return token_shards.read_token_shards(shards, out)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in pii.KINDS])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(k):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select(F.col("id").alias("doc_id"), *counts,
                        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                        listed(F.array_sort(F.concat("base", "added"))).alias("spans"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter(
        "base", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.array_sort(F.concat("base", "linked"))).alias("spans"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive_folder(spark)
    archives = warc.write_archives(table(spark, sf_dir, "pages"), out)
    return warc.read_archives(archives, out)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, final = centroids.cluster(table(spark, sf_dir, "embeddings"))
    # One row per cluster.
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(
        F.sum("distance").alias("s")).collect()}
    known = spark.createDataFrame(
        [(c, s, sum(sums.values()), centroids.centroid_sha256(final[c])) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _centroid_sql() -> str:
    """The rounds written out, one step after the other."""
    k, dim, scale = centroids.CLUSTERS, centroids.DIMENSIONS, centroids.SCALE
    steps = [f"""
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding,
                       lambda c: floor({scale} * c::DOUBLE)::BIGINT) AS x
            FROM embeddings WHERE len(embedding) = {dim}
            AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {dim}),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS cluster, x AS c
            FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS h, x FROM v)
            ORDER BY h NULLS LAST, x LIMIT {k})"""]
    for turn in range(centroids.ROUNDS + 1):
        steps.append(f"""
        a{turn} AS MATERIALIZED (
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY distance, cluster) AS k
                FROM (SELECT row_id, vec_id, x, cluster, list_sum(list_transform(list_zip(x, c),
                          lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
                      FROM v, c{turn}))
            WHERE k = 1)""")
        if turn < centroids.ROUNDS:
            steps.append(f"""
        c{turn + 1} AS MATERIALIZED (
            SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{turn} o LEFT JOIN (
                SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY place) AS c
                FROM (SELECT cluster, place, sum(y) AS s, count(*) AS n
                      FROM (SELECT cluster, unnest(x) AS y, unnest(range({dim})) AS place
                            FROM a{turn}) GROUP BY 1, 2) GROUP BY 1) m USING (cluster))""")
    last = centroids.ROUNDS
    return f"""WITH {",".join(steps)}
        SELECT vec_id, cluster::INTEGER AS cluster, distance,
               (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{last} JOIN c{last} USING (cluster)"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "component", "n",
                        F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened",
                        "explained", "identity_error")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_mixing": op2_mixing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language": op4_language,
    "op5_simhash": op5_simhash,
    "op6_licenses": op6_licenses,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_shards": op8_token_shards,
    "op9_pii": op9_pii,
    "op10_secrets": op10_secrets,
    "op11_warc": op11_warc,
    "op12_centroids": op12_centroids,
    "op13_whitening": op13_whitening,
}

ORACLE = {
    "op1_decontaminate": """
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
             b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
             bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n,
                           array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS content
                    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
                          FROM b WHERE len(w) > 0)),
             dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS content
                    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                          FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
             hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id
                     FROM dw JOIN bw ON dw.n = bw.n AND dw.content = bw.content),
             covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                         FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
             found AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
                       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY 1)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op2_mixing": """
        WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text,
                       '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
             s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
             w AS (SELECT *, [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1)
                                       % 3)::INTEGER] AS weight FROM s),
             r AS (SELECT *, row_number() OVER o AS k,
                          ((SELECT sum(source_size) FROM w)
                           - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING
                                                             AND 1 PRECEDING), 0))::DOUBLE
                          / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW
                                               AND UNBOUNDED FOLLOWING))::DOUBLE AS level
                   FROM w WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
             c AS (SELECT level FROM r WHERE level * weight <= 3 * source_size ORDER BY k LIMIT 1),
             t AS (SELECT source, source_size,
                          CASE WHEN 3 * source_size < level * weight THEN (3 * source_size)::DOUBLE
                               ELSE level * weight END AS target
                   FROM w, c),
             m AS (SELECT doc_id, size, source_size, target,
                          CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
                          ('0x' || substr(md5('20:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0
                          ::DOUBLE AS draw
                   FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))
               ::BIGINT AS taken
        FROM m""",
    "op3_exact_dedup": """
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')
                          AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM t""",
    "op6_licenses": _license_sql(),
    # Base 32 takes five bits a letter: each five hex digits of the SHA-1 give four letters.
    "op11_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
                          max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i:
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((
                       ('0x' || hex[5 * (i // 4) + 1:5 * (i // 4) + 5])::INTEGER
                       >> (15 - 5 * (i % 4))::INTEGER) & 31)]), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p""",
    "op12_centroids": _centroid_sql(),
}
