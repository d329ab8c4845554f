"""The queries of the corpus operators, by name, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, fingerprints, hmm, media, mixing, packing, pii, prefix_bpe, sharding, simhash, toxicity, url_filter, vector_codes
from .common import Scratch, table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), Scratch(spark))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents"), Scratch(spark))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored_digest(table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block') AS r(host, path, verdict)")
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP5_SQL = r"""
WITH rules(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, row_number() OVER () AS rid FROM pages),
m AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS v
    FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m USING (rid)
"""


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.judged(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), Scratch(spark)))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), Scratch(spark))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    mixed = mixing.per_document(mixing.mix(table(spark, sf_dir, "documents"), scratch), scratch)
    return mixed.withColumn("position", F.round("position", 9))


def _time_sql(share: str) -> str:
    """The inverse of each schedule's integral, as in ``mixing.time_at``."""
    out = []
    for k, knots in enumerate(mixing.SCHEDULES):
        segments, total = [], 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            segments.append((t0, w0, (w1 - w0) / (t1 - t0), t1 - t0, total))
            total += (w0 + w1) / 2 * (t1 - t0)
        y = f"({share} * {total!r}::DOUBLE)"
        cases = " ".join(
            f"WHEN {y} >= {b!r} THEN {t!r}::DOUBLE + least(coalesce(2.0::DOUBLE * ({y} - {b!r}::DOUBLE) / nullif({w!r}::DOUBLE + sqrt(greatest({w!r}::DOUBLE * {w!r}::DOUBLE + 2.0::DOUBLE * {s!r}::DOUBLE * ({y} - {b!r}::DOUBLE), 0)), 0), 0), {d!r}::DOUBLE)"
            for t, w, s, d, b in reversed(segments)
        )
        out.append(f"WHEN {k} THEN CASE {cases} END")
    return f"CASE rank % {len(mixing.SCHEDULES)} {' '.join(out)} END"


OP9_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(concat_ws('|', '17', CAST(doc_id AS VARCHAR), md5(text))) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][rank % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
b AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(w) OVER () AS all_w, coalesce(sum(cap) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before FROM w WINDOW o AS (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap / w <= (budget - cap_before) / (all_w - w_before) AS capped FROM b),
t AS (SELECT source, source_size, rank, CASE WHEN capped THEN cap ELSE (budget - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN capped THEN 0 ELSE w END) OVER (), 0) * w END AS target FROM c),
r AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d),
x AS (SELECT r.*, t.source_size, t.target, t.rank, greatest(least(floor(target)::BIGINT - before, size), 0) AS t0, greatest(least(floor(target)::BIGINT - before - source_size, size), 0) AS t1 FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target, t0 + t1 AS taken, (CASE WHEN t0 > 0 THEN 1 ELSE 0 END + CASE WHEN t1 > 0 THEN 1 ELSE 0 END)::BIGINT AS passes,
  CASE WHEN t0 > 0 THEN round({_time_sql("least(coalesce((before + t0 / 2) / nullif(target, 0), 0), 1)")}, 9) END AS position FROM x
"""


def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), Scratch(spark))


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return prefix_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), Scratch(spark))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"), Scratch(spark))


def _vector_codes_sql(rounds: int) -> str:
    """Distances from inner products of whole numbers below 2^53, which doubles hold exactly."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (SELECT rid, p, any_value(x.v) AS v, min((list_inner_product(x.v, x.v) + list_inner_product(b.v, b.v) - 2 * list_inner_product(x.v, b.v))::BIGINT * 256 + e) AS best FROM parts x JOIN b{k} b USING (p) GROUP BY rid, p)""")
        if k < rounds:
            steps.append(f"""
m{k} AS (SELECT p, e, list(m ORDER BY i) AS v FROM (SELECT p, best % 256 AS e, i, floor(sum(v[i]) / count(*)) AS m FROM a{k}, range(1, (SELECT max(d) FROM kept) + 1) r(i) GROUP BY ALL) GROUP BY p, e),
b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{k}.v, b{k}.v) AS v FROM b{k} LEFT JOIN m{k} USING (p, e))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id, label, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS c, len(embedding) // 4 AS d FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT rid, p, c[p * d + 1:(p + 1) * d] AS v FROM kept, range(4) r(p)),
b0 AS MATERIALIZED (SELECT p, e, v FROM parts JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (rid) WHERE e < 256),{",".join(steps)},
h AS (SELECT sha256(string_agg(list_aggregate(list_transform(v, lambda x: x::BIGINT), 'string_agg', ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
r AS (SELECT rid, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN r USING (rid), h
"""


QUERIES = {"op1_sharding": op1_sharding, "op2_pii": op2_pii, "op3_fingerprints": op3_fingerprints, "op4_media": op4_media, "op5_url_filters": op5_url_filters, "op6_simhash": op6_simhash, "op7_toxicity": op7_toxicity, "op8_packing": op8_packing, "op9_mixing": op9_mixing, "op10_hmm": op10_hmm, "op11_prefix_bpe": op11_prefix_bpe, "op12_alignment": op12_alignment, "op13_vector_codes": op13_vector_codes}
ORACLE_SQL = {"op5_url_filters": OP5_SQL, "op9_mixing": OP9_SQL, "op13_vector_codes": _vector_codes_sql(vector_codes.ROUNDS)}
