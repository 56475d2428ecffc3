"""The contract queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression, decontam, licenses, mixing, ngram_join, quality, sharding, tokencount, toxicity, warc
from .common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.withColumn("taken", F.col("size") * F.col("copies")).select("doc_id", "size", "source_size", "target", "copies", "taken")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), vocabulary()).withColumn("over_limit", F.col("n_tokens") > 512)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    return toxicity.score_toxicity(docs, index).withColumn("held_out", held_out)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("contaminated", F.lit(True))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_rules(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_mixing": op2_mixing,
    "op3_license_scan": op3_license_scan,
    "op4_token_counts": op4_token_counts,
    "op5_ngram_join": op5_ngram_join,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_quality_rules": op8_quality_rules,
    "op9_sharding": op9_sharding,
    "op10_warc": op10_warc,
}

_OP2 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS id_digest, md5(coalesce(text, '')) AS text_digest
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM d GROUP BY source),
f AS (
  SELECT *, (source_size * 2)::DOUBLE AS most, (source_size * 2)::DOUBLE / weight AS full_at FROM s),
w AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(most) OVER (ORDER BY full_at, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY full_at, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM f),
g AS (SELECT arg_min(level, full_at) AS water FROM w WHERE level <= full_at),
t AS (
  SELECT source, source_size, least(most, coalesce(water * weight, most)) AS target,
         ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS start
  FROM w CROSS JOIN g),
r AS (
  SELECT doc_id, size, source_size, target, start, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY size, id_digest, text_digest) - 1 AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, (floor(rate) + floor(start + (place + 1) * (rate - floor(rate))) - floor(start + place * (rate - floor(rate))))::INTEGER AS copies FROM r)
SELECT doc_id, size, source_size, target, copies, size * copies::BIGINT AS taken FROM c
"""

_OP9 = """
WITH tab AS (
  SELECT list(list_reduce(range(0, 8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) ORDER BY i) AS tab
  FROM range(0, 256) r(i)),
d AS (
  SELECT doc_id, md5(coalesce(text, '')) AS key, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size,
         xor(coalesce(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
                                  lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295), 4294967295)::BIGINT AS text_crc32
  FROM documents, tab),
p AS (
  SELECT *, (sum(size) OVER (ORDER BY key, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS off, (sum(size) OVER ())::BIGINT AS total,
         row_number() OVER (ORDER BY key, doc_id NULLS FIRST) - 1 AS nth
  FROM d),
g AS (SELECT *, min(off) OVER (PARTITION BY key) AS goff, sum(size) OVER (PARTITION BY key) AS weight FROM p),
s AS (
  SELECT *, least(23, ((2 * CASE WHEN weight * 24 > total THEN off ELSE goff END + size) * 24) // (2 * total))::INTEGER AS shard FROM g)
SELECT doc_id, size, text_crc32, shard, nth - min(nth) OVER (PARTITION BY shard) AS slot, 'bytes' AS law, NULL::INTEGER AS grown_shard FROM s
"""

_TEMPLATES = ", ".join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in licenses.TEMPLATES.items())

_OP3 = r"""
WITH t AS (
  SELECT template, w FROM (SELECT template, regexp_extract_all(lower(body), '[\p{L}\p{N}]+') AS w FROM (VALUES @TEMPLATES) v(template, body))),
ts AS (SELECT DISTINCT template, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT template, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
tn AS (SELECT template, count(*) AS n FROM ts GROUP BY template),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
ds AS (SELECT r, doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
h AS (SELECT r, doc_id, template, count(DISTINCT s) AS k, min(i) - 1 AS first_word FROM ds JOIN ts USING (s) GROUP BY ALL)
SELECT doc_id, template, k / n AS containment, first_word::INTEGER AS first_word FROM h JOIN tn USING (template) WHERE 5 * k >= 4 * n
""".replace("@TEMPLATES", _TEMPLATES)

_OP5 = r"""
WITH RECURSIVE x AS (SELECT coalesce(text, '') AS text, min(doc_id) AS first_id, count(*) AS copies, row_number() OVER (ORDER BY coalesce(text, '')) AS t FROM documents GROUP BY coalesce(text, '')),
w AS (SELECT t, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM x),
s AS (
  SELECT DISTINCT t, s FROM (SELECT t, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT t, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0))),
n AS (SELECT t, count(*) AS n FROM s GROUP BY t),
p AS (SELECT a.t AS a, b.t AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.t < b.t GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.t = a JOIN n nb ON nb.t = b WHERE 5 * c >= 4 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT t AS a, t AS root FROM x UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.a),
k AS (SELECT r.a AS t, min(x.first_id) AS class_id FROM r JOIN x ON x.t = r.root GROUP BY r.a),
m AS (SELECT e.a AS t, count(*) AS text_links, sum(x.copies) AS doc_links FROM e JOIN x ON x.t = e.b GROUP BY e.a)
SELECT d.doc_id, class_id, first_id AS copy_of, (coalesce(doc_links, 0) + copies - 1)::BIGINT AS n_links, coalesce(text_links, 0)::BIGINT AS text_links
FROM documents d JOIN x ON x.text = coalesce(d.text, '') JOIN k USING (t) LEFT JOIN m USING (t)
"""

_OP10 = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best FROM pages),
h AS (SELECT *, sha1(encode(html)) AS hex FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, 1 + 10 * (i // 8)::BIGINT, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to, url AS target_uri
FROM h
"""

ORACLES: dict[str, str] = {"op2_mixing": _OP2, "op3_license_scan": _OP3, "op5_ngram_join": _OP5, "op9_sharding": _OP9, "op10_warc": _OP10}
