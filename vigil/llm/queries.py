"""The registered queries of the training-data operators (contract digests)."""
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (bpe, decontam, embeddup, hardneg, htmlmain, langid, licenses, packing, pii, sharding, simhash, warc,
                       whitening)
from vigil.llm.common import made, ship, sweep, table

#: Vocabularies of the packing and of the encoding query.
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str):
    def keep(fn):
        @functools.wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            mark = made()
            return sweep(fn(spark, sf_dir), mark)
        REGISTRY[name] = query
        return query
    return keep


@register("op8_shard_tree")
def op8_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards under the ``key`` law."""
    out = sharding.assign(table(spark, sf_dir, "documents"), n_shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register("op6_simhash_tiles")
def op6_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their components at 3 bits or fewer."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op4_langid_ppm")
def op4_langid_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.is_held_out("doc_id")))
    out = langid.predict(docs, model)
    return out.select("doc_id", langid.is_held_out("doc_id").alias("held_out"), "lang_pred", "score", "bits_per_byte")


@register("op5_decontam_wumanber")
def op5_decontam_wumanber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


SQL["op5_decontam_wumanber"] = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM win),
pos AS (
  SELECT doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS t
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM low, lens WHERE len(w) >= m)),
hit AS (SELECT doc_id, pos.m, i, item_id FROM pos JOIN win ON pos.t = win.t AND pos.m = win.m),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, m, i FROM hit)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT low.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@register("op10_pii_surrogates")
def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates in place of the personal data found."""
    out = pii.anonymise(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("entities").cast("long").alias("n_entities"), "entities", "text")


@register("op2_pack_swap")
def op2_pack_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@register("op9_embed_covertree")
def op9_embed_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9 or more."""
    out = embeddup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


SQL["op9_embed_covertree"] = """
WITH RECURSIVE ok AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
walk AS (
  SELECT u, v FROM link UNION SELECT w.u, l.v FROM walk w JOIN link l ON w.v = l.u)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(m, e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT u, count(*) AS n FROM link GROUP BY u) d ON d.u = e.vec_id
LEFT JOIN (SELECT u, min(v) AS m FROM walk GROUP BY u) c ON c.u = e.vec_id
"""


@register("op7_warc_index")
def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, read back through the two-level index."""
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


SQL["op7_warc_index"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
             max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM q
"""


@register("op3_html_template")
def op3_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return htmlmain.main_text(table(spark, sf_dir, "pages"))


@register("op1_license_zstd")
def op1_license_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses stated in all documents."""
    out = licenses.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_candidates", F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
                      "matches")


@register("op11_bpe_prefix")
def op11_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and the bytes that they decode to."""
    import public_tokenizers

    vocabulary = bpe.share(spark, public_tokenizers.path(RANKS))
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN), vocabulary)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op12_hardneg_lemp")
def op12_hardneg_lemp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the first positives of every 50th embedding."""
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings"), is_anchor=F.col("id") % 50 == 0, label=label)


SQL["op12_hardneg_lemp"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(CASE WHEN len(a.e) = 0 THEN 0 ELSE list_inner_product(a.e, b.e) END AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS place
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score
                   AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE place <= 3
"""


@register("op13_whiten_dqds")
def op13_whiten_dqds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of all embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)
