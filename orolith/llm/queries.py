"""Queries opN_... over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, embeddings, hardneg, html, lm, mixing, packing, phrases, quality, rangecoder, sharding, simhash
from .common import shared_dir, table


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embeddings.near_duplicates(vectors).select("vec_id", "n_links", "component_id", "kept")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    rangecoder.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), out)
    return rangecoder.read_token_files(spark.read.parquet(out)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    placed = sharding.assign_shards(sharding.assign_shards(sized, sharding.shard_tree(8)), sharding.shard_tree(9), "grown_shard")
    return sharding.number_slots(placed).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.backoff_scores(table(spark, sf_dir, "documents")).select("doc_id", "n_pairs", F.round("score", 6).alias("score"))


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT row, unnest(ws[:-2]) AS h, unnest(ws[2:]) AS w FROM d WHERE len(ws) > 1),
o AS (SELECT row, h, w, count(*) AS n FROM p GROUP BY ALL),
u AS (SELECT row, unnest(ws) AS w FROM d),
uo AS (SELECT row, w, count(*) AS n FROM u GROUP BY ALL),
ho AS (SELECT row, h, sum(n) AS n FROM o GROUP BY ALL),
c2 AS (SELECT h, w, sum(n) AS n FROM o GROUP BY ALL),
c1 AS (SELECT w, sum(n) AS n FROM uo GROUP BY ALL),
ch AS (SELECT h, sum(n) AS n FROM ho GROUP BY ALL),
t AS (SELECT sum(n) AS n FROM c1),
s AS (SELECT o.row, sum(o.n) AS n_pairs, sum(o.n * CASE WHEN c2.n - o.n > 0 THEN ln((c2.n - o.n)::DOUBLE) - ln((ch.n - ho.n)::DOUBLE)
  ELSE ln(0.4::DOUBLE) + ln(greatest(c1.n - uo.n, 1)::DOUBLE) - ln(t.n::DOUBLE) END) AS log
  FROM o JOIN c2 USING (h, w) JOIN ch USING (h) JOIN ho ON ho.row = o.row AND ho.h = o.h JOIN c1 ON c1.w = o.w JOIN uo ON uo.row = o.row AND uo.w = o.w, t GROUP BY o.row)
SELECT doc_id, coalesce(n_pairs, 0)::BIGINT AS n_pairs, round(log / n_pairs, 6) AS score FROM d LEFT JOIN s ON d.row = s.row
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_windows(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.quality_verdicts(docs, labels).select("doc_id", *quality.BASE, "base_failed", "kept", "lang", *quality.EXTRA)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    fixed = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rendered = chat.chat_format(rows.unionByName(fixed))
    line = F.concat(F.coalesce("role", F.lit("")), F.lit("\n"), "text", F.lit("\n"))
    turns = chat.read_back(rendered).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("ord", line.alias("line"), "loss_text"))).alias("ts"))
    loss = F.array_join(F.transform("ts", lambda t: t["loss_text"]), "")
    read = turns.select(
        F.col("conv_id").alias("id"), F.size("ts").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("ts", lambda t: t["line"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
    )
    return rendered.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars")).join(read, F.col("conv_id").eqNullSafe(F.col("id"))).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


OP8_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, coalesce(role, '') AS r FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok', 'user'), (-7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant')) t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(r || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS loss_sha256,
  sum(length(r) + length(text) + 14 + length(regexp_replace(r || text, '[^\\<#:]', '', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep_text=False)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
e AS (SELECT *, (size >> greatest(length(bin(size)) - 4, 0)) + 16 * length(bin(size)) AS class, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 6))::BIGINT % 64 AS bucket FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
a AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight,
  coalesce(sum(3 * source_size) OVER b, 0) AS cap_before, coalesce(sum(weight) OVER b, 0) AS weight_before FROM w
  WINDOW b AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap::DOUBLE * (all_weight - weight_before) <= weight * (all_size - cap_before)::DOUBLE AS capped FROM a),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE weight::DOUBLE * (all_size - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))::DOUBLE / (all_weight - coalesce(sum(CASE WHEN capped THEN weight END) OVER (), 0))::DOUBLE END AS target FROM c),
r AS (SELECT e.*, t.source_size, t.target, ('0x' || substr(md5('mix' || coalesce(e.source, '')), 1, 5))::BIGINT::DOUBLE / 1048576 AS u,
  CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
  row_number() OVER (PARTITION BY e.source ORDER BY class, bucket, size, doc_id) AS k FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (least(floor(u + rate * k::DOUBLE) - floor(u + rate * (k - 1)::DOUBLE), 3) * size)::BIGINT AS taken FROM r
"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hardneg.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id AS id, a.label = e.label AS same, list_inner_product(a.v, e.v)::BIGINT AS score FROM e a, e WHERE a.vec_id % 50 = 0 AND a.vec_id IS DISTINCT FROM e.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.id)::INTEGER AS rank, s.id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.id) <= 3
"""


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
o AS (SELECT lang, 1 AS k, ws[i] AS phrase FROM g UNION ALL SELECT lang, 2, ws[i] || ' ' || ws[i + 1] FROM g WHERE i + 1 <= len(ws) UNION ALL SELECT lang, 3, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FROM g WHERE i + 2 <= len(ws)),
t AS (SELECT lang, count(*) AS n FROM o WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, count(*) AS n FROM o GROUP BY ALL HAVING count(*) >= 10),
x AS (SELECT lang, phrase, n AS a, k, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS cut FROM c WHERE k > 1),
s AS (SELECT x.lang, x.phrase, a, cut, cl.n AS l, cr.n AS r, (1000000::HUGEINT * a::HUGEINT * a::HUGEINT) // (cl.n::HUGEINT * cr.n::HUGEINT) AS score FROM x
  JOIN c cl ON cl.lang = x.lang AND cl.k < 3 AND cl.phrase = array_to_string(ws[1:cut], ' ') JOIN c cr ON cr.lang = x.lang AND cr.k < 3 AND cr.phrase = array_to_string(ws[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
e AS (SELECT lang, n, string_split(phrase, ' ') AS ws FROM c WHERE k = 3),
f AS (SELECT lang, part, max(n) AS longer FROM (SELECT lang, n, array_to_string(ws[1:2], ' ') AS part FROM e UNION ALL SELECT lang, n, array_to_string(ws[2:3], ' ') FROM e) GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN f ON f.lang = b.lang AND f.part = b.phrase WHERE f.longer IS NULL OR 100 * f.longer < 50 * b.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n::BIGINT AS n, score::BIGINT AS score
FROM k JOIN t ON t.lang = k.lang QUALIFY row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    told = F.array_join(F.col("ids").cast("array<string>"), ",")
    return docs.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(told, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_embeddings": op1_embeddings, "op2_token_files": op2_token_files, "op3_sharding": op3_sharding, "op4_backoff": op4_backoff, "op5_packing": op5_packing, "op6_quality": op6_quality, "op7_html": op7_html, "op8_chat": op8_chat, "op9_simhash": op9_simhash, "op10_mixing": op10_mixing, "op11_hard_negatives": op11_hard_negatives, "op12_phrases": op12_phrases, "op13_bpe": op13_bpe}

SQL: dict[str, str] = {"op4_backoff": OP4_SQL, "op8_chat": OP8_SQL, "op10_mixing": OP10_SQL, "op11_hard_negatives": OP11_SQL, "op12_phrases": OP12_SQL}
