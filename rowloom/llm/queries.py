"""The dealt operators as queries over their whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import decontaminate, gnat, hmm, langid, licenses, minhash, mixing, packing, phrases, pii, search, signatures, warc
from rowloom.llm.tables import crc_of, table
from rowloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


@query("op1_mix_sources")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return taken.select(F.col("row.doc_id").alias("doc_id"), "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
g AS (SELECT count(*) AS n, sum(len(w)) / count(*) AS mean FROM d),
s AS (
  SELECT q.doc_id AS query_id, t.doc_id, round(sum(q.tf * ln(1 + (g.n - df.df + 0.5) / (df.df + 0.5)) * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * len(d.w) / g.mean))), 6) AS score
  FROM tf q JOIN tf t ON q.term = t.term JOIN df ON df.term = q.term JOIN d ON d.doc_id = t.doc_id, g
  WHERE q.doc_id % 50 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""


@query("op2_bm25_search", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = search.top_documents(docs, docs.filter("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id"))
    return found.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "score")


@query("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_private(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = pii.KINDS[: pii.TERM]
    count = [F.size(F.filter("spans", pii.of_kind(i))).cast("bigint").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select(F.col("row.doc_id").alias("doc_id"), *count, F.sha2(pii.listed(F.col("spans"), base), 256).alias("base_sha256"), pii.listed(F.col("spans"), pii.KINDS).alias("spans"))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(crc_of("doc_id"), F.lit(4)) == 2, F.lit(False))
    model = langid.fit(docs.filter(F.pmod(crc_of("doc_id"), F.lit(4)) != 2))
    found = docs.select("doc_id", held_out.alias("held_out"), langid.identify(F.col("text"), spark, model, spans=False).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest([w[i : i + 3] for i in range(1, greatest(len(w) - 3, 1) + 1)]) AS shingle FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_shingles FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 80 * (na.n_shingles + nb.n_shingles - shared)),
reach AS (SELECT DISTINCT a AS node, a AS other FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n_shingles, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.node = d.doc_id
"""


@query("op5_near_duplicates", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS lead FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT) + 1, 1) for i in range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = lead THEN NULL ELSE lead END AS refers_to
FROM m
"""


@query("op6_web_archives", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path, with_payload=False)
    return records.select(F.col("id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


@query("op7_licenses")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", F.array_join("families", ",").alias("families"), "n_licensed", "n_unknown", "probability")


@query("op8_hidden_markov")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.pmod(crc_of("doc_id"), F.lit(5))
    scored = hmm.score_texts(table(spark, sf_dir, "documents"), remainder != 1, keep=["doc_id"])
    held_out = F.coalesce(F.pmod(crc_of("row.doc_id"), F.lit(5)) == 1, F.lit(False))
    return scored.select(F.col("row.doc_id").alias("doc_id"), held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, unnest([{'at': i, 'h': md5(array_to_string(w[i : i + 12], ' '))} for i in range(1, len(w) - 11)], recursive := true) FROM d WHERE len(w) >= 13),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range("at", "at" + 13)) AS word FROM win JOIN least ON win.h = least.h AND m < doc_id),
lists AS (SELECT doc_id, list(word) AS words FROM gone GROUP BY doc_id),
kept AS (SELECT d.doc_id, w, words, CASE WHEN words IS NULL THEN w ELSE [w[i] for i in range(1, len(w) + 1) if NOT list_contains(words, i)] END AS rest FROM d LEFT JOIN lists ON d.doc_id = lists.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(words), 0) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(rest, ' '), '')) AS kept_sha256
FROM kept
"""


@query("op9_repeated_phrases", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = phrases.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"], with_text=False)
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, unnest([w[i : i + least(10, len(w)) - 1] for i in range(1, greatest(len(w) - 9, 1) + 1)]) AS win
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM items),
wins AS (
  SELECT doc_id, size, unnest([{'at': i, 'win': w[i : i + size - 1]} for i in range(1, len(w) - size + 2)], recursive := true)
  FROM d, sizes WHERE len(w) >= size),
found AS (SELECT doc_id, wins.size, "at", item_id FROM wins JOIN items ON wins.size = items.size AND wins.win = items.win),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range("at", "at" + size)) AS word FROM (SELECT DISTINCT doc_id, size, "at" FROM found)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS list FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN ids ON d.doc_id = ids.doc_id
"""


@query("op10_decontaminate", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hits = F.aggregate(F.zip_with("leak.starts", "leak.ends", lambda a, b: (b - a).cast("bigint")), F.lit(0).cast("bigint"), lambda x, y: x + y)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.col("leak.n_words").alias("n_words"), hits.alias("n_hit"), F.size("leak.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("leak.items", ","), 256).alias("items_sha256"), (F.size("leak.starts") > 0).alias("contaminated"),
    )


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_dot_product(a.e, r.e) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""


@query("op11_hard_negatives", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return gnat.mine(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", label=label)


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
m AS (SELECT doc_id, 25 + (75 * len(w) * g.n) // g.l AS m FROM d, g WHERE len(w) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, CAST(floor(1000 * ln((2 * g.n + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY term, g.n),
q AS (SELECT item_id, unnest(w) AS term FROM b),
s AS (
  SELECT item_id, tf.doc_id, CAST(sum(df.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS BIGINT) AS score
  FROM q JOIN tf ON tf.term = q.term JOIN df ON df.term = q.term JOIN m ON m.doc_id = tf.doc_id GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""


@query("op12_signature_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signatures.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("query_id", "item_id")


@query("op13_pack_documents")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
    return pieces.select(F.col("row.doc_id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
