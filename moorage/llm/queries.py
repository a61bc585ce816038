"""The operators as registered queries over whole tables, with SQL where SQL can state the answer."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.llm import (
    alignment, decontam, html_text, kd_shards, licenses, mixing, neighbours, quality_ledger, ranked_search, repeats, secret_scan,
    simhash, toxicity,
)
from moorage.llm.common import table


#: Folder of the public tokenizers' vocabulary files.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def _sha256(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.learn(pages))


def op3_license_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base, own = F.col("places.label"), F.col("spans.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start_word").alias("first_word"), F.array_max("places.start_word").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.coalesce(F.array_max("spans.share"), F.lit(0.0)).alias("score"),
    )


def op4_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_ledger.ledger(table(spark, sf_dir, "documents"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_ledger.verdict("base")).alias("base_failed"), quality_ledger.verdict("2").alias("kept"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.inspect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        _sha256(F.array_join("items", ",")).alias("items_sha256"), "contaminated",
    )


def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digest(kd_shards.shard(table(spark, sf_dir, "documents"), 40))


def shard_digest(placed: DataFrame) -> DataFrame:
    return placed.select(
        F.col("doc.doc_id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents")).drop("spans")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), F.col("component").alias("component_id"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.learn(docs))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["kind"] != "format")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), _sha256(listed(base)).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(
        table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
    )


def op12_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return neighbours.score(docs, neighbours.train(docs, table(spark, sf_dir, "labels")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_html_text, op3_license_spans, op4_quality_ledger, op5_toxicity, op6_decontaminate,
        op7_kd_shards, op8_repeats, op9_simhash, op10_secret_scan, op11_alignment, op12_quality_neighbours,
        op13_ranked_search, pipeline,
    )
}

_BLANK_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_PLAIN_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES = {
    "op1_mix_sources": f"""
WITH d AS (
  SELECT doc_id, source, row_number() OVER () AS rid, coalesce(text, '') AS t,
         CAST(len({_BLANK_WORDS}) AS BIGINT) AS size FROM documents
), k AS (
  SELECT *, (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(t)), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
            / 4503599627370496::DOUBLE AS u,
         greatest(0.05::DOUBLE, 1::DOUBLE - 5::DOUBLE * (length(t) - length(translate(t, '#*$%&|<>', '')))::DOUBLE
                  / greatest(length(t), 1)::DOUBLE) AS w FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS weight FROM s
), o AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS alls,
    CAST(coalesce(sum(source_size) OVER (ORDER BY source_size / weight::DOUBLE, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY source_size / weight::DOUBLE, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS wleft FROM r
), f AS (
  SELECT *, 3 * alls - 4 * before AS lft, (3 * alls - 4 * before) * weight <= 4 * source_size * wleft AS fits FROM o
), l AS (
  SELECT lft AS l_left, wleft AS l_weight FROM f WHERE fits ORDER BY source_size / weight::DOUBLE, source NULLS LAST LIMIT 1
), t AS (
  SELECT source, source_size, CASE WHEN fits THEN (SELECT l_left FROM l) * weight / (2::DOUBLE * (SELECT l_weight FROM l))
    ELSE 2::DOUBLE * source_size END AS target FROM f
), p AS (
  SELECT k.doc_id, k.source, k.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY -ln(k.u) / k.w, k.doc_id, k.size, k.rid
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT *, epochs + CASE WHEN size > 0 AND start + size / 2::DOUBLE < target - epochs * source_size THEN 1 ELSE 0 END AS copies FROM p
)
SELECT doc_id, source, size, source_size, target, CAST(copies AS BIGINT) AS copies, CAST(copies * size AS BIGINT) AS taken FROM c
""",
    "op4_quality_ledger": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_BLANK_WORDS} AS w FROM documents
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), windows AS (
  SELECT rid, i, w[i:i+2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid
), m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN repeated USING (rid)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 5 * n_symbols > word_chars OR 2 * n_dup_lines > n_lines) AS kept
FROM m
""",
    "op6_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_PLAIN_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i+n-1], ' ') AS gram
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
c AS (SELECT d.rid, x.n, x.i, array_to_string(d.w[x.i:x.i+x.n-1], ' ') AS gram
      FROM (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n) x JOIN d USING (rid)),
h AS (SELECT c.rid, c.n, c.i, g.item_id FROM c JOIN g USING (n, gram)),
p AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM h WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN t USING (rid)
""",
    "op13_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_PLAIN_WORDS} AS w FROM documents),
b AS (SELECT qid, item_id, unnest(list_distinct(w)) AS term
      FROM (SELECT row_number() OVER () AS qid, item_id, {_PLAIN_WORDS} AS w FROM benchmark)),
a AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM b) GROUP BY rid, term),
f AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight
      FROM p, a GROUP BY term, n_docs),
m AS (SELECT rid, doc_id, 50 + (50 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM d, a WHERE len(w) > 0),
s AS (SELECT qid, item_id, rid, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM b JOIN p USING (term) JOIN f USING (term) JOIN m USING (rid) GROUP BY qid, item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 50
""",
}
