"""The registered query of each operator: production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermopolis.llm import bpe, decontaminate, extract, licenses, lines, periodic, search, simhash, suffixes, tokens, toxicity, vectors, warc
from thermopolis.llm.common import materialize, remove, scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_distance=3)


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return edited.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


ORACLES["op2_line_dedup"] = f"""
WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
totals AS (SELECT source, count(*) AS host_pages FROM pages GROUP BY source),
distinct_lines AS (SELECT source, unnest(list_distinct(lines)) AS line FROM pages),
counted AS (SELECT source, line, count(*) AS n FROM distinct_lines WHERE trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' GROUP BY source, line),
bad AS (
  SELECT source, list(line) AS bad_lines FROM counted JOIN totals USING (source)
  WHERE n >= {lines.MIN_PAGES} AND n > {lines.MAX_RATIO}::DOUBLE * host_pages GROUP BY source
),
kept AS (
  SELECT doc_id, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(bad_lines, []), x)) AS good
  FROM pages LEFT JOIN bad USING (source)
)
SELECT doc_id, len(lines)::INTEGER AS n_lines, (len(lines) - len(good))::INTEGER AS n_dropped,
  md5(array_to_string(good, chr(10))) AS text_md5
FROM kept
"""


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archive(spark, folder, payloads=False).drop("headers", "url")
    records = materialize(records)
    remove(spark, folder)
    return warc.restore(records).select(
        "page_id", "payload_bytes", F.col("sha1").alias("payload_digest"), "record_type", "refers_to"
    )


ORACLES["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + ((('0x' || substr(x, (1 + 5 * (i // 4))::INTEGER, 5))::BIGINT >> (5 * (3 - i % 4))::INTEGER) & 31))::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


def word_bpe() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@_query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), word_bpe())
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@_query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), word_bpe(), full=False)


@_query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "start")


_WORDS = r"regexp_split_to_array(trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[ \t\n\x0B\f\r]+')"
_SHINGLES = "list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: list_slice(w, i, i + least(5, len(w)) - 1))"
ORACLES["op7_decontaminate"] = f"""
WITH items AS (
  SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k, len(w) - least(5, len(w)) + 1 AS m, {_SHINGLES} AS shingles
  FROM (SELECT DISTINCT item_id, list_filter({_WORDS}, lambda x: x <> '') AS w FROM benchmark) WHERE len(w) > 0
),
texts AS (
  SELECT * FROM (SELECT DISTINCT doc_id, list_filter({_WORDS}, lambda x: x <> '') AS w FROM documents) WHERE len(w) > 0
),
places AS (
  SELECT doc_id, k, len(w) AS size, p, list_slice(w, p + 1, p + k) AS shingle
  FROM texts, (SELECT DISTINCT k FROM items), unnest(range(len(w) - k + 1)) AS u(p)
),
item_shingles AS (
  SELECT item_id, n, k, m, shingle, count(*) AS item_times
  FROM (SELECT item_id, n, k, m, unnest(shingles) AS shingle FROM items) GROUP BY ALL
),
hits AS (SELECT doc_id, size, p, shingle, item_id, n, m, item_times FROM places JOIN item_shingles USING (k, shingle)),
windows AS (
  SELECT DISTINCT doc_id, item_id, size, n, m, s
  FROM hits, unnest(range(greatest(p - m + 1, 0), least(p, greatest(size - n, 0)) + 1)) AS u(s)
),
counted AS (
  SELECT v.doc_id, v.item_id, v.s, v.m, least(v.m, v.size - v.n + v.m) AS shingles, h.shingle, h.item_times, count(*) AS times
  FROM windows v JOIN hits h ON h.doc_id = v.doc_id AND h.item_id = v.item_id AND h.p BETWEEN v.s AND v.s + v.m - 1
  GROUP BY ALL
),
scored AS (
  SELECT doc_id, item_id, s, sum(least(times, item_times)) / (shingles + m - sum(least(times, item_times))) AS similarity
  FROM counted GROUP BY doc_id, item_id, s, m, shingles
)
SELECT doc_id, item_id, round(max(similarity), 6) AS similarity, arg_max(s, similarity * 1e9 - s)::INTEGER AS start
FROM scored WHERE similarity >= {decontaminate.MIN_SIMILARITY} GROUP BY doc_id, item_id
"""


@_query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op8_embedding_dedup"] = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
),
usable AS (
  SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS norm FROM v
  WHERE label IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(x, lambda e: e <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.x, b.x) / a.norm / b.norm >= {vectors.MIN_COSINE}
),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS m FROM reached GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(least(m, vec_id), vec_id) AS component_id,
  coalesce(m, vec_id) >= vec_id AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least ON least.a = vec_id
"""


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores learnt from the labels that are not held out."""
    return toxicity.score(docs, labels.where(~held_out()))


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@_query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.cut_repeats(table(spark, sf_dir, "documents"), length=100, texts=False)


@_query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth text by its id's CRC-32 with its words from a certain one on repeated at an interval."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.select("*", F.size("words").cast("long").alias("n"), F.floor(F.col("h") / 10).alias("g"))
    rows = rows.select("*", F.expr("if(n > 0, g % n, null)").alias("a"))
    rows = rows.select("*", F.expr("1 + floor((n - a) / (3 + g % 8))").alias("p"))
    again = "array_join(transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)])), ' ')"
    return rows.select("doc_id", F.expr(f"if(n > 0, {again}, text)").alias("text"))


@_query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


_TERMS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
ORACLES["op13_lexical_search"] = f"""
WITH texts AS (SELECT row_number() OVER () AS place, doc_id, {_TERMS} AS terms FROM documents),
docs AS (SELECT place, doc_id, terms, len(terms)::BIGINT AS n FROM texts WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM docs),
wanted AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
),
postings AS (
  SELECT place, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT place, doc_id, n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, totals GROUP BY term, all_docs
),
scored AS (
  SELECT item_id, place, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_docs) // all_terms))))::BIGINT AS score
  FROM wanted JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY item_id, place, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""


@_query
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_text(table(spark, sf_dir, "pages"))
