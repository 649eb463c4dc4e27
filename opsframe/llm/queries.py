"""One query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm import (
    alignment,
    decontaminate,
    linededup,
    maintext,
    mixing,
    phrases,
    quality,
    secrets,
    sharding,
    simhash,
    toxicity,
    urls,
    warc,
)
from opsframe.llm.batches import bounded_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{folder}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@query
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.scanned(docs, table(spark, folder, "benchmark"))
    hit = F.col("contamination")
    items = F.concat_ws(",", F.array_sort(hit["items"]))
    return found.select(
        "doc_id",
        hit["n_words"].alias("n_words"),
        decontaminate.n_hit(hit["spans"]).alias("n_hit"),
        F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (F.size(hit["spans"]) > 0).alias("contaminated"),
    )


ORACLES["op2_decontaminate"] = r"""
WITH documents_words AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents),
benchmark_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, len(list_slice(w, i, i + 9)) AS n,
           array_to_string(list_slice(w, i, i + 9), ' ') AS phrase
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM benchmark_words WHERE len(w) > 0)),
runs AS (
    SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM documents_words, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT doc_id, n, i, item FROM runs JOIN windows USING (n, phrase)),
covered AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM documents_words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scanned(table(spark, folder, "documents").select("doc_id", "text"))
    kinds = [rule.kind for rule in secrets.BASE]
    counts = [
        F.size(secrets.of_kinds(F.col("secrets"), kind)).cast("long").alias(f"n_{kind}")
        for kind in kinds
    ]
    base = secrets.listed(secrets.of_kinds(F.col("secrets"), *kinds))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base, 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


@query
def op4_maintext(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return maintext.with_main_text(pages).select("page_id", "url", "text", "n_chars")


@query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.judged(docs, table(spark, folder, "labels")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = toxicity.scored(docs, table(spark, folder, "labels"))
    return found.select(
        "doc_id",
        (~toxicity.in_fold("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.CUT).cast("int").alias("predicted"),
    )


@query
def op7_linededup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    lines = F.col("lines")
    return linededup.deduplicated(docs).select(
        "doc_id",
        lines["n_lines"].alias("n_lines"),
        lines["n_dropped"].alias("n_dropped"),
        F.sha2(lines["kept"], 256).alias("kept_sha256"),
    )


ORACLES["op7_linededup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
    FROM documents),
keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
repeated AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
    SELECT k.*, coalesce(k.doc_id <> r.last, false) AS gone
    FROM keyed k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    names = ("size", "source_size", "target", "taken")
    return mixing.mixed(docs).select("doc_id", *(F.col(f"mix.{name}").alias(name) for name in names))


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.sharded(docs).select(
        "doc_id",
        sharding.text_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.judged(pages).select("page_id", "host", "path", "rule", "verdict")


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("lang", "text"))


ORACLES["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
    SELECT lang, k, list_slice(w, i, i + k - 1) AS p
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) AS v(k))),
counted AS (SELECT lang, k, p, count(*) AS f FROM grams GROUP BY lang, k, p),
frequent AS (SELECT lang, k, p, f AS a FROM counted WHERE k > 1 AND f >= 10),
cuts AS (
    SELECT lang, p, a, c AS k, list_slice(p, 1, c) AS x, list_slice(p, c + 1, k) AS y
    FROM (SELECT *, unnest(range(1, k)) AS c FROM frequent)),
scored AS (
    SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r,
           CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts c JOIN counted x ON x.lang = c.lang AND x.p = c.x JOIN counted y ON y.lang = c.lang AND y.p = c.y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
longer AS (
    SELECT lang, p, max(a) AS most
    FROM (SELECT lang, list_slice(p, 1, 2) AS p, a FROM frequent WHERE k = 3
          UNION ALL SELECT lang, list_slice(p, 2, 3), a FROM frequent WHERE k = 3) GROUP BY lang, p),
kept AS (
    SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, b.l, b.r, b.score
    FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.p = b.p
    WHERE x.most IS NULL OR 100 * x.most < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLES["op12_warc"] = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
firsts AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
              ELSE page_id END AS first
    FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM firsts
"""


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return alignment.aligned(docs).select("doc_id", *(F.col(f"alignment.{name}").alias(name) for name in names))
