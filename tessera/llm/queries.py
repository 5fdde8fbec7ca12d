"""The queries of this package, each over whole tables, and the SQL for those that have it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, bpe, decontamination, exact_dedup, group_ranks, html_text, license_scan, pii, quality, simhash, toxicity, turn_repair, url_filter
from tessera.llm.shared import read

#: The rules that op2 is given.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def vocabulary() -> str:
    """Where the tokenizer file of op3 is."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary()).drop("text")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal(read(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(read(spark, sf_dir, "documents"), license_scan.catalogue(spark))
    return out.withColumn("notice_ids", F.array_join("notice_ids", ","))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_ranked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "sale_lines")
    fold = F.col("sale_id").isNotNull() & (F.crc32(F.col("sale_id").cast("string").cast("binary")) % 5 == 0)
    own = lambda c: F.when(fold, F.lit(-1)).otherwise(c).cast("long")
    rows = lines.select(
        own(F.col("vendor_id")).alias("vendor_id"),
        own(F.coalesce(F.col("item_id") % 2, F.lit(-1))).alias("part"),
        own(F.coalesce(100 * F.year("shipped_at") + F.month("shipped_at"), F.lit(-1))).alias("month"),
        F.floor(F.col("quantity") / 10).alias("tens"),
        F.floor(100 * F.col("discount") + 0.5).alias("percent"),
        F.col("sale_id").cast("long"), F.col("line_no").cast("long"), F.col("quantity").cast("long"),
        F.floor(100 * F.col("amount") + 0.5).alias("amount_cents"),
    )
    rank = [("tens", F.desc_nulls_last), ("percent", F.asc_nulls_last)]
    return group_ranks.top_places(rows, ["vendor_id", "part", "month"], rank, ["sale_id", "line_no", "quantity", "amount_cents"], 5).drop("tens")


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return ann.nearest(rows, F.col("vec_id") % 20 == 0, 20)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    turns, report = turn_repair.repair(turn_repair.damage(conversations))
    return turn_repair.digests(turns, report, conversations)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_url_filter, op3_bpe, op4_pii, op5_html_text, op6_exact_dedup, op7_simhash, op8_license_scan, op9_quality, op10_decontamination, op11_ranked_lines, op12_nearest, op13_turn_repair)
}

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{license_scan.COPYRIGHT.replace('*+', '*')}', '', 'g')"
    for pattern, to, _ in license_scan.SPELLINGS:
        out = f"regexp_replace({out}, '{pattern}', '{to.replace('$', chr(92))}', 'g')"
    return f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"


def _license_sql() -> str:
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    known = [(i, t) for i, ts in license_scan.NOTICES.items() for t in ts] + list(license_scan.TEXTS.items())
    whole = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
    return f"""
        WITH raw(id, t) AS (VALUES {", ".join(f"({quote(i)}, {quote(t)})" for i, t in known)}),
        known AS (SELECT digest, min(id) AS id FROM (SELECT sha256({whole.format(_canonical_sql("t"))}) AS digest, id FROM raw UNION ALL VALUES {", ".join(f"({quote(d)}, {quote(i)})" for i, (_, d) in license_scan.DIGESTS.items())}) GROUP BY digest),
        docs AS (SELECT doc_id, {_canonical_sql("coalesce(text, '')")} AS lines FROM documents),
        hits AS (SELECT doc_id, list_sort(list_distinct(list(id))) AS ids FROM (SELECT doc_id, unnest(list_distinct(list_transform(string_split(lines, chr(10)), lambda x: sha256(trim(x))))) AS digest FROM docs)
                 JOIN known USING (digest) GROUP BY doc_id)
        SELECT doc_id, sha256({whole.format("lines")}) AS text_digest, known.id AS license_id, array_to_string(coalesce(ids, []), ',') AS notice_ids, CAST(len(coalesce(ids, [])) AS INTEGER) AS n_notices
        FROM docs LEFT JOIN known ON known.digest = sha256({whole.format("lines")}) LEFT JOIN hits USING (doc_id)"""


#: CRC-32 of a text of ASCII characters; crc_table is made from its polynomial.
_CRC32 = "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({}, ''), lambda c: ascii(c)::UBIGINT)), lambda h, c: xor(h >> 8, crc_table[CAST((xor(h, c) & 255) + 1 AS BIGINT)])), 4294967295::UBIGINT)"
_CRC_TABLE = "(SELECT list(list_reduce(list_prepend(b::UBIGINT, list_transform(range(8), lambda i: i::UBIGINT)), lambda h, i: CASE WHEN h & 1 = 1 THEN xor(h >> 1, 3988292384::UBIGINT) ELSE h >> 1 END) ORDER BY b) AS crc_table FROM range(256) t(b))"

ORACLE: dict[str, str] = {
    "op11_ranked_lines": f"""
        WITH raw AS (
            SELECT *, sale_id IS NOT NULL AND {_CRC32.format("CAST(sale_id AS VARCHAR)")} % 5 = 0 AS fold
            FROM sale_lines, {_CRC_TABLE}),
        d AS (
            SELECT CASE WHEN fold THEN -1 ELSE vendor_id END AS vendor_id,
                   CAST(CASE WHEN fold THEN -1 ELSE coalesce(item_id % 2, -1) END AS BIGINT) AS part,
                   CAST(CASE WHEN fold THEN -1 ELSE coalesce(100 * year(shipped_at) + month(shipped_at), -1) END AS BIGINT) AS month,
                   CAST(floor(quantity / 10) AS BIGINT) AS tens, CAST(floor(100 * discount + 0.5) AS BIGINT) AS percent,
                   sale_id, CAST(line_no AS BIGINT) AS line_no, CAST(quantity AS BIGINT) AS quantity, CAST(floor(100 * amount + 0.5) AS BIGINT) AS amount_cents
            FROM raw)
        SELECT vendor_id, part, month, percent, sale_id, line_no, quantity, amount_cents,
               row_number() OVER (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS LAST, percent NULLS LAST, sale_id NULLS LAST, line_no NULLS LAST, quantity NULLS LAST, amount_cents NULLS LAST) AS pos,
               dense_rank() OVER (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS LAST, percent NULLS LAST) AS place,
               count(*) OVER (PARTITION BY vendor_id, part, month, tens, percent) AS tied
        FROM d QUALIFY place <= 5""",
    "op8_license_scan": _license_sql(),
    "op2_url_filter": f"""
        WITH u AS (
            SELECT page_id,
                   {_ASCII_LOWER.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} AS host,
                   regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages),
        r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                              ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
        SELECT page_id, host, path, any_value(rule) AS rule,
               coalesce(any_value(v), CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
        FROM (SELECT page_id, host, path, h || p AS rule, v,
                     row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h) DESC NULLS LAST, length(p) DESC) AS k
              FROM u LEFT JOIN r ON ('.' || host) LIKE ('%.' || h) AND starts_with(path, p))
        WHERE k = 1 GROUP BY page_id, host, path""",
    "op6_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_ASCII_LOWER.format("coalesce(text, '')")} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
}
