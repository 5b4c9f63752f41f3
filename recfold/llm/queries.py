"""The corpus operators as registered queries, with their SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from recfold.llm import (
    bpe, conversations, decontaminate, langid, license_digest, ngram_rules, pii, pu_quality, simhash, spelling,
    token_lengths, url_rules, warc_zip,
)
from recfold.llm.rows import ID, NO_ID
from recfold.sources.storage import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, tokenizer_file()).select(
        "doc_id",
        bpe.token_count().alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op10_simhash_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return groups.select(
        F.when(F.col(ID) != NO_ID, F.col(ID)).alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@query
def op1_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that overlap."""
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.when(F.col(ID) != NO_ID, F.col(ID)).alias("doc_id"), "item_id", "n_items", "token_at", "n_tokens", "n_same"
    )


@query
def op3_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, _ = pu_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    doc_id = pu_quality.id_column()
    return scores.select(
        doc_id.alias("doc_id"),
        F.coalesce(pu_quality.remainder(doc_id) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_ngram_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter("doc_id is not null and quality is not null")
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1")
    return ngram_rules.judge(table(spark, sf_dir, "documents"), trusted.select("doc_id"))


@query
def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(pii.count_of(F.col("pii_base"), kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")),
        F.sha2(pii.as_text(F.col("pii_base")).cast("binary"), 256).alias("base_sha256"),
        pii.as_text(F.col("pii_spans")).alias("spans"),
        F.array_join(
            F.transform("pii_spans", lambda s: F.format_number(s["score"], 2)), ","
        ).alias("scores"),
    )


@query
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


@query
def op6_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc_zip.write_packages(table(spark, sf_dir, "pages"), f"{scratch_dir(spark)}/packages")
    read = warc_zip.read_records(warc_zip.locate(packages), payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_token_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_lengths.suffix_sums(token_lengths.histogram(docs, tokenizer_file()))


@query
def op8_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.scan(table(spark, sf_dir, "documents"), license_digest.known_digests(spark))


@query
def op11_conversation_auction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(conversations.damage(table(spark, sf_dir, "conversations")))


@query
def op12_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(spelling.words(table(spark, sf_dir, "documents")))


@query
def op13_string_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


SQL["op6_warc_zip"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS low FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > low THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > low THEN low END AS refers_to
FROM m"""


def _url_sql() -> str:
    """Host rules are compared as text here; pattern rules run one by one on every URL, without an index."""
    def expression(rule: str) -> str:
        signs = {"^": "([^a-z0-9]+|\\A|\\z)", "*": ".*"}
        return "(?s)" + "".join(signs.get(sign) or re.escape(sign) for sign in rule)

    hosts = ", ".join(
        f"('{name}', '{name.partition('/')[0]}', '/{name.partition('/')[2]}', '{verdict}')"
        for verdict, name in url_rules.HOST_RULES
    )
    patterns = ", ".join(f"('{name}', '{verdict}', '{expression(name)}')" for verdict, name in url_rules.PATTERN_RULES)
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, regexp_extract(rest, '^[^?#]*') AS place FROM u
), s AS (
  SELECT page_id, split_part(place, '/', 1) AS raw, substr(place, length(split_part(place, '/', 1)) + 1) AS path FROM h
), p AS (
  SELECT page_id, translate(raw, {lower}) AS host, path FROM s
), r(rule, rule_host, start, verdict) AS (VALUES {hosts}), q(name, verdict, expression) AS (VALUES {patterns}), f AS (
  SELECT p.*, (
    SELECT max(struct_pack(n := length(rule), rule := rule, verdict := verdict)) FROM r
    WHERE (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, start)
  ) AS best, (
    SELECT min(struct_pack(n := -length(name), later := verdict <> 'block', name := name, verdict := verdict)) FROM q
    WHERE p.host <> '' AND regexp_matches(translate(p.host || p.path, {lower}), expression)
  ) AS pattern FROM p
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, pattern.verdict, 'allow') AS verdict,
       CASE WHEN best IS NULL THEN pattern.name END AS pattern_rule
FROM f"""


SQL["op4_url_rules"] = _url_sql()


def _license_sql() -> str:
    def canonical(text: str) -> str:
        statement = license_digest.COPYRIGHT.replace("'", "''")
        plain = f"regexp_replace(lower({text}), '(?m){statement}', ' \\1', 'g')"
        plain = f"regexp_replace(' ' || {plain} || ' ', '[^a-z0-9]+', '  ', 'g')"
        for pair in license_digest.SPELLINGS:
            found, used = ("".join(f" {word} " for word in words.split()) for words in pair)
            plain = f"replace({plain}, '{found}', '{used}')"
        return f"nullif(trim({plain}), '')"

    known = ", ".join(f"('{name}', '{text}')" for name, text in license_digest.KNOWN)
    return f"""
WITH k(license, text) AS (VALUES {known}), known AS (
  SELECT {canonical('text')} AS plain, min(license) AS license FROM k GROUP BY 1
), d AS (SELECT DISTINCT doc_id, text FROM documents), parts AS (
  SELECT doc_id, text, true AS whole, {canonical('text')} AS plain FROM d
  UNION ALL
  SELECT doc_id, text, false, {canonical('line')} FROM (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line FROM d WHERE contains(text, chr(10)))
), found AS (
  SELECT doc_id, text, min(license) FILTER (WHERE whole) AS license,
         array_to_string(list_sort(list(DISTINCT license)), ',') AS notices,
         greatest(count(*) FILTER (WHERE NOT whole), least(count(*) FILTER (WHERE whole), 1)) AS n_notices
  FROM parts JOIN known USING (plain) GROUP BY doc_id, text
)
SELECT d.doc_id, found.license, coalesce(notices, '') AS notices, coalesce(n_notices, 0) AS n_notices
FROM d LEFT JOIN found ON d.doc_id IS NOT DISTINCT FROM found.doc_id AND d.text IS NOT DISTINCT FROM found.text"""


SQL["op8_license_digests"] = _license_sql()
