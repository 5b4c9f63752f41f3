"""The corpus pipeline: quality, near-duplicates, benchmark overlaps, personal data, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recfold.llm import bpe, decontaminate, pii, pu_quality, queries, simhash
from recfold.sources.storage import materialise, scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives at least an even chance of quality 1.

    NULL and empty texts are scored as the empty text; repeated rows are scored alike and all stay
    or go. An empty table stays empty. All columns are returned as they are.
    """
    return pu_quality.keep_good(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one of smallest id.

    NULL and empty texts have fingerprint zero and are one group; a NULL id comes after all others,
    ties go by the text's hash. Of equal rows (id and text) one stays. An empty table stays empty.
    """
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item.

    NULL and empty texts overlap none; repeated rows stay or go together. Without items, or
    without documents, nothing changes.
    """
    return decontaminate.without_benchmark(docs, queries.table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in ``text`` is replaced by its kind; ``n_chars`` counts the new text."""
    clean = pii.redact(docs)
    return clean.select(*(
        F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns
    ))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with ``token_ids``, ``n_tokens`` and whether decoding gives the text back.

    NULL is encoded as the empty text, which has no ids; every row is encoded, repeated ones alike.
    Columns of the new names are replaced. An empty table gives no rows.
    """
    path = queries.tokenizer_file()
    kept = [c for c in docs.columns if c.lower() not in ("token_ids", "n_tokens", "decoded", "round_trip")]
    decoded = bpe.round_trip(docs.select(*(F.col(f"`{c}`") for c in kept)), path)
    return decoded.select(
        *(F.col(f"`{c}`") for c in kept), "token_ids", bpe.token_count().alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet to the shared folder and read by the next.

    NULLs, empty texts, repeated rows and an empty table are treated as the stages say.
    """
    docs = queries.table(spark, sf_dir, "documents")
    folder = scratch_dir(spark)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
