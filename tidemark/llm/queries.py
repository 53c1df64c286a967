"""The operators as queries over the supplied tables, with their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, gam, lm_scoring, packing, token_counts
from tidemark.llm import conversation_repair as repair
from tidemark.llm import exact_dedup as exact
from tidemark.llm import jaccard_join as jaccard
from tidemark.llm import line_runs as lines
from tidemark.llm import merkle_manifest as merkle
from tidemark.llm import quality_rules as rules
from tidemark.llm import secret_scans as secrets
from tidemark.llm import substring_dedup as substring
from tidemark.session import prepare, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name; `sql` gives the same result in DuckDB."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


@query(rules.SQL)
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.quality_rules(table(spark, folder, "documents"))
    too_long = F.col("longest_repeat") > rules.MAX_REPEAT
    return found.withColumn("repeat_too_long", too_long).drop("longest_repeat")


@query()
def op2_gam(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return gam.quality_scores(docs, gam.fit_scores(docs, table(spark, folder, "labels")))


@query(jaccard.sql())
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, folder, "documents"))


@query(lines.sql())
def op4_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.line_runs(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))


@query()
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digests(packing.packed(table(spark, folder, "documents")))


@query()
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(table(spark, folder, "documents")))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.length_histogram(table(spark, folder, "documents"))


@query()
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, folder, "documents"))


@query(exact.SQL)
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_dedup(table(spark, folder, "documents"))


@query(substring.sql())
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.substring_dedup(table(spark, folder, "documents"))
    n_chars = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_removed_chars", n_chars).drop("spans")


@query(merkle.sql())
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return merkle.merkle_manifest(docs, claims={"n_chars": merkle.tampered()})


@query(secrets.sql())
def op12_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """From an empty ledger, so every content is scanned."""
    docs = table(spark, folder, "documents")
    ledger = secrets.BlobLedger(spark, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    return secrets.digest_columns(secrets.secret_scan(docs, ledger))


@query(repair.sql())
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns, copies = repair.damaged(table(spark, folder, "conversations"))
    return repair.conversation_repair(turns, copies=copies)
