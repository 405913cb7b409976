"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import conversations, decontaminate, embeddings, extraction, licenses, lines, mixing, phrases, pii, simhash, tokens, toxicity, warc
from tillhouse.llm.common import ROW, ship
from tillhouse.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
TOKEN_LIMIT = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pseudonym_key(spark: SparkSession) -> str:
    """The secret in the session's setting `spark.tillhouse.pseudonym.key`; only local sessions do without."""
    key = spark.conf.get("spark.tillhouse.pseudonym.key", None)
    if key is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.tillhouse.pseudonym.key")
    return key or "not secret: for tests in a local session"


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allotment(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonym_key(spark))
    return found.select(F.col(f"{ROW}.doc_id").alias("doc_id"), "found.*")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return warc.round_trip(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    doc_id = F.col(f"{ROW}.doc_id")
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        doc_id.alias("doc_id"),
        toxicity.held_out(doc_id).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), shared_dir(spark, "llm-token-cache"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = lines.drop_boilerplate(pages, lines.host_of(F.col("url")), lines.visible_lines(F.col("html")))
    return found.select(F.col(f"{ROW}.page_id").alias("page_id"), "host", "n_lines", "n_dropped", "text")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    pages = table(spark, sf_dir, "pages")
    found = extraction.extract(pages.select("page_id", "url", "html"), extraction.train(pages))
    return found.select(f"{ROW}.page_id", f"{ROW}.url", "text", "n_chars")


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_mix, op2_licenses, op3_pseudonyms, op4_warc, op5_simhash,
            op6_embeddings, op7_toxicity, op8_decontaminate, op9_tokens, op10_lines,
            op11_phrases, op12_conversations, op13_main_text,
        )
    }
