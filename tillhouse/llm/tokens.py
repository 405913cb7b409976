"""Token counts through a digest cache.

Every text is known by the SHA-256 of its normalised content, and a tokenizer by the SHA-256 of its
file, so another file is another version. Counts are looked up by both digests in a cache table;
of the texts that are not there, each distinct one is encoded once, and its count is appended.

Normalisation reads a null as an empty text and changes nothing else, since the count depends on
every character. Digests are made by Spark; texts travel to the encoder only where the cache misses
them, keyed by row and digest, so a group of copies sends one of them.

Defined results: null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each.
Null doc_ids are kept. An empty table gives an empty result and appends nothing. Extra columns are
not read. Two jobs that append the same count leave two equal rows, which are read as one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import batch_rows, keep
from tillhouse.operators.joins import splittable_join

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


@cache
def _load(path: str):
    """A function from a list of texts to their token counts, once per worker."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]


def version(path: str) -> str:
    """The digest of a tokenizer's file."""
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def normalised(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version, each digest once; `path` must exist or be writable."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer") == tokenizer)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode(misses: DataFrame, tokenizer_path: str, tokenizer: str) -> DataFrame:
    """`misses` (digest, text) as rows of the cache."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _load(tokenizer_path)
        for frame in frames:
            yield pd.DataFrame(
                {"digest": frame["digest"], "tokenizer": tokenizer, "n_tokens": count(frame["text"].tolist())}
            )

    return misses.select("digest", "text").mapInPandas(run, CACHE_SCHEMA)


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of `docs`; new counts are appended at `cache_path`.

    `tokenizer_path` is a file that every worker has at the same place.
    """
    spark, tokenizer = docs.sparkSession, version(tokenizer_path)
    texts = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    digested = texts.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    rows = keep(
        digested.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "text-digests"
    )
    known = read_cache(spark, cache_path, tokenizer)
    # One row of each distinct text that the cache misses: the one with the smallest doc_id.
    wanted = rows.groupBy("digest").agg(F.min("doc_id").alias("id")).join(known, "digest", "left_anti")
    key = ["digest", "id"]
    met = digested.select("digest", _id(F.col("doc_id")).alias("id"), "text").join(wanted.select("digest", _id(F.col("id")).alias("id")), key)
    # Rows that repeat id and text meet as one of each task, however many they are.
    misses = met.dropDuplicates(key)
    with batch_rows(spark, 64):
        encode(misses.select("digest", "text"), tokenizer_path, tokenizer).write.mode("append").parquet(cache_path)
    counted = keep(read_cache(spark, cache_path, tokenizer), "token-counts")
    return splittable_join(rows, counted, "digest").select("doc_id", "n_bytes", "n_tokens")
